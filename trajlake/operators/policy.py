"""Decisions on requested tool calls: which tools, paths, networks and installations a session may use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parts of arguments that reach beyond the workspace, and parts of commands that reach a network.
FORBIDDEN_PATHS = ("..", "/etc/", "/var/run/docker.sock")
NETWORK = ("curl ", "wget ", "http://", "https://")
# Installers that always fetch, those that fetch on some words, and words that keep pip local.
SYSTEM_INSTALLERS = ("apt", "apt-get", "apk", "yum", "dnf", "brew")
NODE_INSTALLERS, NODE_WORDS = ("npm", "pnpm", "yarn"), ("install", "add")
PIP, PYTHON, LOCAL = ("pip", "pip3"), ("python", "python3"), ("--no-index", "--no-deps")


def command_words(arguments: Column) -> Column:
    """Words of a command in JSON arguments as texts; none if it is no list."""
    words = F.try_variant_get(F.try_parse_json(arguments), "$.command", "array<variant>")
    return F.coalesce(F.transform(words, lambda w: F.coalesce(F.try_variant_get(w, "$", "string"), F.lit("None"))), F.array().cast("array<string>"))


def fetches(words: Column) -> Column:
    """Whether a command would install packages from a network."""
    first, line = F.coalesce(F.get(words, F.lit(0)), F.lit("")), F.array_join(words, " ")
    local = F.arrays_overlap(words, F.array(*[F.lit(w) for w in LOCAL]))
    pip = F.when(first.isin(*PIP) & F.contains(F.concat(F.lit(" "), line, F.lit(" ")), F.lit(" install ")), ~local)
    module = F.when(first.isin(*PYTHON) & (F.coalesce(F.get(words, F.lit(1)), F.lit("")) == "-m") & (F.coalesce(F.get(words, F.lit(2)), F.lit("")) == "pip"), F.array_contains(words, "install") & ~local)
    node = first.isin(*NODE_INSTALLERS) & F.arrays_overlap(words, F.array(*[F.lit(w) for w in NODE_WORDS]))
    return F.coalesce(pip, module, node | first.isin(*SYSTEM_INSTALLERS))


def decisions(calls: DataFrame, tools: tuple[str, ...], network: bool = False) -> DataFrame:
    """event_id, decision and reason, of the first rule that fits: tool not enabled, path beyond the workspace, network, installation, else allowed.

    calls: event_id, tool, arguments (JSON). Paths are looked for in the arguments with their escapes resolved, in names as well as in values.
    Cases: a null tool is not enabled; arguments that are null or no JSON hold nothing and have no command; a session with network skips the last two rules.
    """
    v = F.try_parse_json("arguments")
    plain = F.coalesce(F.to_json(v), F.lit(""))
    words = command_words(F.col("arguments"))
    line = F.array_join(words, " ")

    def holds(c: Column, parts: tuple[str, ...]) -> Column:
        out = F.lit(False)
        for p in parts:
            out = out | F.contains(c, F.lit(p))
        return out

    shut = F.lit(not network) & (F.col("tool") == "run_command")
    reason = (
        F.when(~F.coalesce(F.col("tool").isin(*tools), F.lit(False)), "tool_not_enabled")
        .when(holds(plain, FORBIDDEN_PATHS), "forbidden_host_path")
        .when(shut & holds(line, NETWORK), "network_disabled")
        .when(shut & fetches(words), "package_installation")
        .otherwise("allowed")
    )
    return calls.select("event_id", reason.alias("reason")).select("event_id", F.when(F.col("reason") == "allowed", "allow").otherwise("deny").alias("decision"), "reason")
