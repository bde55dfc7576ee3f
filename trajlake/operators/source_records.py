"""Checks of public source records that stand as JSON: required fields under any of their names, URLs, and why a record is not curated.

records: position and raw. A field counts as missing if it is null, blank, or of another kind than expected. Cases: a raw that is null
or no JSON object has no fields, so that every required one is missing; repeated rows repeat their codes; an empty table has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.functions.text import label

# Names under which a record may hold a field, the first that is not blank counting.
REPOSITORY = ("repository", "repo", "full_name")
OWNER = ("org", "owner")
URL = ("source_url", "html_url", "issue_url", "pull_request_url", "url")
REVISION = ("source_revision", "base_commit", "base_sha", "commit")
INSTANCE = ("source_instance_id", "instance_id", "issue_id", "pull_request_id", "id")
NUMBER = ("number", "issue_number", "pr_number")
# Fields that hold evidence of a verifier, as lists and as objects.
VERIFIER_LISTS = ("test_commands", "build_commands", "ci_commands", "doctest_commands", "benchmark_commands", "adversarial_tests", "diff_constraints", "hidden_tests")
VERIFIER_OBJECTS = ("required_state", "forbidden_state", "performance_threshold")
# What marks a URL that is not public, anywhere in a record.
PRIVATE = ("http://localhost", "https://localhost", "http://127.0.0.1", "https://127.0.0.1", "http://go/", "https://go/", "ssh://", "git@")
# Fields that hold a benchmark's answer, and where a record may name the set it comes from.
ORACLE = ("patch", "test_patch", "reference_patch", "oracle_patch", "FAIL_TO_PASS", "PASS_TO_PASS", "fail_to_pass", "pass_to_pass")
ORIGIN = ("source_name", "source_format", "dataset", "benchmark", "source", "metadata.source_name", "metadata.source_format", "metadata.dataset", "metadata.benchmark")
# Labels of the kinds of public sources.
KINDS = {"public_issue": ("issue", "issues", "public_issue"), "public_pr": ("pr", "prs", "pull_request", "pull_requests", "public_pr"), "public_ci": ("ci", "ci_failure", "ci_failures", "workflow_run", "workflow_runs", "public_ci")}


def public_kind(c: Column) -> Column:
    """Kind of a public source from any of its labels; an unknown label stays as it is."""
    own = label(c)
    out = own
    for kind, names in KINDS.items():
        out = F.when(own.isin(*names), kind).otherwise(out)
    return out


class Fields:
    """Fields of a parsed JSON value as expressions."""

    def __init__(self, v: Column):
        self.v = v

    def at(self, path: str) -> Column:
        return F.try_variant_get(self.v, f"$.{path}", "variant")

    def kind(self, path: str) -> Column:
        return F.coalesce(F.schema_of_variant(self.at(path)), F.lit(""))

    def text(self, *names: str) -> Column:
        """The first of the fields that is a text or a number and not blank, trimmed; empty if none is."""
        each = []
        for n in names:
            plain = self.kind(n).rlike("^(STRING|BIGINT|DECIMAL.*|DOUBLE)$")
            each.append(F.nullif(F.when(plain, F.trim(F.try_variant_get(self.v, f"$.{n}", "string"))), F.lit("")))
        return F.coalesce(*each, F.lit(""))

    def listed(self, name: str) -> Column:
        """Whether a field is a text or a list with something in it."""
        items = F.try_variant_get(self.v, f"$.{name}", "array<variant>")
        some = F.exists(items, lambda x: F.coalesce(F.coalesce(F.try_variant_get(x, "$", "string"), F.to_json(x)) != "", F.lit(False)))
        return F.when(self.kind(name) == "STRING", self.text(name) != "").otherwise(F.coalesce(some, F.lit(False)))

    def filled(self, name: str) -> Column:
        """Whether a field is an object with something in it."""
        return self.kind(name).startswith("OBJECT") & (F.coalesce(F.size(F.try_variant_get(self.v, f"$.{name}", "map<string, variant>")), F.lit(0)) > 0)


def repository(f: Fields) -> Column:
    joined = F.when((f.text(*OWNER) != "") & (f.text("name") != ""), F.concat_ws("/", f.text(*OWNER), f.text("name"))).otherwise("")
    return F.regexp_replace(F.lower(F.coalesce(F.nullif(f.text(*REPOSITORY), F.lit("")), joined)), r"^/+|/+$", "")


def instance_id(own: str = "own", repository: str = "repository", kind: str = "kind", number: str = "number", url: str = "url") -> Column:
    """The record's id, one made of repository, kind and number, or its URL; all are columns."""
    between = F.when(F.col(kind) == "public_pr", "-pr-").when(F.col(kind) == "public_ci", "-ci-").otherwise("-issue-")
    made = F.when((F.col(repository) != "") & (F.col(number) != ""), F.concat(F.replace(F.col(repository), F.lit("/"), F.lit("__")), between, F.col(number)))
    return F.coalesce(F.nullif(F.col(own), F.lit("")), made, F.col(url))


def public_url(url: Column) -> Column:
    host = F.regexp_extract(url, r"^(?i:https?)://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.contains(host, F.lit("."))


def record_issues(records: DataFrame) -> DataFrame:
    """position, source_instance_id and code of each of twelve checks that a record fails."""
    read = records.select("position", F.try_parse_json("raw").alias("_v"))
    f = Fields(F.col("_v"))
    # step by step, so that no expression holds the parsing of another and all stay in generated code
    read = read.withColumns({"title": f.text("title"), "body": f.text("body"), "license": f.text("license"), "language": f.text("language"), "url": f.text(*URL), "revision": f.text(*REVISION), "labels": f.listed("labels")})
    read = read.withColumns({"repository": repository(f), "number": f.text(*NUMBER), "own": f.text(*INSTANCE), "kind": public_kind(f.text("source_type", "type", "kind"))})
    read = read.withColumns({"lists": F.array(*[f.listed(n) for n in VERIFIER_LISTS]), "objects": F.array(*[f.filled(n) for n in VERIFIER_OBJECTS]), "text": F.lower(F.coalesce(F.to_json("_v"), F.lit("")))})
    read = read.withColumns({"private": F.exists(F.array(*[F.lit(p) for p in PRIVATE]), lambda p: F.contains("text", p)), "source_instance_id": instance_id()})
    c = F.col
    failed = {
        "missing_repository": c("repository") == "",
        "missing_title": c("title") == "",
        "missing_body": c("body") == "",
        "missing_labels": ~c("labels"),
        "missing_license": c("license") == "",
        "missing_language": c("language") == "",
        "missing_source_instance_id": c("source_instance_id") == "",
        "missing_candidate_verifier": ~F.exists(F.concat("lists", "objects"), lambda x: x),
        "missing_source_url": c("url") == "",
        "missing_fixed_revision": ~c("revision").rlike("^[0-9a-fA-F]{40}$"),
        "non_public_source_url": (c("url") != "") & ~public_url(c("url")),
        "private_url": c("private"),
    }
    codes = F.array_compact(F.array(*[F.when(when, F.lit(code)) for code, when in failed.items()]))
    return read.select("position", "source_instance_id", F.explode(codes).alias("code"))


def rejections(records: DataFrame, accepted: tuple[str, ...] = ("public_issue", "public_pr"), host: str = "github.com") -> DataFrame:
    """position and rejection_code: the first rule by which a record is not curated for a hidden test patch, empty if none does.

    In order: another kind of source, a required public field missing, a revision that is not fixed, a benchmark as origin, a field
    that holds a benchmark's answer, a URL on another host.
    """
    records = records.select("position", "raw", F.try_parse_json("raw").alias("_v"))
    f = Fields(F.col("_v"))
    kind = public_kind(f.text("source_type", "type", "source_format", "collection_source"))
    needed = F.array(*[f.text(n) for n in ("repository", "source_revision", "source_instance_id", "source_url", "title")])
    lacking = F.array_contains(needed, "")
    tags = F.transform(F.coalesce(F.try_variant_get(f.v, "$.contamination_tags", "array<variant>"), F.array().cast("array<variant>")), lambda x: label(F.coalesce(F.try_variant_get(x, "$", "string"), F.lit(""))))
    origin = F.exists(F.concat(F.array(*[label(f.text(n)) for n in ORIGIN]), tags), lambda x: F.contains(x, F.lit("swe_bench")))
    oracle = F.arrays_overlap(F.coalesce(F.json_object_keys("raw"), F.array().cast("array<string>")), F.array(*[F.lit(n) for n in ORACLE]))
    here = f.text("source_url").startswith(f"https://{host}/") | f.text("source_url").startswith(f"http://{host}/")
    code = (
        F.when(~kind.isin(*accepted), "unsupported_source_type")
        .when(lacking, "missing_required_public_source_fields")
        .when(~f.text("source_revision").rlike("^[0-9a-fA-F]{40}$"), "invalid_source_revision")
        .when(origin, "benchmark_source_rejected")
        .when(oracle, "oracle_fields_rejected")
        .when(~here, "other_source_url")
        .otherwise("")
    )
    return records.select("position", code.alias("rejection_code"))
