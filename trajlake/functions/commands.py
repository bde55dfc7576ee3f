"""Test commands from a template and test ids, and the verifiers that a record has, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trajlake.functions.text import label


def shell_quoted(c: Column) -> Column:
    """A text as one word of a POSIX shell."""
    plain = c.rlike(r"\A[A-Za-z0-9_@%+=:,./-]+\z")
    return F.when(plain, c).otherwise(F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("'\"'\"'")), F.lit("'")))


def test_id_fault(c: Column) -> Column:
    """Why a test id is refused: it would be read as an option, or holds a control character that ends a line or a text; else null."""
    return F.when(c.isNull(), "missing_test_id").when(c.startswith("-"), "option").when(c.rlike(r"[\x00\n\r]"), "control_character")


def test_commands(ids: Column, template: Column) -> Column:
    """A struct of ``commands``, distinct and in order, and ``fault``: that of the first refused id, or of the template.

    ``{test}`` in the template stands for the quoted id without its parameters (all from the first "["), ``{{`` and ``}}`` for
    braces. Cases: a null or empty template gives no commands and no fault; null ids give none; with a fault there are none.
    """
    marked = F.replace(F.replace(template, F.lit("{{"), F.lit("\x01")), F.lit("}}"), F.lit("\x02"))
    odd = F.regexp_replace(marked, r"\{test\}", "").rlike(r"[{}]")

    def command(c: Column) -> Column:
        put = F.replace(marked, F.lit("{test}"), shell_quoted(F.substring_index(c, "[", 1)))
        return F.translate(put, "\x01\x02", "{}")

    own = F.coalesce(ids, F.array().cast("array<string>"))
    fault = F.coalesce(F.get(F.array_compact(F.transform(own, test_id_fault)), F.lit(0)), F.when(odd & (F.size(own) > 0), "template"), F.lit(""))
    blank = F.coalesce(template, F.lit("")) == ""
    none = F.array().cast("array<string>")
    fault = F.when(blank, "").otherwise(fault)
    return F.struct(F.when(blank | (fault != ""), none).otherwise(F.array_distinct(F.transform(own, command))).alias("commands"), fault.alias("fault"))


# Kinds of verifiers with the fields that hold their commands; of the hidden ones the first that is there counts.
GROUPS = {"adversarial_test": "adversarial_tests", "benchmark_command": "benchmark_commands", "build_command": "build_commands", "doctest": "doctest_commands", "example_command": "example_commands"}
HIDDEN, TEST_IDS = ("hidden_tests", "test_commands", "eval_commands"), ("FAIL_TO_PASS", "fail_to_pass", "test_ids")
# Kinds of verifiers that a field of any content stands for, of a filled object, of a filled list, of a filled text.
BY_PRESENCE = {"performance_threshold": "performance_threshold", "trace_quality_rubric": "trace_quality"}
BY_OBJECT = {"required_state": "required_state", "forbidden_state": "forbidden_state"}
BY_LIST = {"diff_constraints": "diff_constraint", "retrieval_requirements": "retrieval_evidence"}
BY_TEXT = {"patch": "reference_patch", "test_patch": "hidden_test_patch"}


def _field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def listed(v: Column, *names: str) -> Column:
    """The first of a JSON object's fields that is not null, as a list of texts without empty ones."""
    each = []
    for n in names:
        kind = F.coalesce(F.schema_of_variant(_field(v, n)), F.lit(""))
        items = F.transform(F.try_variant_get(v, f"$.{n}", "array<variant>"), lambda x: F.trim(F.coalesce(F.try_variant_get(x, "$", "string"), F.lit(""))))
        text = F.array(F.trim(F.try_variant_get(v, f"$.{n}", "string")))
        each.append(F.when(kind == "STRING", text).when(kind.startswith("ARRAY"), items).when(~kind.isin("", "VOID"), F.array().cast("array<string>")))
    return F.filter(F.coalesce(*each, F.array().cast("array<string>")), lambda x: x != "")


def command_groups(v: Column, template: Column) -> Column:
    """Kinds of verifiers with their commands, by kind: an array of structs (verifier_type, commands), without empty ones.

    ``v`` is a record as VARIANT; hidden commands are those it holds and those of its test ids by ``template``, none of these if one
    id is refused. Commands are distinct within a kind, in order.
    """
    hidden = F.concat(listed(v, *HIDDEN), test_commands(listed(v, *TEST_IDS), template)["commands"])
    kinds = {**{k: listed(v, f) for k, f in GROUPS.items()}, "hidden_command": hidden}
    each = F.array(*[F.struct(F.lit(k).alias("verifier_type"), F.array_distinct(kinds[k]).alias("commands")) for k in sorted(kinds)])
    return F.filter(each, lambda g: F.size(g["commands"]) > 0)


def all_commands(groups: Column) -> Column:
    """The commands of all kinds, each once, in order of kind."""
    return F.array_distinct(F.flatten(F.transform(groups, lambda g: g["commands"])))


def verifier_types(v: Column, groups: Column) -> Column:
    """Sorted labels of the verifiers that a record names, has commands of, or holds the means of."""

    def some(n: str) -> Column:
        return F.coalesce(F.schema_of_variant(_field(v, n)), F.lit("VOID")) != "VOID"

    def filled(n: str) -> Column:
        return F.coalesce(F.size(F.try_variant_get(v, f"$.{n}", "map<string, variant>")), F.lit(0)) > 0

    marks = [F.when(some(n), F.lit(k)) for n, k in BY_PRESENCE.items()] + [F.when(filled(n), F.lit(k)) for n, k in BY_OBJECT.items()] + [F.when(F.size(listed(v, n)) > 0, F.lit(k)) for n, k in (BY_LIST | BY_TEXT).items()]
    named = F.concat(listed(v, "verifier_types"), F.transform(groups, lambda g: g["verifier_type"]), F.array_compact(F.array(*marks)))
    return F.array_sort(F.array_distinct(F.transform(named, lambda x: label(x))))


def coverage_tags(v: Column, family: Column, source_format: Column, repository: Column, types: Column, more: Column) -> Column:
    """Sorted distinct tags of a record: its own, further ones, and those of family, format, verifiers, repository and language."""
    language = F.element_at(F.concat(listed(v, "language"), F.array(F.lit(""))), 1)
    made = F.array(F.concat(F.lit("task_family:"), family), F.concat(F.lit("source_format:"), source_format), F.when(repository != "", F.concat(F.lit("repo:"), repository)), F.when(language != "", F.concat(F.lit("language:"), language)))
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(listed(v, "coverage_tags"), more, made, F.transform(types, lambda t: F.concat(F.lit("verifier:"), t))))))


# names that pytest would otherwise take for tests when they are imported into one
test_id_fault.__test__ = test_commands.__test__ = False
