"""Fields of dynamic records as Column functions: lists, timestamps, sizes, images, labels and seed keys.

A field that cannot be read gives null (or -1 for a size), never an error; null counts as missing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms in the name of a field that make it secret-like.
SECRET_TERMS = ("api_key", "apikey", "password", "secret", "token", "credential")
#: Source formats whose records are repairs of bugs.
BUG_FORMATS = ("swe_bench", "swe_smith", "multi_swe")


def normal_label(c: Column) -> Column:
    """Trimmed, in lower case, dashes and spaces as underscores; null counts as empty."""
    return F.translate(F.lower(F.trim(F.coalesce(c.cast("string"), F.lit("")))), "- ", "__")


def normal_source(c: Column) -> Column:
    return F.replace(normal_label(c), F.lit("__"), F.lit("/"))


def distinct_in_order(c: Column) -> Column:
    """An array's values without repeats, each where it first stands."""
    return F.array_distinct(c)


def list_field(c: Column) -> Column:
    """Texts of a field that may be missing, a JSON list or values between commas; blanks are dropped.

    Of a JSON list, null items and blank ones are dropped and other scalars stand as text, true and false
    with a capital. A text that begins like a list and is none gives null.
    """
    text = F.trim(F.coalesce(c, F.lit("")))

    def item(v: Column) -> Column:
        plain = F.try_variant_get(v, "$", "string")
        return F.trim(F.coalesce(F.when(F.schema_of_variant(v) == "BOOLEAN", F.initcap(plain)).otherwise(plain), F.lit("")))

    listed = F.filter(F.transform(F.try_variant_get(F.try_parse_json(text), "$", "array<variant>"), item), lambda x: x != "")
    cut = F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(text == "", F.array().cast("array<string>")).when(text.startswith("["), listed).otherwise(cut)


def canonical_timestamp(c: Column) -> Column:
    """An ISO-8601 time with a zone, as UTC text with Z; null if it cannot be read or has no zone."""
    form = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2})(:\d{2}(?:\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})$"
    part = [F.regexp_extract(c, form, k) for k in range(1, 5)]
    local = F.concat(part[0], F.lit(" "), part[1], F.when(part[2] == "", ":00").otherwise(part[2])).try_cast("timestamp_ntz")
    sign = F.when(F.startswith(part[3], F.lit("-")), -1).otherwise(1)
    minutes = F.when(part[3] == "Z", 0).otherwise(sign * (F.substring(part[3], 2, 2).try_cast("int") * 60 + F.substring(part[3], 5, 2).try_cast("int")))
    utc = local - F.make_dt_interval(F.lit(0), F.lit(0), minutes)
    whole = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss")
    micro = F.date_format(utc, "SSSSSS")
    return F.when(c.rlike(form) & (F.abs(minutes) < 1440), F.concat(whole, F.when(micro != "000000", F.concat(F.lit("."), micro)).otherwise(""), F.lit("Z")))


def memory_bytes(c: Column) -> Column:
    """Bytes of a size such as 512m; -1 if it has no unit or no number."""
    text = F.lower(F.trim(c))
    unit = F.when(text.endswith("b"), 1).when(text.endswith("k"), 1 << 10).when(text.endswith("m"), 1 << 20).when(text.endswith("g"), 1 << 30)
    number = F.regexp_extract(text, r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?)\s*[bkmg]$", 1).try_cast("double")
    return F.coalesce((number * unit).cast("long"), F.lit(-1).cast("long"))


def immutable_image(c: Column) -> Column:
    """Whether an image is named by its content."""
    return F.coalesce(c.contains("@sha256:") | c.rlike("^sha256:[0-9a-fA-F]{64}$"), F.lit(False))


def secret_keys(c: Column) -> Column:
    """Names of a map's fields that look like secrets, in order."""

    def secret(k: Column) -> Column:
        plain = F.replace(F.lower(k), F.lit("-"), F.lit("_"))
        found = F.lit(False)
        for term in SECRET_TERMS:
            found = found | plain.contains(term)
        return found

    return F.array_sort(F.filter(F.map_keys(c), secret))


def seed_language(tags: Column, otherwise: Column) -> Column:
    """The first ``language:`` tag, else a seed's own field."""
    tagged = F.get(F.filter(tags, lambda t: t.startswith("language:")), F.lit(0))
    return normal_label(F.coalesce(F.substr(tagged, F.lit(10)), otherwise))


def seed_repository(context: Column, metadata: Column) -> Column:
    return normal_source(F.coalesce(F.nullif(context, F.lit("")), metadata))


def source_instance_key(name: Column, provenance: Column, instance: Column) -> Column:
    """``source:instance``; empty if one is missing. A seed without a source's name has it before the colon of its provenance."""
    source = F.coalesce(F.nullif(name, F.lit("")), F.substring_index(provenance, ":", 1), F.lit(""))
    instance = F.coalesce(instance, F.lit(""))
    return F.when((source == "") | (instance == ""), "").otherwise(F.concat(normal_source(source), F.lit(":"), normal_label(instance)))


def default_family(family: Column, source_format: Column) -> Column:
    return F.when(normal_label(family) != "", normal_label(family)).when(source_format.isin(*BUG_FORMATS), "bug_repair").otherwise("software_engineering")


def default_method(source_format: Column) -> Column:
    return F.when(source_format == "swe_smith", "synthetic_issue_workspace").otherwise("external_issue_workspace")


def goal_satisfied(text: Column, key: Column, description: Column) -> Column:
    """Whether a text names a goal by its key, its key with spaces, or its description."""
    low = F.lower(text)
    named = [F.lower(key), F.replace(F.lower(key), F.lit("_"), F.lit(" ")), F.lower(description)]
    out = F.lit(False)
    for n in named:
        out = out | F.coalesce((n != "") & low.contains(n), F.lit(False))
    return out


def evaluators(test_patch: Column, hidden_tests: Column, required: Column, forbidden: Column, retrieval: Column, rubric: Column) -> Column:
    """Evaluators that a scenario asks for, in order; one hidden_command for each hidden test."""
    one = F.array_compact(F.array(F.when(F.coalesce(test_patch, F.lit("")) != "", "hidden_test_patch")))
    commands = F.transform(F.coalesce(hidden_tests, F.array().cast("array<string>")), lambda _: F.lit("hidden_command"))

    def some(c: Column) -> Column:
        return F.coalesce(F.size(c) > 0, F.lit(False))

    rest = F.array_compact(F.array(F.when(some(required), "required_state"), F.when(some(forbidden), "forbidden_state"), F.when(some(retrieval) | some(rubric), "trace_requirements")))
    return F.concat(one, commands, rest)
