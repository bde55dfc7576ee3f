"""Content ids: SHA-256 over canonical JSON, exact for any value, and forbidden keys of nested JSON."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf


def canonical_json(raw: Column) -> Column:
    """Keys sorted, no spaces, non-ASCII escaped; null where the text is no JSON. An Arrow UDF: SQL lacks the number format."""

    @pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(text: str | None) -> str | None:
            try:
                return None if text is None else json.dumps(json.loads(text), sort_keys=True, ensure_ascii=True, separators=(",", ":"))
            except ValueError:
                return None

        for s in batches:
            yield s.map(one)

    return run(raw)


def stable_id(prefix: str, raw: Column, digits: int = 16) -> Column:
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(canonical_json(raw), 256), 1, digits))


def keys_anywhere(raw: Column) -> Column:
    """Names of all fields of a JSON text at any depth, escapes resolved; null where the text is no JSON.

    Blanks that are written as escapes become blanks, other escaped characters (quotes, backslashes, controls) a mark. No pattern
    repeats a group, so texts of any length are read without recursion.
    """
    plain = F.regexp_replace(F.regexp_replace(F.to_json(F.try_parse_json(raw)), r"\\[nrt]", " "), r"\\(?:u[0-9a-fA-F]{4}|.)", "\x01")
    strings = F.regexp_extract_all(plain, F.lit(r'"[^"]*"(?:\s*:)?'), 0)  # whole strings one after the other
    return F.transform(F.filter(strings, lambda s: s.endswith(":")), lambda s: F.regexp_replace(s, r'^"|"\s*:$', ""))


def has_key(raw: Column, names: list[str]) -> Column:
    """Whether any object inside the JSON text has one of the keys (case, dashes, underscores and blanks do not matter); false where the text is no JSON."""
    keys = F.transform(keys_anywhere(raw), lambda k: F.regexp_replace(F.lower(k), "[-_ ]", ""))
    return F.coalesce(F.arrays_overlap(keys, F.array(*[F.lit(n.lower().replace("_", "")) for n in names])), F.lit(False))
