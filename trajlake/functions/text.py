"""Text and label normalisers as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(c: Column) -> Column:
    """ASCII tokens of a text, lower-cased, in order."""
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), 0)


def normalized_query(c: Column) -> Column:
    return F.array_join(tokens(c), " ")


def label(c: Column, default: str = "") -> Column:
    """Trim, lower-case, dashes and spaces to underscores; blank gives the default."""
    out = F.translate(F.lower(F.trim(c)), "- ", "__")
    return F.coalesce(F.nullif(out, F.lit("")), F.lit(default))


def label_list(c: Column) -> Column:
    """Distinct normalised labels in order, blanks dropped."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(c, lambda x: label(x)), lambda x: x != "")))


def source_uri(c: Column) -> Column:
    """Scheme, host and path in lower case, without user, port, query, fragment, last slash or ``.git``."""
    bare = F.lower(F.regexp_replace(c, r"[?#].*$", ""))
    bare = F.regexp_replace(bare, r"^([a-z]+://)(?:[^/@]*@)?([^/:]*)(?::[0-9]+)?", "$1$2")
    return F.regexp_replace(F.regexp_replace(bare, r"/+$", ""), r"\.git$", "")


def redacted(c: Column, secrets: list[str]) -> Column:
    """Every secret replaced by a mark."""
    for s in secrets:
        c = F.replace(c, F.lit(s), F.lit("[redacted]"))
    return c
