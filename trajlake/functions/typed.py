"""Strict typed reading of JSON: a declared shape, no coercion, and the place of the first fault.

A shape is built of the kinds below and turned into one column expression over VARIANT: nothing runs row by row in Python.
A boolean is no number, 1.0 is no whole number, text is never parsed, and a number must be finite. Cases: a text that is null, no JSON, or holds a
key twice has the fault "$:json"; fields that the shape does not name may hold any JSON.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


def kind_of(v: Column) -> Column:
    """JSON type of a variant; empty where it is missing."""
    return F.coalesce(F.schema_of_variant(v), F.lit(""))


def _at(path: Column, code: str) -> Column:
    return F.concat(path, F.lit(f":{code}"))


@dataclass(frozen=True)
class Text:
    def fault(self, v: Column, path: Column) -> Column:
        return F.when(kind_of(v) != "STRING", _at(path, "text"))


@dataclass(frozen=True)
class Flag:
    def fault(self, v: Column, path: Column) -> Column:
        return F.when(kind_of(v) != "BOOLEAN", _at(path, "boolean"))


@dataclass(frozen=True)
class Whole:
    """A whole number of any size, not below ``least`` if that is given."""

    least: int | None = None

    def fault(self, v: Column, path: Column) -> Column:
        kind = kind_of(v)
        out = F.when(~((kind == "BIGINT") | kind.rlike(r"^DECIMAL\((19|[23]\d),0\)$")), _at(path, "whole"))
        return out if self.least is None else out.when(F.try_variant_get(v, "$", "decimal(38,0)") < self.least, _at(path, f"at_least_{self.least}"))


@dataclass(frozen=True)
class Number:
    def fault(self, v: Column, path: Column) -> Column:
        value = F.try_variant_get(v, "$", "double")
        return F.when(~kind_of(v).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$") | value.isNull() | F.isnan(value) | (F.abs(value) == float("inf")), _at(path, "number"))


@dataclass(frozen=True)
class Anything:
    def fault(self, v: Column, path: Column) -> Column:
        return F.lit(None).cast("string")


@dataclass(frozen=True)
class ListOf:
    item: object

    def fault(self, v: Column, path: Column) -> Column:
        items = F.try_variant_get(v, "$", "array<variant>")
        each = F.transform(items, lambda x, i: self.item.fault(x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        return F.when(~kind_of(v).startswith("ARRAY"), _at(path, "list")).otherwise(F.get(F.array_compact(each), F.lit(0)))


@dataclass(frozen=True)
class MapOf:
    """An object of any keys; they are taken in their order."""

    value: object

    def fault(self, v: Column, path: Column) -> Column:
        pairs = F.array_sort(F.map_keys(F.try_variant_get(v, "$", "map<string, variant>")))
        values = F.try_variant_get(v, "$", "map<string, variant>")
        each = F.transform(pairs, lambda k: self.value.fault(F.element_at(values, k), F.concat(path, F.lit("."), k)))
        return F.when(~kind_of(v).startswith("OBJECT"), _at(path, "object")).otherwise(F.get(F.array_compact(each), F.lit(0)))


@dataclass(frozen=True)
class Shape:
    """An object with named fields, checked in their order; those of ``optional`` may be missing, but not null."""

    fields: dict[str, object]
    optional: frozenset[str] = field(default_factory=frozenset)

    def fault(self, v: Column, path: Column) -> Column:
        each = []
        for name, kind in self.fields.items():
            value = F.try_variant_get(v, f"$.{name}", "variant")
            own = kind.fault(value, F.concat(path, F.lit(f".{name}")))
            each.append(F.when(value.isNotNull(), own) if name in self.optional else own)
        return F.when(~kind_of(v).startswith("OBJECT"), _at(path, "object")).otherwise(F.coalesce(*each))


def first_fault(raw: Column, shape: object) -> Column:
    """Path and expectation of a JSON text's first fault, in the shape's order; empty if there is none."""
    v = F.try_parse_json(raw)
    return F.when(v.isNull(), "$:json").otherwise(F.coalesce(shape.fault(v, F.lit("$")), F.lit("")))


EVIDENCE = Shape({"evaluator": Text(), "passed": Flag(), "score": Number(), "reason": Text(), "evidence": MapOf(Anything()), "infrastructure_failure": Flag()}, frozenset({"evidence", "infrastructure_failure"}))
TURN_REWARD = Shape({"turn_index": Whole(0), "event_id": Text(), "kind": Text(), "action_type": Text(), "reward": Number(), "reason": Text(), "evidence": MapOf(Anything())}, frozenset({"evidence"}))
#: What an evaluation report must be.
REPORT = Shape(
    {"scenario_instance_id": Text(), "success": Flag(), "reward": Whole(), "infrastructure_failure": Flag(), "results": ListOf(EVIDENCE), "metrics": MapOf(Number()), "turn_rewards": ListOf(TURN_REWARD)},
    frozenset({"metrics", "turn_rewards"}),
)
