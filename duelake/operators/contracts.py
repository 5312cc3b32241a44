"""Record contracts: per-column rules that gather into an error list.

A contract is applied to a frame, or to the struct elements of an array, and
yields typed columns plus ``array<string>`` of what is wrong.  Nothing runs per
row in Python; each rule is one ``when``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelake.functions import casting

ERRORS = "validation_errors"
BREAK = "\n"
_ABSENT = object()


class Value(NamedTuple):
    column: Column
    dtype: T.DataType


Lookup = Callable[[str], "Value | None"]


@dataclass(frozen=True)
class Rule:
    message: str
    broken: Callable[[Column], Column]


#: White space of every kind; the four separators count as such too.
BLANK = r"(?U)^[\s\x1c-\x1f]*$"

NOT_BLANK = Rule("must not be blank", lambda v: v.rlike(BLANK))
NOT_NEGATIVE = Rule("must not be negative", lambda v: v < 0)


@dataclass(frozen=True)
class Field:
    """One attribute of a record.

    ``kind`` is one of int, float, text, day, flag, id_or_text, texts.  A
    ``default`` is used only where the landed schema lacks the attribute; a
    null that is present counts as given.
    """

    name: str
    kind: str
    required: bool = False
    default: object = _ABSENT
    rules: tuple[Rule, ...] = ()

    def typed(self, value: Value) -> Column:
        column, source = value
        if self.kind == "int":
            return casting.whole_number(column, source)
        if self.kind == "float":
            return casting.real_number(column, source)
        if self.kind == "day":
            return casting.calendar_day(column, source)
        if self.kind == "flag":
            return casting.truth_value(column, source)
        if self.kind == "texts":
            return column.cast("array<string>")
        return column.cast("string")

    def resolve(self, lookup: Lookup) -> Value:
        found = lookup(self.name)
        if found is not None:
            return found
        if self.default is _ABSENT:
            return Value(F.lit(None).cast("string"), T.StringType())
        if self.kind == "texts":
            return Value(F.array().cast("array<string>"), T.ArrayType(T.StringType()))
        literal = F.lit(self.default)
        return Value(literal, T.BooleanType() if isinstance(self.default, bool) else T.StringType())

    def checks(self, lookup: Lookup) -> list[Column]:
        value = self.resolve(lookup)
        raw, typed = value.column, self.typed(value)
        found = []
        if self.required:
            found.append(F.when(raw.isNull(), F.lit(f"{self.name}: required")))
        if self.kind in ("int", "float", "day", "flag"):
            bad = raw.isNotNull() & typed.isNull()
            found.append(F.when(bad, F.lit(f"{self.name}: not a valid {self.kind}")))
        if self.kind == "texts":
            found.append(F.when(F.exists(typed, lambda x: x.isNull()), F.lit(f"{self.name}: null element")))
        found += [F.when(rule.broken(typed), F.lit(f"{self.name}: {rule.message}")) for rule in self.rules]
        return found


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    nested: dict[str, "Contract"] = field(default_factory=dict)

    def problems(self, lookup: Lookup) -> Column:
        """All broken rules as lines of text; empty when there are none.

        Joining text skips nulls within generated code; compacting an array of
        messages would be interpreted for every row.
        """
        checks = [c for f in self.fields for c in f.checks(lookup)]
        for name, inner in self.nested.items():
            value = lookup(name)
            if value is None:
                checks.append(F.lit(f"{name}: required"))
                continue
            inside = inner.problems(struct_lookup(value.column, value.dtype))
            prefixed = F.concat(F.lit(f"{name}."), F.replace(inside, F.lit(BREAK), F.lit(f"{BREAK}{name}.")))
            checks.append(
                F.when(value.column.isNull(), F.lit(f"{name}: required")).when(inside != "", prefixed)
            )
        return F.concat_ws(BREAK, *checks)

    def errors(self, lookup: Lookup) -> Column:
        """The broken rules as an array."""
        text = self.problems(lookup)
        return F.when(text != "", F.split(text, BREAK)).otherwise(F.array().cast("array<string>"))

    def record(self, lookup: Lookup) -> list[Column]:
        out = [f.typed(f.resolve(lookup)).alias(f.name) for f in self.fields]
        for name, inner in self.nested.items():
            value = lookup(name)
            if value is None:
                value = Value(F.lit(None).cast("struct<name:string>"), T.StructType([T.StructField("name", T.StringType())]))
            body = F.struct(*inner.record(struct_lookup(value.column, value.dtype)))
            out.append(F.when(value.column.isNotNull(), body).alias(name))
        return out

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields] + list(self.nested)


def frame_lookup(df: DataFrame) -> Lookup:
    return lambda name: Value(F.col(f"`{name}`"), df.schema[name].dataType) if name in df.columns else None


def struct_lookup(parent: Column, dtype: T.DataType) -> Lookup:
    return lambda name: Value(parent[name], dtype[name].dataType) if name in dtype.fieldNames() else None


def validate(df: DataFrame, contract: Contract, carry: tuple[str, ...] = ()) -> DataFrame:
    """The carried columns, typed contract columns, the errors, and the original.

    ``original_payload`` is the record as landed, as JSON, kept for rows with
    errors only.

    The record is built as one struct and inlined, one row in and one row out.
    As plain columns, a filter on the errors would be pushed below them, and
    the optimizer's constraint inference would then try every combination of
    the casts that both the filter and the columns contain.
    """
    lookup = frame_lookup(df)
    given = [F.col(f"`{c}`") for c in contract.columns if c in df.columns]
    original = F.to_json(F.struct(*given), {"ignoreNullFields": "false"})
    errors = contract.errors(lookup)
    record = F.struct(
        *contract.record(lookup),
        errors.alias(ERRORS),
        F.when(F.size(errors) > 0, original).alias("original_payload"),
    )
    return df.select(*carry, record.alias("record")).select(*carry, F.inline(F.array("record")))


def accepted(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.size(ERRORS) == 0).drop(ERRORS, "original_payload")


def rejected(flagged: DataFrame, key: str) -> DataFrame:
    """The quarantine envelope of every record with errors."""
    return flagged.where(F.size(ERRORS) > 0).select(F.col(key).alias("record_key"), "original_payload", ERRORS)


def valid_members(array: Column, dtype: T.ArrayType, contract: Contract, extra: dict[str, Value]) -> Column:
    """The typed members of an array that satisfy the contract; the others go."""

    def lookup(member: Column) -> Lookup:
        inside = struct_lookup(member, dtype.elementType)
        return lambda name: extra.get(name) or inside(name)

    kept = F.filter(array, lambda m: m.isNotNull() & ((contract.problems(lookup(m)) == "")))
    return F.transform(kept, lambda m: F.struct(*contract.record(lookup(m))))


def tally(flagged: DataFrame, record_type: str) -> DataFrame:
    """Valid and invalid attempts of one record type."""
    return flagged.agg(
        F.lit(record_type).alias("record_type"),
        F.count_if(F.size(ERRORS) == 0).alias("valid"),
        F.count_if(F.size(ERRORS) > 0).alias("invalid"),
    )
