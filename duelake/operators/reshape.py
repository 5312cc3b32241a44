"""Flattening, widening and unpivoting of nested and two-sided rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelake.fixed_values import UNKNOWN


def flatten_struct(df: DataFrame, parent: str, fields: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """Lift struct fields to columns; a null struct gives null columns.

    ``fields`` maps output name to (field, type or None for no cast).
    """
    lifted = {}
    for out, (field, dtype) in fields.items():
        value = F.col(f"{parent}.{field}")
        lifted[out] = value.cast(dtype) if dtype else value
    return df.withColumns(lifted)


def unpivot_sides(
    df: DataFrame,
    shared: Sequence[str],
    sides: Sequence[Mapping[str, Column]],
    present: str,
) -> DataFrame:
    """One row per side from one scan of the two-sided table.

    ``sides`` gives, for each side, the output columns as expressions; rows
    whose ``present`` column is null name no side and are left out.
    """
    packed = F.array(*[F.struct(*[c.alias(n) for n, c in side.items()]) for side in sides])
    return df.select(*shared, F.inline(packed)).where(F.col(present).isNotNull())


def positional(array: Column, index: int) -> Column:
    """Array element by position; null when the array is shorter."""
    return F.get(array, F.lit(index))


def has_field(dtype: T.DataType, path: str) -> bool:
    """Whether a landed schema carries ``path``, looking through structs and arrays."""
    for part in path.split("."):
        while isinstance(dtype, T.ArrayType):
            dtype = dtype.elementType
        if not isinstance(dtype, T.StructType) or part not in dtype.fieldNames():
            return False
        dtype = dtype[part].dataType
    return True


def attribute(df: DataFrame, name: str, default=None) -> Column:
    """A column, or the default when the frame does not carry it at all.

    A null that is present stays null; only absence takes the default.
    """
    if name in df.columns:
        return F.col(name)
    return default if isinstance(default, Column) else F.lit(default)


def action_list(schema: T.StructType, lists: Mapping[str, str]) -> Column:
    """All action arrays of a match as one array, tagged with their type.

    ``lists`` maps array column to action type, in the order actions count.  Items that lack a team have
    the default one; a team that is there and null stays null, for the contract to reject.
    """
    none = F.array().cast("array<struct<action_type:string,team:string,map:string>>")

    def tag(column: str, kind: str):
        def part(item: Column, name: str, default: Column) -> Column:
            return item[name] if has_field(schema, f"{column}.{name}") else default

        return lambda item: F.struct(
            F.lit(kind).alias("action_type"),
            part(item, "team", F.lit(UNKNOWN)).cast("string").alias("team"),
            part(item, "map", F.lit(None)).cast("string").alias("map"),
        )

    tagged = [F.coalesce(F.transform(F.col(column), tag(column, kind)), none) for column, kind in lists.items()]
    return F.concat(*tagged)


def explode_actions(df: DataFrame, lists: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """One row per action with a running index over all lists of the match."""
    return df.select(*keep, F.posexplode(action_list(df.schema, lists)).alias("action_idx", "item")).select(
        *keep, "action_idx", "item.action_type", "item.team", "item.map"
    )


def explode_maps(df: DataFrame, keep: Sequence[str], fields: Sequence[str], maps: str = "maps") -> DataFrame:
    """One row per map of a match payload: its zero-based index and some of its fields.

    Fields are taken as arrays and zipped, so the scan reads their columns and
    not whole map payloads.  Fields the landed schema lacks come out null.
    """
    have = [f for f in fields if has_field(df.schema, f"{maps}.{f}")]
    zipped = F.arrays_zip(*[F.col(f"{maps}.{f}") for f in have])
    return df.select(*keep, F.posexplode(zipped).alias("map_index", "m")).select(
        *keep, "map_index", *[(F.col("m")[f] if f in have else F.lit(None)).alias(f) for f in fields]
    )


def explode_values(df: DataFrame, array: str, name: str) -> DataFrame:
    """One row per non-null element; null and empty arrays give no row."""
    return df.withColumn(name, F.explode(array)).where(F.col(name).isNotNull())
