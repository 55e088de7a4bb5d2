"""Merging deduplicated changes into a target, as one DataFrame expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import col, cols, qualified, quote, resolve
from tidemark.functions.flags import flag_of, is_delete, is_live, is_upsert
from tidemark.spec import FeedSpec, SettingsError

FLAG = "tm_flag"


# Whole numbers by size.
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _holds(wide: T.DataType, narrow: T.DataType) -> bool:
    """Whether every value of ``narrow`` is kept by a cast to ``wide``."""
    if wide == narrow or isinstance(narrow, T.NullType):
        return True
    if isinstance(narrow, _WHOLE):
        digits = (3, 5, 10, 19)[[type(narrow) is t for t in _WHOLE].index(True)]
        if isinstance(wide, _WHOLE):
            return _WHOLE.index(type(wide)) >= _WHOLE.index(type(narrow))
        if isinstance(wide, T.DecimalType):
            return wide.precision - wide.scale >= digits
        return isinstance(wide, T.DoubleType) and digits <= 10 or isinstance(wide, T.FloatType) and digits <= 5
    if isinstance(narrow, T.DecimalType) and isinstance(wide, T.DecimalType):
        return wide.scale >= narrow.scale and wide.precision - wide.scale >= narrow.precision - narrow.scale
    if isinstance(narrow, T.FloatType):
        return isinstance(wide, T.DoubleType)
    if isinstance(wide, T.StringType):
        return isinstance(narrow, (T.StringType, T.CharType, T.VarcharType, T.DateType, T.BooleanType))
    if isinstance(wide, T.ArrayType) and isinstance(narrow, T.ArrayType):
        return _holds(wide.elementType, narrow.elementType)
    if isinstance(wide, T.MapType) and isinstance(narrow, T.MapType):
        return _holds(wide.keyType, narrow.keyType) and _holds(wide.valueType, narrow.valueType)
    if isinstance(wide, T.StructType) and isinstance(narrow, T.StructType):
        return len(wide) == len(narrow) and all(_holds(a.dataType, b.dataType) for a, b in zip(wide, narrow))
    return isinstance(wide, T.TimestampNTZType) and isinstance(narrow, T.DateType)


def check_lossless(given: T.StructType, stored: T.StructType) -> None:
    """Raise if a given column's type does not fit into the stored column of the same name."""
    types = {f.name.lower(): f.dataType for f in stored.fields}
    for f in given.fields:
        wide = types.get(f.name.lower())
        if wide is not None and not _holds(wide, f.dataType):
            raise SettingsError(
                f"column {f.name!r} is {f.dataType.simpleString()} and would lose values as "
                f"{wide.simpleString()}, the table's type")


def align(changes: DataFrame, schema: T.StructType, spec: FeedSpec) -> DataFrame:
    """The target's columns in the target's types, plus the effective flag."""
    names = resolve(changes.columns, schema.names)
    types = {f.name: f.dataType for f in changes.schema.toNullable().fields}
    picked = [
        quote(have) if (have, types[have]) == (field.name, field.dataType)
        else col(have).cast(field.dataType).alias(field.name)
        for have, field in zip(names, schema.toNullable().fields)
    ]
    return changes.select(*picked, flag_of(spec).alias(FLAG))


def merge_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    spec: FeedSpec = FeedSpec(),
    late_policy: str = "drop",
    strategy: str = "outer",
) -> DataFrame:
    """The target after the merge. ``changes`` holds at most one row per key.

    ============  =========  ==========================
    target row    flag       outcome
    ============  =========  ==========================
    no            ``D``      nothing
    no            any other  insert, NULL flags included
    yes           ``D``      delete
    yes           I, U, L    update
    yes           any other  keep the target row
    ============  =========  ==========================

    ``outer`` reads each side once and shuffles both. ``anti`` lets Spark broadcast the keys of a
    small change set, so that the target is not shuffled; it reads the changes several times and
    suits changes that are already stored. ``late_policy='compare'`` ignores a change that is
    older than the target row.
    """
    if late_policy not in ("drop", "compare"):
        raise ValueError(f"unknown late_policy {late_policy!r}")
    if strategy == "anti" and late_policy == "compare":
        raise ValueError("strategy 'anti' cannot compare stamps; use 'outer'")
    keys = resolve(target.columns, keys, "key")
    spec = spec.spelled(target.columns)
    check_lossless(changes.schema, target.schema)
    changes = align(changes, target.schema, spec)
    if strategy == "anti":
        return _merge_anti(target, changes, keys)
    if strategy != "outer":
        raise ValueError(f"unknown strategy {strategy!r}")
    return _merge_outer(target, changes, keys, spec, late_policy == "compare")


def _merge_outer(target, changes, keys, spec, compare):
    names = target.columns
    old = target.select(*cols(keys), F.struct(*cols(names)).alias("tm_old"))
    new = changes.select(*cols(keys), F.struct(*cols(names)).alias("tm_new"), FLAG)
    old_row, new_row, flag = F.col("tm_old"), F.col("tm_new"), F.col(FLAG)
    pick = (
        F.when(new_row.isNull(), old_row)
        .when(old_row.isNull(), F.when(is_live(flag), new_row))
    )
    if compare:
        before, after = old_row.getField(spec.stamp), new_row.getField(spec.stamp)
        pick = pick.when(~(before.isNull() | F.coalesce(after >= before, F.lit(False))), old_row)
    pick = pick.when(is_upsert(flag), new_row).when(~is_delete(flag), old_row)
    joined = old.join(new, keys, "full_outer")
    return joined.select(pick.alias("tm_row")).where("tm_row IS NOT NULL").select("tm_row.*")


def _merge_anti(target, changes, keys):
    names = cols(target.columns)
    flag = F.col(FLAG)
    acts = is_upsert(flag) | is_delete(flag)
    kept = target.join(changes.where(acts).select(*cols(keys)), keys, "left_anti").select(*names)
    written = changes.where(is_upsert(flag)).select(*names)
    other = changes.where(~acts).join(target.select(*cols(keys)), keys, "left_anti").select(*names)
    return kept.unionByName(written).unionByName(other)


def merge_into_catalog(
    spark,
    table: str,
    changes: DataFrame,
    keys: Sequence[str],
    spec: FeedSpec = FeedSpec(),
    compare: bool = False,
) -> None:
    """The same merge by the catalog itself, for tables of a catalog that supports MERGE."""
    target = spark.table(table)
    keys = resolve(target.columns, keys, "key")
    check_lossless(changes.schema, target.schema)
    source = align(changes, target.schema, spec).alias("s")
    matched = None
    for key in keys:
        equal = F.col(f"{qualified(table)}.{quote(key)}") == F.col(f"s.{quote(key)}")
        matched = equal if matched is None else matched & equal
    flag = F.col(f"s.{FLAG}")
    values = {quote(name): F.col(f"s.{quote(name)}") for name in target.columns}
    newer = F.lit(True)
    if compare:
        stamp = quote(spec.spelled(target.columns).stamp)
        before, after = F.col(f"{qualified(table)}.{stamp}"), F.col(f"s.{stamp}")
        newer = before.isNull() | F.coalesce(after >= before, F.lit(False))
    (
        source.mergeInto(table, matched)
        .whenMatched(is_delete(flag) & newer).delete()
        .whenMatched(is_upsert(flag) & newer).update(values)
        .whenNotMatched(is_live(flag)).insert(values)
        .merge()
    )
