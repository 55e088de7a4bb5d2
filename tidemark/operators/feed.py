"""Reading a change feed: projections, filters, watermark, latest row per key, current state."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import col, cols, qualified, quote, resolve
from tidemark.functions.flags import flag_of, flag_rank, is_live
from tidemark.functions.stamps import decode, encode, floor_literal
from tidemark.spec import DELETE_FLAG, TIME_TYPES, FeedSpec, SettingsError

_RANK = "tm_rank"
_ROW = "tm_row"


def scan_feed(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    """A raw feed with all its columns, from a path (anything holding a slash) or a table name."""
    return spark.read.format(fmt).load(source) if "/" in source else spark.table(source)


def stream_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    max_files: int | None = None,
    max_bytes: int | None = None,
    when_done: str = "off",
    archive: str | None = None,
) -> DataFrame:
    """The files of a landing folder as a stream, with a declared schema.

    A trigger takes at most ``max_files`` files, or files of about ``max_bytes``. Files that have
    been taken in stay (``off``), are removed (``delete``) or moved below ``archive``.
    """
    if max_files is not None and max_bytes is not None:
        raise SettingsError("a trigger is bounded by files or by bytes, not both")
    if when_done not in ("off", "delete", "archive"):
        raise SettingsError(f"unknown when_done {when_done!r}")
    if (when_done == "archive") != (archive is not None):
        raise SettingsError("archive and when_done='archive' go together")
    options = {
        "maxFilesPerTrigger": max_files,
        "maxBytesPerTrigger": max_bytes,
        "cleanSource": when_done,
        "sourceArchiveDir": archive,
    }
    given = {k: v for k, v in options.items() if v is not None}
    return spark.readStream.schema(schema).format(fmt).options(**given).load(path)


def cdc_columns(df: DataFrame, spec: FeedSpec = FeedSpec()) -> DataFrame:
    """Columns kept in a current-state table: everything but the change bookkeeping."""
    return df.drop(*spec.excluded)


def view_columns(df: DataFrame, spec: FeedSpec = FeedSpec()) -> DataFrame:
    """Columns shown by the runtime view: as above, and without the stamp."""
    return df.drop(*spec.excluded, spec.stamp)


def keys_not_null(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for key in resolve(df.columns, keys, "key"):
        df = df.where(col(key).isNotNull())
    return df


def not_deleted(df: DataFrame, spec: FeedSpec = FeedSpec()) -> DataFrame:
    return df.where(is_live(flag_of(spec)))


def watermark(target: DataFrame, spec: FeedSpec = FeedSpec()) -> DataFrame:
    """One row with the highest stamp, or the floor for an empty table."""
    dtype = target.schema[spec.spelled(target.columns).stamp].dataType
    high = F.max(col(spec.stamp))
    floor = floor_literal(dtype)
    return target.agg((high if floor is None else F.coalesce(high, floor)).alias("watermark"))


def since(feed: DataFrame, mark: Column | None, spec: FeedSpec = FeedSpec()) -> DataFrame:
    """Rows stamped at or after ``mark``; rows without a stamp never qualify."""
    if mark is None:
        return feed.where(col(spec.stamp).isNotNull())
    out = feed.where(col(spec.stamp) >= mark)
    if spec.landing:
        column, grain = spec.spelled(feed.columns).landing
        dtype = feed.schema[column].dataType
        if not isinstance(dtype, TIME_TYPES):
            raise SettingsError(
                f"landing column {column!r} must be a date or timestamp, not {dtype.simpleString()}")
        start = F.date_trunc(grain, mark).cast(dtype)
        out = out.where(col(column) >= start)
    return out


def new_records(feed: DataFrame, target: DataFrame, spec: FeedSpec = FeedSpec()) -> DataFrame:
    """Rows that arrived since the target was last refreshed, the last stamp included.

    The single watermark value is fetched first: as a constant it prunes partitions of the feed,
    which a subquery cannot.
    """
    dtype = target.schema[spec.spelled(target.columns).stamp].dataType
    value = watermark(target, spec).select(encode(F.col("watermark"), dtype)).first()[0]
    return since(feed, None if value is None else decode(value, dtype), spec)


def change_order(df: DataFrame, spec: FeedSpec, tiebreak: Sequence[str] = ()) -> list[Column]:
    names = resolve(df.columns, tiebreak or spec.tiebreak, "tiebreak column")
    return [col(spec.stamp), flag_rank(flag_of(spec)), *map(col, names)]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    spec: FeedSpec = FeedSpec(),
    tiebreak: Sequence[str] = (),
    method: str = "window",
) -> DataFrame:
    """The latest change of each key; a delete wins over other changes of the same stamp.

    Both methods reduce to one row per key and task before the shuffle, so a key holding a large
    part of the feed sends few rows to its reducer. ``window`` keeps column pruning for readers
    that use few columns; ``aggregate`` sorts by key only and is the faster one when the whole
    row is wanted.
    """
    keys = resolve(df.columns, keys, "key")
    order = change_order(df, spec, tiebreak)
    if method == "aggregate":
        named = [o.alias(f"o{i}") for i, o in enumerate(order)]
        best = F.max_by(F.struct(*cols(df.columns)), F.struct(*named))
        return df.groupBy(*cols(keys)).agg(best.alias(_ROW)).select(f"{_ROW}.*")
    if method != "window":
        raise ValueError(f"unknown method {method!r}")
    window = Window.partitionBy(*cols(keys)).orderBy(*[o.desc_nulls_last() for o in order])
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def current_state(
    feed: DataFrame,
    keys: Sequence[str],
    spec: FeedSpec = FeedSpec(),
    columns: Sequence[str] | None = None,
    method: str = "window",
) -> DataFrame:
    """Live rows computed from the whole feed at read time, as a lazy DataFrame."""
    rows = keys_not_null(feed, keys)
    if columns is not None:
        if spec.delete_when:
            rows = rows.withColumn(spec.op, flag_of(spec))
            spec = replace(spec, delete_when=None)
        wanted = [*keys, *columns, spec.stamp, spec.op, *spec.tiebreak]
        rows = rows.select(*cols(dict.fromkeys(resolve(feed.columns, wanted))))
    rows = not_deleted(latest_per_key(rows, keys, spec, method=method), spec)
    if columns is not None:
        return rows.select(*cols(resolve(feed.columns, columns)))
    return view_columns(rows, spec)


def current_state_sql(
    name: str, columns: Sequence[str], keys: Sequence[str], spec: FeedSpec = FeedSpec()
) -> str:
    """The same as SQL text, for a view that is stored in the catalog."""
    hidden = {c.lower() for c in (*spec.excluded, spec.stamp)}
    shown = ", ".join(quote(c) for c in columns if c.lower() not in hidden)
    keys = resolve(columns, keys, "key")
    op, stamp = quote(spec.op), quote(spec.stamp)
    if spec.delete_when:
        op = f"if({spec.delete_when}, '{DELETE_FLAG}', {op})"
    order = [stamp, f"if({op} = '{DELETE_FLAG}', 'ZZ', {op})"]
    order += [quote(c) for c in resolve(columns, spec.tiebreak, "tiebreak column")]
    by = ", ".join(f"{o} DESC NULLS LAST" for o in order)
    return (
        f"SELECT {shown} FROM (SELECT *, row_number() OVER ("
        f"PARTITION BY {', '.join(quote(k) for k in keys)} ORDER BY {by}) AS {_RANK} "
        f"FROM {qualified(name)} WHERE {' AND '.join(quote(k) + ' IS NOT NULL' for k in keys)}) "
        f"WHERE {_RANK} = 1 AND coalesce({op}, 'I') <> '{DELETE_FLAG}'"
    )
