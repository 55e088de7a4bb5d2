"""Applying a feed to a stored table: read what is new, keep the latest per key, merge, commit."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import col, cols, qualified, resolve, text_literal
from tidemark.functions.flags import flag_of, flag_rank, is_delete, is_live, is_upsert
from tidemark.functions.stamps import decode, encode, floor_literal
from tidemark.operators.feed import (
    cdc_columns,
    current_state,
    keys_not_null,
    latest_per_key,
    not_deleted,
    since,
    watermark,
)
from tidemark.operators.layout import PART, sized, with_part
from tidemark.operators.merge import FLAG, align, check_lossless, merge_changes, merge_into_catalog
from tidemark.session import staging
from tidemark.sources.snapshot import SnapshotTable
from tidemark.spec import (
    FeedSpec,
    KeyBuckets,
    Layout,
    RangePartition,
    SettingsError,
    partition_columns,
)

# Keys of a change set are broadcast up to this many bytes; a larger set is shuffled.
BROADCAST_KEY_BYTES = 64 * 1024 * 1024

# Key types whose range in the changes bounds the scan for stored rows.
RANGED = (T.IntegerType, T.LongType, T.StringType)

# Up to so many changes, the values of clustered and Bloom-filtered keys bound it one by one;
# session.SETTINGS has the reader push down as many.
EXACT_KEYS = 1000

# Property of a catalog table under which the highest stamp taken in is kept, by stamp column.
MARK = "tidemark.watermark."

_OLD_PART = "tm_old_part"
_HIT = "tm_hit"
_ACTION = "tm_action"
_OLD = "tm_old_"


def open_table(
    table: SnapshotTable,
    feed: DataFrame,
    spec: FeedSpec = FeedSpec(),
    layout: Layout = Layout(),
    tombstones: bool = False,
) -> SnapshotTable:
    """Create the current-state table from the feed's columns unless it exists."""
    if table.exists():
        return table
    rows = cdc_columns(feed, spec)
    schema = rows.schema
    stamp = spec.spelled(schema.names).stamp
    layout = sized(layout.spelled(schema), rows)
    return table.create(schema, layout, stamp=stamp, tombstones=tombstones)


def _fitted(
    table: SnapshotTable, at: dict, feed: DataFrame, spec: FeedSpec, allow_new: bool
) -> dict:
    """The version to commit on, with the columns the feed adds; changed types are refused."""
    have = T.StructType.fromJson(at["schema"])
    known = {f.name.lower(): f for f in have.fields}
    wanted = cdc_columns(feed, spec).schema
    new = [f for f in wanted.fields if f.name.lower() not in known]
    gone = known.keys() - {f.name.lower() for f in wanted.fields}
    if gone:
        raise SettingsError(f"the feed lacks columns of the table: {sorted(gone)}")
    check_lossless(wanted, have)
    if not new:
        return at
    if not allow_new:
        raise SettingsError(
            f"the feed has columns the table lacks: {[f.name for f in new]}; "
            "pass allow_new_columns=True to add them"
        )
    return table.with_columns(at, new)


def apply_feed(
    spark: SparkSession,
    feed: DataFrame,
    table: SnapshotTable,
    keys: Sequence[str],
    spec: FeedSpec = FeedSpec(),
    late_policy: str = "drop",
    lookback: timedelta | None = None,
    layout: Layout = Layout(),
    allow_new_columns: bool = False,
) -> dict:
    """Bring ``table`` up to date with ``feed`` in one commit; the first call fills it.

    ``drop`` reads rows stamped at or after the table's highest stamp, so rows that arrive late
    are never seen. ``compare`` reads the whole feed, or ``lookback`` before the highest stamp,
    and changes a row only if the change is not older.
    """
    if late_policy not in ("drop", "compare"):
        raise ValueError(f"unknown late_policy {late_policy!r}")
    open_table(table, feed, spec, layout)
    at = table.current()  # everything below is decided on this version and commits on it
    spec = spec.spelled(T.StructType.fromJson(at["schema"]).names)
    mark = table.watermark(spec.stamp, at)
    at = _fitted(table, at, feed, spec, allow_new_columns)
    compare = late_policy == "compare" and table.row_count(at) > 0
    if compare:
        dtype = T.StructType.fromJson(at["schema"])[spec.stamp].dataType
        mark = floor_literal(dtype) if lookback is None else (mark - F.lit(lookback)).cast(dtype)
    rows = since(feed, mark, spec)
    changes = latest_per_key(keys_not_null(rows, keys), keys, spec, method="aggregate")
    return merge_into(spark, table, changes, keys, spec, compare=compare, at=at)


def apply_feed_to_catalog(
    spark: SparkSession,
    feed: DataFrame,
    name: str,
    keys: Sequence[str],
    spec: FeedSpec = FeedSpec(),
    late_policy: str = "drop",
) -> None:
    """Bring a table of a catalog that supports MERGE up to date with ``feed``.

    The catalog does the merge, so only the files it must change are written, and it keeps
    concurrent writers apart. ``compare`` reads the whole feed and leaves rows alone that are not
    older than their change.

    The watermark is a property of the table: the highest stamp among the rows taken in that were
    no deletes. Only a table without it has its stamps scanned. The property is set after the
    merge, so a run that dies in between is followed by one that reads some rows again.
    """
    if late_policy not in ("drop", "compare"):
        raise ValueError(f"unknown late_policy {late_policy!r}")
    target = spark.table(name)
    spec = spec.spelled(target.columns)
    dtype = target.schema[spec.stamp].dataType
    compare = late_policy == "compare"
    mark = None if compare else catalog_mark(spark, name, spec.stamp)
    if not compare and mark is None:
        mark = watermark(target, spec).select(encode(F.col("watermark"), dtype)).first()[0]
    at = floor_literal(dtype) if compare or mark is None else decode(mark, dtype)
    rows = keys_not_null(since(feed, at, spec), keys)
    # Before the merge reads them: rows that arrive meanwhile are read again, not missed.
    stamps = rows.select(col(spec.stamp), is_live(flag_of(spec)).alias(_HIT))
    count, new = stamps.agg(
        F.count(F.lit(1)), encode(F.max(F.when(F.col(_HIT), col(spec.stamp))), dtype)).first()
    if not count:
        return
    changes = latest_per_key(rows, keys, spec, method="aggregate")
    merge_into_catalog(spark, name, changes, keys, spec, compare)
    if not compare and new is not None:
        pair = f"{text_literal(MARK + spec.stamp)} = {text_literal(str(new))}"
        spark.sql(f"ALTER TABLE {qualified(name)} SET TBLPROPERTIES ({pair})")


def catalog_mark(spark: SparkSession, name: str, stamp: str) -> str | None:
    """The watermark kept with a catalog table, as ``encode`` writes it."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {qualified(name)}").collect()
    return {r[0]: r[1] for r in rows}.get(MARK + stamp)


def create_in_catalog(
    spark: SparkSession,
    name: str,
    feed: DataFrame,
    spec: FeedSpec = FeedSpec(),
    layout: Layout = Layout(),
) -> None:
    """Create the current-state table of a feed in a catalog, empty, unless it exists.

    Time partitions and key buckets become the catalog's own transforms. It has none for integer
    ranges, which are refused; files are clustered as the catalog does it.
    """
    if spark.catalog.tableExists(name):
        return
    rows = cdc_columns(feed, spec)
    layout = sized(layout.spelled(rows.schema), rows).check(rows.schema)
    part = layout.partition
    if isinstance(part, RangePartition):
        raise SettingsError(f"{name}: a catalog table cannot be partitioned by integer ranges")
    writer = rows.where(F.lit(False)).writeTo(name)
    if isinstance(part, KeyBuckets):
        writer = writer.partitionedBy(F.partitioning.bucket(part.count, *cols(part.keys)))
    elif part is not None:
        writer = writer.partitionedBy(getattr(F.partitioning, part.grain + "s")(col(part.column)))
    writer.create()


def fresh_state(
    table: SnapshotTable,
    feed: DataFrame,
    keys: Sequence[str],
    spec: FeedSpec = FeedSpec(),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """What the table would show after ``apply_feed``, as a lazy DataFrame that writes nothing.

    Stored rows stand for the feed up to the table's watermark, so only rows stamped at or after
    it are read from the feed; the latest of each key replaces or hides the stored row. Without the
    table, or with an empty one, the whole feed is read. The stamp is not shown unless ``columns``
    names it. Late rows are not seen, and unknown flags leave a stored row alone, as in the merge.
    """
    if not table.exists():
        return current_state(feed, keys, spec, columns)
    at = table.current()
    if at["tombstones"]:
        raise ValueError("a table kept by a stream is current already; read it")
    names = T.StructType.fromJson(at["schema"]).names
    spec = spec.spelled(names)
    rows = since(feed, table.watermark(spec.stamp, at), spec)
    changes = latest_per_key(keys_not_null(rows, keys), keys, spec, method="aggregate")
    merged = merge_changes(table.read(at=at), changes, keys, spec, strategy="anti")
    if columns is not None:
        return merged.select(*cols(resolve(names, columns)))
    return merged.drop(spec.stamp)


def merge_into(
    spark: SparkSession,
    table: SnapshotTable,
    changes: DataFrame,
    keys: Sequence[str],
    spec: FeedSpec = FeedSpec(),
    compare: bool = False,
    meta: dict | None = None,
    broadcast_bytes: int = BROADCAST_KEY_BYTES,
    at: dict | None = None,
    max_folders: int | None = None,
) -> dict:
    """Merge changes, at most one per key, into the table; returns the committed manifest.

    The merge is decided on version ``at``, the current one by default, and raises CommitConflict
    if another writer commits meanwhile. A partition of ``max_folders`` folders or more is written
    as one when it is touched; by default none is.

    Only partitions that lose a row are rewritten; new rows are added to the others as further
    folders. The table is read twice: its key columns, to find those partitions, then the
    partitions themselves. While the keys of the changes are small, neither read is shuffled, and
    what is kept of a partition is written by the tasks that read it.
    """
    manifest = at or table.current()
    tombstones = manifest["tombstones"]
    schema = T.StructType.fromJson(manifest["schema"])
    spec = spec.spelled(schema.names)
    check_lossless(changes.schema, schema)
    keys = resolve(schema.names, keys, "key")
    names = schema.names

    if table.row_count(manifest) == 0:
        rows = changes if tombstones else not_deleted(changes, spec)
        rows = align(rows, schema, spec)
        return table.overwrite(rows if tombstones else rows.drop(FLAG), keys, meta, at=manifest)

    with staging(spark, table.path) as stage:
        layout = Layout.from_json(manifest["layout"])
        size = Observation()
        ranged = [k for k in keys if isinstance(schema[k].dataType, RANGED)]
        width = sum((F.octet_length(col(k).cast("string")) + 16 for k in keys), F.lit(0))
        staged = stage.put(
            align(changes, schema, spec).observe(
                size,
                F.count(F.lit(1)).alias("rows"),
                F.sum(width).alias("bytes"),
                *[F.min(col(k)).alias(f"low{i}") for i, k in enumerate(ranged)],
                *[F.max(col(k)).alias(f"high{i}") for i, k in enumerate(ranged)],
            ),
            "changes",
        )
        size = size.get
        if size["rows"] == 0:
            return table.replace_parts(staged, (), keys, meta, at=manifest) if meta else manifest
        small = size["bytes"] <= broadcast_bytes

        def few(df):
            return F.broadcast(df) if small else df

        # The stored rows of these keys: key columns only, and of those only the row groups
        # (and, where the partition follows from the keys, the partitions) the changes can meet.
        parts = None
        if layout.partition and set(partition_columns(layout.partition)) <= set(keys):
            parts = {r[0] for r in with_part(staged, layout).select(PART).distinct().collect()}
        target = table.stored(parts, manifest)
        listed = {*layout.bloom, *layout.cluster[:1]} if size["rows"] <= EXACT_KEYS else set()
        for i, k in enumerate(ranged):
            if k in listed:
                values = [r[0] for r in staged.select(col(k)).distinct().collect()]
                target = target.where(col(k).isin(values))
            else:
                target = target.where(col(k).between(size[f"low{i}"], size[f"high{i}"]))
        order = [spec.stamp, *resolve(names, spec.tiebreak)] if compare else []
        old = target.select(
            *cols(keys),
            F.col(PART).alias(_OLD_PART),
            *[col(c).alias(_OLD + c) for c in dict.fromkeys(order)],
            *([F.col(FLAG).alias(_OLD + FLAG)] if tombstones else []),
        )
        matched = old.join(few(staged.select(*cols(keys))), keys, "inner")
        both = staged.join(matched.withColumn(_HIT, F.lit(True)), keys, "left")
        both = both.withColumn(_ACTION, _action(spec, order, tombstones, compare))
        if layout.partition:
            both = with_part(both, layout)
        else:
            both = both.withColumn(PART, F.lit(None).cast("string"))
        decided = stage.put(
            both.where(F.col(_ACTION) != "skip").select(
                *cols(names), FLAG, PART, _OLD_PART, _HIT, _ACTION),
            "decided",
        )

        def end(part, loses):
            return F.struct(F.col(part).alias("part"), F.lit(loses).alias("loses"))

        # At most two rows per partition of the table.
        ends = F.array(
            F.when(F.col(_HIT), end(_OLD_PART, True)),
            F.when(F.col(_ACTION) == "write", end(PART, False)),
        )
        touched = (
            decided.select(F.explode(ends).alias("end")).where("end IS NOT NULL")
            .select("end.*").distinct().collect()
        )
        if not touched:
            return table.replace_parts(staged.limit(0), (), keys, meta, at=manifest) if meta else manifest
        folders = {p["part"]: len(p["dirs"]) for p in manifest["parts"]}
        crowded = {r["part"] for r in touched if max_folders and folders.get(r["part"], 0) >= max_folders}
        losing = {r["part"] for r in touched if r["loses"]} - crowded

        stored = [*names, FLAG] if tombstones else names
        gone = decided.where(F.col(_HIT)).select(*cols(keys))

        def kept(parts):
            return table.stored(parts, manifest).join(few(gone), keys, "left_anti").select(*cols(stored))

        rows = decided.where(F.col(_ACTION) == "write").select(*cols(stored))
        settled = None
        if crowded:
            rows = rows.unionByName(kept(crowded))
        if losing and small:
            settled = kept(losing)
        elif losing:  # the join has mixed the rows of all partitions
            rows = rows.unionByName(kept(losing))
        return table.replace_parts(rows, losing | crowded, keys, meta, settled=settled, at=manifest)


def _action(spec: FeedSpec, order: Sequence[str], tombstones: bool, compare: bool) -> Column:
    """``write`` (replacing a matched row), ``remove`` (the matched row) or ``skip``."""
    flag = F.col(FLAG)
    hit = F.coalesce(F.col(_HIT), F.lit(False))
    buried = hit & is_delete(F.col(_OLD + FLAG)) if tombstones else F.lit(False)
    live = hit & ~buried
    action = F.when(F.lit(False), F.lit("skip"))
    if compare:
        action = action.when(hit & _older(spec, order, tombstones), "skip")
    if tombstones:
        action = action.when(is_delete(flag), "write")
    else:
        action = action.when(is_delete(flag), F.when(hit, F.lit("remove")).otherwise("skip"))
    return action.when(is_upsert(flag), "write").when(live, "skip").otherwise("write")


def _older(spec: FeedSpec, order: Sequence[str], tombstones: bool) -> Column:
    """Whether the change precedes the stored row in the order used to pick the latest row."""
    stamp, *ties = order
    new, old = [col(stamp)], [col(_OLD + stamp)]
    if tombstones:
        new += [flag_rank(F.col(FLAG)), *map(col, ties)]
        old += [flag_rank(F.col(_OLD + FLAG)), *[col(_OLD + t) for t in ties]]

    def ranked(columns):
        return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(columns)])

    return ranked(new) < ranked(old)
