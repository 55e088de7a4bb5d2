"""Keeping a table current from a streaming feed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.columns import col, resolve
from tidemark.functions.flags import flag_of, is_delete, is_live
from tidemark.functions.stamps import floor_literal
from tidemark.operators.apply import create_in_catalog, merge_into, open_table
from tidemark.operators.feed import keys_not_null, latest_per_key, since
from tidemark.operators.layout import PART
from tidemark.operators.merge import FLAG, merge_into_catalog
from tidemark.session import staging
from tidemark.sources.snapshot import SnapshotTable
from tidemark.spec import DELETE_FLAG, UPSERT_FLAGS, FeedSpec, Layout


def apply_batch(
    batch: DataFrame,
    batch_id: int,
    table: SnapshotTable,
    keys: Sequence[str],
    spec: FeedSpec = FeedSpec(),
    query: str = "stream",
) -> None:
    """Merge one micro-batch. A batch that was committed before a failure is not applied again.

    Batches are numbered per checkpoint, so ``query`` has to identify the checkpoint.
    """
    done = table.current()["meta"].get(query)
    if done is not None and done >= batch_id:
        return
    spec = spec.spelled(batch.columns)
    rows = since(batch, floor_literal(batch.schema[spec.stamp].dataType), spec)
    changes = latest_per_key(keys_not_null(rows, keys), keys, spec, method="aggregate")
    merge_into(
        batch.sparkSession, table, changes, keys, spec, compare=True, meta={query: batch_id}
    )


def bury_for_good(table: SnapshotTable, age: timedelta, spec: FeedSpec = FeedSpec()) -> dict:
    """Drop the tombstones stamped more than ``age`` before the table's highest stamp.

    Rows later than that would bring their keys back, so ``age`` has to exceed the longest delay
    of a row. Only partitions that hold such tombstones are rewritten.
    """
    at = table.current()
    if not at["tombstones"]:
        raise ValueError("the table keeps no tombstones")
    stamp = spec.spelled(table.schema().names).stamp
    mark = table.watermark(stamp, at)
    old = is_delete(F.col(FLAG)) & (col(stamp) < mark - F.lit(age))
    rows = table.stored(at=at)
    parts = {r[0] for r in rows.where(old).select(PART).distinct().collect()}
    if not parts:
        return at
    kept = table.stored(parts, at).where(~F.coalesce(old, F.lit(False))).drop(PART)
    return table.replace_parts(kept, parts, at=at)


def last_words(feed: DataFrame, keys: Sequence[str], spec: FeedSpec = FeedSpec()) -> DataFrame:
    """The latest change of each key over all that a stream has brought, kept in its state.

    In update mode a micro-batch gives the keys it touched, with their latest change, be it from
    this batch or an earlier one. The flag says only whether the key lives (``U``) or not (``D``).
    """
    spec = spec.spelled(feed.columns)
    rows = since(feed, floor_literal(feed.schema[spec.stamp].dataType), spec)
    latest = latest_per_key(keys_not_null(rows, keys), keys, spec, method="aggregate")
    flag = F.when(is_live(flag_of(spec)), UPSERT_FLAGS[1]).otherwise(DELETE_FLAG)
    return latest.withColumn(spec.op, flag)


def stream_with_state(
    feed: DataFrame,
    target: SnapshotTable | str,
    keys: Sequence[str],
    checkpoint: str,
    spec: FeedSpec = FeedSpec(),
    layout: Layout = Layout(),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query that keeps ``target`` at the current state of a streaming feed.

    Which change of a key counts is decided by a streaming aggregate: its state holds the latest
    change of every key, deletes included, so late rows are harmless in any order and the table
    needs no tombstones. What reaches the table is final; it is merged without comparing stamps.
    With key buckets only those the batch's keys fall into are read. ``target`` can also be the
    name of a table in a catalog that supports MERGE, where a batch can safely be applied twice.

    State is as large as the table and lies with the executors (RocksDB, by ``session.SETTINGS``)
    and in the checkpoint. It is spread over the shuffle partitions of the first start, for good.
    The checkpoint must be the only writer of the table, which has to be new or made by it.
    """
    keys = resolve(feed.columns, keys, "key")
    plain = replace(spec.spelled(feed.columns), delete_when=None)
    named = isinstance(target, str)
    if named:
        create_in_catalog(feed.sparkSession, target, feed, spec, layout)
    elif open_table(target, feed, spec, layout).current()["tombstones"]:
        raise ValueError("the table belongs to stream_cdc")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # Running the batch is what moves the state on: once, and also if the table has it already.
        spark = batch.sparkSession
        if named:
            with staging(spark) as stage:
                merge_into_catalog(spark, target, stage.put(batch, "latest"), keys, plain)
            return
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        at = target.current()
        done = at["meta"].get(query)
        if done is not None and done >= batch_id:
            batch.write.format("noop").mode("overwrite").save()
        elif target.row_count(at) or not target.layout().cluster:  # the merge runs it once
            merge_into(spark, target, batch, keys, plain, meta={query: batch_id}, at=at)
        else:  # ranges are found by sampling, which would run it again
            with staging(spark, target.path) as stage:
                rows = stage.put(batch, "latest")
                merge_into(spark, target, rows, keys, plain, meta={query: batch_id}, at=at)

    return (
        last_words(feed, keys, spec).writeStream.outputMode("update").foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_cdc(
    feed: DataFrame,
    table: SnapshotTable,
    keys: Sequence[str],
    checkpoint: str,
    spec: FeedSpec = FeedSpec(),
    layout: Layout = Layout(),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query that merges a streaming feed into ``table``.

    What is new is known from the stream's own offsets, so rows are compared with the stored row
    rather than with the highest stamp: a late row changes its key only if nothing newer did.
    Deleted keys stay in the table as tombstones, hidden from readers, so that a late row does not
    bring them back, until ``bury_for_good`` drops old ones.
    """
    open_table(table, feed, spec, layout, tombstones=True)
    if not table.current()["tombstones"]:
        raise ValueError("a streaming target has to be created by stream_cdc")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # The identifier Spark keeps in the checkpoint.
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query:
            raise RuntimeError("the streaming query has no identifier")
        apply_batch(batch, batch_id, table, keys, spec, query)

    return (
        feed.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
