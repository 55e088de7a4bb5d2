"""Physical arrangement of a table: time or integer-range partitions, clustered files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import col, cols
from tidemark.functions.stamps import bucket_text, range_bucket, time_bucket
from tidemark.spec import (
    MAX_CLUSTER_COLUMNS,
    KeyBuckets,
    Layout,
    RangePartition,
    SettingsError,
    TimePartition,
)

PART = "tm_part"
# Input that one task of a clustered write sorts into a file.
TARGET_BYTES = 256 * 1024 * 1024
# Key buckets at most: each is a folder, and an entry of every version file.
MAX_BUCKETS = 50_000


def partition_by_time(df: DataFrame, column: str, grain: str, name: str = PART) -> DataFrame:
    """Adds the start of the hour, day, month or year that ``column`` falls into."""
    Layout(TimePartition(column, grain)).check(df.schema)
    return df.withColumn(name, time_bucket(col(column), df.schema[column].dataType, grain))


def partition_by_range(
    df: DataFrame, column: str, start: int, end: int, interval: int, name: str = PART
) -> DataFrame:
    """Adds the start of the interval ``column`` falls into, NULL outside ``[start, end)``."""
    Layout(RangePartition(column, start, end, interval)).check(df.schema)
    return df.withColumn(name, range_bucket(col(column), start, end, interval))


def cluster_by(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Rows ordered over and within tasks, so that file statistics can skip most of a table."""
    if not 1 <= len(columns) <= MAX_CLUSTER_COLUMNS:
        raise SettingsError(f"1 to {MAX_CLUSTER_COLUMNS} cluster columns are needed")
    layout = Layout(cluster=tuple(columns)).check(df.schema)
    return in_order(spread(df, layout, keys), layout)


def _hashable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _hashable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_hashable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _breaker(df: DataFrame, used: Sequence[str], keys: Sequence[str]) -> list:
    if keys:
        return cols(k for k in keys if k not in used)
    names = [f.name for f in df.schema.fields if _hashable(f.dataType)]
    return [F.xxhash64(*cols(names))]


def with_part(df: DataFrame, layout: Layout) -> DataFrame:
    """Adds the partition value as it is spelled in directory names."""
    part = layout.partition
    if isinstance(part, KeyBuckets):
        return df.withColumn(PART, F.pmod(F.xxhash64(*cols(part.keys)), F.lit(part.count)).cast("string"))
    dtype = df.schema[part.column].dataType
    return df.withColumn(PART, bucket_text(col(part.column), dtype, part))


def sized(layout: Layout, df: DataFrame, target_bytes: int | None = None) -> Layout:
    """The layout with the number of key buckets that the frame's sources call for: about
    ``target_bytes`` (``TARGET_BYTES``) each. A single bucket is no partitioning."""
    part = layout.partition
    if not isinstance(part, KeyBuckets) or part.count:
        return layout
    if df.isStreaming:
        raise SettingsError("the size of a stream is not known: state the number of key buckets")
    count = min(-(-input_bytes(df) // (target_bytes or TARGET_BYTES)), MAX_BUCKETS)
    return replace(layout, partition=replace(part, count=count) if count > 1 else None)


def input_bytes(df: DataFrame) -> int:
    """What the frame's sources hold, as the optimizer knows it: never a product of join sides."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def ranges_for(df: DataFrame, target_bytes: int | None = None) -> int | None:
    """Ranges of about ``target_bytes`` (``TARGET_BYTES``) of input; None if the session's number
    of shuffle partitions, which adaptive execution may lower but not raise, is enough."""
    wanted = -(-input_bytes(df) // (target_bytes or TARGET_BYTES))
    default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return wanted if default < wanted < 1 << 31 else None


def spread(df: DataFrame, layout: Layout, keys: Sequence[str] = ()) -> DataFrame:
    """Distribute rows over tasks by partition and cluster columns.

    A large partition, or a frequent cluster value, is split over several tasks: by adaptive
    execution, or by ranges that the keys (or a hash of the row) continue. The number of ranges
    follows the input's size.
    """
    if layout.partition is None and not layout.cluster:
        return df
    lead = [PART] if layout.partition is not None else []
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    if not layout.cluster and adaptive:
        return df.hint("rebalance", *map(col, lead))
    lead += layout.cluster
    count = ranges_for(df)
    return df.repartitionByRange(
        *([count] if count else []), *cols(lead), *_breaker(df, lead, keys))


def in_order(df: DataFrame, layout: Layout) -> DataFrame:
    """Sort rows within tasks by the cluster columns of each partition."""
    if not layout.cluster:
        return df
    lead = [PART] if layout.partition is not None else []
    return df.sortWithinPartitions(*cols([*lead, *layout.cluster]))


def arrange(
    df: DataFrame,
    layout: Layout,
    keys: Sequence[str] = (),
    settled: DataFrame | None = None,
) -> DataFrame:
    """Rows ready to be written. ``settled`` rows, read from files of this layout, lie together
    already and join without a shuffle."""
    layout.check(df.schema)
    if layout.partition is not None:
        df = with_part(df, layout)
        settled = settled if settled is None else with_part(settled, layout)
    df = spread(df, layout, keys)
    if settled is not None:
        df = df.unionByName(settled)
    return in_order(df, layout)


def part_between(layout: Layout, schema: T.StructType, low=None, high=None) -> Column:
    """Predicate on the partition column that holds wherever the source column is in [low, high].

    Catalyst cannot derive it from a predicate on the source column.
    """
    part = layout.partition
    dtype = schema[part.column].dataType
    test = F.lit(True)
    if isinstance(part, TimePartition):
        if low is not None:
            test = test & (F.col(PART) >= bucket_text(F.lit(low).cast(dtype), dtype, part))
        if high is not None:
            test = test & (F.col(PART) <= bucket_text(F.lit(high).cast(dtype), dtype, part))
        return test
    start_of = F.col(PART).cast("long")
    if low is not None:
        test = test & (start_of > F.lit(low).cast("long") - part.interval)
    if high is not None:
        test = test & (start_of <= F.lit(high).cast("long"))
    outside = (low is None or low < part.start) or (high is None or high >= part.end)
    return (test | F.col(PART).isNull()) if outside else test
