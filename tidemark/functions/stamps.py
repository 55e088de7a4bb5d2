"""Record stamps and time/range buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.spec import WATERMARK_FLOOR, RangePartition, TimePartition

# Text form of a bucket, ordered as text like the time it stands for.
BUCKET_FORMATS = {
    "hour": "yyyy-MM-dd-HH",
    "day": "yyyy-MM-dd",
    "month": "yyyy-MM",
    "year": "yyyy",
}


def floor_literal(dtype: T.DataType) -> Column | None:
    """Start of time for an empty target, in the type of the stamp, so no cast hinders pushdown."""
    if isinstance(dtype, T.TimestampType):
        return F.lit(WATERMARK_FLOOR + "+00:00").cast(dtype)
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(WATERMARK_FLOOR).cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.lit(WATERMARK_FLOOR[:10]).cast(dtype)
    return None


def encode(value: Column, dtype: T.DataType) -> Column:
    """A stamp as a JSON-safe value that is independent of any time zone setting."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(dtype, T.TimestampNTZType):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(dtype, T.DateType):
        return value.cast("string")
    return value


def decode(value, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(F.lit(value).cast("long"))
    return F.lit(value).cast(dtype)


def time_bucket(value: Column, dtype: T.DataType, grain: str) -> Column:
    """Start of the hour, day, month or year, in the type of the input."""
    return F.date_trunc(grain, value).cast(dtype)


def range_bucket(value: Column, start: int, end: int, interval: int) -> Column:
    """Start of the interval ``value`` falls into; NULL outside ``[start, end)``."""
    x = value.cast("long")
    inside = (x >= start) & (x < end)
    return F.when(inside, x - F.pmod(x - F.lit(start), F.lit(interval)))


def bucket_text(value: Column, dtype: T.DataType, part: TimePartition | RangePartition) -> Column:
    """Directory value of a partition."""
    if isinstance(part, RangePartition):
        return range_bucket(value, part.start, part.end, part.interval).cast("string")
    if isinstance(dtype, T.TimestampType):
        value = F.to_utc_timestamp(value, F.current_timezone())
    return F.date_format(value, BUCKET_FORMATS[part.grain])
