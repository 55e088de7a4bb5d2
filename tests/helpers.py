from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

BASE = datetime(2020, 1, 1, tzinfo=timezone.utc)
SCHEMA = "k long, s long, operation_flag string, v long"


def feed(spark, rows, ntz=False):
    """Rows of (key, stamp in hours, flag, value) as a feed."""
    stamp = F.timestamp_seconds(F.lit(int(BASE.timestamp())) + F.col("s") * 3600)
    if ntz:
        stamp = stamp.cast("timestamp_ntz")
    df = spark.createDataFrame(list(rows), SCHEMA)
    return df.select("k", stamp.alias("recordstamp"), "operation_flag", "v")


def at(hours):
    return BASE + timedelta(hours=hours)


def state(df):
    """A current-state table as {key: (stamp in hours, value)}, failing on duplicate keys."""
    seconds = (F.unix_seconds(F.col("recordstamp").cast("timestamp")) - int(BASE.timestamp())) / 3600
    rows = df.select("k", seconds.cast("long"), "v").collect()
    out = {r[0]: (r[1], r[2]) for r in rows}
    assert len(out) == len(rows), "a key occurs twice"
    return out


def scanned_rows(df):
    """Rows that the file scans of a query gave, after row groups were skipped."""
    session = df.sparkSession
    before = session.conf.get("spark.sql.adaptive.enabled")
    session.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = df._jdf.queryExecution()
        execution.toRdd().count()
        leaves = execution.executedPlan().collectLeaves()
        return [leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())]
    finally:
        session.conf.set("spark.sql.adaptive.enabled", before)
