"""Times the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from pyspark.sql import functions as F  # noqa: E402

from checks import feeds  # noqa: E402
from checks.feeds import LINEITEM_SPEC  # noqa: E402
from checks.queries import QUERIES, Place  # noqa: E402
from tidemark import Layout, TimePartition  # noqa: E402
from tidemark.operators import feed as ops  # noqa: E402
from tidemark.operators.apply import apply_feed, merge_into  # noqa: E402
from tidemark.operators.merge import merge_changes  # noqa: E402
from tidemark.session import build_session  # noqa: E402

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "2"))
KEYS = ["k", "n", "p", "q"]  # unique per row: the table keeps all lines


def drain(df):
    df.write.format("noop").mode("overwrite").save()


def changed(feed, share):
    """A batch that updates, deletes and inserts about ``share`` of the lines."""
    pick = F.pmod(F.xxhash64("k", "n", "p", "q"), F.lit(1000)) < int(share * 1000)
    part = feed.where(pick)
    flag = F.when(F.col("n") == 1, "D").otherwise("U")
    moved = part.withColumn("operation_flag", flag)
    new = part.where("n = 2").withColumn("n", F.lit(90)).withColumn("operation_flag", F.lit("I"))
    return moved.unionByName(new).withColumn(
        "recordstamp", F.col("recordstamp") + F.expr("INTERVAL 1 HOUR"))


def jobs(spark):
    lines = feeds.lineitem_feed(spark, SF)
    hot = lines.withColumn("k", F.when(F.col("k") % 3 == 0, F.lit(-1)).otherwise(F.col("k")))
    by_year = Layout(TimePartition("recordstamp", "year"))
    unpruned = Place(spark, SF)
    base = {}

    def loaded(layout):
        if layout not in base:
            table = unpruned.table(f"base{len(base)}")
            apply_feed(spark, lines, table, KEYS, layout=layout)
            base[layout] = table
        return base[layout]

    def increment(share, layout, limit=1 << 26):
        table = loaded(layout)
        merge_into(spark, table, changed(lines, share), KEYS, broadcast_bytes=limit)

    def merge_frame(share, strategy):
        target = loaded(Layout()).read()
        changes = changed(lines, share)
        drain(merge_changes(target, changes, KEYS, strategy=strategy))

    return {
        "current_state_window": lambda: drain(ops.current_state(lines, ["k"], LINEITEM_SPEC)),
        "current_state_aggregate": lambda: drain(
            ops.current_state(lines, ["k"], LINEITEM_SPEC, method="aggregate")),
        "current_state_hot_key": lambda: drain(ops.current_state(hot, ["k"], LINEITEM_SPEC)),
        "current_state_two_columns": lambda: drain(
            ops.current_state(lines, ["k"], LINEITEM_SPEC, columns=["k", "price"])),
        "first_load": lambda: apply_feed(
            spark, lines, Place(spark, SF).table(), ["k"], LINEITEM_SPEC),
        "first_load_by_month_clustered": lambda: apply_feed(
            spark, lines, Place(spark, SF).table(), ["k"], LINEITEM_SPEC,
            layout=Layout(TimePartition("recordstamp", "month"), ("k",))),
        "merge_1pct": lambda: increment(0.01, Layout()),
        "merge_10pct": lambda: increment(0.10, Layout()),
        "merge_1pct_by_year": lambda: increment(0.01, by_year),
        "merge_10pct_by_year": lambda: increment(0.10, by_year),
        "merge_10pct_shuffled": lambda: increment(0.10, Layout(), -1),
        "merge_10pct_outer": lambda: merge_frame(0.10, "outer"),
        "merge_10pct_anti": lambda: merge_frame(0.10, "anti"),
        **{
            name: (lambda q=QUERIES[name]: drain(q(spark, SF)))
            for name in (
                "current_state_events", "primary_keys", "refresh_table", "clustered_roundtrip",
                "pruned_partition_read", "load_parquet", "copy_table", "merge_three_batches",
                "stream_merge_final_state", "multi_table_run", "refresh_graph_regional_sales",
            )
        },
    }


def main():
    spark = build_session("tidemark-bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false",
        "spark.checkpoint.dir": f"file://{tempfile.mkdtemp(prefix='tidemark-bench-')}",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")})
    spark.sparkContext.setLogLevel("ERROR")
    drain(ops.current_state(feeds.lineitem_feed(spark, SF), ["k"], LINEITEM_SPEC))
    wanted = sys.argv[1:]
    times = {}
    for name, job in jobs(spark).items():
        if wanted and name not in wanted:
            continue
        runs = []
        for _ in range(REPEAT):
            begin = time.perf_counter()
            job()
            runs.append(time.perf_counter() - begin)
        times[name] = round(min(runs), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": SF.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
