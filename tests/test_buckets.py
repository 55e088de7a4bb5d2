import random

import pytest
from pyspark.sql import functions as F

from tests import model
from tests.helpers import at, feed, scanned_rows, state
from tidemark import FeedSpec, KeyBuckets, Layout, SettingsError, SnapshotTable, TimePartition
from tidemark.operators import apply as ap
from tidemark.operators import feed as ops
from tidemark.operators.apply import apply_feed, apply_feed_to_catalog, create_in_catalog, fresh_state, merge_into, open_table
from tidemark.operators.keys import primary_key_lists, primary_keys_of
from tidemark.operators.layout import sized

SPEC = FeedSpec(tiebreak=("v",))


def folders(table):
    return {p["part"]: tuple(p["dirs"]) for p in table.current()["parts"]}


def test_small_batch_leaves_other_buckets_alone(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    rows = [(i, int(i == 0), "I", i) for i in range(1000)]  # only the last stamp is read again
    apply_feed(spark, feed(spark, rows), table, ["K"], SPEC, layout=Layout(KeyBuckets(("K",), 50)))
    assert table.layout().partition == KeyBuckets(("k",), 50)
    before = folders(table)
    assert len(before) == 50 and set(before) == {str(i) for i in range(50)}
    batch = [(i, 2, "UD"[i % 2], -i) for i in range(0, 1000, 100)]  # one row in a hundred
    found = feed(spark, [*rows, *batch])
    apply_feed(spark, found, table, ["k"], SPEC)
    after = folders(table)
    hit = {r[0] for r in feed(spark, batch).select(F.pmod(F.xxhash64("k"), F.lit(50)).cast("string")).collect()}
    assert {b for b in before if before[b] != after.get(b)} == hit and len(hit) <= 10
    assert state(table.read()) == model.merge({k: (s, v) for k, s, _, v in rows}, model.latest(batch))
    # New keys only add files to their buckets.
    apply_feed(spark, feed(spark, [(5000, 3, "I", 1)]), table, ["k"], SPEC)
    changed = {b for b, d in folders(table).items() if d != after.get(b)}
    (grown,) = changed
    assert folders(table)[grown][:-1] == after.get(grown, ())


@pytest.mark.parametrize("seed", range(3))
def test_bucketed_merges_equal_the_model(spark, tmp_path, seed):
    rng = random.Random(seed)
    layout = [Layout(KeyBuckets(("k",), 3)), Layout(KeyBuckets(("k",), 7), ("v",)), Layout(KeyBuckets(("v",), 4))][seed]
    table = SnapshotTable(spark, str(tmp_path / "t"))
    rows, want = [], {}
    for step in range(4):
        batch = [(rng.randrange(20), 2 * step + rng.randrange(2), rng.choice(["I", "U", "L", "D", None, "X"]), rng.randrange(99)) for _ in range(15)]
        rows += batch
        open_table(table, feed(spark, rows), SPEC, layout)
        changes = ops.latest_per_key(feed(spark, batch), ["k"], SPEC)
        merge_into(spark, table, changes, ["k"], SPEC, broadcast_bytes=[1 << 26, -1][step % 2])
        want = model.merge(want, model.latest(batch))
        assert state(table.read()) == want


def test_number_of_buckets_follows_the_bytes(spark, tmp_path, monkeypatch):
    rows = feed(spark, [(i, 1, "I", i) for i in range(20_000)])
    rows.write.parquet(str(tmp_path / "f"))
    source, layout = spark.read.parquet(str(tmp_path / "f")), Layout(KeyBuckets(("k",)))
    assert sized(layout, source).partition is None  # one bucket is no partitioning
    few, many = (sized(layout, source, n).partition.count for n in (20_000, 5_000))
    assert 1 < few < many
    monkeypatch.setattr("tidemark.operators.layout.TARGET_BYTES", 20_000)
    table = SnapshotTable(spark, str(tmp_path / "t"))
    apply_feed(spark, source, table, ["k"], layout=layout)
    assert table.layout().partition.count == few and table.row_count() == 20_000
    stream = spark.readStream.schema(source.schema).parquet(str(tmp_path / "f"))
    with pytest.raises(SettingsError, match="state the number"):
        sized(layout, stream)


def test_wrong_buckets(spark, tmp_path):
    table, schema = SnapshotTable(spark, str(tmp_path / "t")), feed(spark, []).schema
    for bad in (KeyBuckets(("nope",), 3), KeyBuckets((), 3), KeyBuckets(("k",), 0), KeyBuckets(("k",))):
        with pytest.raises(SettingsError):
            table.create(schema, Layout(bad))
    with pytest.raises(SettingsError):
        table.create(schema, Layout(bloom=("nope",)))
    table.create(schema, Layout(KeyBuckets(("k",), 3)))
    with pytest.raises(ValueError, match="no partition column"):
        table.read(low=1)
    layout = Layout(KeyBuckets(("k", "v"), 9), ("s",), ("k",))
    assert Layout.from_json(layout.to_json()) == layout


def test_buckets_by_name(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    table = SnapshotTable(spark, str(tmp_path / "t"), "bucketed.t")
    rows = [(i, 1, "I", i) for i in range(40)]
    apply_feed(spark, feed(spark, rows), table, ["k"], layout=Layout(KeyBuckets(("k",), 12)))
    apply_feed(spark, feed(spark, [(3, 2, "U", 9), (4, 2, "D", 1)]), table, ["k"])
    assert state(spark.table("bucketed.t")) == {**{i: (1, i) for i in range(40) if i != 4}, 3: (2, 9)}
    spark.sql("DROP DATABASE bucketed CASCADE")


def scattered(spark, path, layout):
    """100,000 rows in random order, in files of 300."""
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "300")
    try:
        table = SnapshotTable(spark, str(path))
        rows = spark.range(100_000).select((F.col("id") * 7919 % 100_003).alias("k"), F.timestamp_seconds("id").alias("recordstamp"), F.col("id").alias("v"))
        table.create(rows.schema, layout)
        table.overwrite(rows.orderBy(F.xxhash64("k")) if not layout.cluster else rows)
        return table
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def test_bloom_filters_skip_scattered_keys(spark, tmp_path):
    keys = [r.k for r in spark.range(100).select((F.col("id") * 991 * 7919 % 100_003).alias("k")).collect()]
    read = {}
    for name, layout in {"plain": Layout(), "bloom": Layout(bloom=("k",))}.items():
        table = scattered(spark, tmp_path / name, layout)
        hits = table.read().where(F.col("k").isin(keys))
        read[name] = sum(scanned_rows(hits.select("k")))
        assert hits.count() == 100
    # 100 of 334 row groups hold a key
    assert read["plain"] == 100_000 and read["bloom"] < 45_000


def test_merge_of_few_keys_scans_few_row_groups(spark, tmp_path, monkeypatch):
    table = scattered(spark, tmp_path / "t", Layout(bloom=("k",)))
    scans = []
    real = SnapshotTable.stored

    def watched(self, *args):
        rows = real(self, *args)
        scans.append(rows)
        return rows

    changes = spark.sql("SELECT 7919L AS k, timestamp'2030-01-01' AS recordstamp, 5L AS v, 'U' AS operation_flag")
    monkeypatch.setattr(SnapshotTable, "stored", watched)
    merge_into(spark, table, changes, ["k"])
    assert sum(scanned_rows(scans[0].where(F.col("k").isin([7919])).select("k"))) < 3_000
    assert table.read().count() == 100_000 and table.read().where("k = 7919").first().v == 5


def test_clustered_files_are_skipped(spark, tmp_path):
    table = scattered(spark, tmp_path / "t", Layout(cluster=("k",)))
    hits = table.read().where("k BETWEEN 500 AND 900")
    assert hits.count() == 401 and sum(scanned_rows(hits.select("k"))) < 2_000


def test_fresh_state_reads_the_feed_from_the_watermark_on(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.randrange(30), s, rng.choice(["I", "U", "L", "D", None, "X"]), s) for s in range(300)]
    feed(spark, rows).sortWithinPartitions("recordstamp").coalesce(1).write.option("parquet.block.size", 1024).option("parquet.page.size.row.check.min", 20).parquet(str(tmp_path / "f"))
    whole = spark.read.parquet(str(tmp_path / "f"))
    for layout in (Layout(), Layout(KeyBuckets(("k",), 5)), Layout(TimePartition("recordstamp", "day"))):
        table = SnapshotTable(spark, f"{tmp_path}/t{layout.partition.__class__.__name__}")
        assert sorted(fresh_state(table, whole, ["k"], SPEC).collect()) == sorted(ops.current_state(whole, ["k"], SPEC).collect())
        early = whole.where(F.col("recordstamp") < F.lit(at(200)))
        apply_feed(spark, early, table, ["k"], SPEC, layout=layout)
        version = table.current()["version"]
        fresh = fresh_state(table, whole, ["k"], SPEC, columns=["K", "recordstamp", "v"])
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(recordstamp," in plan
        got, shown = state(fresh), sorted(fresh_state(table, whole, ["k"], SPEC).collect())
        assert table.current()["version"] == version
        mark = table.watermark("recordstamp")
        read = scanned_rows(ops.since(whole, mark, SPEC).select("k"))
        assert sum(read) < 200  # the feed's older row groups are not read
        apply_feed(spark, whole, table, ["k"], SPEC)
        assert got == state(table.read()) and shown == sorted(table.read().drop("recordstamp").collect())


def test_fresh_state_of_streamed_tables_is_refused(spark, tmp_path):
    table = open_table(SnapshotTable(spark, str(tmp_path / "t")), feed(spark, []), SPEC, tombstones=True)
    with pytest.raises(ValueError, match="read it"):
        fresh_state(table, feed(spark, []), ["k"], SPEC)


class Clauses:
    def __init__(self, seen):
        self.seen = seen

    def __getattr__(self, name):
        return lambda *args: self.seen.append((name, *map(str, args))) or self


def test_catalog_watermark_is_a_property(spark, tmp_path, monkeypatch):
    name = "spark_catalog.default.marked_target"
    spark.sql(f"CREATE TABLE marked_target (k BIGINT, recordstamp TIMESTAMP, v BIGINT) USING parquet LOCATION '{tmp_path / 'p'}'")
    seen, scans = [], []
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.mergeInto", lambda self, *a: seen.append(sorted((r.k, r.tm_flag) for r in self.collect())) or Clauses([]))
    monkeypatch.setattr(ap, "watermark", lambda *a, real=ap.watermark: scans.append(1) or real(*a))
    apply_feed_to_catalog(spark, feed(spark, [(1, 5, "I", 1), (2, 9, "D", 1)]), name, ["k"], SPEC)
    assert len(scans) == 1 and ap.catalog_mark(spark, name, "recordstamp") == str(int(at(5).timestamp() * 10**6))
    rows = feed(spark, [(1, 4, "U", 7), (1, 6, "D", 1), (2, 7, "I", 2), (3, None, "I", 2)])
    apply_feed_to_catalog(spark, rows, name, ["k"], SPEC)
    assert len(scans) == 1 and seen == [[(1, "I"), (2, "D")], [(1, "D"), (2, "I")]]  # the row at hour 4 is late
    assert ap.catalog_mark(spark, name, "recordstamp") == str(int(at(7).timestamp() * 10**6))
    apply_feed_to_catalog(spark, rows.where("false"), name, ["k"], SPEC)
    assert len(seen) == 2  # nothing new: no merge
    apply_feed_to_catalog(spark, rows, name, ["k"], SPEC, "compare")
    assert len(scans) == 1 and seen[2] == [(1, "D"), (2, "I")]
    spark.sql("DROP TABLE marked_target")


def test_catalog_tables_are_created_with_their_layout(spark, monkeypatch):
    seen = []
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.writeTo", lambda self, name: seen.append((name, self.columns, self.count())) or Clauses(seen))
    rows = feed(spark, [(1, 5, "I", 1)])
    create_in_catalog(spark, "default.made_a", rows)
    create_in_catalog(spark, "default.made_b", rows, layout=Layout(TimePartition("RECORDSTAMP", "month")))
    create_in_catalog(spark, "default.made_c", rows, layout=Layout(KeyBuckets(("k",), 8)))
    assert [s[0] for s in seen] == ["default.made_a", "create", "default.made_b", "partitionedBy", "create", "default.made_c", "partitionedBy", "create"]
    assert seen[0][1:] == (["k", "recordstamp", "v"], 0)
    assert "months(recordstamp)" in seen[3][1].lower() and "bucket" in seen[6][1].lower()
    from tidemark import RangePartition

    with pytest.raises(SettingsError, match="integer ranges"):
        create_in_catalog(spark, "default.made_d", rows, layout=Layout(RangePartition("k", 0, 9, 1)))


def test_key_lists(spark):
    rows = [("T", "B", "X", 2), ("T", "A", "X", 2), ("T", "Z", "X", 1), ("T", "N", "X", None), ("T", ".INCLUDE", "X", 0), ("T", "Q", "", 0), ("/N/U", "/N/K", "X", 1), ("T", "Z", "X", 1)]
    dictionary = spark.createDataFrame(rows, "tabname string, fieldname string, keyflag string, position int")
    assert {r.tabname: r["keys"] for r in primary_key_lists(dictionary).collect()} == {"T": ["Z", "A", "B", "N"], "N_U": ["N_K"]}
    assert primary_keys_of(dictionary, ["x.t", "none"]) == {"x.t": ["Z", "A", "B", "N"], "none": []}
    assert primary_keys_of(dictionary.drop("position"), ["t"]) == {"t": ["A", "B", "N", "Z"]}
