from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import CommitConflict, Layout, RangePartition, SettingsError, SnapshotTable, TimePartition, Warehouse
from tidemark.operators.layout import PART, cluster_by, partition_by_range, partition_by_time

DAY = Layout(TimePartition("t", "day"))


def rows(spark, n=10):
    return spark.range(n).select(
        "id", F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(cast(id AS int))").alias("t"),
        (F.col("id") % 3).cast("int").alias("g"))


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def make(spark, path, layout=Layout(), **kw):
    table = SnapshotTable(spark, str(path), **kw)
    return table.create(rows(spark).schema, layout, stamp="t")


def test_failed_write_leaves_the_old_version(spark, tmp_path, monkeypatch):
    table = make(spark, tmp_path / "t")
    table.overwrite(rows(spark, 3))
    with pytest.raises(Exception, match="boom"):
        table.overwrite(rows(spark, 5).withColumn("id", F.raise_error(F.lit("boom")).cast("long")))
    assert ids(table.read()) == [0, 1, 2]

    def stop(*_):
        raise KeyboardInterrupt

    # Stopped after the rows are written and before the version appears.
    with monkeypatch.context() as m:
        m.setattr(table, "_commit", stop)
        with pytest.raises(KeyboardInterrupt):
            table.overwrite(rows(spark, 7))
    assert ids(SnapshotTable(spark, table.path).read()) == [0, 1, 2]
    assert len(table.drop_orphans()) == 2
    assert ids(table.read()) == [0, 1, 2]
    table.overwrite(rows(spark, 4))
    assert ids(table.read()) == [0, 1, 2, 3]


def test_second_writer_fails(spark, tmp_path):
    table = make(spark, tmp_path / "t")
    manifest = {**table.current(), "version": 2}
    table._commit(manifest)
    with pytest.raises(CommitConflict):
        table._commit(manifest)
    assert not [n for n in table._fs.names(f"{table.path}/_versions") if n.endswith(".tmp")]


def test_only_old_versions_and_their_folders_are_forgotten(spark, tmp_path):
    table = make(spark, tmp_path / "t", DAY)
    for i in range(4):
        table.replace_parts(rows(spark, 1 + i).where(f"id = {i}"), ["2020-01-01"] if i == 3 else [])
    assert table.forget() == [] and table.versions() == [1, 2, 3, 4, 5]
    assert table.forget(timedelta(0), keep=2) == [1, 2, 3]
    assert table.versions() == [4, 5]
    table.append(rows(spark, 1))
    table.forget(timedelta(0), keep=2)
    found = {p.parent.name for p in Path(table.path).glob("base*/*/tm_part=*")}
    assert len(found) == 4
    assert ids(table.read()) == [0, 1, 2, 3]
    table.overwrite(rows(spark, 2))
    table.overwrite(rows(spark, 2))
    table.forget(timedelta(0), keep=2)
    assert len(list(Path(table.path).glob("base*/*"))) == 2


def test_reader_survives_later_commits(spark, tmp_path):
    table = make(spark, tmp_path / "t")
    table.overwrite(rows(spark, 3))
    before = table.read()
    for n in range(5):
        table.overwrite(rows(spark, n))
        table.forget()
    assert ids(before) == [0, 1, 2]


def test_commit_on_an_older_version_conflicts_and_loses_nothing(spark, tmp_path):
    table = make(spark, tmp_path / "t")
    table.overwrite(rows(spark, 3))
    seen = table.current()
    SnapshotTable(spark, table.path).overwrite(rows(spark, 5))
    with pytest.raises(CommitConflict):
        table.overwrite(rows(spark, 1), at=seen)
    assert ids(table.read()) == [0, 1, 2, 3, 4]


def test_append_goes_on_top_of_another_writers_version(spark, tmp_path, monkeypatch):
    table, other = make(spark, tmp_path / "t"), SnapshotTable(spark, str(tmp_path / "t"))
    write = table._write

    def and_another(*args):
        other.append(rows(spark, 2))
        monkeypatch.setattr(table, "_write", write)
        return write(*args)

    monkeypatch.setattr(table, "_write", and_another)
    table.append(rows(spark, 3))
    assert ids(table.read()) == [0, 0, 1, 1, 2] and table.row_count() == 5


@pytest.mark.parametrize("grain,first,count", [
    ("day", "2020-01-01", 10), ("month", "2020-01", 1), ("year", "2020", 1), ("hour", "2020-01-01-00", 10)])
def test_time_partition_folders(spark, tmp_path, grain, first, count):
    table = make(spark, tmp_path / "t", Layout(TimePartition("t", grain)))
    table.overwrite(rows(spark).unionByName(rows(spark, 1).selectExpr("id", "CAST(NULL AS timestamp_ntz) t", "g")))
    folders = sorted(p.name for p in Path(table.path).glob("base*/*/*") if p.is_dir())
    assert folders[0] == f"tm_part={first}"
    assert folders[-1] == "tm_part=__HIVE_DEFAULT_PARTITION__"
    assert len(folders) == count + 1
    assert table.read().count() == 11


def test_range_partition(spark, tmp_path):
    df = spark.createDataFrame([(x,) for x in (-1, 0, 9, 10, 49, 50, None)], "x int")
    got = partition_by_range(df, "x", 0, 50, 10, "b").collect()
    assert {r.x: r.b for r in got} == {-1: None, 0: 0, 9: 0, 10: 10, 49: 40, 50: None, None: None}
    negative = partition_by_range(df, "x", -7, 50, 4, "b").where("x = -1").first().b
    assert negative == -3
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.create(df.schema, Layout(RangePartition("x", 0, 50, 10))).overwrite(df)
    assert {p["part"]: p["rows"] for p in table.current()["parts"]} == {"0": 2, "10": 1, "40": 1, None: 3}
    assert sorted(r.x for r in table.read(low=9, high=20).collect()) == [9, 10]
    assert sorted(r.x for r in table.read(low=10).collect()) == [10, 49, 50]
    assert sorted(r.x for r in table.read(high=0).collect()) == [-1, 0]
    plan = table.read(low=9, high=20)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tm_part" in plan


def test_time_buckets_keep_the_type(spark):
    df = spark.sql("SELECT date'2020-05-17' d, timestamp'2020-05-17 10:20:30' t, "
                   "timestamp_ntz'2020-05-17 10:20:30' n, 'x' s")
    assert partition_by_time(df, "d", "month").first()[PART] == date(2020, 5, 1)
    for column in ("t", "n"):
        out = partition_by_time(df, column, "hour")
        assert out.schema[PART].dataType == df.schema[column].dataType
        assert out.first()[PART] == datetime(2020, 5, 17, 10)


def test_pruned_read_scans_only_its_partitions(spark, tmp_path):
    table = make(spark, tmp_path / "t", DAY)
    table.overwrite(rows(spark))
    df = table.read(low=datetime(2020, 1, 4), high=datetime(2020, 1, 5, 12))
    assert ids(df) == [3, 4]
    assert len(df.inputFiles()) <= 10
    scanned = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tm_part" in scanned
    assert table.layout() == DAY


def test_cluster_orders_files_and_splits_a_frequent_value(spark, tmp_path):
    df = spark.range(4000).select(
        F.when(F.col("id") < 3000, 7).otherwise(F.col("id") % 10).cast("int").alias("c"), "id")
    spread = cluster_by(df.repartition(4), ["c"])
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(c" in plan and "xxhash64(c" in plan.replace("_nondeterministic", "")
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.create(df.schema, Layout(cluster=("c",))).overwrite(df)
    import pyarrow.parquet as pq
    bounds = []
    for file in Path(table.path).glob("base*/*/*.parquet"):
        values = pq.read_table(file).column("c").to_pylist()
        assert values == sorted(values)
        bounds.append((values[0], values[-1]))
    bounds.sort()
    assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:]))


def test_timestamps_are_stored_with_statistics(spark, tmp_path):
    import pyarrow.parquet as pq
    df = rows(spark).select("id", F.col("t").cast("timestamp").alias("t"))
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == "TIMESTAMP_MICROS"
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.create(df.schema).overwrite(df)
    file = next(Path(table.path).glob("base*/*/*.parquet"))
    assert pq.ParquetFile(file).metadata.row_group(0).column(1).statistics.has_min_max


def test_names_follow_the_current_version(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "w"))
    house.create_dataset("names_ds")
    table = house.table("names_ds.t")
    table.create(rows(spark).schema, DAY, "what's in it", stamp="t")
    assert spark.table("names_ds.t").count() == 0
    table.overwrite(rows(spark))
    table.replace_parts(rows(spark, 1), ["2020-01-01", "2020-01-02"])
    assert ids(spark.table("names_ds.t")) == ids(table.read()) == [0, *range(2, 10)]
    text = spark.sql("DESCRIBE EXTENDED names_ds.t").where("col_name = 'Comment'").first()[1]
    assert text == "what's in it"
    wider = rows(spark, 2).withColumn("extra", F.lit("e"))
    table.overwrite(wider, schema=wider.schema)
    assert spark.table("names_ds.t").columns == ["id", "t", "g", "extra"]
    assert spark.table("names_ds.t").count() == 2
    spark.sql("DROP VIEW names_ds.t")
    Warehouse(spark, str(tmp_path / "w")).publish("names_ds")
    assert spark.table("names_ds.t").count() == 2
    assert house.tables("names_ds") == ["t"]


@pytest.mark.parametrize("grain", ["hour", "month", "year"])
def test_names_with_every_grain_after_a_partial_rewrite(spark, tmp_path, grain):
    house = Warehouse(spark, str(tmp_path / "w"))
    house.create_dataset(f"grain_{grain}")
    table = house.table(f"grain_{grain}.t")
    df = rows(spark, 40).withColumn("t", F.expr("t + make_ym_interval(cast(id % 3 as int), cast(id % 2 as int))"))
    df = df.unionByName(df.where("id = 0").selectExpr("100L AS id", "CAST(NULL AS timestamp_ntz) AS t", "g"))
    table.create(df.schema, Layout(TimePartition("t", grain)))
    table.overwrite(df)
    first = table.current()["parts"][0]["part"]
    table.replace_parts(table.stored([first]), [first])
    assert len(table.current()["gens"]) == 2
    assert ids(spark.table(table.name)) == ids(table.read()) == [*range(40), 100]


def test_watermark_without_a_named_stamp(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t")).create(rows(spark).schema)
    table.overwrite(rows(spark, 4))
    mark = spark.range(1).select(table.watermark("t")).first()[0]
    assert mark == datetime(2020, 1, 4)


BAD = [
    ({"partition_details": {"partition_type": "time", "time_grain": "day"}}, "column"),
    ({"partition_details": {"column": "t", "time_grain": "day"}}, "partition_type"),
    ({"partition_details": {"column": "t", "partition_type": "list"}}, "partition_type"),
    ({"partition_details": {"column": "t", "partition_type": "time"}}, "time_grain"),
    ({"partition_details": {"column": "t", "partition_type": "time", "time_grain": "week"}}, "time_grain"),
    ({"partition_details": {"column": "t", "partition_type": "integer_range"}}, "integer_range_bucket"),
    ({"partition_details": {"column": "t", "partition_type": "integer_range",
                            "integer_range_bucket": {"start": 0, "end": 5}}}, "interval"),
    ({"cluster_details": {"columns": []}}, "columns"),
    ({"cluster_details": {"columns": "t"}}, "list"),
    ({"cluster_details": {"columns": list("abcde")}}, "4"),
]


@pytest.mark.parametrize("setting,message", BAD)
def test_bad_layout_settings(setting, message):
    with pytest.raises(SettingsError, match=message):
        Layout.from_settings(setting)


def test_layout_settings(spark):
    zero = {"column": "g", "partition_type": "integer_range",
            "integer_range_bucket": {"start": 0, "end": 5, "interval": 1}}
    layout = Layout.from_settings({"partition_details": zero, "cluster_details": {"columns": ["id"]}})
    assert layout == Layout(RangePartition("g", 0, 5, 1), ("id",))
    assert Layout.from_json(layout.to_json()) == layout
    for details in ({"partition_details": zero}, {"cluster_details": {"columns": ["id"]}}):
        with pytest.raises(SettingsError, match="runtime"):
            Layout.from_settings(details, "RUNTIME")
    schema = rows(spark).withColumn("d", F.current_date()).schema
    for bad in (Layout(TimePartition("g", "day")), Layout(RangePartition("t", 0, 1, 1)),
                Layout(TimePartition("nope", "day")), Layout(cluster=("nope",)),
                Layout(TimePartition("d", "hour"))):
        with pytest.raises(SettingsError):
            bad.check(schema)


def test_ranges_of_clustered_writes_follow_the_input(spark, tmp_path, monkeypatch):
    import tidemark.operators.layout as layouts

    counts = {}
    for n in (1_000, 20_000):
        rows(spark, n).write.parquet(str(tmp_path / f"in{n}"))
        df = spark.read.parquet(str(tmp_path / f"in{n}"))
        assert layouts.ranges_for(df) is None
        monkeypatch.setattr(layouts, "TARGET_BYTES", 2_000)
        joined = df.join(df.selectExpr("id AS other"), F.col("id") == F.col("other"))
        assert layouts.ranges_for(joined) < 3 * layouts.ranges_for(df)
        counts[n] = cluster_by(df, ["g"], ["id"]).rdd.getNumPartitions()
        monkeypatch.undo()
    assert 2 < counts[1_000] < counts[20_000] / 5
