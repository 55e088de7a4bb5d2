import random

import pytest
from pyspark.sql import functions as F

from tests import model
from tests.helpers import feed, state
from tidemark import FeedSpec
from tidemark.functions.columns import normalize_name
from tidemark.operators import feed as ops
from tidemark.operators.keys import key_fields, primary_keys, primary_keys_of
from tidemark.spec import SettingsError

SPEC = FeedSpec(tiebreak=("v",))
METHODS = ("window", "aggregate")


@pytest.mark.parametrize("method", METHODS)
def test_flag_order_within_a_stamp(spark, method):
    flags = ["D", "X", "U", "L", "I", None]
    for i, first in enumerate(flags):
        rows = feed(spark, [(1, 5, f, 0) for f in reversed(flags[i:])])
        got = ops.latest_per_key(rows, ["k"], SPEC, method=method).collect()
        assert [r.operation_flag for r in got] == [first]


@pytest.mark.parametrize("method", METHODS)
def test_null_stamp_comes_last_but_counts_in_the_view(spark, method):
    rows = feed(spark, [(1, None, "U", 9), (1, 3, "U", 1), (2, None, "I", 4), (None, 8, "I", 5)])
    got = ops.current_state(rows, ["k"], SPEC, method=method).collect()
    assert sorted((r.k, r.v) for r in got) == [(1, 1), (2, 4)]
    assert got[0].__fields__ == ["k", "v"]


@pytest.mark.parametrize("method", METHODS)
def test_current_state_matches_model(spark, method):
    rng = random.Random(7)
    rows = [
        (rng.choice([None, *range(30)]), rng.choice([None, *range(6)]),
         rng.choice(["I", "U", "L", "D", "X", None]), i)
        for i in range(600)
    ]
    # A third of all rows on one key.
    rows += [(0, rng.randrange(6), rng.choice("IUD"), 1000 + i) for i in range(300)]
    df = feed(spark, rows).repartition(5)
    got = state(ops.not_deleted(ops.latest_per_key(
        ops.keys_not_null(df, ["K"]), ["K"], SPEC, method=method)))
    assert got == model.current_state(rows)
    chosen = ops.current_state(df, ["k"], SPEC, columns=["v"], method=method)
    assert chosen.columns == ["v"]
    assert sorted(r.v for r in chosen.collect()) == sorted(v for _, v in got.values())


def test_stored_view_text_gives_the_same_rows(spark):
    rows = [(i % 7, i // 10, "IULDX"[i % 5], i) for i in range(200)]
    feed(spark, rows).createOrReplaceTempView("raw_rows")
    df = spark.table("raw_rows")
    for spec in (SPEC, FeedSpec(tiebreak=("v",), delete_when="v % 4 = 0")):
        text = ops.current_state_sql("raw_rows", df.columns, ["K"], spec)
        want = ops.current_state(df, ["k"], spec).collect()
        assert sorted(spark.sql(text).collect()) == sorted(want) != []


def test_chosen_columns_with_a_delete_condition(spark):
    rows = feed(spark, [(1, 1, "I", 1), (2, 1, "I", 2), (1, 2, "U", 3)]).selectExpr("*", "v = 3 AS gone")
    spec = FeedSpec(tiebreak=("v",), delete_when="gone")
    for method in METHODS:
        got = ops.current_state(rows, ["k"], spec, columns=["k"], method=method)
        assert [tuple(r) for r in got.collect()] == [(2,)]


def test_window_plan_reduces_before_the_shuffle_and_prunes_columns(spark, tmp_path):
    feed(spark, [(1, 1, "I", 1)]).withColumn("wide", F.lit("x")).write.parquet(str(tmp_path / "f"))
    df = ops.scan_feed(spark, str(tmp_path / "f"))
    lazy = ops.current_state(df, ["k"]).select("v")
    plan = lazy._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert "wide" not in plan
    best = ops.current_state(df, ["k"], method="aggregate")
    assert "partial_max_by" in best._jdf.queryExecution().executedPlan().toString()


def test_projections_tolerate_missing_columns(spark):
    rows = feed(spark, [(1, 1, "I", 1)])
    assert ops.cdc_columns(rows).columns == ["k", "recordstamp", "v"]
    assert ops.view_columns(rows).columns == ["k", "v"]
    other = rows.withColumnRenamed("operation_flag", "OperationalFlag").withColumn(
        "IsDeleted", F.lit(False))
    assert ops.cdc_columns(other, FeedSpec.camel_case()).columns == ["k", "recordstamp", "v"]


def test_watermark_and_new_records(spark):
    for ntz in (False, True):
        rows = feed(spark, [(1, 1, "I", 1), (2, 2, "I", 2), (3, None, "I", 3)], ntz)
        empty = ops.cdc_columns(rows).where("false")
        mark = ops.watermark(empty)
        assert mark.schema["watermark"].dataType == rows.schema["recordstamp"].dataType
        text = mark.select(F.col("watermark").cast("string")).first()[0]
        assert text == "1940-12-25 05:30:00"
        # Rows without a stamp are never new; the highest stamp itself is read again.
        assert {r.k for r in ops.new_records(rows, empty).collect()} == {1, 2}
        target = ops.cdc_columns(rows).where("k = 2")
        assert {r.k for r in ops.new_records(rows, target).collect()} == {2}


def test_watermark_floor_hides_older_rows(spark):
    rows = spark.sql(
        "SELECT 1L AS k, timestamp'1940-12-25 05:29:59Z' AS recordstamp, 'I' AS operation_flag, 1 AS v "
        "UNION ALL SELECT 2L, timestamp'1940-12-25 05:30:00Z', 'I', 2")
    assert [r.k for r in ops.new_records(rows, ops.cdc_columns(rows).where("false")).collect()] == [2]


def test_landing_partition_is_pruned(spark, tmp_path):
    path = str(tmp_path / "feed")
    rows = feed(spark, [(i, 24 * i, "I", i) for i in range(5)], ntz=True)
    rows.withColumn("day", F.to_date("recordstamp")).write.partitionBy("day").parquet(path)
    raw = spark.read.parquet(path)
    target = ops.cdc_columns(rows).where("k = 3")
    new = ops.new_records(raw, target, FeedSpec(landing=("day", "day")))
    assert {r.k for r in new.collect()} == {3, 4}
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_landing_column_must_be_a_time(spark):
    rows = feed(spark, [(i, 24 * i, "I", i) for i in range(5)])
    target = ops.cdc_columns(rows).where("k = 3")
    for day, kind in (("CAST(date_format(recordstamp, 'yyyyMMdd') AS INT)", "int"),
                      ("date_format(recordstamp, 'yyyy-MM-dd')", "string")):
        with pytest.raises(SettingsError, match=kind):
            ops.new_records(rows.withColumn("day", F.expr(day)), target, FeedSpec(landing=("day", "day")))
    dated = rows.withColumn("day", F.to_date("recordstamp"))
    found = ops.new_records(dated, target, FeedSpec(landing=("DAY", "day")))
    assert {r.k for r in found.collect()} == {3, 4}


def test_normalize_name(spark):
    names = ["/OPT/Z_TABLE", "PLAIN", "A/B/C", "//X", "/", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(normalize_name(F.col("n"))).collect()]
    assert got == ["OPT_Z_TABLE", "PLAIN", "A_B_C", "_X", "", None]
    assert df.select(normalize_name(F.col("n"), "#")).first()[0] == "OPT#Z_TABLE"


def dictionary(spark):
    return spark.createDataFrame(
        [
            ("BKPF", "MANDT", "X", "0001"), ("BKPF", "BELNR", "X", "0003"),
            ("BKPF", "BUKRS", "X", "0002"), ("BKPF", "BUDAT", "", "0004"),
            ("BKPF", ".INCLUDE", "X", "0005"), ("BKPF", None, "X", "0006"),
            ("BKPF", ".INCLU--AP", "X", "0007"), ("BKPF", "BELNR", "X", "0003"),
            ("/OPT/DOC", "/OPT/ID", "X", "0001"), ("NOKEY", "F", " ", "0001"),
        ],
        "tabname string, fieldname string, keyflag string, position string",
    )


def test_primary_keys(spark):
    dd = dictionary(spark)
    assert primary_keys(dd, "proj.raw.bkpf") == ["MANDT", "BUKRS", "BELNR", ".INCLU--AP"]
    assert primary_keys(dd, "opt_doc") == ["OPT_ID"]
    assert primary_keys_of(dd, ["bkpf", "nokey"])["nokey"] == []
    with pytest.raises(SettingsError, match="nokey"):
        primary_keys(dd, "nokey")
    assert key_fields(dd.drop("position")).count() == 5
    assert primary_keys(dd.drop("position"), "bkpf")[1:] == ["BELNR", "BUKRS", "MANDT"]


def test_unknown_key_is_an_error(spark):
    with pytest.raises(ValueError, match="nope"):
        ops.keys_not_null(feed(spark, [(1, 1, "I", 1)]), ["nope"])


def test_scan_feed_reads_paths_and_tables(spark, tmp_path):
    path = str(tmp_path / "raw")
    feed(spark, [(1, 1, "I", 1)]).write.parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("some_feed")
    assert ops.scan_feed(spark, path).columns == ops.scan_feed(spark, "some_feed").columns
