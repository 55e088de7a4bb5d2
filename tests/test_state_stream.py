import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import feed, state
from tidemark import FeedSpec, KeyBuckets, Layout, SettingsError, SnapshotTable, Warehouse
from tidemark.operators import feed as ops
from tidemark.operators.apply import open_table
from tidemark.plans.runner import await_streams, run_cdc, stream_tables
from tidemark.streaming.cdc import stream_with_state

SPEC = FeedSpec(tiebreak=("v",))


def run(spark, landing, target, check, spec=SPEC, **kw):
    stream = ops.stream_feed(spark, landing, feed(spark, []).schema, **kw)
    query = stream_with_state(stream, target, ["K"], check, spec, Layout(KeyBuckets(("k",), 4)))
    query.awaitTermination()
    return query


def test_any_arrival_order_gives_the_current_state(spark, tmp_path):
    """Restarted from its checkpoint for each arrival; the state outlives the query."""
    rng = random.Random(3)
    rows = [(rng.randrange(12), rng.randrange(8), rng.choice(["I", "U", "L", "D", None, "X"]), i) for i in range(200)] + [(None, 3, "I", 1), (4, None, "I", 1)]
    landing, check, table = str(tmp_path / "in"), str(tmp_path / "check"), SnapshotTable(spark, str(tmp_path / "t"))
    rng.shuffle(rows)
    for i in range(3):
        feed(spark, rows[i::3]).coalesce(1).write.mode("append").parquet(landing)
        run(spark, landing, table, check)
        seen = spark.read.parquet(landing).where("recordstamp IS NOT NULL")
        assert sorted(ops.current_state(seen, ["k"], SPEC).collect()) == sorted(table.read().drop("recordstamp").collect())
    assert not table.current()["tombstones"] and table.row_count() == table.read().count()
    state_files = list((tmp_path / "check" / "state" / "0").rglob("*.zip")) + list((tmp_path / "check" / "state" / "0").rglob("*.changelog"))
    assert state_files  # written by the RocksDB store


def test_a_batch_commits_its_changes_and_not_the_whole_state(spark, tmp_path):
    landing, check, table = str(tmp_path / "in"), tmp_path / "check", SnapshotTable(spark, str(tmp_path / "t"))
    for i in range(3):
        feed(spark, [(k, i, "U" if k % 7 else "D", i) for k in range(i, 40, i + 1)]).coalesce(1).write.mode("append").parquet(landing)
        run(spark, landing, table, str(check))
        parts = [p for p in (check / "state" / "0").iterdir() if p.name.isdigit()]
        assert parts and all((p / f"{i + 1}.changelog").exists() for p in parts)
    assert sorted(ops.current_state(spark.read.parquet(landing), ["k"], SPEC).collect()) == sorted(table.read().drop("recordstamp").collect())


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    landing, check, table = str(tmp_path / "in"), tmp_path / "check", SnapshotTable(spark, str(tmp_path / "t"))
    feed(spark, [(1, 1, "I", 1), (2, 1, "I", 2)]).coalesce(1).write.parquet(landing)
    run(spark, landing, table, str(check))
    version = table.current()["version"]
    for name in ("0", ".0.crc"):  # as if the query had died after the table's commit
        (check / "commits" / name).unlink()
    run(spark, landing, table, str(check))
    assert table.current()["version"] == version and state(table.read()) == {1: (1, 1), 2: (1, 2)}
    feed(spark, [(1, 0, "U", 9), (2, 5, "D", 0), (3, 1, "I", 3)]).coalesce(1).write.mode("append").parquet(landing)
    run(spark, landing, table, str(check))
    feed(spark, [(2, 4, "U", 9)]).coalesce(1).write.mode("append").parquet(landing)
    run(spark, landing, table, str(check))
    assert state(table.read()) == {1: (1, 1), 3: (1, 3)}


def test_conditions_that_mark_deletes(spark, tmp_path):
    landing, table = str(tmp_path / "in"), SnapshotTable(spark, str(tmp_path / "t"))
    feed(spark, [(1, 1, "I", 1), (2, 1, "I", 2), (1, 2, "U", -1)]).write.parquet(landing)
    run(spark, landing, table, str(tmp_path / "check"), FeedSpec(tiebreak=("v",), delete_when="v < 0"))
    assert state(table.read()) == {2: (1, 2)}


def test_tables_of_the_other_kind_are_refused(spark, tmp_path):
    table = open_table(SnapshotTable(spark, str(tmp_path / "t")), feed(spark, []), SPEC, tombstones=True)
    (tmp_path / "in").mkdir()
    with pytest.raises(ValueError, match="stream_cdc"):
        run(spark, str(tmp_path / "in"), table, str(tmp_path / "check"))


def test_catalog_tables_are_merged_by_the_catalog(spark, tmp_path, monkeypatch):
    from tidemark.streaming import cdc

    made, merged = [], []
    monkeypatch.setattr(cdc, "create_in_catalog", lambda spark, name, *a: made.append(name))
    monkeypatch.setattr(cdc, "merge_into_catalog", lambda spark, name, rows, keys, spec: merged.append((name, keys, {(r.k, r.operation_flag, r.v) for r in rows.collect()})))
    landing = str(tmp_path / "in")
    for rows in ([(1, 1, "I", 1), (2, 2, None, 2)], [(1, 0, "U", 7), (2, 3, "D", 3)]):
        feed(spark, rows).coalesce(1).write.mode("append").parquet(landing)
        run(spark, landing, "cat.cdc.t", str(tmp_path / "check"))
    assert made == ["cat.cdc.t"] * 2
    assert merged == [("cat.cdc.t", ["k"], {(1, "U", 1), (2, "U", 2)}), ("cat.cdc.t", ["k"], {(1, "U", 1), (2, "D", 3)})]


@pytest.mark.parametrize("bound", ["files", "bytes"])
def test_a_trigger_takes_no_more_than_its_bound(spark, tmp_path, bound):
    landing = tmp_path / "in"
    feed(spark, [(i, i, "I", i) for i in range(80)]).repartition(8).write.parquet(str(landing))
    largest = max(f.stat().st_size for f in landing.glob("*.parquet"))
    limit = {"max_files": 3} if bound == "files" else {"max_bytes": 3 * largest}
    stream = ops.stream_feed(spark, str(landing), feed(spark, []).schema, **limit)
    sizes = []
    writer = stream.writeStream.option("checkpointLocation", str(tmp_path / "check"))
    writer.foreachBatch(lambda rows, i: sizes.append(rows.select(F.input_file_name()).distinct().count())).trigger(availableNow=True).start().awaitTermination()
    assert sum(sizes) == 8 and max(sizes) <= 4 and len(sizes) >= 3
    assert bound == "bytes" or sizes == [3, 3, 2]


def test_files_taken_in_are_archived(spark, tmp_path):
    landing, archive = tmp_path / "in", tmp_path / "old"
    for i in range(3):
        feed(spark, [(i, i, "I", i)]).coalesce(1).write.mode("append").parquet(str(landing))
        stream = ops.stream_feed(spark, str(landing), feed(spark, []).schema, max_files=1, when_done="archive", archive=str(archive))
        stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    assert list(archive.rglob("*.parquet")) and len(list(landing.glob("*.parquet"))) < 3
    for bad in ({"max_files": 1, "max_bytes": 1}, {"when_done": "archive"}, {"archive": "x"}, {"when_done": "burn"}):
        with pytest.raises(SettingsError):
            ops.stream_feed(spark, str(landing), feed(spark, []).schema, **bad)


def test_one_failing_stream_stops_no_other(spark, tmp_path):
    house, landing, schema = Warehouse(spark, str(tmp_path / "w")), tmp_path / "in", feed(spark, []).schema
    for name in ("one", "two", "late"):
        feed(spark, [(1, 1, "I", 1), (2, 1, "I", 2)]).write.parquet(f"{landing}/{name}")
    feed(spark, [(1, 1, "I", 1)]).withColumn("v", F.lit("text")).write.parquet(f"{landing}/broken")
    names = ["one", "two", "broken", "absent", "late"]
    dictionary = spark.createDataFrame([(n.upper(), "K", "X", 1) for n in names], "tabname string, fieldname string, keyflag string, position int")
    settings = [{"base_table": n, "load_frequency": "@hourly", "target_table": f"t_{n}"} for n in names] + [{"base_table": "view", "load_frequency": "RUNTIME"}]
    schemas = {n: schema for n in names if n != "absent"}
    tag = f"streams{abs(hash(str(tmp_path))) % 10**9}"
    for step in range(2):
        streams = {s.base_table: s for s in await_streams(stream_tables(house, settings, str(landing), schemas, dictionary, tag, str(tmp_path / "check"), spec=SPEC, buckets=2 if step else None))}
        assert set(streams) == set(names)
        assert streams["absent"].query is None and isinstance(streams["absent"].error, KeyError)
        assert streams["broken"].query is not None and streams["broken"].error is not None
        for n in ("one", "two", "late"):
            assert streams[n].error is None and streams[n].target == f"{tag}.t_{n}"
            assert state(spark.table(f"{tag}.t_{n}")) == ({1: (1, 1), 2: (1, 2)} if not step or n != "one" else {2: (1, 2)})
        feed(spark, [(1, 2, "D", 1)]).write.mode("append").parquet(f"{landing}/one")
    with pytest.raises(SettingsError, match="no primary key"):
        stream_tables(house, [{"base_table": "nokey", "load_frequency": "@daily"}], str(landing), {}, dictionary, tag, str(tmp_path / "c2"))


def test_frequencies_and_buckets_of_many_tables(spark, tmp_path, monkeypatch):
    house = Warehouse(spark, str(tmp_path / "w"))
    raw, cdc = (f"{n}{abs(hash(str(tmp_path))) % 10**9}" for n in ("fraw", "fcdc"))
    house.create_dataset(raw)
    feed(spark, [(i, 1, "I", i) for i in range(5000)]).write.parquet(str(tmp_path / "f"))
    for name in ("one", "two"):
        spark.sql(f"CREATE VIEW {raw}.{name} AS SELECT * FROM parquet.`{tmp_path / 'f'}`")
    spark.sql(f"CREATE VIEW {raw}.dd03l AS SELECT * FROM VALUES ('ONE', 'K', 'X', 1), ('TWO', 'K', 'X', 1) AS t(tabname, fieldname, keyflag, position)")
    settings = [{"base_table": "one", "load_frequency": "@hourly"}, {"base_table": "two", "load_frequency": "@yearly"}]
    monkeypatch.setattr("tidemark.operators.layout.TARGET_BYTES", 10_000)
    assert [r.base_table for r in run_cdc(house, settings, raw, cdc, spec=SPEC, frequencies=["@hourly"])] == ["one"]
    assert house.tables(cdc) == ["one"] and isinstance(house.table(f"{cdc}.one").layout().partition, KeyBuckets)
    assert len(run_cdc(house, settings, raw, cdc, spec=SPEC, bucketed=False)) == 2
    assert house.table(f"{cdc}.two").layout().partition is None and spark.table(f"{cdc}.two").count() == 5000
    assert run_cdc(house, settings, raw, cdc, spec=SPEC, frequencies=[]) == []
