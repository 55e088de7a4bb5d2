import threading

import pytest
from pyspark.errors import AnalysisException, ParseException

from tests.helpers import feed, state
from tidemark import FeedSpec, Layout, SettingsError, TimePartition, Warehouse
from tidemark.plans import graph
from tidemark.plans import reporting as rep
from tidemark.plans.runner import entries_for, read_settings, run_cdc
from tidemark.spec import check_objects, check_table_entries, check_table_setting


@pytest.fixture
def house(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "w"))
    house.tag = f"rep{abs(hash(str(tmp_path))) % 10**9}"
    house.create_dataset(house.tag)
    return house


def test_view_with_description(spark, house):
    name = f"{house.tag}.v"
    rep.create_view(house, name, "SELECT 1 AS a", "it's a view")
    rep.create_view(house, name, "SELECT 2 AS a", "it's a view")
    assert spark.table(name).first().a == 2
    rows = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert rows["Comment"] == "it's a view"


def test_empty_table_from_query(spark, house):
    name = f"{house.tag}.t"
    sql = "SELECT id, timestamp_seconds(id) AS t, raise_error('never run') AS r FROM range(3)"
    layout = Layout(TimePartition("t", "day"), ("id",))
    rep.create_table_as_schema(house, name, sql, layout, "desc", comments={"id": "the id"})
    df = spark.table(name)
    assert df.count() == 0 and df.columns == ["id", "t", "r"]
    assert house.table(name).layout() == layout
    assert house.table(name).schema()["id"].metadata == {"comment": "the id"}
    described = {r[0]: r[2] for r in spark.sql(f"DESCRIBE {name}").collect()}
    assert described["id"] == "the id"
    with pytest.raises(SettingsError, match="nope"):
        rep.create_table_as_schema(house, f"{house.tag}.u", "SELECT 1 AS a", Layout(cluster=("nope",)))
    with pytest.raises(ParseException):
        rep.create_table_as_schema(house, f"{house.tag}.u", "SELEC 1")
    assert not house.exists(f"{house.tag}.u")


def test_refresh_is_by_position_and_atomic(spark, house):
    name = f"{house.tag}.t"
    rep.create_table_as_schema(house, name, "SELECT 'x' AS a, 1L AS b")
    rep.refresh_table(house, name, "SELECT 5 AS b, 7 AS a")
    assert [tuple(r) for r in spark.table(name).collect()] == [("5", 7)]
    for bad, message in (("SELECT 1", "columns"), ("SELECT 1, 'text'", "cannot be stored")):
        with pytest.raises(ValueError, match=message):
            rep.refresh_table(house, name, bad)
    with pytest.raises(Exception, match="(?i)overflow"):
        rep.refresh_table(house, name, "SELECT 'a', 1e30D")
    with pytest.raises(AnalysisException):
        rep.refresh_table(house, name, "SELECT * FROM no_such_table")
    assert [tuple(r) for r in spark.table(name).collect()] == [("5", 7)]
    # A table may be refreshed from itself.
    rep.refresh_table(house, name, f"SELECT a, b + 1 FROM {name} UNION ALL SELECT 'z', NULL")
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [("5", 8), ("z", None)]
    with pytest.raises(ValueError, match="does not exist"):
        rep.refresh_table(house, f"{house.tag}.absent", "SELECT 1")


def test_object_policy(spark, house, tmp_path):
    file = tmp_path / "sales.sql"
    file.write_text("SELECT id FROM range(4)")
    obj = {"type": "table", "sql_file": str(file), "table_setting": {"load_frequency": "@daily"}}
    assert rep.materialize(house, obj, house.tag, "cdc") == "created"
    assert spark.table(f"{house.tag}.sales").count() == 0
    assert rep.materialize(house, obj, house.tag, "cdc", load=True) == "skipped"
    assert spark.table(f"{house.tag}.sales").count() == 0
    assert rep.materialize(house, obj, house.tag, load=True) == "recreated"
    assert spark.table(f"{house.tag}.sales").count() == 4
    view = {"type": "view", "name": "v", "sql": "SELECT 1 AS a", "description": "d"}
    assert rep.materialize(house, view, house.tag) == "created"
    assert rep.materialize(house, {**view, "sql": "SELECT 2 AS b"}, house.tag) == "recreated"
    assert rep.materialize(house, {**obj, "name": "v"}, house.tag, load=True) == "recreated"
    assert spark.table(f"{house.tag}.v").count() == 4
    assert rep.materialize(house, {**view, "sql": "SELECT 3 AS c"}, house.tag) == "recreated"
    assert spark.table(f"{house.tag}.v").first().c == 3
    assert not house.table(f"{house.tag}.v").exists()
    with pytest.raises(ValueError, match="stored table"):
        rep.create_view(house, f"{house.tag}.sales", "SELECT 1 AS a")
    with pytest.raises(ValueError, match="type"):
        rep.materialize(house, {"type": "model", "name": "m", "sql": "SELECT 1"}, house.tag)
    with pytest.raises(AnalysisException):
        rep.materialize(house, {**view, "sql": "SELECT nope"}, house.tag)


def test_all_objects_of_the_settings(spark, house):
    d = house.tag
    setting = {"load_frequency": "@daily"}
    settings = {
        "bq_independent_objects": [
            {"type": "table", "name": "a", "sql": "SELECT 1 AS x", "table_setting": setting},
            {"type": "table", "name": "b", "sql": "SELECT 2 AS x", "table_setting": setting},
        ],
        "bq_dependent_objects": [
            {"type": "view", "name": "c", "sql": f"SELECT a.x + b.x AS x FROM {d}.a JOIN {d}.b"},
            {"type": "table", "name": "d", "sql": f"SELECT x * 2 AS x FROM {d}.c", "table_setting": setting},
        ],
    }
    out = rep.materialize_all(house, settings, d, load=True)
    assert out == dict.fromkeys("abcd", "created")
    assert spark.table(f"{d}.d").first().x == 6
    twice = {**settings, "bq_dependent_objects": settings["bq_independent_objects"][:1]}
    with pytest.raises(SettingsError, match="more than once"):
        rep.materialize_all(house, twice, d)
    with pytest.raises(SettingsError, match="need one of"):
        rep.materialize_all(house, {}, d)
    settings["bq_dependent_objects"][0]["sql"] = "SELECT nope"
    with pytest.raises(AnalysisException):
        rep.materialize_all(house, settings, d)


def test_script(spark, house):
    rep.materialize(house, {"type": "script", "name": "s", "sql": (
        f"CREATE OR REPLACE FUNCTION {house.tag}.plus(x INT) RETURNS INT RETURN x + 1; "
        f"CREATE OR REPLACE VIEW {house.tag}.w AS SELECT {house.tag}.plus(1) AS two;")}, house.tag)
    assert spark.table(f"{house.tag}.w").first().two == 2
    assert rep.run_script(spark, "SELECT 3 AS a").first().a == 3
    out = rep.run_script(spark, "BEGIN DECLARE n INT DEFAULT 4; SELECT n AS a; END")
    assert out.first().a == 4


CONFIG = {
    "projectIdSource": "src", "projectIdTarget": "", "location": "US", "deploySAP": True,
    "SAP": {"SQLFlavor": "ECC", "mandt": "100", "languages": ["E", "S"], "currencies": ["EUR", "CHF"],
            "datasets": {"cdc": "c", "raw": "r", "reporting": "REPORTING", "cdcECC": "ce"}},
    "k9": {"datasets": {"processing": "kp", "reporting": "kr"}},
    "SFDC": {"datasets": {"raw": "sr"}, "currencies": ["USD"]},
    "marketing": {"deployMeta": True, "Meta": {"datasets": {"cdc": "mc"}}},
}


def test_parameters(spark, house):
    params = rep.query_params({**CONFIG, "SAP": {**CONFIG["SAP"], "datasets": {"cdc": house.tag}}})
    rep.create_view(house, f"{house.tag}.c", "SELECT * FROM VALUES ('USD', 1), ('EUR', 2) AS t(c, v)")
    sql = ("SELECT sum(v) AS s, :mandt AS client FROM IDENTIFIER(:dataset_cdc_processed || '.c') "
           "WHERE array_contains(:sap_currencies, c)")
    assert tuple(rep.run_query(spark, sql, params).first()) == (2, "100")
    view = {"type": "view", "name": "p", "sql": sql}
    rep.materialize(house, view, house.tag, params=params)
    assert tuple(spark.table(f"{house.tag}.p").first()) == (2, "100")
    table = {"type": "table", "name": "q", "sql": sql, "table_setting": {"load_frequency": "@daily"}}
    rep.materialize(house, table, house.tag, params=params, load=True)
    assert tuple(spark.table(f"{house.tag}.q").first()) == (2, "100")
    script = f"CREATE OR REPLACE VIEW {house.tag}.x AS SELECT :sql_flavour AS f; SELECT 1;"
    rep.materialize(house, {"type": "script", "name": "x", "sql": script}, house.tag, params=params)
    assert spark.table(f"{house.tag}.x").first().f == "ecc"


def test_parameters_of_a_configuration():
    params = rep.query_params(CONFIG)
    assert params["dataset_cdc_processed_ecc"] == "ce" and "dataset_raw_landing_s4" not in params
    assert params["k9_datasets_processing"] == "kp" and params["sfdc_currencies"] == ["USD"]
    assert params["marketing_meta_datasets_cdc"] == "mc" and params["sap_languages"] == ["E", "S"]
    assert rep.query_params({}) == {}


def table(name, sql, parents=None, frequency=None, group="G one"):
    dag = {"name": group, **({"parents": parents} if parents else {})}
    setting = {"dag_setting": dag, **({"load_frequency": frequency} if frequency else {})}
    return {"type": "table", "name": name, "sql": sql, "table_setting": setting}


def test_graph_order(spark, house):
    d = house.tag
    objects = [
        table("c", f"SELECT a.x + b.x AS x FROM {d}.a JOIN {d}.b", ["a", "b"]),
        table("b", f"SELECT x * 10 AS x FROM {d}.a", ["a"]),
        table("a", "SELECT 2 AS x", frequency="@daily"),
        table("z", "SELECT 9 AS x", frequency="@hourly", group="Other"),
        {"type": "table", "name": "alone", "sql": "SELECT 1 AS x",
         "table_setting": {"load_frequency": "@daily"}},
    ]
    done = graph.refresh_graph(house, objects, d)
    assert done == {"g_one": ["a", "b", "c"], "other": ["z"]}
    assert spark.table(f"{d}.c").first().x == 22
    assert not house.exists(f"{d}.alone")


def test_graph_runs_independent_objects_side_by_side(spark, house, monkeypatch):
    meet = threading.Barrier(2, timeout=60)

    def refresh(warehouse, name, sql, params):
        if not name.endswith("last"):
            meet.wait()

    monkeypatch.setattr(graph, "refresh_table", refresh)
    objects = [table("p", "SELECT 1 AS x", frequency="@daily"),
               table("q", "SELECT 1 AS x", frequency="@daily"),
               table("last", "SELECT 1 AS x", ["p", "q"])]
    assert graph.refresh_graph(house, objects, house.tag)["g_one"][-1] == "last"


def test_graph_failure_stops_children_and_keeps_tables(spark, house):
    d = house.tag
    good = [table("a", "SELECT 1 AS x", frequency="@daily"),
            table("b", f"SELECT x FROM {d}.a", ["a"])]
    graph.refresh_graph(house, good, d)
    bad = [table("a", "SELECT CAST(raise_error('down') AS INT) AS x", frequency="@daily"),
           table("b", f"SELECT x + 5 AS x FROM {d}.a", ["a"])]
    with pytest.raises(Exception, match="down"):
        graph.refresh_graph(house, bad, d)
    assert spark.table(f"{d}.a").first().x == spark.table(f"{d}.b").first().x == 1


def test_graph_failure_stops_what_is_queued(house, monkeypatch):
    started = []

    def refresh(warehouse, name, sql, params):
        started.append(name)
        raise RuntimeError("down")

    monkeypatch.setattr(graph, "refresh_table", refresh)
    monkeypatch.setattr(graph, "create_table_as_schema", lambda *a: None)
    objects = [table(n, "SELECT 1 AS x", frequency="@daily", group=f"G {n}") for n in "abcd"]
    with pytest.raises(RuntimeError, match="down"):
        graph.refresh_graph(house, objects, house.tag, parallel=1)
    assert len(started) == 1


def test_graph_groups_run_side_by_side(house, monkeypatch):
    meet = threading.Barrier(2, timeout=60)
    monkeypatch.setattr(graph, "refresh_table", lambda *a: meet.wait())
    monkeypatch.setattr(graph, "create_table_as_schema", lambda *a: None)
    objects = [table(n, "SELECT 1 AS x", frequency="@daily", group=f"G {n}") for n in "ab"]
    assert graph.refresh_graph(house, objects, house.tag) == {"g_a": ["a"], "g_b": ["b"]}


@pytest.mark.parametrize("objects,message", [
    ([table("a", "", ["b"]), table("b", "", ["a"])], "cycle"),
    ([table("a", "", ["b"]),
      {"type": "table", "name": "b", "table_setting": {"load_frequency": "@daily"}}], "dag_setting"),
    ([table("a", "", ["gone"])], "unknown parents"),
    ([table("a", "", frequency="@daily"), table("b", "", frequency="@hourly")], "agree"),
    ([table("a", "")], "agree"),
    ([table("a", "", frequency="@daily"), table("b", "", ["a"], group="H")], "unknown parents"),
])
def test_bad_graphs(house, objects, message):
    with pytest.raises(SettingsError, match=message):
        graph.refresh_graph(house, objects, house.tag)


@pytest.mark.parametrize("setting,message", [
    (None, "table_setting"),
    ({}, "table_setting"),
    ({"partition_details": {}}, "load_frequency"),
    ({"load_frequency": "@daily", "dag_setting": {"name": "g", "parents": ["a"]}}, "exclude"),
    ({"load_frequency": "runtime"}, "runtime"),
])
def test_bad_table_settings(setting, message):
    with pytest.raises(SettingsError, match=message):
        check_table_setting(setting)


@pytest.mark.parametrize("objects,message", [
    ([], "no reporting"),
    ([{"name": "a"}], "type"),
    ([{"type": "view"}], "sql_file"),
    ([{"type": "view", "sql_file": "a"}, {"type": "view", "sql_file": "a"}], "more than once"),
    ([{"type": "table", "sql_file": "a"}], "table_setting"),
])
def test_bad_objects(objects, message):
    with pytest.raises(SettingsError, match=message):
        check_objects(objects)


@pytest.mark.parametrize("entries,message", [
    ([{"load_frequency": "@daily"}], "base_table"),
    ([{"base_table": "a"}], "load_frequency"),
    ([{"base_table": "a", "load_frequency": "x"}] * 2, "more than once"),
    ([{"base_table": "a", "load_frequency": "RUNTIME", "cluster_details": {"columns": ["x"]}}], "runtime"),
])
def test_bad_entries(entries, message):
    with pytest.raises(SettingsError, match=message):
        check_table_entries(entries)


def test_run_many_tables(spark, house, tmp_path):
    raw, cdc, spec = f"{house.tag}_raw", f"{house.tag}_cdc", FeedSpec(tiebreak=("v",))
    house.create_dataset(raw)
    feed(spark, [(1, 1, "I", 1), (2, 2, "I", 2), (2, 3, "D", 2)]).write.parquet(str(tmp_path / "f"))
    for name in ("one", "two"):
        spark.sql(f"CREATE VIEW {raw}.{name} AS SELECT * FROM parquet.`{tmp_path / 'f'}`")
    spark.sql(
        f"CREATE VIEW {raw}.dd03l AS SELECT * FROM VALUES ('ONE', 'K', 'X'), ('TWO', 'K', 'X') "
        "AS t(tabname, fieldname, keyflag)")
    settings = tmp_path / "settings.yaml"
    settings.write_text(
        "data_to_replicate:\n"
        "- {base_table: one, load_frequency: '@hourly', target_table: uno}\n"
        "- {base_table: two, load_frequency: RUNTIME}\n"
        "- {base_table: three, load_frequency: '@daily', sql_flavour: s4}\n")
    loaded = read_settings(str(settings))
    assert run_cdc(house, loaded, raw, cdc, spec=spec, load=False)[0].rows == 0
    assert spark.table(f"{cdc}.uno").count() == 0
    runs = run_cdc(house, loaded, raw, cdc, spec=spec)
    assert [(r.base_table, r.kind, r.rows) for r in runs] == [("one", "table", 1), ("two", "view", None)]
    assert state(spark.table(f"{cdc}.uno")) == {1: (1, 1)}
    assert [tuple(r) for r in spark.table(f"{cdc}.two").collect()] == [(1, 1)]
    feed(spark, [(3, 9, "I", 3)]).write.mode("append").parquet(str(tmp_path / "f"))
    run_cdc(house, loaded, raw, cdc, spec=spec)
    assert spark.table(f"{cdc}.uno").count() == spark.table(f"{cdc}.two").count() == 2
    assert len(entries_for(loaded, "S4")) == 3
    with pytest.raises(SettingsError, match="three"):
        run_cdc(house, loaded, raw, cdc, "S4", spec=spec)
    with pytest.raises(SettingsError, match="flavour"):
        run_cdc(house, loaded, raw, cdc, "R2")
    # One table fails; the other is still refreshed, and the failure is raised.
    spark.sql(f"CREATE OR REPLACE VIEW {raw}.two AS SELECT 1 AS k")
    feed(spark, [(4, 10, "I", 3)]).write.mode("append").parquet(str(tmp_path / "f"))
    with pytest.raises(RuntimeError, match="two"):
        run_cdc(house, loaded, raw, cdc, spec=spec)
    assert spark.table(f"{cdc}.uno").count() == 3
