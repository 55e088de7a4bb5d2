"""The registered queries. Each reads the tables under ``sf`` and returns a DataFrame."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import feeds
from checks.feeds import CLEAN, CUTS, DIRTY, LINEITEM_COLUMNS, LINEITEM_SPEC, ORDERS_SPEC, table
from checks.oracles import BY_STATUS
from tidemark import (
    FeedSpec,
    KeyBuckets,
    Layout,
    RangePartition,
    SnapshotTable,
    TimePartition,
    Warehouse,
)
from tidemark.functions.columns import normalize_name
from tidemark.functions.flags import flag_rank
from tidemark.operators import feed as ops
from tidemark.operators.apply import apply_feed, fresh_state
from tidemark.operators.keys import key_fields, primary_key_lists
from tidemark.operators.layout import PART, partition_by_range, partition_by_time
from tidemark.operators.merge import FLAG, merge_changes
from tidemark.plans.graph import refresh_graph
from tidemark.plans.reporting import (
    create_table_as_schema,
    create_view,
    materialize,
    refresh_table,
    run_query,
    run_script,
)
from tidemark.plans.runner import await_streams, run_cdc, stream_tables
from tidemark.session import new_scratch
from tidemark.sources import files
from tidemark.sources.fs import Fs
from tidemark.streaming.cdc import bury_for_good, stream_cdc, stream_with_state


class Place:
    """A warehouse in the shared scratch folder, with dataset names of its own."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf, self.root = spark, sf, new_scratch(spark, "query")
        self.warehouse = Warehouse(spark, f"{self.root}/warehouse")
        Fs(spark, self.root).delete_at_end(self.root)
        self.tag = uuid.uuid4().hex[:10]

    def dataset(self, name: str) -> str:
        full = f"{name}_{self.tag}"
        self.warehouse.create_dataset(full)
        return full

    def sources(self, *tables: str) -> str:
        """A dataset of views over the given tables."""
        name = self.dataset("src")
        for t in tables:
            self.spark.sql(
                f"CREATE VIEW {name}.{t} AS SELECT * FROM parquet.`{self.sf}/{t}.parquet`")
        return name

    def feed_view(self, dataset: str, name: str, fields: dict[str, str], source: str) -> None:
        listed = ", ".join(feeds.select_list(fields))
        self.spark.sql(
            f"CREATE VIEW {dataset}.{name} AS SELECT {listed} "
            f"FROM parquet.`{self.sf}/{source}.parquet`")

    def table(self, name: str = "state") -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/{name}")


# feeds

def current_state_lineitem(spark, sf):
    return ops.current_state(feeds.lineitem_feed(spark, sf), ["k"], LINEITEM_SPEC)


def current_state_dirty_flags(spark, sf):
    return ops.current_state(feeds.lineitem_feed(spark, sf, DIRTY), ["k"], LINEITEM_SPEC)


def current_state_by_aggregate(spark, sf):
    feed = feeds.lineitem_feed(spark, sf, DIRTY)
    return ops.current_state(feed, ["k"], LINEITEM_SPEC, method="aggregate")


def current_state_events(spark, sf):
    return ops.current_state(feeds.events_feed(spark, sf), ["user_id"])


def current_state_delete_when(spark, sf):
    spec = FeedSpec(tiebreak=("n", "p", "q"), delete_when="is_deleted = true")
    return ops.current_state(feeds.lineitem_feed(spark, sf), ["k"], spec)


def runtime_view(spark, sf):
    place = Place(spark, sf)
    raw, cdc = place.dataset("raw"), place.dataset("cdc")
    place.feed_view(raw, "lines", feeds.lineitem_fields(DIRTY), "lineitem")
    columns = spark.table(f"{raw}.lines").columns
    text = ops.current_state_sql(f"{raw}.lines", columns, ["K"], LINEITEM_SPEC)
    spark.sql(f"CREATE OR REPLACE VIEW {cdc}.lines AS {text}")
    return spark.table(f"{cdc}.lines")


def latest_per_key_ties(spark, sf):
    year = F.date_trunc("year", "recordstamp").cast("timestamp_ntz")
    feed = feeds.lineitem_feed(spark, sf, DIRTY).withColumn("shipped", F.col("recordstamp"))
    feed = feed.withColumn("recordstamp", year)
    return ops.latest_per_key(feed, ["k"], tiebreak=("n", "p", "q", "shipped"))


def flag_rank_order(spark, sf):
    feed = feeds.lineitem_feed(spark, sf, DIRTY)
    ranked = feed.select("operation_flag", flag_rank(F.col("operation_flag")).alias("flag_rank"))
    return ranked.groupBy("operation_flag", "flag_rank").agg(F.count(F.lit(1)).alias("row_count"))


def cdc_projection(spark, sf):
    return ops.cdc_columns(feeds.lineitem_feed(spark, sf, DIRTY))


def view_projection(spark, sf):
    return ops.view_columns(feeds.lineitem_feed(spark, sf, DIRTY))


def keys_not_null(spark, sf):
    feed = feeds.lineitem_feed(spark, sf, DIRTY).withColumn("n", F.expr("nullif(n, 3)"))
    return ops.keys_not_null(feed, ["K", "N"])


def not_deleted(spark, sf):
    return ops.not_deleted(feeds.lineitem_feed(spark, sf, DIRTY))


def watermark(spark, sf):
    return ops.watermark(feeds.lineitem_feed(spark, sf, DIRTY))


def watermark_empty_target(spark, sf):
    return ops.watermark(feeds.lineitem_feed(spark, sf, DIRTY).where("quantity < 0"))


def new_records(spark, sf):
    feed = feeds.lineitem_feed(spark, sf, DIRTY)
    latest = ops.not_deleted(ops.latest_per_key(feed, ["k"], LINEITEM_SPEC))
    target = latest.where("recordstamp < timestamp_ntz'2000-01-01'")
    return ops.new_records(feed, target, LINEITEM_SPEC)


# merges

def _fold_frames(spark, sf, flag, strategy, batches=range(len(CUTS))):
    """The merge expression batch after batch; each result but the last is written out, so that
    no batch is computed twice, and so are the changes, which some strategies read repeatedly."""
    feed, root = feeds.lineitem_feed(spark, sf, flag), new_scratch(spark, "fold")
    Fs(spark, root).delete_at_end(root)

    def stored(df, name):
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    target = ops.cdc_columns(feed).where("false")
    for i in batches:
        fresh = ops.new_records(feeds.visible(feed, i), target, LINEITEM_SPEC)
        changes = ops.latest_per_key(
            ops.keys_not_null(fresh, ["k"]), ["k"], LINEITEM_SPEC, method="aggregate")
        if strategy == "anti":
            changes = stored(changes, f"changes{i}")
        target = merge_changes(target, changes, ["k"], LINEITEM_SPEC, strategy=strategy)
        if i != batches[-1]:
            target = stored(target, i)
    return target


def _fold_stored(spark, sf, flag, batches=range(len(CUTS)), late=False, late_policy="drop",
                 layout=Layout(), feed=None):
    place = Place(spark, sf)
    feed, state = feed or feeds.lineitem_feed(spark, sf, flag), place.table()
    for i in batches:
        apply_feed(spark, feeds.visible(feed, i, late), state, ["k"], LINEITEM_SPEC,
                   late_policy, layout=layout)
    return state.read()


def initial_population(spark, sf):
    """The whole feed into a table that does not exist yet."""
    return _fold_stored(spark, sf, DIRTY, batches=[len(CUTS) - 1])


def merge_one_batch(spark, sf):
    """An existing state and one batch with everything after it."""
    return _fold_frames(spark, sf, CLEAN, "outer", batches=[0, len(CUTS) - 1])


def merge_three_batches(spark, sf):
    return _fold_stored(spark, sf, CLEAN)


def merge_three_batches_partitioned(spark, sf):
    layout = Layout(TimePartition("recordstamp", "month"), ("k", "n"))
    return _fold_stored(spark, sf, CLEAN, layout=layout)


def merge_null_and_unknown_flags(spark, sf):
    layout = Layout(TimePartition("recordstamp", "year"))
    return _fold_stored(spark, sf, DIRTY, layout=layout)


def merge_fold_outer(spark, sf):
    return _fold_frames(spark, sf, DIRTY, "outer")


def merge_fold_anti(spark, sf):
    return _fold_frames(spark, sf, DIRTY, "anti")


def merge_late_rows_dropped(spark, sf):
    return _fold_stored(spark, sf, CLEAN, late=True)


def merge_late_rows_compared(spark, sf):
    return _fold_stored(spark, sf, CLEAN, late=True, late_policy="compare")


def merge_three_batches_bucketed(spark, sf):
    """Dealt to buckets by key: each batch rewrites only buckets that lose a row."""
    return _fold_stored(spark, sf, CLEAN, layout=Layout(KeyBuckets(("k",), 16)))


def merge_dirty_flags_bucketed(spark, sf):
    """Clustered within buckets whose number follows from the first load's bytes."""
    return _fold_stored(spark, sf, DIRTY, layout=Layout(KeyBuckets(("k",)), ("k", "n")))


def merge_three_batches_filtered(spark, sf):
    """With Bloom filters on the keys."""
    return _fold_stored(spark, sf, CLEAN, layout=Layout(bloom=("k",)))


def merge_added_column(spark, sf):
    """The feed gets a column after the first load; rows it does not touch have NULL there."""
    feed, state = feeds.lineitem_feed(spark, sf), Place(spark, sf).table()
    apply_feed(spark, feeds.visible(feed, 0).drop("price"), state, ["k"], LINEITEM_SPEC)
    apply_feed(spark, feed, state, ["k"], LINEITEM_SPEC, allow_new_columns=True)
    return state.read()


def _fresh(spark, sf, flag, layout=Layout()):
    """Two batches are stored, the rest of the feed is seen by the reader only."""
    feed, state = feeds.lineitem_feed(spark, sf, flag), Place(spark, sf).table()
    for i in range(2):
        apply_feed(spark, feeds.visible(feed, i), state, ["k"], LINEITEM_SPEC, layout=layout)
    return state, feed


def current_state_on_read(spark, sf):
    state, feed = _fresh(spark, sf, CLEAN, Layout(KeyBuckets(("k",), 8)))
    return fresh_state(state, feed, ["k"], LINEITEM_SPEC)


def merge_on_read_dirty_flags(spark, sf):
    state, feed = _fresh(spark, sf, DIRTY)
    return fresh_state(state, feed, ["k"], LINEITEM_SPEC, columns=LINEITEM_COLUMNS)


def _stream_arrivals(spark, sf, start, flag=CLEAN):
    """Three arrivals, the last with late rows, each taken in by a run of the same stream."""
    place = Place(spark, sf)
    landing, state = f"{place.root}/landing", place.table()
    feed = feeds.lineitem_feed(spark, sf, flag)
    seen = None
    for i in range(len(CUTS)):
        arrived = feeds.visible(feed, i, late=True)
        if i:
            before = F.expr(seen)
            arrived = arrived.where(~before)
        late = f" AND n <> {feeds.LATE_LINE}"
        seen = f"coalesce(recordstamp < timestamp_ntz'{CUTS[i]}'{late}, false)" if CUTS[i] else "true"
        arrived.write.mode("append").parquet(landing)
        stream = ops.stream_feed(spark, landing, feed.schema, max_files=100)
        start(stream, state, ["k"], f"{place.root}/checkpoint", LINEITEM_SPEC).awaitTermination()
    return state


def _in_buckets(*args):
    return stream_with_state(*args, layout=Layout(KeyBuckets(("k",), 8)))


def stream_merge_final_state(spark, sf):
    """Which change of a key counts is decided in the stream's state."""
    return _stream_arrivals(spark, sf, stream_with_state).read()


def stream_dirty_flags(spark, sf):
    return _stream_arrivals(spark, sf, _in_buckets, DIRTY).read()


def stream_merge_compared(spark, sf):
    """Each change is compared with the stored row; deleted keys stay as tombstones."""
    return _stream_arrivals(spark, sf, stream_cdc).read()


def stream_buried_tombstones(spark, sf):
    """What is stored after tombstones of more than a year before the highest stamp were dropped."""
    state = _stream_arrivals(spark, sf, stream_cdc)
    bury_for_good(state, timedelta(days=365), LINEITEM_SPEC)
    dead = (F.col(FLAG) == "D").alias("deleted")
    return state.stored().groupBy(dead).agg(F.count(F.lit(1)).alias("row_count"))


def scan_feed_stream(spark, sf):
    """A landing folder read as a stream, three files a trigger."""
    place = Place(spark, sf)
    landing, out = f"{place.root}/landing", f"{place.root}/out"
    feed = feeds.lineitem_feed(spark, sf, DIRTY)
    feed.repartition(8).write.parquet(landing)
    stream = ops.stream_feed(spark, landing, feed.schema, max_files=3)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{place.root}/checkpoint")
    writer.trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(feed.schema).parquet(out)


def multi_stream_run(spark, sf):
    """Three tables kept by streams of their own, beside a fourth whose files cannot be read."""
    place = Place(spark, sf)
    cdc, landing = place.dataset("cdc"), f"{place.root}/landing"
    sources = {
        "lineitem_feed": feeds.lineitem_feed(spark, sf),
        "orders_feed": feeds.orders_feed(spark, sf),
        "events_feed": feeds.events_feed(spark, sf),
        "broken_feed": feeds.orders_feed(spark, sf).withColumn("price", F.lit("text")),
    }
    for name, rows in sources.items():
        rows.write.parquet(f"{landing}/{name}")
    schemas = {name: rows.schema for name, rows in sources.items()}
    schemas["broken_feed"] = schemas["orders_feed"]
    dictionary = spark.sql(
        "SELECT * FROM VALUES ('LINEITEM_FEED', 'K', 'X', 1), ('ORDERS_FEED', 'CUSTKEY', 'X', 1), "
        "('EVENTS_FEED', 'USER_ID', 'X', 1), ('BROKEN_FEED', 'CUSTKEY', 'X', 1) "
        "AS t(tabname, fieldname, keyflag, position)")
    settings = [{"base_table": name, "load_frequency": "@hourly"} for name in sources]
    specs = {"lineitem_feed": LINEITEM_SPEC, "orders_feed": ORDERS_SPEC, "broken_feed": ORDERS_SPEC}
    streams = await_streams(stream_tables(
        place.warehouse, settings, landing, schemas, dictionary, cdc, f"{place.root}/checkpoints",
        specs=specs, buckets=4))
    counts = [
        _count(spark.table(s.target), s.base_table if s.error is None else f"{s.base_table} failed")
        for s in streams
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


# keys

def _dictionary(spark, sf) -> DataFrame:
    text = F.col
    rows = table(spark, sf, "lineitem")
    return rows.select(
        F.concat(F.lit("/"), text("l_returnflag"), F.lit("/"), text("l_linestatus"), F.lit("/T"),
                 text("l_suppkey").cast("string")).alias("tabname"),
        F.when(text("l_linenumber") == 7, F.lit(".INCLUDE"))
        .when(text("l_linenumber") == 6, F.lit(None))
        .when(text("l_linenumber") == 5,
              F.concat(F.lit("/NS/F"), text("l_partkey").cast("string")))
        .otherwise(F.concat(F.lit("F"), text("l_partkey").cast("string"))).alias("fieldname"),
        F.when(text("l_discount") >= 0.05, "X").otherwise("").alias("keyflag"),
        text("l_linenumber").alias("position"),
    )


def normalize_names(spark, sf):
    return _dictionary(spark, sf).select(
        "tabname", normalize_name(F.col("tabname")).alias("table_name"),
        "fieldname", normalize_name(F.col("fieldname")).alias("field_name"))


def primary_keys(spark, sf):
    return key_fields(_dictionary(spark, sf))


def primary_key_lists_query(spark, sf):
    lists = primary_key_lists(_dictionary(spark, sf))
    return lists.select("tabname", F.array_join("keys", ",").alias("keys"))


# layouts

def _bucket_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("bucket").agg(F.count(F.lit(1)).alias("row_count"))


def _grain_counts(source, column, grain):
    def query(spark, sf):
        return _bucket_counts(
            partition_by_time(table(spark, sf, source), column, grain, "bucket"))

    return query


def partition_int_range_counts(spark, sf):
    return _bucket_counts(partition_by_range(table(spark, sf, "part"), "p_size", 5, 45, 10, "bucket"))


def _stored_counts(source, partition):
    def query(spark, sf):
        df = table(spark, sf, source)
        stored = Place(spark, sf).table().create(df.schema, Layout(partition))
        stored.overwrite(df)
        return stored.stored().groupBy(PART).agg(F.count(F.lit(1)).alias("row_count"))

    return query


def pruned_partition_read(spark, sf):
    df = table(spark, sf, "orders")
    layout = Layout(TimePartition("o_orderdate", "month"), ("o_custkey",))
    stored = Place(spark, sf).table().create(df.schema, layout)
    stored.overwrite(df)
    return stored.read(low=datetime(1996, 3, 15), high=datetime(1997, 2, 3))


def clustered_roundtrip(spark, sf):
    df = feeds.lineitem_feed(spark, sf)
    stored = Place(spark, sf).table().create(df.schema, Layout(cluster=("k", "n")))
    stored.overwrite(df)
    return stored.read()


# reporting

def _by_status(source: str) -> str:
    return BY_STATUS.replace("FROM orders", f"FROM {source}.orders")


def create_view_query(spark, sf):
    place = Place(spark, sf)
    src, rep = place.sources("orders"), place.dataset("reporting")
    create_view(place.warehouse, f"{rep}.by_status", _by_status(src), "Orders by status")
    return spark.table(f"{rep}.by_status")


def schema_only(spark, sf):
    place = Place(spark, sf)
    src, rep = place.sources("orders"), place.dataset("reporting")
    name, sql = f"{rep}.by_status", _by_status(src)
    create_table_as_schema(place.warehouse, name, sql)
    empty = spark.table(name)
    refresh_table(place.warehouse, name, sql)
    return _count(empty, "created").unionByName(_count(spark.table(name), "refreshed"))


def refresh_table_query(spark, sf):
    """Filled twice, so the second refresh replaces the rows of the first."""
    place = Place(spark, sf)
    src, rep = place.sources("orders"), place.dataset("reporting")
    name, sql = f"{rep}.by_status", _by_status(src)
    create_table_as_schema(place.warehouse, name, sql, Layout(cluster=("status",)))
    refresh_table(place.warehouse, name, f"SELECT status, orders + 1, total FROM ({sql})")
    refresh_table(place.warehouse, name, sql)
    return spark.table(name)


def refresh_positional(spark, sf):
    place = Place(spark, sf)
    src, rep = place.sources("nation"), place.dataset("reporting")
    name = f"{rep}.labels"
    shape = "SELECT n_regionkey AS region, n_name AS label, CAST(n_nationkey AS BIGINT) AS id"
    create_table_as_schema(place.warehouse, name, f"{shape} FROM {src}.nation")
    refresh_table(
        place.warehouse, name,
        f"SELECT n_regionkey AS id, n_name AS region, n_nationkey AS label FROM {src}.nation")
    return spark.table(name)


def refresh_graph_regional_sales(spark, sf):
    place = Place(spark, sf)
    src, rep = place.sources("nation", "region", "customer", "orders"), place.dataset("reporting")
    graph = "Regional Sales"
    objects = [
        {
            "type": "table", "name": "sales_by_region",
            "sql": f"SELECT region, count(*) AS orders, "
                   f"CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total "
                   f"FROM {src}.orders JOIN {rep}.customer_region ON o_custkey = custkey "
                   f"GROUP BY region",
            "table_setting": {"dag_setting": {"name": graph, "parents": ["customer_region"]}},
        },
        {
            "type": "table", "name": "customer_region",
            "sql": f"SELECT c_custkey AS custkey, region FROM {src}.customer "
                   f"JOIN {rep}.nation_region ON c_nationkey = nationkey",
            "table_setting": {"dag_setting": {"name": graph, "parents": ["nation_region"]}},
        },
        {
            "type": "table", "name": "nation_region",
            "sql": f"SELECT n_nationkey AS nationkey, r_name AS region FROM {src}.nation "
                   f"JOIN {src}.region ON n_regionkey = r_regionkey",
            "table_setting": {"load_frequency": "@daily", "dag_setting": {"name": graph}},
        },
    ]
    # The second object's query is analysed only when its parent exists.
    refresh_graph(place.warehouse, objects, rep)
    return spark.table(f"{rep}.sales_by_region")


def materialize_recreated(spark, sf):
    place = Place(spark, sf)
    src, rep = place.sources("orders"), place.dataset("reporting")
    first = {"type": "table", "name": "by_status", "table_setting": {"load_frequency": "@daily"},
             "sql": f"SELECT o_orderkey FROM {src}.orders"}
    materialize(place.warehouse, first, rep, load=True)
    materialize(place.warehouse, {**first, "sql": _by_status(src)}, rep, load=True)
    return spark.table(f"{rep}.by_status")


def run_script_query(spark, sf):
    place = Place(spark, sf)
    src, rep = place.sources("customer"), place.dataset("reporting")
    run_script(
        spark,
        f"CREATE OR REPLACE FUNCTION {rep}.shout(x STRING) RETURNS STRING RETURN upper(x);"
        f"CREATE OR REPLACE VIEW {rep}.segments AS SELECT {rep}.shout(c_mktsegment) AS segment, "
        f"count(*) AS row_count FROM {src}.customer GROUP BY 1;")
    return spark.table(f"{rep}.segments")


def param_query(spark, sf):
    src = Place(spark, sf).sources("orders")
    return run_query(
        spark,
        "SELECT o_orderpriority AS priority, count(*) AS row_count FROM IDENTIFIER(:orders) "
        "WHERE array_contains(:statuses, o_orderstatus) AND o_totalprice >= :least GROUP BY 1",
        {"orders": f"{src}.orders", "statuses": ["O", "P"], "least": 1000.0})


# movement

def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count")


def _load(place: Place, source: str, **options) -> DataFrame:
    raw = place.dataset("raw")
    files.load_tables(place.warehouse, source, f"{raw}.loaded", **options)
    return place.warehouse.frame(f"{raw}.loaded")


def load_csv(spark, sf):
    place = Place(spark, sf)
    path = f"{place.root}/customer.csv"
    table(spark, sf, "customer").write.option("header", True).csv(path)
    return _load(place, path)


def load_json(spark, sf):
    place = Place(spark, sf)
    path = f"{place.root}/part.json"
    table(spark, sf, "part").write.json(path)
    return _load(place, path)


def load_parquet(spark, sf):
    return _load(Place(spark, sf), f"{sf}/lineitem.parquet")


def load_append(spark, sf):
    place = Place(spark, sf)
    raw, source = place.dataset("raw"), f"{sf}/orders.parquet"
    for _ in range(2):
        files.load_tables(place.warehouse, source, f"{raw}.orders", disposition="append")
    return place.warehouse.frame(f"{raw}.orders")


def load_only_if_empty(spark, sf):
    place = Place(spark, sf)
    raw, source = place.dataset("raw"), f"{sf}/orders.parquet"
    for _ in range(2):
        files.load_tables(place.warehouse, source, f"{raw}.orders")
    return place.warehouse.frame(f"{raw}.orders")


def load_truncate(spark, sf):
    place = Place(spark, sf)
    raw = place.dataset("raw")
    for source in ("customer", "orders"):
        files.load_tables(
            place.warehouse, f"{sf}/{source}.parquet", f"{raw}.t", disposition="truncate")
    return place.warehouse.frame(f"{raw}.t")


def load_skip_and_continue(spark, sf):
    """One target exists and is skipped, one source is missing, one is loaded."""
    place = Place(spark, sf)
    raw = place.dataset("raw")
    files.load_tables(place.warehouse, f"{sf}/orders.parquet", f"{raw}.a")
    results = files.load_tables(
        place.warehouse,
        [f"{sf}/customer.parquet", f"{place.root}/absent.parquet", f"{sf}/part.parquet"],
        [f"{raw}.a", f"{raw}.b", f"{raw}.c"],
        continue_if_failed=True, skip_existing=True)
    counts = [
        _count(place.warehouse.frame(r.target), r.status)
        for r in results if r.status != "failed"
    ]
    return counts[0].unionByName(counts[1])


def copy_table_query(spark, sf):
    place = Place(spark, sf)
    src, dst = place.sources("documents"), place.dataset("copied")
    files.copy_table(place.warehouse, f"{src}.documents", f"{dst}.documents")
    return spark.table(f"{dst}.documents")


def copy_dataset_counts(spark, sf):
    place = Place(spark, sf)
    raw, dst = place.dataset("raw"), place.dataset("copied")
    names = ["conversations", "labels", "pages"]
    files.load_tables(place.warehouse, [f"{sf}/{n}.parquet" for n in names],
                      [f"{raw}.{n}" for n in names])
    files.copy_dataset(place.warehouse, raw, dst)
    counts = [_count(spark.table(f"{dst}.{n}"), n) for n in names]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def extract_roundtrip(spark, sf):
    place = Place(spark, sf)
    src = place.sources("supplier")
    uris = [f"{place.root}/out/a.parquet", f"{place.root}/out/b.parquet"]
    files.extract_table(place.warehouse, f"{src}.supplier", uris, "parquet")
    return spark.read.parquet(*uris)


def _mapping(place: Place, rows: list[tuple], header: str) -> str:
    path = f"{place.root}/mapping.csv"
    place.spark.createDataFrame(rows, header).coalesce(1).write.option("header", True).csv(path)
    return path


def mapped_read(spark, sf):
    place = Place(spark, sf)
    path = f"{place.root}/customer.csv"
    table(spark, sf, "customer").write.option("header", True).csv(path)
    mapping = _mapping(
        place,
        [("c_name", "STRING"), ("c_custkey", "STRING"), ("c_acctbal", "FLOAT"),
         ("c_nationkey", "STRING")],
        "target string, type string")
    return files.read_with_mapping(
        spark, path, mapping, "target", {"c_nationkey": "INTEGER", "source": "STRING"}, "type")


def mapped_read_all_text(spark, sf):
    place = Place(spark, sf)
    mapping = _mapping(place, [("s_suppkey", "a"), ("s_name", "b")], "target string, note string")
    return files.read_with_mapping(
        spark, f"{sf}/supplier.parquet", mapping, "target", {"s_nationkey": "INTEGER"})


# many tables

def _run_many(spark, sf, frequencies=None) -> tuple[Place, str]:
    place = Place(spark, sf)
    raw, cdc = place.dataset("raw"), place.dataset("cdc")
    place.feed_view(raw, "lineitem_feed", feeds.lineitem_fields(), "lineitem")
    place.feed_view(raw, "orders_feed", feeds.ORDERS, "orders")
    place.feed_view(raw, "events_feed", feeds.EVENTS, "events")
    spark.sql(
        f"CREATE VIEW {raw}.dd03l AS SELECT * FROM VALUES ('LINEITEM_FEED', 'K', 'X', 1), "
        "('ORDERS_FEED', 'CUSTKEY', 'X', 1), ('EVENTS_FEED', 'USER_ID', 'X', 1), "
        "('EVENTS_FEED', '.INCLUDE', 'X', 2) AS t(tabname, fieldname, keyflag, position)")
    month = {"column": "recordstamp", "partition_type": "time", "time_grain": "month"}
    settings = {"data_to_replicate": [
        {"base_table": "lineitem_feed", "target_table": "lines", "load_frequency": "@hourly",
         "partition_details": month, "cluster_details": {"columns": ["k"]}},
        {"base_table": "orders_feed", "load_frequency": "@daily"},
        {"base_table": "events_feed", "load_frequency": "RUNTIME"},
        {"base_table": "missing", "load_frequency": "@daily", "sql_flavour": "S4"},
    ]}
    specs = {"lineitem_feed": LINEITEM_SPEC, "orders_feed": ORDERS_SPEC}
    for _ in range(2):  # the second run finds nothing new
        run_cdc(place.warehouse, settings, raw, cdc, "ecc", specs=specs, frequencies=frequencies)
    return place, cdc


def multi_table_hourly(spark, sf):
    """Only the entries that are due every hour."""
    place, cdc = _run_many(spark, sf, ["@hourly"])
    (only,) = place.warehouse.tables(cdc)
    return _count(spark.table(f"{cdc}.{only}"), only)


def multi_table_run(spark, sf):
    _, cdc = _run_many(spark, sf)
    names = ("lines", "orders_feed", "events_feed")
    counts = [_count(spark.table(f"{cdc}.{n}"), n) for n in names]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def multi_table_orders(spark, sf):
    place, cdc = _run_many(spark, sf)
    return place.warehouse.frame(f"{cdc}.orders_feed")


def multi_table_lines(spark, sf):
    _, cdc = _run_many(spark, sf)
    return spark.table(f"{cdc}.lines")


def multi_table_events(spark, sf):
    _, cdc = _run_many(spark, sf)
    return spark.table(f"{cdc}.events_feed")


def scan_feed(spark, sf):
    """The same feed by path and by name."""
    place = Place(spark, sf)
    path, raw = f"{place.root}/landing", place.dataset("raw")
    feeds.lineitem_feed(spark, sf, DIRTY).write.parquet(path)
    spark.sql(f"CREATE VIEW {raw}.lines AS SELECT * FROM parquet.`{path}`")
    by_path = ops.scan_feed(spark, path).withColumn("via", F.lit("path"))
    return by_path.unionByName(ops.scan_feed(spark, f"{raw}.lines").withColumn("via", F.lit("name")))


def copy_dataset_content(spark, sf):
    place = Place(spark, sf)
    raw, dst = place.dataset("raw"), place.dataset("copied")
    shown = {"labels": ("doc_id", "quality"), "pages": ("page_id", "html"),
             "conversations": ("conv_id", "text")}
    files.load_tables(place.warehouse, [f"{sf}/{n}.parquet" for n in shown],
                      [f"{raw}.{n}" for n in shown])
    files.copy_dataset(place.warehouse, raw, dst)
    rows = [
        spark.table(f"{dst}.{name}").select(
            F.lit(name).alias("table_name"), F.col(key).alias("id"),
            F.col(content).cast("string").alias("content"))
        for name, (key, content) in shown.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def materialize_skipped(spark, sf):
    """Outside the reporting layer an object that exists is left as it is."""
    place = Place(spark, sf)
    src, cdc = place.sources("orders"), place.dataset("cdc")
    first = {"type": "table", "name": "by_status", "sql": _by_status(src),
             "table_setting": {"load_frequency": "@daily"}}
    materialize(place.warehouse, first, cdc, "cdc", load=True)
    other = {**first, "sql": f"SELECT o_orderkey FROM {src}.orders"}
    materialize(place.warehouse, other, cdc, "cdc", load=True)
    return spark.table(f"{cdc}.by_status")


def _zoned(feed: DataFrame) -> DataFrame:
    """The feed with stamps that mean instants, UTC being the session's zone."""
    return feed.withColumn("recordstamp", F.col("recordstamp").cast("timestamp"))


def merge_zoned_stamp(spark, sf):
    rows = _fold_stored(spark, sf, CLEAN, feed=_zoned(feeds.lineitem_feed(spark, sf)))
    return rows.withColumn("recordstamp", F.col("recordstamp").cast("timestamp_ntz"))


def current_state_zoned_stamp(spark, sf):
    return ops.current_state(_zoned(feeds.lineitem_feed(spark, sf)), ["k"], LINEITEM_SPEC)


def early_years_by_name(spark, sf):
    """A table by year with years below 1000, read by name after one year was rewritten."""
    place = Place(spark, sf)
    name = f"{place.dataset('raw')}.orders"
    early = "CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate - INTERVAL 1990 YEARS ELSE o_orderdate END"
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", "o_totalprice", f"{early} AS day")
    stored = place.warehouse.table(name).create(rows.schema, Layout(TimePartition("day", "year")))
    stored.overwrite(rows)
    stored.replace_parts(rows.where("year(day) = 5"), ["0005"])
    return spark.table(name)


QUERIES = {
    "scan_feed": scan_feed,
    "copy_dataset_content": copy_dataset_content,
    "multi_table_lines": multi_table_lines,
    "multi_table_events": multi_table_events,
    "materialize_skipped": materialize_skipped,
    "merge_zoned_stamp": merge_zoned_stamp,
    "current_state_zoned_stamp": current_state_zoned_stamp,
    "early_years_by_name": early_years_by_name,
    "current_state_lineitem": current_state_lineitem,
    "current_state_dirty_flags": current_state_dirty_flags,
    "current_state_by_aggregate": current_state_by_aggregate,
    "current_state_events": current_state_events,
    "current_state_delete_when": current_state_delete_when,
    "runtime_view": runtime_view,
    "latest_per_key_ties": latest_per_key_ties,
    "flag_rank_order": flag_rank_order,
    "cdc_projection": cdc_projection,
    "view_projection": view_projection,
    "keys_not_null": keys_not_null,
    "not_deleted": not_deleted,
    "watermark": watermark,
    "watermark_empty_target": watermark_empty_target,
    "new_records": new_records,
    "initial_population": initial_population,
    "merge_one_batch": merge_one_batch,
    "merge_three_batches": merge_three_batches,
    "merge_three_batches_partitioned": merge_three_batches_partitioned,
    "merge_null_and_unknown_flags": merge_null_and_unknown_flags,
    "merge_fold_outer": merge_fold_outer,
    "merge_fold_anti": merge_fold_anti,
    "merge_late_rows_dropped": merge_late_rows_dropped,
    "merge_late_rows_compared": merge_late_rows_compared,
    "merge_three_batches_bucketed": merge_three_batches_bucketed,
    "merge_dirty_flags_bucketed": merge_dirty_flags_bucketed,
    "merge_three_batches_filtered": merge_three_batches_filtered,
    "merge_added_column": merge_added_column,
    "current_state_on_read": current_state_on_read,
    "merge_on_read_dirty_flags": merge_on_read_dirty_flags,
    "stream_merge_final_state": stream_merge_final_state,
    "stream_dirty_flags": stream_dirty_flags,
    "stream_merge_compared": stream_merge_compared,
    "stream_buried_tombstones": stream_buried_tombstones,
    "scan_feed_stream": scan_feed_stream,
    "multi_stream_run": multi_stream_run,
    "multi_table_hourly": multi_table_hourly,
    "primary_key_lists": primary_key_lists_query,
    "normalize_names": normalize_names,
    "primary_keys": primary_keys,
    "partition_day_counts": _grain_counts("orders", "o_orderdate", "day"),
    "partition_month_counts": _grain_counts("orders", "o_orderdate", "month"),
    "partition_year_counts": _grain_counts("orders", "o_orderdate", "year"),
    "partition_hour_counts": _grain_counts("events", "ts", "hour"),
    "partition_int_range_counts": partition_int_range_counts,
    "stored_partition_month": _stored_counts("orders", TimePartition("o_orderdate", "month")),
    "stored_partition_hour": _stored_counts("events", TimePartition("ts", "hour")),
    "stored_partition_int_range": _stored_counts("part", RangePartition("p_size", 5, 45, 10)),
    "pruned_partition_read": pruned_partition_read,
    "clustered_roundtrip": clustered_roundtrip,
    "create_view": create_view_query,
    "schema_only": schema_only,
    "refresh_table": refresh_table_query,
    "refresh_positional": refresh_positional,
    "refresh_graph_regional_sales": refresh_graph_regional_sales,
    "materialize_recreated": materialize_recreated,
    "run_script": run_script_query,
    "param_query": param_query,
    "load_csv": load_csv,
    "load_json": load_json,
    "load_parquet": load_parquet,
    "load_append": load_append,
    "load_only_if_empty": load_only_if_empty,
    "load_truncate": load_truncate,
    "load_skip_and_continue": load_skip_and_continue,
    "copy_table": copy_table_query,
    "copy_dataset_counts": copy_dataset_counts,
    "extract_roundtrip": extract_roundtrip,
    "mapped_read": mapped_read,
    "mapped_read_all_text": mapped_read_all_text,
    "multi_table_run": multi_table_run,
    "multi_table_orders": multi_table_orders,
}
