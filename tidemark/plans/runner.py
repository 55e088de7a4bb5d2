"""Replicating many tables from one list of settings."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.columns import qualified
from tidemark.operators.apply import (
    apply_feed,
    apply_feed_to_catalog,
    create_in_catalog,
    open_table,
)
from tidemark.operators.feed import current_state_sql, stream_feed
from tidemark.operators.keys import primary_keys_of
from tidemark.sources.files import run_jobs
from tidemark.sources.warehouse import Warehouse
from tidemark.streaming.cdc import stream_with_state
from tidemark.spec import (
    RUNTIME,
    FeedSpec,
    KeyBuckets,
    Layout,
    SettingsError,
    check_table_entries,
    check_table_entry,
)

PARALLEL_TABLES = 10
FLAVOURS = ("ECC", "S4")
DICTIONARY = "dd03l"


@dataclass(frozen=True)
class TableRun:
    base_table: str
    target: str
    kind: str  # view or table
    rows: int | None


def read_settings(path: str) -> dict:
    """Settings from a YAML file."""
    try:
        import yaml
    except ImportError as err:
        raise RuntimeError("reading a settings file needs PyYAML; pass a dict instead") from err
    with open(path, encoding="utf-8") as file:
        found = yaml.safe_load(file)
    if not found:
        raise SettingsError(f"settings file {path!r} is empty")
    return found


def entries_for(settings: Mapping | Sequence[Mapping], flavour: str) -> list[Mapping]:
    """Entries of ``data_to_replicate`` that apply to a flavour; one without ``sql_flavour``
    applies to both."""
    if flavour.upper() not in FLAVOURS:
        raise SettingsError(f"flavour must be one of {FLAVOURS}, not {flavour!r}")
    entries = settings["data_to_replicate"] if isinstance(settings, Mapping) else settings
    return [
        e for e in entries
        if str(e.get("sql_flavour") or flavour).upper() == flavour.upper()
    ]


def _keys_for(dictionary: DataFrame, entries: Sequence[Mapping]) -> dict[str, list[str]]:
    keys = primary_keys_of(dictionary, [e["base_table"] for e in entries])
    missing = sorted(t for t, k in keys.items() if not k)
    if missing:
        raise SettingsError(f"no primary key in the data dictionary for {missing}")
    return keys


def _target_name(entry: Mapping, target: str) -> str:
    return f"{target}.{entry.get('target_table') or entry['base_table']}"


def _keyed(layout: Layout, keys: Sequence[str], bucketed: bool) -> Layout:
    if layout.partition is not None or not bucketed:
        return layout
    return replace(layout, partition=KeyBuckets(tuple(keys)))


def run_cdc(
    warehouse: Warehouse,
    settings: Mapping | Sequence[Mapping],
    raw: str,
    target: str,
    flavour: str = "ECC",
    spec: FeedSpec = FeedSpec(),
    specs: Mapping[str, FeedSpec] | None = None,
    late_policy: str = "drop",
    load: bool = True,
    parallel: int = PARALLEL_TABLES,
    frequencies: Collection[str] | None = None,
    bucketed: bool = True,
) -> list[TableRun]:
    """Refresh every table, or define every runtime view, of the settings.

    All entries are checked before work starts, and the keys of all tables come from one pass over
    the data dictionary. Tables run side by side; a failure of any is raised after all are done.
    Without ``load``, missing tables are created and left empty. With ``frequencies`` only entries
    with one of these are run. A new table without a partition column is dealt to buckets by its
    keys, as many as its first load calls for, unless ``bucketed`` is false. A ``target`` that names
    a catalog too (``catalog.dataset``) holds tables of a catalog that supports MERGE.
    """
    spark = warehouse.spark
    entries = entries_for(settings, flavour)
    check_table_entries(entries)
    if frequencies is not None:
        entries = [e for e in entries if e["load_frequency"] in frequencies]
    if "." not in target:
        warehouse.create_dataset(target)
    dictionary = warehouse.frame(f"{raw}.{DICTIONARY}")
    keys = _keys_for(dictionary, entries)

    def one(entry: Mapping) -> TableRun:
        base = entry["base_table"]
        source, name = f"{raw}.{base}", _target_name(entry, target)
        chosen = (specs or {}).get(base, spec)
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", base)
        feed = warehouse.frame(source)
        if entry["load_frequency"] == RUNTIME:
            text = current_state_sql(source, feed.columns, keys[base], chosen)
            spark.sql(f"CREATE OR REPLACE VIEW {qualified(name)} AS {text}")
            return TableRun(base, name, "view", None)
        layout = _keyed(check_table_entry(entry), keys[base], bucketed)
        if "." in target:  # catalog.dataset: the catalog merges
            create_in_catalog(spark, name, feed, chosen, layout)
            if load:
                apply_feed_to_catalog(spark, feed, name, keys[base], chosen, late_policy)
            return TableRun(base, name, "table", spark.table(name).count())
        table = warehouse.table(name)
        if load:
            apply_feed(spark, feed, table, keys[base], chosen, late_policy, layout=layout)
        else:
            open_table(table, feed, chosen, layout)
        return TableRun(base, name, "table", table.row_count())

    outcomes = run_jobs([lambda e=e: one(e) for e in entries], parallel, stop_early=False)
    for entry, outcome in zip(entries, outcomes):
        if isinstance(outcome, Exception):
            raise RuntimeError(f"table {entry['base_table']!r}: {outcome}") from outcome
    return outcomes


@dataclass
class TableStream:
    base_table: str
    target: str
    query: StreamingQuery | None
    error: Exception | None = None


def stream_tables(
    warehouse: Warehouse,
    settings: Mapping | Sequence[Mapping],
    landing: str,
    schemas: Mapping[str, T.StructType],
    dictionary: DataFrame,
    target: str,
    checkpoints: str,
    flavour: str = "ECC",
    spec: FeedSpec = FeedSpec(),
    specs: Mapping[str, FeedSpec] | None = None,
    trigger: dict | None = None,
    max_files: int | None = None,
    buckets: int | None = None,
    parallel: int = PARALLEL_TABLES,
) -> list[TableStream]:
    """Start a streaming query for every table of the settings; runtime views are left out.

    A table's files arrive in ``landing/<base_table>`` with the schema stated for it. Each query
    has a checkpoint and a scheduler pool of its own, so tables share the executors fairly and a
    query that fails, or cannot start, stops no other. Settings and keys are checked before any is
    started. New tables without a partition column get so many key ``buckets``. ``await_streams``
    waits for the queries' end and tells which ones failed.
    """
    spark = warehouse.spark
    entries = entries_for(settings, flavour)
    check_table_entries(entries)
    entries = [e for e in entries if e["load_frequency"] != RUNTIME]
    keys = _keys_for(dictionary, entries)
    if "." not in target:
        warehouse.create_dataset(target)

    def begin(entry: Mapping) -> StreamingQuery:
        base, name = entry["base_table"], _target_name(entry, target)
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", base)
        feed = stream_feed(spark, f"{landing}/{base}", schemas[base], max_files=max_files)
        table = name if "." in target else warehouse.table(name)
        layout = check_table_entry(entry)
        if buckets and layout.partition is None:
            layout = replace(layout, partition=KeyBuckets(tuple(keys[base]), buckets))
        return stream_with_state(
            feed, table, keys[base], f"{checkpoints}/{base}", (specs or {}).get(base, spec),
            layout, trigger)

    outcomes = run_jobs([lambda e=e: begin(e) for e in entries], parallel, stop_early=False)
    return [
        TableStream(e["base_table"], _target_name(e, target), None, o) if isinstance(o, Exception)
        else TableStream(e["base_table"], _target_name(e, target), o)
        for e, o in zip(entries, outcomes)
    ]


def await_streams(streams: Sequence[TableStream]) -> list[TableStream]:
    """Wait until every query has ended, and note the error of each that failed."""
    for stream in streams:
        if stream.query is not None:
            try:
                stream.query.awaitTermination()
            except Exception as err:
                stream.error = err
    return list(streams)
