"""Descriptions of feeds and table layouts, with the checks made before any work starts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Fixed values.
GRAINS = ("hour", "day", "month", "year")
PARTITION_TYPES = ("time", "integer_range")
MAX_CLUSTER_COLUMNS = 4
RUNTIME = "RUNTIME"
WATERMARK_FLOOR = "1940-12-25 05:30:00"
DELETE_FLAG = "D"
UPSERT_FLAGS = ("I", "U", "L")
OBJECT_TYPES = ("table", "view", "script")
OBJECT_SECTIONS = ("bq_independent_objects", "bq_dependent_objects")

TIME_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)
INTEGER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


class SettingsError(ValueError):
    """A setting is missing, contradictory or does not fit the data."""


@dataclass(frozen=True)
class FeedSpec:
    """Which columns of a feed carry the change information.

    ``tiebreak`` orders rows left equal by stamp and flag. ``delete_when`` is a SQL condition that
    marks further rows as deletes. ``landing`` names a (column, grain) the feed's files are
    partitioned by, for a feed whose landing time never precedes the record stamp.
    """

    stamp: str = "recordstamp"
    op: str = "operation_flag"
    deleted: str = "is_deleted"
    load_time: str = "_PARTITIONTIME"
    tiebreak: tuple[str, ...] = ()
    delete_when: str | None = None
    landing: tuple[str, str] | None = None

    @classmethod
    def camel_case(cls, **kw) -> FeedSpec:
        """Naming used by the other family of sources."""
        return cls(op="OperationalFlag", deleted="IsDeleted", **kw)

    def spelled(self, names: Sequence[str]) -> FeedSpec:
        """With stamp and flag columns as ``names`` spells them; names compare without case."""
        by_lower = {n.lower(): n for n in names}
        found = {k: by_lower.get(getattr(self, k).lower(), getattr(self, k)) for k in ("stamp", "op", "deleted", "load_time")}
        landing = self.landing and (by_lower.get(self.landing[0].lower(), self.landing[0]), self.landing[1])
        return replace(self, landing=landing, **found)

    @property
    def excluded(self) -> tuple[str, ...]:
        return (self.load_time, self.op, self.deleted)


@dataclass(frozen=True)
class TimePartition:
    column: str
    grain: str


@dataclass(frozen=True)
class RangePartition:
    column: str
    start: int
    end: int
    interval: int


@dataclass(frozen=True)
class KeyBuckets:
    """Rows dealt to ``count`` partitions by a hash of their keys, for tables without a column to
    partition by. Without a count it follows from the bytes of the first load."""

    keys: tuple[str, ...]
    count: int | None = None


Partition = TimePartition | RangePartition | KeyBuckets


def partition_columns(part: Partition) -> tuple[str, ...]:
    """Columns that decide which partition a row goes to."""
    return part.keys if isinstance(part, KeyBuckets) else (part.column,)


@dataclass(frozen=True)
class Layout:
    """How a table's files are arranged: at most one partitioning, up to four cluster columns, and
    columns with Bloom filters, by which scattered values skip row groups."""

    partition: Partition | None = None
    cluster: tuple[str, ...] = ()
    bloom: tuple[str, ...] = ()

    @classmethod
    def from_settings(cls, setting: Mapping, load_frequency: str | None = None) -> Layout:
        part = setting.get("partition_details")
        cluster = setting.get("cluster_details")
        if load_frequency == RUNTIME and (part or cluster):
            raise SettingsError("a runtime view takes neither partition_details nor cluster_details")
        return cls(
            _partition_from(part) if part else None,
            _cluster_from(cluster) if cluster else (),
        )

    def spelled(self, schema: T.StructType) -> Layout:
        """With column names as ``schema`` spells them; names compare without case."""
        by_lower = {n.lower(): n for n in schema.names}
        part = self.partition

        def all_of(names: Iterable[str]) -> tuple[str, ...]:
            return tuple(by_lower.get(c.lower(), c) for c in names)

        if isinstance(part, KeyBuckets):
            part = replace(part, keys=all_of(part.keys))
        elif part is not None:
            part = replace(part, column=all_of([part.column])[0])
        return Layout(part, all_of(self.cluster), all_of(self.bloom))

    def check(self, schema: T.StructType) -> Layout:
        """Raise unless the columns exist in ``schema`` with fitting types; returns self."""
        fields = {f.name: f.dataType for f in schema.fields}
        p = self.partition
        if isinstance(p, KeyBuckets):
            if not p.keys or not p.count or p.count < 1:
                raise SettingsError("key buckets need keys and a positive count")
            for name in p.keys:
                if name not in fields:
                    raise SettingsError(f"bucket key {name!r} does not exist in the table")
                if isinstance(fields[name], (T.MapType, T.VariantType)):
                    raise SettingsError(f"bucket key {name!r} cannot be hashed")
        elif p is not None:
            if p.column not in fields:
                raise SettingsError(f"partition column {p.column!r} does not exist in the table")
            dtype = fields[p.column]
            if isinstance(p, TimePartition):
                if not isinstance(dtype, TIME_TYPES):
                    raise SettingsError(
                        f"time partition column {p.column!r} must be a date or timestamp, "
                        f"not {dtype.simpleString()}"
                    )
                if p.grain == "hour" and isinstance(dtype, T.DateType):
                    raise SettingsError(f"date column {p.column!r} has no hours to partition by")
            elif not isinstance(dtype, INTEGER_TYPES):
                raise SettingsError(
                    f"range partition column {p.column!r} must be an integer, "
                    f"not {dtype.simpleString()}"
                )
        for name in self.cluster:
            if name not in fields:
                raise SettingsError(f"cluster column {name!r} does not exist in the table")
        for name in self.bloom:
            if name not in fields:
                raise SettingsError(f"Bloom filter column {name!r} does not exist in the table")
        return self

    def to_json(self) -> dict:
        p = self.partition
        out: dict = {"cluster": list(self.cluster)}
        if isinstance(p, TimePartition):
            out["time"] = [p.column, p.grain]
        elif isinstance(p, RangePartition):
            out["range"] = [p.column, p.start, p.end, p.interval]
        elif isinstance(p, KeyBuckets):
            out["buckets"] = [list(p.keys), p.count]
        if self.bloom:
            out["bloom"] = list(self.bloom)
        return out

    @classmethod
    def from_json(cls, data: Mapping) -> Layout:
        part = None
        if "time" in data:
            part = TimePartition(*data["time"])
        elif "range" in data:
            part = RangePartition(*data["range"])
        elif "buckets" in data:
            part = KeyBuckets(tuple(data["buckets"][0]), data["buckets"][1])
        return cls(part, tuple(data.get("cluster", ())), tuple(data.get("bloom", ())))


def _need(details: Mapping, key: str, where: str):
    value = details.get(key)
    if not value:
        raise SettingsError(f"{where} needs {key!r}")
    return value


def _partition_from(details: Mapping) -> TimePartition | RangePartition:
    column = _need(details, "column", "partition_details")
    kind = _need(details, "partition_type", "partition_details")
    if kind not in PARTITION_TYPES:
        raise SettingsError(f"partition_type must be one of {PARTITION_TYPES}, not {kind!r}")
    if kind == "time":
        grain = _need(details, "time_grain", "a time partition")
        if grain not in GRAINS:
            raise SettingsError(f"time_grain must be one of {GRAINS}, not {grain!r}")
        return TimePartition(column, grain)
    bucket = _need(details, "integer_range_bucket", "an integer_range partition")
    bounds = [bucket.get(k) for k in ("start", "end", "interval")]
    if None in bounds:  # zero is a valid bound
        raise SettingsError("integer_range_bucket needs start, end and interval")
    start, end, interval = bounds
    if interval <= 0 or end <= start:
        raise SettingsError("integer_range_bucket needs end > start and a positive interval")
    return RangePartition(column, start, end, interval)


def _cluster_from(details: Mapping) -> tuple[str, ...]:
    columns = _need(details, "columns", "cluster_details")
    if not isinstance(columns, list):
        raise SettingsError("cluster_details.columns has to be a list")
    if len(columns) > MAX_CLUSTER_COLUMNS:
        raise SettingsError(f"at most {MAX_CLUSTER_COLUMNS} cluster columns are allowed")
    return tuple(columns)


def check_table_entry(entry: Mapping) -> Layout:
    """Validate one replication entry and return its layout."""
    frequency = entry.get("load_frequency")
    if not frequency:
        raise SettingsError("load_frequency is missing")
    return Layout.from_settings(entry, frequency)


def check_table_entries(entries: Iterable[Mapping]) -> None:
    seen: set[str] = set()
    for entry in entries:
        base = entry.get("base_table")
        if not base:
            raise SettingsError("an entry has no base_table")
        try:
            check_table_entry(entry)
        except SettingsError as err:
            raise SettingsError(f"table {base!r}: {err}") from err
        if base in seen:
            raise SettingsError(f"table {base!r} is listed more than once")
        seen.add(base)


def check_table_setting(setting: Mapping | None) -> Layout:
    """Validate the ``table_setting`` of a reporting table and return its layout."""
    if not setting:
        raise SettingsError("a reporting table needs table_setting")
    frequency = setting.get("load_frequency")
    graph = setting.get("dag_setting")
    if not frequency and not graph:
        raise SettingsError("table_setting needs load_frequency or dag_setting")
    if frequency and graph and graph.get("parents"):
        raise SettingsError("load_frequency and dag_setting.parents exclude each other")
    if frequency == "runtime":
        raise SettingsError("a reporting table cannot have load_frequency 'runtime'")
    return Layout.from_settings(setting)


def check_objects(objects: Sequence[Mapping]) -> None:
    """Validate reporting objects; names must be unique over all sections."""
    if not objects:
        raise SettingsError("there are no reporting objects")
    seen: set[str] = set()
    for obj in objects:
        kind = obj.get("type")
        if kind not in OBJECT_TYPES:
            raise SettingsError(f"type must be one of {OBJECT_TYPES}, not {kind!r}")
        name = obj.get("sql_file") or obj.get("name")
        if not name:
            raise SettingsError("an object needs sql_file (or name and sql)")
        if name in seen:
            raise SettingsError(f"{name!r} is listed more than once")
        seen.add(name)
        if kind == "table":
            check_table_setting(obj.get("table_setting"))
