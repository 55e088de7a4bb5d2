"""Loading files into tables, copying tables and datasets, extracting, typed reads."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from threading import Event

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import col, cols, quote, resolve
from tidemark.operators.merge import check_lossless
from tidemark.sources.warehouse import Warehouse
from tidemark.session import staging
from tidemark.spec import Layout

log = logging.getLogger(__name__)

PARALLEL_JOBS = 5
_SHARE = "tm_share"

# Format by file extension, and the data types a mapping file may name.
FORMATS = {"parquet": "parquet", "csv": "csv", "json": "json", "avro": "avro"}
TYPES = {
    "STRING": T.StringType(),
    "BYTES": T.BinaryType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "NUMERIC": T.DecimalType(38, 9),
    "BIGNUMERIC": T.DecimalType(38, 18),
    "BOOL": T.BooleanType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampType(),
}
DISPOSITIONS = ("empty", "append", "truncate")


class TargetNotEmpty(RuntimeError):
    """The target already holds rows and the disposition is ``empty``."""


@dataclass(frozen=True)
class LoadResult:
    target: str
    status: str  # loaded, skipped or failed
    error: Exception | None = None


def read_files(
    spark: SparkSession, uri: str, schema: T.StructType | None = None, **options
) -> DataFrame:
    """Files in the format their extension names. Text formats are scanned once more to find
    their types unless ``schema`` is given."""
    extension = uri.rstrip("/").rsplit(".", 1)[-1].lower()
    fmt = FORMATS.get(extension)
    if fmt is None:
        raise ValueError(f"extension {extension!r} is not a supported source format")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "csv":
        reader = reader.option("inferSchema", True)
    try:
        rows = reader.options(**options).load(uri)
        return _wide_integers(rows) if fmt == "csv" and schema is None else rows
    except AnalysisException as err:
        if fmt == "avro" and "avro" in str(err).lower():
            raise ValueError("reading avro needs the spark-avro module on the class path") from err
        raise


def _wide_integers(df: DataFrame) -> DataFrame:
    """Integers found by inspection as 64-bit, so the type does not hang on the values seen."""
    return df.select(*[
        col(f.name).cast("long").alias(f.name) if isinstance(f.dataType, T.IntegerType)
        else quote(f.name)
        for f in df.schema.fields
    ])


def write_table(
    warehouse: Warehouse,
    df: DataFrame,
    name: str,
    disposition: str = "empty",
    layout: Layout = Layout(),
    description: str = "",
    stamp: str | None = None,
) -> None:
    """Write rows to a table, created if needed, under a write disposition."""
    if disposition not in DISPOSITIONS:
        raise ValueError(f"disposition must be one of {DISPOSITIONS}, not {disposition!r}")
    table = warehouse.table(name)
    if not table.exists():
        if warehouse.spark.catalog.tableExists(name):
            raise ValueError(f"{name} exists in the catalog but is not a stored table")
        warehouse.create_dataset(warehouse.split(name)[0])
        table.create(df.schema, layout, description, stamp)
    if disposition == "empty" and not table.is_empty():
        raise TargetNotEmpty(f"table {name} already holds rows")
    if disposition == "append":
        stored = table.schema()
        names = resolve(df.columns, stored.names)
        extra = sorted(set(df.columns) - set(names))
        if extra:
            raise ValueError(f"table {name} lacks columns of the rows to append: {extra}")
        check_lossless(df.schema, stored)
        table.append(df.select(*cols(names)).toDF(*stored.names))
    else:
        table.overwrite(df, schema=df.schema)


def load_tables(
    warehouse: Warehouse,
    sources: str | Sequence[str],
    targets: str | Sequence[str],
    continue_if_failed: bool = False,
    skip_existing: bool = False,
    disposition: str = "empty",
    parallel_jobs: int = PARALLEL_JOBS,
    schema: T.StructType | None = None,
) -> list[LoadResult]:
    """Load each source, a file path or a table name, into the target at the same position."""
    sources = [sources] if isinstance(sources, str) else list(sources)
    targets = [targets] if isinstance(targets, str) else list(targets)
    if len(sources) != len(targets):
        raise ValueError("there must be as many sources as targets")

    def one(source: str, target: str) -> LoadResult:
        if skip_existing and warehouse.exists(target):
            log.warning("table %s already exists, skipped", target)
            return LoadResult(target, "skipped")
        kept: dict = {}
        if "/" in source:
            df = read_files(warehouse.spark, source, schema)
        else:
            df = warehouse.frame(source)
            stored = warehouse.table(source)
            if stored.exists():
                kept = {
                    "layout": stored.layout(),
                    "description": stored.description(),
                    "stamp": stored.stamp(),
                }
        try:
            write_table(warehouse, df, target, disposition, **kept)
        except TargetNotEmpty as err:
            log.warning("%s, skipped", err)
            return LoadResult(target, "skipped")
        return LoadResult(target, "loaded")

    outcomes = run_jobs(
        [lambda s=s, t=t: one(s, t) for s, t in zip(sources, targets)],
        parallel_jobs,
        stop_early=not continue_if_failed,
    )
    results = []
    for target, outcome in zip(targets, outcomes):
        if isinstance(outcome, Exception):
            log.error("failed to load table %s: %s", target, outcome)
            if not continue_if_failed:
                raise outcome
            outcome = LoadResult(target, "failed", outcome)
        results.append(outcome)
    return results


def run_jobs(tasks: Sequence[Callable], parallel: int, stop_early: bool = True) -> list:
    """Run driver-side callables side by side, each submitting Spark jobs of its own.

    Returns each one's result, or the exception it raised, in order. With ``stop_early`` those
    not yet started when one fails are left out, as None.
    """
    failed = Event()

    def run(task: Callable):
        if stop_early and failed.is_set():
            return None
        try:
            return task()
        except Exception:
            failed.set()
            raise

    with ThreadPoolExecutor(parallel) as pool:
        futures = [pool.submit(run, task) for task in tasks]
    return [f.exception() or f.result() for f in futures]


def copy_table(
    warehouse: Warehouse, source: str, target: str, disposition: str = "empty"
) -> LoadResult:
    return load_tables(warehouse, source, target, disposition=disposition)[0]


def copy_dataset(
    warehouse: Warehouse,
    source: str,
    target: str,
    skip_existing: bool = False,
    disposition: str = "empty",
) -> list[LoadResult]:
    """Copy every table of a dataset."""
    names = warehouse.tables(source)
    return load_tables(
        warehouse,
        [f"{source}.{n}" for n in names],
        [f"{target}.{n}" for n in names],
        skip_existing=skip_existing,
        disposition=disposition,
    )


def extract_table(
    warehouse: Warehouse, name: str, uris: str | Sequence[str], fmt: str = "csv", **options
) -> None:
    """Write a table to files. Several URIs share its rows out between them."""
    uris = [uris] if isinstance(uris, str) else list(uris)
    df = warehouse.frame(name)
    def save(rows: DataFrame, uri: str) -> None:
        writer = rows.write.format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.options(**options).save(uri)

    if len(uris) == 1:
        return save(df, uris[0])
    # One pass over the table: a staged copy, cut by a random share that is fixed by writing it.
    with staging(warehouse.spark, warehouse.root) as stage:
        share = F.floor(F.rand(seed=1) * len(uris)).cast("int")
        path = f"{stage.root}/shares"
        df.withColumn(_SHARE, share).write.partitionBy(_SHARE).parquet(path)
        schema = df.schema.add(_SHARE, T.IntegerType())
        copy = warehouse.spark.read.schema(schema).parquet(path)
        for i, uri in enumerate(uris):
            save(copy.where(col(_SHARE) == i).drop(_SHARE), uri)


def data_type(name: str) -> T.DataType:
    found = TYPES.get(name.strip().upper())
    if found is None:
        raise ValueError(f"data type {name!r} is not known; use one of {sorted(TYPES)}")
    return found


def mapped_schema(
    spark: SparkSession,
    mapping: str,
    target_field: str,
    system_fields: Mapping[str, str],
    type_field: str | None = None,
) -> T.StructType:
    """Schema named by a mapping file: one row per field, all strings without a type column.

    System fields replace mapped fields of the same name and otherwise follow them.
    """
    wanted = [target_field, *([type_field] if type_field else [])]
    rows = spark.read.option("header", True).csv(mapping).select(*cols(wanted)).collect()
    types = {r[0]: (r[1] if type_field else "STRING") for r in rows}
    types.update(system_fields)
    return T.StructType([T.StructField(n, data_type(t)) for n, t in types.items()])


def read_with_mapping(
    spark: SparkSession,
    path: str,
    mapping: str,
    target_field: str,
    system_fields: Mapping[str, str],
    type_field: str | None = None,
    **options,
) -> DataFrame:
    """Files cast to the types of a mapping file; fields the files lack are NULL."""
    schema = mapped_schema(spark, mapping, target_field, system_fields, type_field)
    if path.rstrip("/").lower().endswith(".csv"):
        options = {"inferSchema": False, **options}
    df = read_files(spark, path, **options)
    have = {c.lower(): c for c in df.columns}
    return df.select(*[
        (col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None))
        .cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])
