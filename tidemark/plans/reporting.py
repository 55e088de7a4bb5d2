"""Reporting objects: views, tables refreshed from queries, scripts, parameterised queries."""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import col, qualified, text_literal
from tidemark.sources.files import run_jobs
from tidemark.sources.warehouse import Warehouse
from tidemark.spec import (
    OBJECT_SECTIONS,
    OBJECT_TYPES,
    Layout,
    SettingsError,
    check_objects,
    check_table_setting,
)

PARALLEL_OBJECTS = 10

# Parameter names and where their values stand in a configuration.
GENERAL_PARAMS = {
    "project_id_src": "projectIdSource",
    "project_id_tgt": "projectIdTarget",
    "location": "location",
}
SYSTEM_PARAMS = {
    "dataset_raw_landing": ("datasets", "raw"),
    "dataset_raw_landing_ecc": ("datasets", "rawECC"),
    "dataset_raw_landing_s4": ("datasets", "rawS4"),
    "dataset_cdc_processed": ("datasets", "cdc"),
    "dataset_cdc_processed_ecc": ("datasets", "cdcECC"),
    "dataset_cdc_processed_s4": ("datasets", "cdcS4"),
    "dataset_reporting_tgt": ("datasets", "reporting"),
    "mandt": (None, "mandt"),
    "mandt_ecc": (None, "mandtECC"),
    "mandt_s4": (None, "mandtS4"),
    "sap_languages": (None, "languages"),
    "sap_currencies": (None, "currencies"),
}

TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
_POSITION = "tm_c"


def run_query(spark: SparkSession, sql: str, params: Mapping | None = None) -> DataFrame:
    """A query with named parameters: ``:name`` for values and lists, ``IDENTIFIER(:name)`` for
    datasets and tables. Parsing and analysis raise before any job runs."""
    return spark.sql(sql, args=dict(params)) if params else spark.sql(sql)


def query_params(config: Mapping) -> dict:
    """Parameters queries may use, from a deployment configuration.

    Each section with datasets gives ``<section>_datasets_<layer>`` and its currencies; the
    replicated system gives the names below as well. Values that are not set are left out.
    """
    found = {name: config.get(key) for name, key in GENERAL_PARAMS.items()}
    marketing = config.get("marketing") or {}
    sections = {**config, **{f"marketing_{k}": v for k, v in marketing.items()}}
    for section, values in sections.items():
        if isinstance(values, Mapping):
            for layer, dataset in (values.get("datasets") or {}).items():
                found[f"{_section(section)}_datasets_{layer.lower()}"] = dataset
            if "currencies" in values:
                found[f"{_section(section)}_currencies"] = values["currencies"]
    system = config.get("SAP") or {}
    for name, (part, key) in SYSTEM_PARAMS.items():
        found[name] = (system.get(part) or {}).get(key) if part else system.get(key)
    flavour = str(system.get("SQLFlavor") or "").lower() or None
    found.update(sql_flavour=flavour, sql_flavor=flavour)
    found.update({
        f"deploy_{key[6:].lower()}": value for key, value in config.items()
        if key.startswith("deploy") and isinstance(value, bool)
    })
    return {name: value for name, value in found.items() if value is not None}


def _section(name: str) -> str:
    """A section's name in parameters: ``OracleEBS`` reads as two words, the others as one."""
    return {"oracleebs": "oracle_ebs"}.get(name.lower(), name.lower())


def create_view(
    warehouse: Warehouse,
    name: str,
    sql: str,
    description: str = "",
    params: Mapping | None = None,
) -> None:
    if warehouse.table(name).exists():
        raise ValueError(f"{name} is a stored table")
    warehouse.create_dataset(warehouse.split(name)[0])
    run_query(
        warehouse.spark,
        f"CREATE OR REPLACE VIEW {qualified(name)} COMMENT {text_literal(description or '')} AS {sql}",
        params,
    )


def create_table_as_schema(
    warehouse: Warehouse,
    name: str,
    sql: str,
    layout: Layout = Layout(),
    description: str = "",
    params: Mapping | None = None,
    comments: Mapping[str, str] | None = None,
    replace: bool = False,
) -> None:
    """An empty table with the columns of a query, which is analysed but not run."""
    schema = run_query(warehouse.spark, sql, params).schema
    fields = []
    for f in schema.fields:
        given = {"comment": comments[f.name]} if comments and f.name in comments else {}
        fields.append(T.StructField(f.name, f.dataType, True, {**given, **f.metadata}))
    warehouse.create_dataset(warehouse.split(name)[0])
    warehouse.table(name).create(
        T.StructType(fields), layout, description or "", replace=replace
    )


def assignable(source: T.DataType, target: T.DataType) -> bool:
    """Whether a query column may be stored in a table column: the ANSI store-assignment rule."""
    if source == target or isinstance(source, T.NullType):
        return True
    if isinstance(source, T.NumericType) and isinstance(target, T.NumericType):
        return True
    if isinstance(source, TIMES) and isinstance(target, TIMES):
        return True
    if isinstance(target, T.StringType):
        return isinstance(source, (T.AtomicType, T.NumericType)) and not isinstance(
            source, T.BinaryType)
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return assignable(source.elementType, target.elementType)
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        return assignable(source.keyType, target.keyType) and assignable(
            source.valueType, target.valueType)
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        return len(source) == len(target) and all(
            assignable(s.dataType, t.dataType) for s, t in zip(source.fields, target.fields))
    return False


def by_position(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of a query as rows of a table: columns match by position, not by name."""
    if len(df.columns) != len(schema.fields):
        raise ValueError(
            f"the query has {len(df.columns)} columns, the table {len(schema.fields)}")
    for have, want in zip(df.schema.fields, schema.fields):
        if not assignable(have.dataType, want.dataType):
            raise ValueError(
                f"query column {have.name!r} ({have.dataType.simpleString()}) cannot be stored as "
                f"{want.name!r} ({want.dataType.simpleString()})")
    renamed = df.toDF(*[f"{_POSITION}{i}" for i in range(len(df.columns))])
    return renamed.select(*[
        F.col(f"{_POSITION}{i}").cast(f.dataType).alias(f.name, metadata=f.metadata)
        for i, f in enumerate(schema.fields)
    ])


def refresh_table(
    warehouse: Warehouse, name: str, sql: str, params: Mapping | None = None
) -> dict:
    """Replace a table's rows with a query's result, all or nothing."""
    table = warehouse.table(name)
    schema = table.schema()
    return table.overwrite(by_position(run_query(warehouse.spark, sql, params), schema))


def run_script(spark: SparkSession, sql: str, params: Mapping | None = None) -> DataFrame:
    """Run SQL statements in order, for their effects; the last result is returned."""
    text = sql.strip().rstrip(";").rstrip()
    if ";" in text and not text.upper().startswith("BEGIN"):
        text = f"BEGIN\n{text};\nEND"
    return run_query(spark, text, params)


def object_sql(obj: Mapping) -> str:
    if obj.get("sql"):
        return obj["sql"]
    with open(obj["sql_file"], encoding="utf-8") as file:
        return file.read()


def object_name(obj: Mapping) -> str:
    return obj.get("name") or PurePosixPath(obj["sql_file"]).stem


def materialize(
    warehouse: Warehouse,
    obj: Mapping,
    dataset: str,
    layer: str = "reporting",
    params: Mapping | None = None,
    load: bool = False,
) -> str:
    """Create one object: ``created``, ``recreated`` or ``skipped``.

    Objects of the reporting layer are recreated; in other layers those that exist are left
    alone. Scripts always run. ``load`` fills a table at once.
    """
    kind = obj.get("type")
    if kind not in OBJECT_TYPES:
        raise ValueError(f"type must be one of {OBJECT_TYPES}, not {kind!r}")
    spark, sql = warehouse.spark, object_sql(obj)
    if kind == "script":
        run_script(spark, sql, params)
        return "created"
    name = f"{dataset}.{object_name(obj)}"
    run_query(spark, sql, params)
    existed = warehouse.exists(name)
    if existed and layer.lower() != "reporting":
        return "skipped"
    stored = warehouse.table(name).exists()
    if kind == "view":
        if stored:
            warehouse.drop(name)
        create_view(warehouse, name, sql, obj.get("description"), params)
    else:
        layout = check_table_setting(obj.get("table_setting"))
        create_table_as_schema(
            warehouse, name, sql, layout, obj.get("description"), params, replace=True)
        if load:
            refresh_table(warehouse, name, sql, params)
    return "recreated" if existed else "created"


def all_objects(settings: Mapping) -> list[Mapping]:
    """Objects of both sections of the settings, validated together."""
    sections = [settings.get(name) for name in OBJECT_SECTIONS]
    if sections == [None, None]:
        raise SettingsError(f"settings need one of {OBJECT_SECTIONS}")
    found = [obj for section in sections for obj in section or ()]
    check_objects(found)
    return found


def materialize_all(
    warehouse: Warehouse,
    settings: Mapping,
    dataset: str,
    layer: str = "reporting",
    params: Mapping | None = None,
    load: bool = False,
    parallel: int = PARALLEL_OBJECTS,
) -> dict[str, str]:
    """Create the independent objects side by side, then the dependent ones in the order listed."""
    all_objects(settings)
    independent, dependent = (settings.get(name) or [] for name in OBJECT_SECTIONS)
    outcome: dict[str, str] = {}
    for objects, width in ((independent, parallel), (dependent, 1)):
        tasks = [
            lambda o=o: materialize(warehouse, o, dataset, layer, params, load) for o in objects
        ]
        for obj, result in zip(objects, run_jobs(tasks, width)):
            if isinstance(result, Exception):
                raise result
            outcome[object_name(obj)] = result
    return outcome
