"""Primary keys from the replicated data dictionary."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import has, normalize_name
from tidemark.spec import SettingsError

# Fixed values.
KEY_MARK = "X"
NOT_A_FIELD = ".INCLUDE"


def key_fields(dictionary: DataFrame, repl: str = "_") -> DataFrame:
    """Distinct key fields of all tables: ``tabname``, ``fieldname``, ``position``."""
    position = F.col("position").cast("long") if has(dictionary, "position") else F.lit(None).cast("long")
    marked = dictionary.where(
        (F.col("keyflag") == KEY_MARK) & (F.col("fieldname") != NOT_A_FIELD)
    )
    named = marked.select(
        normalize_name(F.col("tabname"), repl).alias("tabname"),
        normalize_name(F.col("fieldname"), repl).alias("fieldname"),
        position.alias("position"),
    )
    return named.groupBy("tabname", "fieldname").agg(F.min("position").alias("position"))


def primary_key_lists(dictionary: DataFrame, repl: str = "_") -> DataFrame:
    """``tabname`` and ``keys``, the key fields of each table by position, those without one last."""
    field = F.struct(
        F.col("position").isNull().alias("last"), "position", F.col("fieldname").alias("name"))
    fields = F.sort_array(F.collect_list(field))
    return key_fields(dictionary, repl).groupBy("tabname").agg(fields["name"].alias("keys"))


def primary_keys_of(
    dictionary: DataFrame, tables: Iterable[str], repl: str = "_"
) -> dict[str, list[str]]:
    """Ordered key fields of each table: one aggregate over the dictionary, one row per table."""
    wanted = {t.split(".")[-1].upper(): t for t in tables}
    rows = primary_key_lists(dictionary, repl).where(F.col("tabname").isin(*wanted)).collect()
    found = {wanted[r["tabname"]]: list(r["keys"]) for r in rows}
    return {t: found.get(t, []) for t in wanted.values()}


def primary_keys(dictionary: DataFrame, table: str, repl: str = "_") -> list[str]:
    keys = primary_keys_of(dictionary, [table], repl)[table]
    if not keys:
        raise SettingsError(f"no primary key for {table!r} in the data dictionary")
    return keys
