"""Change feeds derived from the test tables. Every expression reads the same in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark import FeedSpec

CLEAN = (
    "case when l_linenumber = 5 then 'L' when l_returnflag = 'R' then 'D' "
    "when l_returnflag = 'N' then 'U' else 'I' end"
)
DIRTY = f"case when l_linenumber = 7 then null when l_linenumber = 6 then 'X' else {CLEAN} end"

LINEITEM = {
    "k": "l_orderkey",
    "n": "l_linenumber",
    "p": "l_partkey",
    "q": "l_suppkey",
    "quantity": "l_quantity",
    "price": "l_extendedprice",
    "recordstamp": "l_shipdate",
    "is_deleted": "l_linestatus = 'O' and l_discount > 0.08",
}
EVENTS = {
    "event_id": "event_id",
    "user_id": "user_id",
    "value": "value",
    "props": "props",
    "recordstamp": "ts",
    "operation_flag": (
        "case event_type when 'signup' then 'I' when 'click' then 'L' "
        "when 'error' then 'D' else 'U' end"
    ),
}
ORDERS = {
    "custkey": "o_custkey",
    "orderkey": "o_orderkey",
    "status": "o_orderstatus",
    "price": "o_totalprice",
    "recordstamp": "o_orderdate",
    "operation_flag": (
        "case o_orderstatus when 'F' then 'D' when 'O' then 'I' else 'U' end"
    ),
}

LINEITEM_SPEC = FeedSpec(tiebreak=("n", "p", "q"))
ORDERS_SPEC = FeedSpec(tiebreak=("orderkey",))
LINEITEM_COLUMNS = ["k", "n", "p", "q", "quantity", "price", "recordstamp"]

# Batch ends of the folds, and the line number that arrives only with the last batch.
# The last batch is the whole feed.
CUTS = ("1998-06-01", "2000-01-01", None)
LATE_LINE = 3


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def lineitem_fields(flag: str = CLEAN) -> dict[str, str]:
    return {**LINEITEM, "operation_flag": flag}


def select_list(fields: dict[str, str]) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in fields.items()]


def lineitem_feed(spark: SparkSession, sf: str, flag: str = CLEAN) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(*select_list(lineitem_fields(flag)))


def events_feed(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(*select_list(EVENTS))


def orders_feed(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(*select_list(ORDERS))


def visible(feed: DataFrame, batch: int, late: bool = False) -> DataFrame:
    """What has arrived by the end of a batch."""
    if CUTS[batch] is None:
        return feed
    rows = feed.where(f"recordstamp < timestamp_ntz'{CUTS[batch]}'")
    return rows.where(f"n <> {LATE_LINE}") if late else rows
