"""Operation flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.columns import col
from tidemark.spec import DELETE_FLAG, UPSERT_FLAGS, FeedSpec


def flag_of(spec: FeedSpec) -> Column:
    """The operation flag, with rows that meet ``delete_when`` counted as deletes."""
    flag = col(spec.op)
    if spec.delete_when:
        return F.when(F.expr(spec.delete_when), F.lit(DELETE_FLAG)).otherwise(flag)
    return flag


def flag_rank(flag: Column) -> Column:
    """Sort value of a flag within equal stamps: deletes first, then by letter, NULL last."""
    return F.when(flag == DELETE_FLAG, F.lit("ZZ")).otherwise(flag)


def is_live(flag: Column) -> Column:
    return F.coalesce(flag, F.lit("I")) != DELETE_FLAG


def is_delete(flag: Column) -> Column:
    return F.coalesce(flag == DELETE_FLAG, F.lit(False))


def is_upsert(flag: Column) -> Column:
    return F.coalesce(flag.isin(*UPSERT_FLAGS), F.lit(False))
