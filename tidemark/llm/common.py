"""Shared folder, written intermediate tables and split ranking for the operators of this package."""

from __future__ import annotations

import gc
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import shared_dir

#: ASCII white space as the contracts name it: space and tab to carriage return.
WORD_BREAK = r"[\x20\x09-\x0D]+"

_KEPT: dict[str, dict] = {}


def kept_in_worker(user: str) -> dict:
    """What one user keeps in this Python worker from task to task; what others kept is let go.

    A worker serves one step after the other, so its memory need only do for each alone.
    """
    if user not in _KEPT:
        _KEPT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _KEPT[user] = {}
    return _KEPT[user]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def columns_of(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra ones can't clash; a missing one is null."""
    have = set(df.columns)
    return df.select(*[df[n] if n in have else F.lit(None).alias(n) for n in names])


def by_position(docs: DataFrame, *names: str) -> tuple[DataFrame, list]:
    """The rows with columns c0, c1, ... in place of their names, which then can neither clash with
    others nor hold a dot, and the columns that had the given names (null where there was none).

    ``toDF(*docs.columns)`` gives the names back.
    """
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain, [F.col(f"c{docs.columns.index(n)}") if n in docs.columns else F.lit(None) for n in names]


def shared_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors see, removed when the session's JVM ends.

    It lies in spark.checkpoint.dir, or where the library's own shared folder is.
    """
    context = spark.sparkContext
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    jpath = context._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(context._jsc.hadoopConfiguration())
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)
    return fs.makeQualified(jpath).toString()  # with its scheme, for readers that aren't Spark's


def written(df: DataFrame, name: str = "t", small_groups: bool = False) -> DataFrame:
    """The same rows from Parquet in the shared folder: cuts lineage and survives lost executors.

    ``small_groups`` is for rows of megabytes: row groups of 16 MB, looked at after every row, so
    that neither writer nor reader holds many of them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    options = {"parquet.block.size": 1 << 24, "parquet.page.size.row.check.min": 1} if small_groups else {}
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def buckets(spark: SparkSession) -> int:
    """Parts into which a hot group is split; follows the number of shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ranked(df: DataFrame, group: list[str], key: str, order: list[str], out: str = "_rank") -> DataFrame:
    """Number the rows of each group from 0 without ever gathering a group in one task.

    The order is that of ``key``, a hash that spreads the rows of a group, and then ``order``; it
    does not depend on the number of partitions. Rows go to (group, range of the hash), are
    numbered there, and get the total of the earlier ranges of their group. Only these totals
    meet per group. Groups compare null-safe.
    """
    n = buckets(df.sparkSession)
    top = F.expr(f"shiftrightunsigned({key}, 33)")
    df = df.withColumn("_top", top).withColumn("_bucket", F.expr(f"cast(_top * {n} div 2147483648 as int)"))
    within = Window.partitionBy(*group, "_bucket").orderBy("_top", key, *order)
    df = df.withColumn("_in", (F.row_number().over(within) - 1).cast("long"))
    totals = df.groupBy(*group, "_bucket").agg((F.max("_in") + 1).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        *[F.col(g).alias(f"_g_{g}") for g in group], F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    cond = F.col("_bucket") == F.col("_b")
    for g in group:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    drop = [f"_g_{g}" for g in group] + ["_b", "_base", "_bucket", "_top", "_in"]
    return df.join(bases, cond).withColumn(out, F.col("_base") + F.col("_in")).drop(*drop)


def numbered(df: DataFrame, order: list, out: str = "_position") -> DataFrame:
    """All rows numbered from 0 in one order, by a distributed sort; stored.

    Only the sorted partitions' sizes, one row for each, meet in one place.
    """
    rows = written(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()), "sorted")
    rows = rows.withColumn("_part", F.shiftright("_m", 33))
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(bases, "_part").withColumn(out, F.col("_base") + inside).drop("_m", "_part", "_base")
