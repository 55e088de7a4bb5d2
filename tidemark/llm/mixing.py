"""Mixing sources to target weights by entropy balancing.

Among all document rates that give each source its target tokens, the ones closest to 1 (least
relative entropy, a document counting by its tokens) are exponential: exp(lambda of the source).
The dual in the lambdas is convex, and as every document has one source its Hessian is diagonal:
each Newton step of all sources is one expression over the table of sources, wherever its rows
lie. Rates are then rounded into whole copies. Within a source the rounding error is carried from
longer documents to shorter ones, so taken tokens miss the target by about the shortest document.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_position, numbered, ranked, written

WORD = r"[^\x20\x09-\x0D]+"
#: Newton steps; the first ones go about 1 a step, the last ones double the digits. No ratio of
#: two doubles' range needs more than its logarithm, 745, and a few.
STEPS = 760


def sizes(docs: DataFrame) -> DataFrame:
    """Documents with ``size``, their number of words; null texts have none."""
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))


def targets(source_sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: float = 3.0) -> DataFrame:
    """Adds ``target`` to source, source_size: shares by weight, at most ``most`` times the size.

    Sources take the weights in turn by code point, null last. What a source can't hold is shared
    among the others by weight until none is above. Each pass is one sum over the sources.
    """
    order = [F.col("source").asc_nulls_last()]
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_position"), F.lit(len(weights))) + 1).cast("int"))
    state = written(numbered(source_sizes, order).select("source", "source_size", weight.alias("w"), (F.col("source_size") * most).alias("cap")), "sources")
    total = state.agg(F.sum("source_size")).first()[0] or 0
    unit = 0.0
    while True:  # the unit only grows, so a source that is full stays full
        full = F.lit(unit) * F.col("w") > F.col("cap")
        held, rest = state.agg(
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("w"))), F.lit(0.0))).first()
        new = (total - held) / rest if rest else unit
        if new <= unit:
            break
        unit = new
    return state.select("source", "source_size", F.least(F.lit(unit) * F.col("w"), F.col("cap")).alias("target"))


def rates(targets_: DataFrame) -> DataFrame:
    """Adds ``rate``, the exponential tilt of a source's documents, by Newton's method on the dual.

    The dual's gradient is size * exp(lambda) - target and its curvature size * exp(lambda).
    """
    size, target = F.col("source_size").cast("double"), F.col("target")
    solved = F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS)), F.lit(0.0),
        lambda x, _: x - (size * F.exp(x) - target) / (size * F.exp(x)))
    return targets_.withColumn("rate", F.when((size > 0) & (target > 0), F.exp(solved)).when(size > 0, 0.0).otherwise(1.0))


def _carry(most: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ascending=False)
        out, carry = [], 0.0
        for size, n, rate in zip(pdf["size"].tolist(), pdf["n"].tolist(), pdf["rate"].tolist()):
            want = size * n * rate + carry
            k = min(max(round(want / size if size else n * rate), 0), most * n)
            carry = want - size * k
            out.append(k)
        return pd.DataFrame({"source": pdf["source"], "size": pdf["size"], "n": pdf["n"], "total": out})

    return run


def _placed(rows: DataFrame, weights: tuple[float, ...], most: int) -> DataFrame:
    """Rows of doc_id, source, size, _hash and any others with their copies and what led to them."""
    groups = written(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "sizes")
    totals = groups.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    solved = written(rates(targets(totals, weights, most)), "rates")
    known = solved.withColumnRenamed("source", "_source")
    cells = groups.join(known, groups.source.eqNullSafe(known._source)).select("source", "size", "n", "rate")
    planned = cells.groupBy("source").applyInPandas(_carry(most), "source string, size long, n long, total long")
    plan = planned.join(known, planned.source.eqNullSafe(known._source)).select(
        "_source", F.col("size").alias("_size"), "source_size", "target", "rate",
        F.floor(F.col("total") / F.col("n")).alias("_each"), (F.col("total") % F.col("n")).alias("_more"))
    plan = written(plan, "plan")
    placed = ranked(rows, ["source", "size"], "_hash", ["doc_id"])
    more = F.when(F.col("_rank") < F.col("_more"), 1).otherwise(0)
    return placed.join(plan, placed.source.eqNullSafe(plan._source) & (placed["size"] == plan._size)).withColumn(
        "copies", (F.col("_each") + more).cast("int"))


def _sized(docs: DataFrame, whole: bool) -> DataFrame:
    """doc_id, source, size and a hash; with ``whole`` also the row, packed so no name can clash."""
    plain, (doc_id, text, source) = by_position(docs, "doc_id", "text", "source")
    row = [F.struct(*plain.columns).alias("_row")] if whole else []
    slim = plain.select(*row, doc_id.alias("doc_id"), text.cast("string").alias("text"), source.cast("string").alias("source"))
    return sizes(slim).withColumn("_hash", F.xxhash64("doc_id", "text")).drop("text")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: int = 3) -> DataFrame:
    """doc_id, source, size, source_size, target, rate and copies (0 to ``most``) of all documents.

    A group of the carrying step has one row for each size that occurs in a source, so it is
    bounded by the longest text, not by the source. Copies left over within a size go to the
    documents with the lowest hash of doc_id and text: reruns agree. Null texts have size 0 and
    about one copy; null is a source of its own, the last. Repeated rows count each; other
    columns are left out, and so are texts, before anything is shuffled. An empty table gives
    no row.
    """
    return _placed(_sized(docs, False), weights, most).select("doc_id", "source", "size", "source_size", "target", "rate", "copies")


def take(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: int = 3) -> DataFrame:
    """The mixed documents themselves, all columns, each as often as its copies say.

    Nulls, empty and repeated rows count as in ``mix``; texts are moved whole, with their rows. All
    columns stay, whatever their names; an empty table gives no row.
    """
    taken = _placed(_sized(docs, True), weights, most).where("copies > 0")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).select("_row.*").toDF(*docs.columns)
