"""SpotSigs fingerprints: chains of content words that follow common-word anchors.

A chain is the two content words after an anchor, common words between them left out; the
fingerprint is the set of a text's chains, as 32-bit hashes. In a long stretch without anchors
(another language, a list) a chain starts at every content word, so that a passage gives the same
chains whatever the rest of the text is. A text without such chains gives the chains of all its
content words, one without content words the chains of all words, one without words a chain of its
raw characters. Likeness is Jaccard's, pruned by set length: sets whose lengths differ by more
than the wanted likeness allows are never intersected. Only DataFrame functions are used.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import buckets, columns_of, written
from .stopwords import ALL

#: Content words in a row beyond which a stretch has too few anchors.
FEW = 12
#: Ranges of documents to a shuffle partition: many small ones fall on partitions more evenly.
SPREAD = 8
NO_LETTER = r"[^\p{L}\p{N}]+"


def with_signature(df: DataFrame, text: str, out: str, stop_words: list[str] = ALL) -> DataFrame:
    """Adds the sorted set of chain hashes of a text column that has no nulls."""
    listed = ", ".join("'" + w.replace("'", "''") + "'" for w in stop_words)
    df = df.withColumn("_w", F.array_remove(F.split(F.lower(text), NO_LETTER), ""))
    df = df.withColumn("_c", F.expr(f"filter(transform(_w, (x, i) -> struct(x, i)), s -> s.x not in ({listed}))"))
    # common words before each content word: equal along a stretch; a long one reaches half its length to one side
    df = df.withColumn("_s", F.expr("transform(_c, (s, j) -> s.i - j)"))
    half = (FEW + 1) // 2
    stretch = (f"(get(_s, j - {half}) = s.i - j or get(_s, j + {half}) = s.i - j)"
               f" and exists(sequence(0, {FEW}), d -> coalesce(get(_s, j - d) = get(_s, j - d + {FEW}), false))")
    df = df.withColumn("_h", F.expr(
        f"array_distinct(filter(transform(_c, (s, j) -> case when s.i - coalesce(get(_c, j - 1).i, -1) > 1 or {stretch}"
        " then hash(s.x, get(_c, j + 1).x) end), h -> h is not null))"))
    content = F.expr("array_distinct(transform(_c, (s, j) -> hash(s.x, get(_c, j + 1).x)))")
    every = F.expr("array_distinct(transform(_w, (x, i) -> hash(x, get(_w, i + 1))))")
    chosen = (
        F.when(F.size("_h") > 0, F.col("_h")).when(F.size("_c") > 0, content)
        .when(F.size("_w") > 0, every).otherwise(F.array(F.hash(F.lit("raw"), F.col(text)))))
    return df.withColumn(out, F.sort_array(chosen)).drop("_w", "_c", "_s", "_h")


def likeness(a: str, b: str, least: float = 0.0) -> Column:
    """Jaccard likeness of two sets; 0 without intersecting them where lengths rule ``least`` out."""
    na, nb = F.size(a), F.size(b)
    both = F.size(F.array_intersect(a, b))
    possible = F.least(na, nb) >= least * F.greatest(na, nb)
    return F.when(F.col(a) == F.col(b), 1.0).when(possible, both / (na + nb - both)).otherwise(0.0)


def as_text(signature: str) -> Column:
    return F.array_join(F.col(signature).cast("array<string>"), " ")


def _below(cuts: list[int], value: Column) -> Column:
    """How many of the sorted cuts are below a value: steps over the square root of their number, twice."""
    step = max(1, math.isqrt(len(cuts)))
    fine, coarse = (F.array(*map(F.lit, c)).cast("array<long>") for c in (cuts, cuts[step - 1 :: step]))
    whole = F.size(F.filter(coarse, lambda c: c < value)) * step
    return whole + F.size(F.filter(F.slice(fine, whole + 1, F.lit(step)), lambda c: c < value))


def with_next(rows: DataFrame, columns: list[str], prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Adds next_<column> of the next row by descending doc_id; after the last comes the first.

    Rows are dealt to ranges of doc_id. The first row of each range is also put, marked, behind
    the last row of the range before it, so each range finds its rows' successors by itself and
    only one row of each range is handled twice. ``prepare`` adds columns to rows so dealt, which
    ``columns`` may name. Null ids come last; equal ids and null ones follow each other by a hash of
    the text and then the text, and are dealt to ranges of that hash where they are many.
    """
    n = SPREAD * buckets(rows.sparkSession)
    found = rows.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)] or [0.5], 10_000)).first()[0] or []
    cuts = sorted(set(found))
    often = [c for c, k in Counter(found).items() if k > 1]  # such an id fills a range by itself
    rows = rows.withColumn("_hash", F.shiftrightunsigned(F.xxhash64("text"), 52))  # 12 bits
    place = _below(cuts, F.col("doc_id")).cast("long") * 8192
    split = F.col("_hash") + 1
    rows = rows.withColumn("_range", F.when(F.col("doc_id").isNull(), split - 8192).when(F.col("doc_id").isin(often), place + split).otherwise(place))
    order = [F.col("doc_id").desc_nulls_last(), F.col("_hash").desc(), F.col("text").desc()]
    tops = rows.groupBy("_range").agg(F.max(F.struct("doc_id", "_hash")).alias("_top"))
    # one row for each range: where its first row is needed again
    ring = Window.orderBy(F.col("_range").desc())
    last = Window.partitionBy()
    moved = tops.select(
        F.col("_range").alias("_r"), F.col("_top.doc_id").alias("_d"), F.col("_top._hash").alias("_h"),
        F.coalesce(F.lag("_range").over(ring), F.min("_range").over(last)).alias("_to"))
    heads = rows.join(F.broadcast(moved), (F.col("_range") == F.col("_r")) & F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_h")))
    first = Window.partitionBy("_r").orderBy(*order)
    heads = heads.withColumn("_n", F.row_number().over(first)).where("_n = 1")
    marked = rows.withColumn("_mark", F.lit(0)).unionByName(
        heads.drop("_range").withColumnRenamed("_to", "_range").withColumn("_mark", F.lit(1)).select(*rows.columns, "_mark"))
    marked = prepare(marked.repartition("_range"))
    within = Window.partitionBy("_range").orderBy("_mark", *order)
    return marked.withColumns({f"next_{c}": F.lead(c).over(within) for c in columns}).where("_mark = 0").drop("_mark", "_range", "_hash")


def fingerprints(docs: DataFrame, stop_words: list[str] = ALL) -> DataFrame:
    """Each document's fingerprint, and its likeness to an edited text's and the next document's.

    The edited text has its last half replaced by the first half-length of the next document.
    Null texts count as empty; a single document is its own next; an empty table gives no row.
    """
    rows = columns_of(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = with_next(rows, ["text", "sig"], lambda df: with_signature(df, "text", "sig", stop_words))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half)))
    rows = with_signature(rows.drop("text", "next_text"), "edited", "edited_sig", stop_words)
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text("sig").alias("fingerprint"), as_text("edited_sig").alias("edited_fingerprint"),
        likeness("sig", "edited_sig").alias("near_edited"), likeness("sig", "next_sig").alias("near_next"))


def near_pairs(docs: DataFrame, least: float = 0.8, stop_words: list[str] = ALL) -> tuple[DataFrame, DataFrame]:
    """Classes of equal signatures (doc_id, class_id), and pairs of classes at least so alike.

    Sets are partitioned by length so that alike sets lie in the same or the next partition. Of
    each set only its rarest chains, as many as one of them must be shared, are entered under
    (chain, partition); sets that meet are compared if their lengths allow it. No set is left out.
    """
    rows = columns_of(docs, "doc_id", "text").select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = written(with_signature(rows, "text", "sig", stop_words).select("doc_id", "sig", F.sha2(as_text("sig"), 256).alias("_key")), "sigs")
    members = rows.groupBy("_key").agg(F.min("doc_id").alias("class_id"), F.first("sig").alias("sig"))
    classes = written(members.withColumn("n", F.size("sig")), "classes")
    chains = classes.select("class_id", "n", F.explode("sig").alias("chain"))
    common = chains.groupBy("chain").agg(F.count("*").alias("df"))
    rank = Window.partitionBy("class_id").orderBy("df", "chain")
    prefix = chains.join(common, "chain").withColumn("_k", F.row_number().over(rank)).where(F.col("_k") <= F.col("n") - F.ceil(F.col("n") * least) + 1)
    part = F.floor(F.log("n") / math.log(1 / least)).cast("int") if least < 1 else F.col("n")
    prefix = prefix.select("class_id", "n", "chain", part.alias("part"))
    longer = prefix.select(F.col("class_id").alias("b"), F.col("n").alias("nb"), "chain", F.explode(F.array("part", F.col("part") - 1)).alias("part"))
    met = prefix.select(F.col("class_id").alias("a"), F.col("n").alias("na"), "chain", "part").join(longer, ["chain", "part"]).where(
        ((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))) & (F.col("na") >= F.col("nb") * least))
    found = met.select("a", "b").distinct()
    sigs = classes.select("class_id", "sig")
    pairs = found.join(sigs.toDF("a", "sig_a"), "a").join(sigs.toDF("b", "sig_b"), "b").withColumn("likeness", likeness("sig_a", "sig_b", least)).where(F.col("likeness") >= least)
    return rows.join(classes.select("class_id", "sig"), "sig").select("doc_id", "class_id"), pairs.select("a", "b", "likeness")
