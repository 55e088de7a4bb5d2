"""SimHash near-duplicates found through deletion-variant signatures.

Two fingerprints that differ in at most k bits, cut into s segments, have a segment in which they
differ by at most k // s bits. With k = 2 and s = 2 that is one bit, so they agree on a segment
with one bit left out: each fingerprint is indexed under every segment with every single bit
deleted, equal entries are joined, and the whole fingerprints are compared. Copies share one
fingerprint, so a group of copies is one entry whatever its size.

An entry that many different fingerprints share is not joined with itself. Members of such a crowd
agree on all but one bit of one segment, so links within it differ only in the rest: the rest is
cut into k + 1 parts, of which one must be equal, and that part joins the key. This loses no link.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_position, columns_of, written
from .encode import text_slices

#: An entry shared by more different fingerprints than this is split by a further part.
CROWD = 32
#: Bytes of a text taken at a time, so that long texts need little memory.
_PART = 1_000_000
_BREAK = re.compile(rb"[ \t-\r]")


def _hashes(words: list[bytes], n: int) -> np.ndarray:
    from xxhash import xxh64_intdigest as digest

    line = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    total = len(words) - n + 1
    spans = zip(starts[:total].tolist(), ends[n - 1 :].tolist())
    return np.fromiter((digest(line[a:b], 42) for a, b in spans), np.uint64, total)


def shingle_hashes(text: str | None, n: int):
    """XXH64 (seed 42) of all n-word shingles, in arrays; a shorter text is one shingle.

    Long texts are taken in parts that overlap by n - 1 words: every shingle counts once.
    """
    raw = (text or "").encode().lower()  # bytes: ASCII case and ASCII white space only
    some, carry, at = False, [], 0
    while at < len(raw):
        m = _BREAK.search(raw, at + _PART)
        end = m.start() if m else len(raw)
        words = carry + raw[at:end].split()
        if len(words) >= n:
            some = True
            yield _hashes(words, n)
        carry, at = words[-(n - 1) :] if n > 1 else [], end
    if not some and carry:
        yield _hashes(carry, len(carry))


def fingerprint(text: str | None, n: int = 3) -> int:
    """Majority bits of the hashes of all n-word shingles; unsigned; 0 without words."""
    ones, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, n):
        total += len(hashes)
        for j in range(0, len(hashes), 250):  # counts of one block fit into a byte
            bits = np.unpackbits(hashes[j : j + 250].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0]) if total else 0


def fingerprints(docs: DataFrame, n: int = 3) -> DataFrame:
    """doc_id and the fingerprint as a signed long. Null and blank texts have fingerprint 0."""

    def make(batches):
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1)):
                found = np.array([fingerprint(t, n) for t in texts], np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    rows = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(make, "doc_id long, fp long")


def _differ(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(fps: DataFrame, bits: int = 2) -> DataFrame:
    """Pairs a < b of different fingerprints that differ in at most ``bits`` bits (1 to 3)."""
    if not 1 <= bits <= 3:
        raise ValueError("bits must be 1, 2 or 3")
    fps = fps.select("fp").distinct()
    # two segments: with up to three bits, one of them has at most one
    low = "4294967295L"
    variants = F.expr("flatten(array({}))".format(", ".join(
        f"transform(sequence(0, 31), bit -> named_struct('seg', {s}, 'bit', bit,"
        f" 'part', shiftrightunsigned(fp, {32 * s}) & {low} & ~shiftleft(1L, bit),"
        f" 'rest', shiftrightunsigned(fp, {32 - 32 * s}) & {low}))" for s in (0, 1))))
    entries = fps.select("fp", F.explode(variants).alias("v")).select("fp", "v.*")
    key = ["seg", "bit", "part"]
    sized = entries.withColumn("_n", F.count("*").over(Window.partitionBy(*key)))
    shared = written(sized.where("_n > 1"), "entries")  # entries met by one fingerprint link nothing

    def met(rows: DataFrame, on: list[str]) -> DataFrame:
        a, b = rows.select(F.col("fp").alias("a"), *on), rows.select(F.col("fp").alias("b"), *on)
        return a.join(b, on).where((F.col("a") < F.col("b")) & (_differ("a", "b") <= bits)).select("a", "b")

    few = met(shared.where(F.col("_n") <= CROWD), key)
    width = [(32 * k // (bits + 1), 32 * (k + 1) // (bits + 1)) for k in range(bits + 1)]
    parts = F.array(*[F.struct(F.lit(k).alias("sub"), F.expr(f"shiftrightunsigned(rest, {lo})").bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("piece")) for k, (lo, hi) in enumerate(width)])
    crowd = shared.where(F.col("_n") > CROWD).select("fp", *key, F.explode(parts).alias("p")).select("fp", *key, "p.*")
    return few.union(met(crowd, [*key, "sub", "piece"])).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node and the smallest node it is linked with, for all nodes of the edges a, b.

    Alternates large-star and small-star steps: each hangs neighbours on the smallest one, the
    number of edges never grows, and the rounds grow with the logarithm of the longest path.
    Every round is written to the shared folder.
    """
    edges, before = written(edges.select("a", "b").where("a <> b"), "edges"), None
    edge = F.xxhash64("a", "b")  # two digests of 64 bits and more tell whether a round changed anything
    digest = [F.count("*"), F.sum(edge.cast("decimal(38,0)")), F.bit_xor(F.xxhash64(F.lit(1), "b", "a"))]
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = written(small.where("a <> b").distinct(), "edges")
        after = tuple(edges.agg(*digest).first())
        before, settled = after, after == before
        if settled or not after[0]:
            roots = edges.select(F.col("b").alias("a"), "b").distinct()
            return edges.union(roots).toDF("node", "root")
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _rooted(groups: DataFrame, bits: int) -> DataFrame:
    """The groups, one for each fingerprint, with the root fingerprint of their component."""
    found = components(links(groups, bits))
    return groups.join(found, groups.fp == found.node, "left").withColumn("root", F.coalesce("root", "fp")).drop("node")


def linked_documents(docs: DataFrame, bits: int = 2, n: int = 3) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable) of every document.

    Documents with equal fingerprints link. A null doc_id keeps its row; it never names a
    component unless all of its documents have none. An empty table gives no row.
    """
    rows = written(fingerprints(docs, n), "fingerprints")
    groups = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "groups")
    rooted = _rooted(groups, bits)
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = rooted.join(named, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def row_key(plain: DataFrame, doc_id, text) -> DataFrame:
    """Rows named ``by_position`` with _key: null ids last, then doc_id, hash of text, hash of the row.

    Rows with one key are the same row repeated.
    """
    fields = [F.col(f.name) for f in plain.schema if "map<" not in f.dataType.simpleString()]
    return plain.withColumn("_key", F.struct(
        doc_id.isNull().alias("none"), doc_id.alias("id"), F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), *fields).alias("r")))


def first_rows(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """The keyed row for each struct ``first`` (key, times): a row that repeats is taken once."""
    key = ["_none", "_id", "_h", "_r"]
    kept = firsts.select(*[F.col(f"first.key.{k[1:]}").alias(k) for k in key], F.col("first.times").alias("_times"))
    on = rows["_key.h"].eqNullSafe(kept._h) & (rows["_key.r"] == kept._r) & rows["_key.id"].eqNullSafe(kept._id)
    once = rows.join(kept.where("_times = 1"), on, "left_semi").drop("_key")
    # copies of one row meet as one row from each task
    more = rows.join(kept.where("_times > 1"), on, "left_semi").groupBy("_key").agg(F.first(F.struct(*once.columns)).alias("_row"))
    return once.unionByName(more.select("_row.*"))


def keep_one(docs: DataFrame, bits: int = 2, n: int = 3) -> DataFrame:
    """One row of each component: the smallest doc_id, nulls last, then the first by its text's hash.

    Texts whose fingerprints of n-word shingles differ in at most ``bits`` bits link; null, empty
    and blank texts share fingerprint 0. A row that repeats is kept once. Very long texts are
    fingerprinted in parts. All columns stay, whatever their names; an empty table gives no row.
    """
    plain, (doc_id, text) = by_position(docs, "doc_id", "text")

    def make(batches):
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1)):
                found = np.array([fingerprint(t, n) for t in texts], np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(found.view(np.int64))], names=["_key", "fp"])

    keyed = row_key(plain, doc_id, text.cast("string"))
    slim = keyed.select("_key", text.cast("string").alias("text"))
    rows = slim.mapInArrow(make, slim.select("_key").schema.add("fp", "long"))
    times = rows.groupBy("fp", "_key").agg(F.count("*").alias("times"))
    groups = written(times.groupBy("fp").agg(F.min(F.struct(F.col("_key").alias("key"), "times")).alias("first")), "groups")
    firsts = _rooted(groups, bits).groupBy("root").agg(F.min("first").alias("first"))
    return first_rows(keyed, firsts).toDF(*docs.columns)
