"""Exact ranked search over posting lists that are cut into blocks of similar documents.

Documents are indexed in shards of a bounded number of postings, each within one task. In a shard
every term has a posting list; a long list is clustered by the likeness of its documents, and each
cluster is a block with a summary: the largest impact of every term among its documents. The sum of
a query's weights times the summary is no less than the score of any document of the block, so a
block whose sum is below the score of the k-th document found so far holds nothing to return; it is
skipped, and all other blocks are scored. A list whose terms can't reach that score with all lists
that follow is left out likewise. Nothing else is skipped: results are those of scoring everything.

The impact of a term in a document, and the weight of a term, are whole numbers, and so are scores.
Only terms that some item asks for are indexed, as no other can add to a score; the numbers of
documents and terms and the lengths of documents come from all terms.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import columns_of, written
from .encode import text_slices

#: Postings and documents of a shard, at most (one document more than that is a shard of its own).
POSTINGS, DOCUMENTS = 100_000, 1_000
#: Documents of a block, about; a list of fewer is one block without a summary.
BLOCK = 128
#: Different terms of the items that are searched for at a time.
TERMS = 200_000
#: Summaries hold impacts in steps of this size, rounded up.
STEP = 16
#: Fixed values of the contract.
SCALE, LENGTH, BASE = 1_000_000_000, 25, 75
_SKETCH = 32
# ASCII digits and letters, and all bytes of other characters
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")

_SHARD = {
    "docs": np.int64, "none": np.bool_, "terms": np.int32, "lists": np.int32, "blocks": np.int32, "members": np.int32,
    "impacts": np.int32, "least": np.int32, "sum_terms": np.int32, "sum_lists": np.int32, "sum_blocks": np.int32, "sums": np.uint16,
}


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order: bytes.lower leaves all but A-Z as it is."""
    return _TERM.findall((text or "").encode().lower())


def forward(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (all terms) and, of the vocabulary's terms, numbers in order and how often each occurs.

    Documents without a term are left out.
    """
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def make(batches):
        number = known.value.get
        for batch in batches:
            for begin, end, texts in text_slices(batch.column(1)):
                keep, n, ids, times = [], [], [], []
                for k, text in enumerate(texts):
                    words = terms_of(text)
                    if not words:
                        continue
                    found = sorted((i, c) for t, c in Counter(words).items() if (i := number(t)) is not None)
                    keep.append(begin + k)
                    n.append(len(words))
                    ids.append(np.array([i for i, _ in found], "<i4").tobytes())
                    times.append(np.array([c for _, c in found], "<i4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(times, pa.binary())],
                    names=["doc_id", "n", "ids", "times"])

    rows = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(make, "doc_id long, n long, ids binary, times binary")


def document_counts(rows: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary occurs: one row per task and term."""

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                total[np.frombuffer(ids.as_py(), "<i4")] += 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "n"])

    found = rows.select("ids").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(size, np.int64)
    for r in found.toLocalIterator():  # the vocabulary's size at most
        out[r.term] = r.n
    return out


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impact(times: np.ndarray, n, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term that occurs so often adds to the score of a document of n terms, before its weight."""
    m = BASE + (LENGTH * n * n_docs) // n_terms
    return (SCALE * times) // (1000 * times + 12 * m)


def _directions(terms: np.ndarray) -> np.ndarray:
    """A fixed pseudo-random sign vector for each term."""
    with np.errstate(over="ignore"):
        h = (terms.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : _SKETCH // 8], axis=1)
    return bits.astype(np.float32) * 2 - 1


def build_shard(docs: list, ids: list[np.ndarray], impacts: list[np.ndarray], block: int) -> dict[str, np.ndarray]:
    """Posting lists, blocks and summaries of some documents."""
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    doc = np.repeat(np.arange(len(ids)), sizes)
    flat = np.concatenate([np.zeros(0, np.int32), *ids])
    value = np.concatenate([np.zeros(0, np.int64), *impacts])
    terms, local = np.unique(flat, return_inverse=True)
    sketch = np.zeros((len(ids), _SKETCH), np.float32)
    signs = _directions(terms)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    for d in range(len(ids)):
        part = slice(begin[d], begin[d + 1])
        sketch[d] = value[part].astype(np.float32) @ signs[local[part]]
    sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)

    order = np.argsort(local, kind="stable")  # lists: terms in order, documents in order within
    members, values = doc[order], value[order]
    ends = np.concatenate([[0], np.cumsum(np.bincount(local, minlength=len(terms)))])
    coded = -(-value // STEP)
    blocks, least, lists = [0], [], [0]
    s_block, s_term, s_value = [], [], []
    for t in range(len(terms)):
        a, b = int(ends[t]), int(ends[t + 1])
        if b - a <= block:
            blocks.append(b)
            least.append(0)
        else:
            own = members[a:b].copy()
            count = -(-(b - a) // block)
            heads = own[np.linspace(0, len(own) - 1, count).astype(np.int64)]
            near = np.argmax(sketch[own] @ sketch[heads].T, axis=1)
            turn = np.argsort(near, kind="stable")
            members[a:b], values[a:b] = own[turn], values[a:b][turn]
            own, near = own[turn], near[turn]
            _, near = np.unique(near, return_inverse=True)  # clusters that are empty are no blocks
            count = int(near[-1]) + 1
            most = np.zeros(count * len(terms), np.uint16)
            n = sizes[own]
            at = np.repeat(begin[own], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            np.maximum.at(most, np.repeat(near, n) * len(terms) + local[at], coded[at].astype(np.uint16))
            cell = np.flatnonzero(most)
            s_block.append(cell // len(terms) + len(blocks) - 1)
            s_term.append(cell % len(terms))
            s_value.append(most[cell])
            blocks.extend((a + np.cumsum(np.bincount(near))).tolist())
            least.extend([1] * count)
        lists.append(len(blocks) - 1)
    s_block, s_term = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (s_block, s_term))
    s_value = np.concatenate([np.zeros(0, np.uint16), *s_value])
    turn = np.argsort(s_term, kind="stable")
    sum_lists = np.concatenate([[0], np.cumsum(np.bincount(s_term, minlength=len(terms)))])
    found = {
        "docs": [0 if d is None else d for d in docs], "none": [d is None for d in docs], "terms": terms, "lists": lists, "blocks": blocks,
        "members": members, "impacts": values, "least": least, "sum_terms": [], "sum_lists": sum_lists, "sum_blocks": s_block[turn], "sums": s_value[turn],
    }
    return {k: np.asarray(found[k], kind) for k, kind in _SHARD.items()}


def index(rows: DataFrame, n_docs: int, n_terms: int, block: int = BLOCK) -> DataFrame:
    """One row of arrays for each shard of ``forward`` rows."""
    names = list(_SHARD)

    def make(batches):
        docs, ids, impacts, held = [], [], [], 0

        def shard():
            made = build_shard(docs, ids, impacts, block)
            return pa.RecordBatch.from_arrays([pa.array([made[k].tobytes()], pa.binary()) for k in names], names=names)

        for batch in batches:
            for k in range(len(batch)):
                doc_id, n, i, times = (c[k].as_py() for c in batch.columns)
                i = np.frombuffer(i, "<i4")
                if not len(i):
                    continue
                if docs and (held + len(i) > POSTINGS or len(docs) >= DOCUMENTS):
                    yield shard()
                    docs, ids, impacts, held = [], [], [], 0
                docs.append(doc_id)
                ids.append(i)
                impacts.append(impact(np.frombuffer(times, "<i4").astype(np.int64), n, n_docs, n_terms))
                held += len(i)
        if docs:
            yield shard()

    return rows.mapInArrow(make, ", ".join(f"{k} binary" for k in names))


class Shard:
    """A shard as it is searched."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        for name, array in arrays.items():
            setattr(self, name, array)
        self.ends = self.blocks[self.lists[1:]] if len(self.terms) else self.blocks[:0]
        self.starts = self.blocks[self.lists[:-1]]
        self.top = np.maximum.reduceat(self.impacts, self.starts) if len(self.terms) else self.impacts

    def search(self, terms: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (their places) that score ``least`` or more, and their scores."""
        at = np.searchsorted(self.terms, terms)
        here = (at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == terms)
        at, weights = at[here], weights[here]
        reach = weights * self.top[at]
        order = np.argsort(-reach, kind="stable")
        at, weights, reach = at[order], weights[order], reach[order]
        rest = np.cumsum(reach[::-1])[::-1]  # what a document in none of the earlier lists can score
        use = int(np.count_nonzero(rest >= least))
        if not use:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        bound = np.zeros(len(self.least), np.int64)
        grid = np.zeros((len(at), len(self.docs)), np.int64)
        for k, t in enumerate(at):
            s = slice(self.sum_lists[t], self.sum_lists[t + 1])
            bound[self.sum_blocks[s]] += weights[k] * STEP * self.sums[s].astype(np.int64)
            p = slice(self.starts[t], self.ends[t])
            grid[k, self.members[p]] = self.impacts[p]
        wanted = np.zeros(len(self.docs), bool)
        for t in at[:use]:
            for b in range(self.lists[t], self.lists[t + 1]):
                if not self.least[b] or bound[b] >= least:
                    wanted[self.members[self.blocks[b] : self.blocks[b + 1]]] = True
        docs = np.flatnonzero(wanted)
        scores = weights @ grid[:, docs]
        good = scores >= least
        return docs[good], scores[good]


def search(shards: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """item (its place in the list), doc_id and score of the k best documents of every task."""
    spark = shards.sparkSession
    asked = spark.sparkContext.broadcast(items)
    names = list(_SHARD)

    def find(batches):
        best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))] * len(asked.value)  # ids, without id, scores
        least = [1] * len(best)
        for batch in batches:
            for row in range(len(batch)):
                shard = Shard({n: np.frombuffer(batch.column(c)[row].as_buffer(), _SHARD[n]) for c, n in enumerate(names)})
                for i, (terms, weights) in enumerate(asked.value):
                    docs, scores = shard.search(terms, weights, least[i])
                    if not len(docs):
                        continue
                    ids, none, scores = (np.concatenate(x) for x in zip(best[i], (shard.docs[docs], shard.none[docs], scores)))
                    order = np.lexsort((ids, none, -scores))[:k]
                    best[i] = ids[order], none[order], scores[order]
                    if len(order) == k:
                        least[i] = int(scores[order[-1]])
        sizes = [len(b[0]) for b in best]
        ids, none, scores = (np.concatenate(x) if best else np.zeros(0, np.int64) for x in (zip(*best) if best else ((), (), ())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best)), sizes), pa.int64()), pa.array(ids, pa.int64(), mask=none.astype(bool)), pa.array(scores, pa.int64())],
            names=["item", "doc_id", "score"])

    return shards.mapInArrow(find, "item long, doc_id long, score long")


def _slices(items: DataFrame):
    """The items (id, terms) in lists of at most ``TERMS`` different terms each, or one item."""
    some, seen = [], set()
    for r in items.toLocalIterator():
        terms = Counter(terms_of(r.text))
        if some and len(seen | terms.keys()) > TERMS:
            yield some, sorted(seen)
            some, seen = [], set()
        some.append((r.item_id, terms))
        seen |= terms.keys()
    if some:
        yield some, sorted(seen)


def rank(docs: DataFrame, items: DataFrame, k: int = 20, block: int = BLOCK) -> DataFrame:
    """The k documents with the highest score above 0 for each item: item_id, rank, doc_id, score.

    Equal scores rank by ascending doc_id, documents without one last. A document's score is the sum
    over the item's terms, repeats included, of weight times impact. Texts of any length count whole;
    a null, empty or blank text has no term, so such a document is not counted and such an item finds
    nothing. Every document row is a document of its own, also if it repeats. Item rows that
    repeat (id and text) are one item; an id with different texts is ranked for each text. Columns
    other than doc_id, item_id and text are not looked at. With an empty table there is no row.

    Items are searched for in slices of at most ``TERMS`` different terms, so that the vocabulary
    every task holds is bounded; each slice has an index of its own.
    """
    spark: SparkSession = docs.sparkSession
    asked = columns_of(items, "item_id", "text").select("item_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    schema = asked.select(F.col("item_id").alias("item_id")).schema
    parts = []
    for some, vocabulary in _slices(asked):
        rows = written(forward(docs, vocabulary), "forward")
        n_docs, n_terms = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            continue
        counts = document_counts(rows, len(vocabulary))
        number = {t: i for i, t in enumerate(vocabulary)}
        queries = []
        for _, terms in some:
            pairs = sorted((number[t], c * weight(n_docs, int(counts[number[t]]))) for t, c in terms.items() if counts[number[t]])
            queries.append((np.array([i for i, _ in pairs], np.int32), np.array([w for _, w in pairs], np.int64)))
        shards = written(index(rows, n_docs, n_terms, block), "index", small_groups=True)
        found = search(shards, queries, k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(some)], f"item long, item_id {schema['item_id'].dataType.simpleString()}")
        # a slice of the stated items, as many as the vocabulary's bound lets in
        parts.append(best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], schema.add("rank", "integer").add("doc_id", "long").add("score", "long"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def oracle(k: int = 20) -> str:
    """The contract's columns in DuckDB SQL: every document that shares a term is scored."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    found = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, unnest({found}) AS term FROM documents),
p AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY 1, 2),
l AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM p GROUP BY 1),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM l),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(c.docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM p, c GROUP BY term),
i AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest({found}) AS term FROM benchmark) GROUP BY 1, 2),
s AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * c.docs) // c.terms)))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN p USING (term) JOIN l USING (doc_id), c GROUP BY 1, 2)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= {k}"""
