import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from tests.llm.helpers import AWKWARD, DOCS, awkward, empty
from tidemark.llm import geometric

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    """(item_id, rank, doc_id, score), all scores worked out; items are different (id, text)."""
    found = [(d, Counter(plain_terms(t))) for d, t in docs]
    found = [(d, c, sum(c.values())) for d, c in found if c]
    n_docs, n_terms = len(found), sum(n for *_, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in found:
            m = 75 + (25 * n * n_docs) // n_terms
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in plain_terms(text) if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    topics = [[f"{chr(97 + t)}{w}" for w in range(40)] for t in range(5)]
    docs = []
    for d in range(n):
        own = rng.choice(topics)
        words = [rng.choice(own) if rng.random() < 0.7 else rng.choice(["the", "of", "Été", "x1"]) for _ in range(rng.randint(1, 60))]
        docs.append((d, " ".join(words)))
    docs += [(d + n, docs[3][1]) for d in range(30)]  # copies: equal scores
    items = [(i, " ".join(rng.choice(rng.choice(topics)) for _ in range(12)) + " the the") for i in range(12)]
    return docs, items + [(99, None), (98, ""), (97, "nowhere"), (96, docs[3][1])]


@pytest.mark.parametrize("block,postings,terms", [(64, 200_000, 200_000), (4, 300, 200_000), (2, 40, 30)])
def test_results_are_those_of_scoring_everything(spark, monkeypatch, block, postings, terms):
    monkeypatch.setattr(geometric, "POSTINGS", postings)
    monkeypatch.setattr(geometric, "TERMS", terms)
    docs, items = corpus(1, 300)
    for k in (5, 20):
        got = geometric.rank(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), k, block)
        assert sorted(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect()), key=str) == brute(docs, items, k)


def test_bounds_hold_and_blocks_are_skipped():
    rng = np.random.default_rng(3)
    ids = [np.unique(rng.integers(0, 60, rng.integers(1, 25)) + 60 * (d % 4)).astype(np.int32) for d in range(400)]
    impacts = [rng.integers(1, 900_000, len(i)) for i in ids]
    shard = geometric.Shard(geometric.build_shard(list(range(400)), ids, impacts, 8))
    assert sorted(shard.blocks.tolist()) == shard.blocks.tolist() and shard.blocks[-1] == sum(map(len, ids))
    skipped = 0
    for _ in range(40):
        terms = np.unique(rng.integers(0, 60, 10) + 60 * rng.integers(0, 4)).astype(np.int32)
        weights = rng.integers(0, 9000, len(terms))
        scores = np.array([sum(int(w) * int(v[i == t].sum()) for t, w in zip(terms, weights)) for i, v in zip(ids, impacts)])
        for least in (1, int(np.sort(scores)[-20]), int(scores.max()), int(scores.max()) + 1):
            docs, found = shard.search(terms, weights, max(1, least))
            want = np.flatnonzero(scores >= max(1, least))
            assert docs.tolist() == want.tolist() and found.tolist() == scores[want].tolist()
        bound = np.zeros(len(shard.least), np.int64)
        for t, w in zip(terms, weights):
            at = np.searchsorted(shard.terms, t)
            s = slice(shard.sum_lists[at], shard.sum_lists[at + 1])
            bound[shard.sum_blocks[s]] += w * geometric.STEP * shard.sums[s].astype(np.int64)
        for b in np.flatnonzero(shard.least):
            own = shard.members[shard.blocks[b] : shard.blocks[b + 1]]
            assert scores[own].max() <= bound[b]
            skipped += bound[b] < np.sort(scores)[-20]
    assert skipped > 1000


def test_awkward_tables(spark):
    items = spark.createDataFrame([(1, "the house One 日本語"), (1, "the house One 日本語"), (1, "word end"), (None, "END"), (2, None)], "item_id long, text string")
    got = geometric.rank(awkward(spark), items.selectExpr("*", "1 AS doc_id", "'x' AS score"))
    want = brute([(r[0], r[1]) for r in AWKWARD], [(1, "the house One 日本語"), (1, "word end"), (None, "END")], 20)
    assert sorted(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect()), key=str) == want
    assert geometric.rank(empty(spark), items).count() == 0 and geometric.rank(awkward(spark), items.where("false")).count() == 0
    blank = spark.createDataFrame([(1, " ", "", "", 1)], DOCS)
    assert geometric.rank(blank, items).count() == 0


def test_equals_sql(spark, tmp_path):
    docs, items = corpus(2, 80)
    docs += [(500 + k, r[1]) for k, r in enumerate(AWKWARD)]
    frames = {"documents": spark.createDataFrame(docs, "doc_id long, text string"), "benchmark": spark.createDataFrame(items, "item_id long, text string")}
    con = duckdb.connect()
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.execute(f"SELECT item_id, rank, doc_id, score FROM ({geometric.oracle()}) ORDER BY ALL").fetchall()
    got = geometric.rank(frames["documents"], frames["benchmark"]).select("item_id", "rank", "doc_id", "score")
    assert sorted(map(tuple, got.collect())) == want and want
