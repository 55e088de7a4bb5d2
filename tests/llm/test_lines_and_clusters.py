import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import AWKWARD, DOCS, awkward, clashing, empty
from tidemark.llm import bisectors, line_dedup


def plain_key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def plain_drop(rows, least_chars, least_docs):
    """(doc_id, text) rows to (doc_id, text, n_lines, n_dropped); a missing id is below all others."""
    held = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key := plain_key(line)) >= least_chars:
                held.setdefault(key, set()).add((d is not None, d or 0))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        stay = [
            x for x in lines
            if len(k := plain_key(x)) < least_chars or len(held[k]) < least_docs or max(held[k]) == (d is not None, d or 0)]
        out.append((d, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=str)


def line_rows(seed):
    rng = random.Random(seed)
    common = ["All rights of this text are reserved by its Owner", "Überschrift der Woche mit vielen Zeichen darin ÄÖ", "short", "x" * 40, "y" * 39]
    rows = []
    for d in range(60):
        lines = [rng.choice(common + [f"only in {d} and nowhere else in all of the texts"] * 3) for _ in range(rng.randint(0, 6))]
        rows.append((d, "\n".join(rng.choice(["", "  ", "\t", "\x0b"]) + (x.upper() if rng.random() < 0.2 and x.isascii() else x) + rng.choice(["", "\r", " \x0c"]) for x in lines)))
    rows += [(None, common[0] + "\n" + common[0]), (None, common[1]), (7, common[0]), (7, common[0]), (100, common[1] + "\n\n" + common[1])]
    return rows + [(200 + k, r[1]) for k, r in enumerate(AWKWARD)]


@pytest.mark.parametrize("few", [4096, 0.5])
@pytest.mark.parametrize("least_chars,least_docs", [(40, 5), (1, 2), (40, 1)])
def test_lines_equal_brute_force(spark, monkeypatch, few, least_chars, least_docs):
    monkeypatch.setattr(line_dedup, "FEW", few)
    rows = line_rows(1)
    docs = spark.createDataFrame([(d, t, "en", "a", 1) for d, t in rows], DOCS).repartition(3)
    got = line_dedup.drop_lines(docs, least_chars, least_docs)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "text", "n_lines", "n_dropped"]
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=str)
    assert got == plain_drop(rows, least_chars, least_docs)


def test_hot_lines_are_salted(spark):
    line = "a line that nearly all of the documents have in common"
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit(line + "\n"), F.col("id").cast("string")).alias("text"))
    got = line_dedup.drop_lines(docs)
    assert {r.n_dropped: r["count"] for r in got.groupBy("n_dropped").count().collect()} == {1: 2999, 0: 1}
    assert got.where("n_dropped = 0").first().doc_id == 2999


def test_lines_of_awkward_tables(spark):
    got = line_dedup.drop_lines(clashing(spark), 1, 2)
    want = plain_drop([(r[0], r[1]) for r in AWKWARD], 1, 2)
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=str) == want
    assert set(clashing(spark).columns) <= set(got.columns)
    assert line_dedup.drop_lines(empty(spark)).count() == 0
    assert line_dedup.drop_lines(awkward(spark).select("doc_id")).where("text = '' and n_lines = 1").count() == len(AWKWARD)


def plain_clusters(rows, k, rounds, seed=2, size=64):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(256 * x)) for x in v]))
    first = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), np.array(q, "<i4").tobytes(), q) for i, q in kept)[:k]
    centres = [q for *_, q in first]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        own = {}
        for _, q in kept:
            own.setdefault(nearest(q)[1], []).append(q)
        centres = [[sum(x) // len(own[j]) for x in zip(*own[j])] if j in own else c for j, c in enumerate(centres)]
    placed = [(i, *nearest(q)) for i, q in kept]
    inertia = {j: sum(d for _, d, c in placed if c == j) for _, _, j in placed}
    return sorted(
        ((i, j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest()) for i, d, j in placed), key=str)


def vectors(seed, n, size=64):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (5, size))
    rows = [(int(i), (centres[i % 5] + rng.normal(0, 0.1, size)).round(2).tolist()) for i in range(n)]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (None, rows[0][1]), (n + 1, None), (n + 2, []), (n + 3, [0.0] * (size - 1)), (n + 4, [None] + [0.0] * (size - 1))]
    rows += [(n + 5, [float("nan")] * size), (n + 6, [float("inf")] + [0.0] * (size - 1)), (n + 7, [-0.001] * size), (n + 8, [500_000.0] * size), (n + 9, [-500_000.0] * size)]
    return rows + [(n + 20 + j, rows[5][1]) for j in range(40)]


def outcome(df):
    return sorted(map(tuple, df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=str)


@pytest.mark.parametrize("k,n", [(40, 120), (7, 50), (1, 20), (40, 0)])
def test_clusters_equal_brute_force(spark, k, n):
    rows = vectors(k, n) if n else vectors(k, 10)[:6]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"cluster": F.lit("x"), "q": F.lit(1), "a.b": F.lit(2)}).repartition(3)
    assert outcome(bisectors.cluster(df, k=k, rounds=3)) == plain_clusters(rows, k, 3)


def test_awkward_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert bisectors.cluster(spark.createDataFrame([], schema)).count() == 0
    assert bisectors.cluster(spark.createDataFrame([(1, None), (2, [1.0])], schema)).count() == 0
    far = spark.createDataFrame([(1, [1e30] + [0.0] * 63), (2, [0.5] * 64)], schema)
    assert [tuple(r)[:3] for r in bisectors.cluster(far).collect()] == [(2, 0, 0)]  # beyond 2^27: not kept
    with pytest.raises(ValueError):
        bisectors.fit(far, k=0)


def test_tournament_breaks_ties_by_number():
    rng = np.random.default_rng(5)
    for scale in (2, 200, 1 << 27):
        for k in (1, 2, 3, 7, 40):
            centres = rng.integers(-scale, scale + 1, (k, 3))
            centres[k // 2] = centres[0]
            x = rng.integers(-scale, scale + 1, (500, 3))
            won, apart = bisectors.Bisectors(centres).nearest(x)
            d = ((x[:, None, :].astype(object) - centres[None]) ** 2).sum(axis=2)
            assert won.tolist() == [min(range(k), key=lambda j: (row[j], j)) for row in d] and apart.tolist() == d.min(axis=1).tolist()
