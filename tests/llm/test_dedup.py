import random

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import AWKWARD, DOCS, awkward, empty
import corpus_pipeline
from tidemark.llm import quality, queries, simhash, spotsigs


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]).encode(), 42) for k in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fps = sorted(parent)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
                parent[root(a)] = root(b)
    return {f: root(f) for f in fps}


def test_fingerprints():
    for text in [r[1] for r in AWKWARD] + ["A b C", "É é x y", "a\x0bb\x1cc d"]:
        assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_long_texts_are_fingerprinted_in_parts(monkeypatch):
    text = " ".join(f"w{k * k % 97}\n" for k in range(600))
    want = [brute_fingerprint(t) for t in (text, "a b", "a", "  ", "a b c")]
    for part in (1, 7, 50):
        monkeypatch.setattr(simhash, "_PART", part)
        assert [simhash.fingerprint(t) for t in (text, "a b", "a", "  ", "a b c")] == want


@pytest.mark.parametrize("crowd", [32, 2])
def test_links_lose_none(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(4)
    centres = [rng.getrandbits(64) for _ in range(6)] + [0, 2**64 - 1]
    fps = {c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (rng.random() < 0.5) * (1 << rng.randrange(64)) for c in centres for _ in range(25)}
    fps |= {(centres[0] & (2**32 - 1)) | rng.getrandbits(32) << 32 for _ in range(80)}  # a crowd in one segment
    signed = [f - (f >> 63 << 64) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = {(r.a, r.b) for r in simhash.links(df).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    assert found == want and want
    roots = brute_components(signed)
    linked = {x for p in want for x in p}
    got = {r.node: r.root for r in simhash.components(simhash.links(df)).collect()}
    assert set(got) == linked
    for a in linked:
        for b in linked:
            assert (got[a] == got[b]) == (roots[a] == roots[b])


def test_components_of_long_paths(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}
    assert simhash.components(edges.where("a < 0")).count() == 0


def test_linked_documents_and_keep_one(spark):
    rows = simhash.linked_documents(awkward(spark)).collect()
    assert len(rows) == len(AWKWARD)
    roots = brute_components([r.fp for r in rows])
    for r in rows:
        own = [s.doc_id for s in rows if roots[s.fp] == roots[r.fp] and s.doc_id is not None]
        assert r.component_id == (min(own) if own else None)
    blank = [r for r in rows if r.doc_id in (3, 4, 5)]
    assert {r.fp for r in blank} == {0} and {r.component_id for r in blank} == {3}
    kept = simhash.keep_one(awkward(spark))
    assert kept.columns == awkward(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({r.component_id for r in rows if r.component_id is not None})
    assert simhash.linked_documents(empty(spark)).count() == 0 and simhash.keep_one(empty(spark)).count() == 0


def test_keep_one_goes_by_row(spark):
    texts = [" ".join(f"w{k}x{j}" for j in range(30)) for k in range(6)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (None, texts[2])]  # several null ids
    rows += [(7, texts[3]), (7, texts[4]), (5, texts[4]), (9, texts[5]), (9, texts[5])]  # an id on two texts, a repeated row
    docs = spark.createDataFrame([(d, t, None, "a", 1) for d, t in rows], DOCS)
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id or 0), r.text) for r in got.collect()) == sorted(
        [(0, t) for t in texts[:3]] + [(7, texts[3]), (5, texts[4]), (9, texts[5])])


def test_near_duplicate_stage_on_a_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.collect()
    fps = {r.doc_id: brute_fingerprint(r.text) for r in rows}
    roots = brute_components(fps.values())
    least = {}
    for d, f in fps.items():
        least[roots[f]] = min(d, least.get(roots[f], d))
    got = corpus_pipeline.near_duplicates(spark, docs, sf)
    assert got.columns == docs.columns and sorted(got.collect()) == sorted(r for r in rows if r.doc_id in set(least.values()))


def test_simhash_on_a_whole_table(spark, sf):
    rows = queries.op7_simhash(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    fps = {d: brute_fingerprint(t) for d, t in texts.items()}
    roots = brute_components(fps.values())
    least = {}
    for d, f in fps.items():
        least[roots[f]] = min(d, least.get(roots[f], d))
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {(d, f"{f:016x}", least[roots[f]]) for d, f in fps.items()}


def test_spotsigs_queries(spark):
    rows = spotsigs.fingerprints(awkward(spark)).collect()
    assert len(rows) == len(AWKWARD)
    same = {r.fingerprint for r in rows if r.doc_id in (1, 2)}
    assert len(same) == 1
    order = sorted(((r[0], r[1] or "") for r in AWKWARD), key=lambda x: (x[0] is None, -(x[0] or 0)))
    import hashlib

    want = set()
    for k, (doc, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        want.add((doc, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert {(r.doc_id, r.n_chars, r.edited_sha256) for r in rows} == want
    by = {r.fingerprint: set(r.fingerprint.split()) for r in rows}
    for r in rows:
        a, b = by[r.fingerprint], set(r.edited_fingerprint.split())
        assert r.near_edited == pytest.approx(len(a & b) / len(a | b)) and 0 <= r.near_next <= 1
    assert spotsigs.fingerprints(empty(spark)).count() == 0
    one = spotsigs.fingerprints(awkward(spark).where("doc_id = 1")).first()
    assert one.near_next == 1.0


@pytest.mark.parametrize("ids", [[None] * 60, [7] * 60, [None, 3, 3, 3, 9] * 12, list(range(60))])
def test_spotsigs_next_row_where_ids_are_equal_or_missing(spark, ids):
    docs = spark.createDataFrame([(d, f"text {k}") for k, d in enumerate(ids)], "doc_id long, text string")
    pairs = {(r.text, r.next_text): r for r in spotsigs.with_next(docs, ["text", "doc_id"]).collect()}
    after = dict(pairs.keys())
    assert len(after) == 60
    walk, seen = "text 0", []
    while walk not in seen:  # one ring through all rows
        seen.append(walk)
        walk = after[walk]
    assert len(seen) == 60 and walk == "text 0"
    falls = sum((r.doc_id is None, -(r.doc_id or 0)) > (r.next_doc_id is None, -(r.next_doc_id or 0)) for r in pairs.values())
    assert falls <= 1  # only from the last to the first


def test_spotsigs_cuts_are_found_as_by_counting(spark):
    rng = random.Random(5)
    for n in (0, 1, 2, 3, 10, 97):
        cuts = sorted(rng.sample(range(-300, 300), n))
        rows = spark.range(-310, 310, 7).select("id", spotsigs._below(cuts, F.col("id")).alias("k")).collect()
        assert all(r.k == sum(c < r.id for c in cuts) for r in rows)


def test_spotsigs_passage_gives_same_chains_beside_prose(spark):
    items = " ".join(f"item{k}" for k in range(60))  # no anchor
    prose = " ".join(f"the word{k} of thing{k}" for k in range(200))
    texts = [items, f"{items} the {prose}", f"{prose} the {items}", "the " + " ".join(f"x{k}" for k in range(12)), "the " + " ".join(f"x{k}" for k in range(13))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sigs = {r.doc_id: set(r.sig) for r in spotsigs.with_signature(docs, "text", "sig").collect()}
    assert len(sigs[0]) == 60 and len(sigs[0] & sigs[1]) >= 59 and sigs[0] <= sigs[2] and len(sigs[1]) > 400
    assert len(sigs[3]) == 1 and len(sigs[4]) == 13


@pytest.mark.parametrize("least", [0.8, 0.5])
def test_spotsigs_pairs_lose_none(spark, least):
    rng = random.Random(8)
    words = ["the", "of", "was"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    texts = []
    for _ in range(15):
        base = [rng.choice(words) for _ in range(rng.randint(20, 80))]
        texts.append(" ".join(base))
        for _ in range(3):
            other = list(base)
            for _ in range(rng.randint(0, 4)):
                other[rng.randrange(len(other))] = rng.choice(words)
            texts.append(" ".join(other))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    members, pairs = spotsigs.near_pairs(docs, least)
    sigs = {r.doc_id: set(r.sig) for r in spotsigs.with_signature(docs, "text", "sig").collect()}
    classes = {r.doc_id: r.class_id for r in members.collect()}
    assert all((classes[a] == classes[b]) == (sigs[a] == sigs[b]) for a in sigs for b in sigs)
    heads = set(classes.values())
    want = {frozenset((a, b)) for a in heads for b in heads if a < b and len(sigs[a] & sigs[b]) / len(sigs[a] | sigs[b]) >= least}
    assert {frozenset((r.a, r.b)) for r in pairs.collect()} == want and want


def test_quality_rules(spark):
    df = quality.judge(awkward(spark))
    assert all("Python" not in line for line in df._jdf.queryExecution().executedPlan().toString().splitlines())
    rows = {r.doc_id: r for r in df.collect()}
    assert rows[1].kept and not rows[3].kept and rows[3].n_words == 0 and not rows[8].kept
    assert rows[8].n_repeat_words == 3000 and rows[8].base_failed
    assert quality.judge(empty(spark)).count() == 0
    strict = [("n_words", 1000, None)]
    assert not quality.judge(awkward(spark), strict).where("doc_id = 1").first().kept


def test_quality_equals_sql_and_brute_force(spark, sf, tmp_path):
    texts = [r[1] for r in AWKWARD] + ["a b c d e a b c d e", "a b c d e f a b c d e", "x\nx\n\n \nx y", "# * $ ||| THE Big", "a a a a a a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({quality.oracle()}) ORDER BY doc_id").fetchall()
    got = [tuple(r) for r in quality.judge(docs).select(*names).orderBy("doc_id").collect()]
    assert got == want
    for doc, text in enumerate(texts):
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
        grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        covered = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(5)} if len(words) < 100 else None
        if covered is not None:
            assert got[doc][5] == len(covered)
