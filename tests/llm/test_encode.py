import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import AWKWARD, awkward, empty
from tidemark.llm import id_planes, packing, token_counts
from tidemark.llm.common import shared_folder
from tidemark.llm.encode import Encoder, encoder
from tidemark.llm.queries import tokenizer_file

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
ODD = ["", "  ", "a  b", "x\n\ny", " lead", "trail ", "tab\tx", "a b", "ΣΙΣ ab", "é ́x", "it's I'M we'll",
       "<|endoftext|> a<|startoftext|>b", "日本語 \U0001f600 ok", "a_b __ c", "x\x1cy z\x85w", "12 345\n 6", "\n\n a \n b\n", "\x00 a", "a\r\nb"]


@pytest.mark.parametrize("name", FILES)
def test_cached_ids_equal_those_of_whole_texts(name):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice(" \na Bé'És1#_\tßΣx") for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    coder = encoder(tokenizer_file(name))
    for _ in range(2):  # unknown chunks first, known ones then
        ids, n = coder.encode(texts)
        ends = np.cumsum(n)
        whole = coder.rules.tokenizer.encode_batch(texts, add_special_tokens=False)
        assert [ids[e - k : e].tolist() for e, k in zip(ends, n)] == [w.ids for w in whole]


@pytest.mark.parametrize("name", FILES)
def test_long_texts_are_encoded_in_parts(name, monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice("  \na Bé'És1#_,") for _ in range(5000))
    coder = encoder(tokenizer_file(name))
    want = coder.rules.tokenizer.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr("tidemark.llm.encode.LONG", 300)
    assert len(list(coder.rules.parts(text))) > 5
    ids, n = coder.encode(["x", text, None])
    assert n.tolist() == [n[0], len(want), 0] and ids[n[0] :].tolist() == want


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits, tmp_path):
    rng = np.random.default_rng(1)
    for top in (1, 2, 255, 256, 65_535, 65_536, 2**32 - 1):
        ids = rng.integers(0, top, 1001, dtype=np.uint64).astype(np.uint32)
        assert (id_planes.from_planes(id_planes.to_planes(ids, bits), 1001, bits) == ids).all()
    path = tmp_path / "x.ids"
    docs = [(5, 10), (None, 0), (6, 1000), (7, 1)]
    ids = rng.integers(0, 70_000, 1011).astype(np.uint32)
    with open(path, "wb") as f:
        w = id_planes.ShardWriter(f, block=64, bits=bits)
        w.add([5, None], [10, 0], ids[:10])
        w.add([6, 7], [1000, 1], ids[10:])
        w.close()
    with open(path, "rb") as f:
        r = id_planes.ShardReader(f)
        found = list(r.documents())
        assert (r.block(3) == ids[192:256]).all() and len(r.index) == 16
    assert [(d, len(x)) for d, x in found] == docs
    assert (np.concatenate([x for _, x in found]) == ids).all()


def test_ids_written_in_order_and_read_back(spark):
    file = tokenizer_file("word_bpe_49k.json")
    rows = id_planes.round_trip(awkward(spark), file).orderBy("start").collect()
    tokenizer = encoder(file).rules.tokenizer
    want = []
    for doc, text in sorted(((r[0], r[1]) for r in AWKWARD), key=lambda x: (x[0] is not None, x[0])):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((doc, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in rows] == want
    assert [r.start for r in rows] == np.cumsum([0, *[w[1] for w in want[:-1]]]).tolist()
    shards = id_planes.write_ids(awkward(spark), shared_folder(spark), file, 1, block=64, file_ids=1)
    again = id_planes.read_ids(shards).orderBy("start").collect()
    assert [r[:4] for r in again] == [r[:4] for r in rows] and shards.count() >= shards.where("n_ids > 0").count() > 1
    assert [r.n_ids for r in shards.orderBy("shard").collect()] == [
        sum(r.n_tokens for r in again if r.shard == k) for k in sorted({r.shard for r in again})]
    assert id_planes.round_trip(empty(spark), file).count() == 0


def test_files_have_a_bounded_size_whatever_the_partitions(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("word " * 500_000).alias("text")).where("doc_id < 12")
    shards = id_planes.write_ids(docs.coalesce(1), shared_folder(spark), tokenizer_file("word_bpe_49k.json"), 1, file_ids=1_000_000)
    sizes = [r.n_ids for r in shards.orderBy("shard").collect()]
    assert len(sizes) > 3 and max(sizes) < 3_000_000 and sum(sizes) == 12 * 500_001
    back = id_planes.read_ids(shards).orderBy("doc_id").collect()
    assert [r.start for r in back] == [k * 500_001 for k in range(12)] and len({r.ids_crc32 for r in back}) == 1


@pytest.mark.parametrize("rule", ["first", "last", "most"])
def test_attribution_against_the_librarys_offsets(spark, rule):
    file = tokenizer_file("byte_bpe_50k.json")
    texts = [r[1] for r in AWKWARD] + ["a\n\n\nb\n", "\n\n\n\n\n\n\n", "café 日本\nx", "    y\n        z"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    rows = token_counts.attribute_tokens(docs, file, rule).orderBy("doc_id", "section").collect()
    tokenizer = encoder(file).rules.tokenizer
    for k, text in enumerate(texts):
        text = text or ""
        parts = [p + "\n" for p in text.split("\n")[:-1]] + ([text.split("\n")[-1]] if text.split("\n")[-1] or not text else [])
        ends = np.cumsum([len(p) for p in parts]).tolist()
        counts = [0] * len(parts)
        for a, b in tokenizer.encode(text, add_special_tokens=False).offsets:
            share = [max(0, min(e, b) - max(e - len(p), a)) for e, p in zip(ends, parts)]
            held = [i for i, s in enumerate(share) if s]
            at = {"first": held[0], "last": held[-1], "most": share.index(max(share))}[rule]
            counts[at] += 1
        mine = [r for r in rows if r.doc_id == k]
        assert [r.n_tokens for r in mine] == counts, text[:40]
        assert [r.n_chars for r in mine] == [len(p) for p in parts]
    assert token_counts.attribute_tokens(empty(spark), file).count() == 0


def test_attribution_to_given_sections(spark):
    docs = spark.createDataFrame([(1, "title body text", [5, 10]), (2, "abc", None), (3, None, [1])], "doc_id long, text string, ends array<int>")
    rows = token_counts.attribute_tokens(docs, tokenizer_file("byte_bpe_50k.json"), "first", "ends").orderBy("doc_id", "section").collect()
    assert [(r.doc_id, r.section, r.start, r.n_chars, r.n_tokens) for r in rows][:3] == [(1, 0, 0, 5, 1), (1, 1, 5, 5, 1), (1, 2, 10, 5, 1)]
    assert [(r.doc_id, r.n_chars) for r in rows[3:]] == [(2, 3), (3, 0)]
    with pytest.raises(ValueError):
        token_counts.attribute_tokens(docs, "x", "other")


def test_reduction_and_best_fit_pack_all_and_stay_near_the_bound():
    rng = random.Random(5)
    for trial in range(60):
        capacity = rng.choice([10, 50, 1024])
        counts = {rng.randint(1, capacity): rng.randint(1, 40) for _ in range(rng.randint(0, 60))}
        plan = packing.plan(counts, capacity)
        back: dict[int, int] = {}
        for pattern, n in plan:
            assert 0 < sum(pattern) <= capacity and n > 0
            for s in pattern:
                back[s] = back.get(s, 0) + n
        assert back == counts
        sequences, total = sum(n for _, n in plan), sum(s * n for s, n in counts.items())
        large = sum(n for s, n in counts.items() if 2 * s > capacity)
        assert max(-(-total // capacity), large) <= sequences <= max(1.23 * total / capacity, large) + 2


def test_reduction_is_optimal_on_small_cases():
    def least(items, bins, capacity, best):
        if len(bins) >= best:
            return best
        if not items:
            return len(bins)
        for k in range(len(bins)):
            if bins[k] + items[0] <= capacity and bins[k] not in bins[:k]:
                best = least(items[1:], bins[:k] + [bins[k] + items[0]] + bins[k + 1 :], capacity, best)
        return least(items[1:], bins + [items[0]], capacity, best)

    from collections import Counter

    rng = random.Random(9)
    for _ in range(120):
        items = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 8))), reverse=True)
        counts = Counter(items)
        fixed = packing.reduce_by_dominance(counts, 20)
        rest = sorted(counts.elements(), reverse=True)
        assert sum(n for _, n in fixed) + least(rest, [], 20, 99) == least(items, [], 20, 99), items


def test_pack_has_no_gaps(spark):
    file = tokenizer_file("byte_bpe_50k.json")
    rows = packing.pack(awkward(spark), file, 2, 64).collect()
    tokenizer = encoder(file).rules.tokenizer
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    ids = tokenizer.encode(AWKWARD[8][1], add_special_tokens=False).ids + [2]
    mine = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == 8)
    assert [m[2] for m in mine] == [len(ids) % 64 or 64] + [64] * ((len(ids) - 1) // 64)
    for _, start, length, crc in mine:
        assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
    assert sum(r.doc_id == 2 and r.piece == 0 for r in rows) == 2  # both rows
    assert packing.pack(empty(spark), file).count() == 0


def test_ids_do_not_depend_on_how_many_pieces_a_call_encodes(monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choice(" abcé1,") for _ in range(40)) for _ in range(200)]
    for name in FILES:
        want = encoder(tokenizer_file(name)).encode(texts)
        fresh, calls = Encoder(tokenizer_file(name)), []
        monkeypatch.setattr("tidemark.llm.encode.PIECES", 7)
        monkeypatch.setattr(fresh.rules, "encode_many", lambda pieces, many=fresh.rules.encode_many: calls.append(len(pieces)) or many(pieces))
        got = fresh.encode(texts)
        assert max(calls) <= 7 < sum(calls) and all((a == b).all() for a, b in zip(got, want))
        monkeypatch.undo()
