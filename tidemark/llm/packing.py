"""Best-fit packing of documents into sequences after Martello-Toth dominance reduction.

Everything that decides runs on the histogram of lengths, which has at most ``capacity`` rows
whatever the corpus: the reduction fixes sets of up to three documents that dominate every other
set with their longest member, best-fit-decreasing packs what is left, and both work on many
equal sets at once. The result is a short list of patterns with counts. Documents are then
numbered within their length (hot lengths are split) and look up their place in the patterns.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, ranked, written
from .encode import encoder, text_slices

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, _salt long"


def encoded_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Encode whole texts, add the end id, and cut what is longer than ``capacity``.

    All pieces of a cut document but the first have exactly ``capacity`` tokens. ``_salt`` differs
    for all rows and spreads them.
    """
    rows = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def cut(batches):
        from pyspark import TaskContext

        coder, serial = encoder(tokenizer), TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for a, b, texts in text_slices(batch.column(1), 500_000):
                got, lengths = coder.encode(texts)
                ends = np.cumsum(lengths + 1)
                raw = memoryview(np.insert(got.astype("<u4"), np.cumsum(lengths), end_id).tobytes())
                out = []
                for doc, end, n in zip(ids[a:b], ends.tolist(), (lengths + 1).tolist()):
                    begin, at, piece = end - n, 0, 0
                    size = n % capacity or capacity
                    while at < n:
                        low = 4 * (begin + at)
                        out.append((doc, piece, at, size, zlib.crc32(raw[low : low + 4 * size]), serial))
                        at, piece, size, serial = at + size, piece + 1, capacity, serial + 1
                cols = list(zip(*out))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32", "_salt"])

    return rows.mapInArrow(cut, PIECES)


def reduce_by_dominance(counts: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fix sets that dominate all others with their longest member; ``counts`` keeps the rest.

    For the longest length j and the room r beside it:
    an i with i = r makes {j, i} dominate, since any other company fits into i's place;
    if no two of the shortest fit into r, the longest i that fits does (or j stays alone);
    if two but not three fit, {j, i, b} with the longest i and then the longest b does, when no
    other pair has a longer second member, and {j, i} does when no pair is longer than i.
    """
    fixed = []

    def take(*members: int) -> int:
        need = Counter(members)
        k = min(counts[s] // c for s, c in need.items())
        if k:
            for s, c in need.items():
                counts[s] -= c * k
                if not counts[s]:
                    del counts[s]
            fixed.append((tuple(sorted(members, reverse=True)), k))
        return k

    for j in sorted(counts, reverse=True):
        while counts[j]:
            room = capacity - j
            if room and counts[room] and take(j, room):
                continue
            counts[j] -= 1  # look at the others
            sizes = sorted(s for s in counts if counts[s] and s <= room)
            small = []
            for s in sizes[:3]:
                small += [s] * min(3, counts[s])
            top = sizes[-1] if sizes else 0

            def second(limit: int, beside: int) -> int:
                """The longest that fits, with ``beside`` already taken."""
                k = bisect.bisect_right(sizes, limit)
                while k and sizes[k - 1] == beside and counts[beside] < 2:
                    k -= 1
                return sizes[k - 1] if k else 0

            best: tuple[int, ...] | None = None
            if not small:
                best = (j,)
            elif len(small) < 2 or small[0] + small[1] > room:
                best = (j, top)
            elif len(small) < 3 or sum(small[:3]) > room:
                pairs = [(a, b) for a in sizes if (b := second(room - a, a))]
                if max(a + b for a, b in pairs) <= top:
                    best = (j, top)
                elif (b := second(room - top, top)) and max(min(p) for p in pairs) <= b:
                    best = (j, top, b)
            counts[j] += 1
            if best is None or not take(*best):
                break
    return fixed


def best_fit(counts: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, for equal sequences and documents together."""
    open_: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]
    for s in sorted(counts, reverse=True):
        left = counts[s]
        room = s
        while left:
            while room < capacity and not open_[room]:
                room += 1
            if room >= capacity:
                each = capacity // s
                whole, rest = divmod(left, each)
                if whole:
                    open_[capacity - each * s].append(((s,) * each, whole))
                if rest:
                    open_[capacity - rest * s].append(((s,) * rest, 1))
                break
            pattern, n = open_[room].pop()
            each = room // s
            whole, rest = min(n, left // each), 0
            if whole:
                open_[room - each * s].append((pattern + (s,) * each, whole))
                left -= whole * each
            if whole < n and left:
                rest, left = left, 0
                open_[room - rest * s].append((pattern + (s,) * rest, 1))
            if n > whole + bool(rest):
                open_[room].append((pattern, n - whole - bool(rest)))
    return [x for group in open_ for x in group]


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths, and how many sequences have each."""
    rest = Counter(counts)
    fixed = reduce_by_dominance(rest, capacity)
    total: Counter = Counter()
    for pattern, n in fixed + best_fit(+rest, capacity):
        total[pattern] += n
    return list(total.items())


def _runs(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """length, first and end rank, members in a sequence, first sequence, first offset."""
    used, out, base = Counter(), [], 0
    for pattern, n in patterns:
        offset = 0
        for s, each in sorted(Counter(pattern).items(), reverse=True):
            out.append((s, used[s], used[s] + n * each, each, base, offset))
            used[s] += n * each
            offset += s * each
        base += n
    return out


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """A row for each piece of each document with its sequence and its place there.

    Null texts count as empty and give the end id alone; repeated rows are packed as often; an
    empty table gives no row.
    """
    spark = docs.sparkSession
    pieces = written(encoded_pieces(docs, tokenizer, end_id, capacity), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most capacity rows
    runs = spark.createDataFrame(_runs(plan(counts, capacity)), "_len long, _low long, _high long, _each long, _base long, _off long")
    at = F.col("_rank") - F.col("_low")
    return (
        ranked(pieces.withColumn("_key", F.xxhash64("_salt")), ["length"], "_key", ["_salt"])
        .join(F.broadcast(runs), (F.col("length") == F.col("_len")) & (F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high")))
        .select("doc_id", "piece", "start", "length", "ids_crc32",
                (F.col("_base") + F.floor(at / F.col("_each"))).cast("long").alias("sequence_id"),
                (F.col("_off") + F.col("length") * F.pmod(at, F.col("_each"))).cast("long").alias("offset")))
