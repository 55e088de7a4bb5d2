"""Language identification with interpolated Kneser-Ney character models.

For each language, counts of character 4-grams over all its training texts give an interpolated
Kneser-Ney model; lower orders count continuations. Texts are folded first: letters in lower case,
every run of other characters one space, so digits, symbols and markup say nothing.

A gram is packed into 64 bits, 16 for each character, and multiplied by an odd number, which loses
nothing and spreads the keys. Spark computes all counts and probabilities and writes them as sorted
arrays of these hashes, with a log probability for each language that has the gram, to files of
bounded size in the shared folder; no gram is left out. Tasks map the files they look into, so the
driver holds only their names. A text gets the language with the lowest cross-entropy per character.
Rejection and confidence are calibrated on all training texts; the driver gets sums by language.
"""

from __future__ import annotations

import unicodedata
import uuid
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_position, columns_of, kept_in_worker, numbered, shared_folder, written
from .encode import text_slices
from .id_planes import _open

ORDER = 4
START, SPACE = 1, 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LIMIT = 0x30000  # characters beyond count as no letters
#: Grams that a task holds while it counts.
HELD = 2_000_000
#: How sharp confidence can be.
SHARP = (0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 1.0)
#: Entries of one file of the models, about; 20 bytes each.
FILE = 2_000_000
UNKNOWN = "und"

_FOLD: list[np.ndarray] = []


def _fold_table() -> np.ndarray:
    if not _FOLD:
        table = np.full(0x110000, SPACE, np.uint16)
        for c in range(_LIMIT):
            ch = chr(c)
            if unicodedata.category(ch)[0] in "LM":
                low = ord(ch.lower()[0]) & 0xFFFF
                table[c] = low if low not in (0, START, SPACE) else 2
        _FOLD.append(table)
    return _FOLD[0]


def grams_of(texts: list[str], lead: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The 4-grams ending at each folded character of all texts, and how many each text has.

    Three start signs stand before each text, so that a text's grams don't depend on others; or
    its row of ``lead``, the folded characters before a text that goes on.
    """
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 3
    raw = ("\0\0\0" + "\0\0\0".join(texts)).encode("utf-32-le", "surrogatepass") if texts else b""
    x = _fold_table()[np.frombuffer(raw, np.uint32)]
    ends = np.cumsum(lengths)
    begin = ends - lengths
    head = np.zeros(len(x), bool)
    for k in range(3):
        x[begin + k] = START if lead is None else lead[:, k]
        head[begin + k] = True
    double = np.zeros(len(x), bool)
    double[1:] = (x[1:] == SPACE) & ((x[:-1] == SPACE) | (x[:-1] == START)) & ~head[1:]
    kept = np.concatenate([[0], np.cumsum(~double)])
    x = x[~double].astype(np.uint64)
    g = x.copy()
    for k in range(1, ORDER):
        g[k:] |= x[:-k] << np.uint64(16 * k)
    real = ~head[~double]
    counts = np.diff(kept[np.concatenate([[0], ends])]) - 3
    return g[real], counts


def _batches(texts: list, chars: int = 1_000_000):
    begin = size = 0
    for k, t in enumerate(texts):
        if size and size + len(t or "") > chars:
            yield begin, k
            begin, size = k, 0
        size += len(t or "")
    if begin < len(texts):
        yield begin, len(texts)


def _parts(texts: list[str], chars: int = 1_000_000) -> tuple[np.ndarray, list[str]]:
    """Texts in parts of at most so many characters, and which text each part is of."""
    pairs = [(k, t[i : i + chars]) for k, t in enumerate(texts) for i in range(0, max(1, len(t)), chars)]
    return np.array([k for k, _ in pairs], np.int64), [p for _, p in pairs]


def _grams(texts: list[str], chars: int = 1_000_000):
    """Some texts' numbers, their grams and how many each has, about ``chars`` characters at a time.

    A longer text comes in several turns, each with the three folded characters before it, so its
    grams are those of the whole text.
    """
    owner, parts = _parts(texts, chars)
    carry = None
    for a, b in _batches(parts, chars):
        lead = np.full((b - a, 3), START, np.uint16)
        if a and owner[a] == owner[a - 1]:  # only the first part of a turn can go on
            lead[0] = carry
        grams, counts = grams_of(parts[a:b], lead)
        last = int(grams[-1]) if counts[-1] else None
        carry = lead[-1] if last is None else [last >> 32 & 0xFFFF, last >> 16 & 0xFFFF, last & 0xFFFF]
        yield owner[a:b], grams, counts


def count_grams(train: DataFrame) -> DataFrame:
    """lang, gram, n over all texts of text, lang; each task adds up before the shuffle.

    A task holds about ``HELD`` grams of all languages at a time.
    """

    def count(batches):
        kept_in_worker("grams")
        held: dict[str, list[np.ndarray]] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for a, _, texts in text_slices(batch.column(0)):
                for owner, grams, counts in _grams(texts):
                    names = [langs[a + k] for k in owner.tolist()]
                    kinds = {lang: k for k, lang in enumerate(dict.fromkeys(names))}
                    which = np.repeat(np.array([kinds[x] for x in names]), counts)
                    for lang, k in kinds.items():
                        g, n = np.unique(grams[which == k], return_counts=True)
                        if lang in held:
                            old = held[lang]
                            g, at = np.unique(np.concatenate([old[0], g]), return_inverse=True)
                            n = np.bincount(at, np.concatenate([old[1], n])).astype(np.int64)
                        held[lang] = [g, n]
                    if sum(len(g) for g, _ in held.values()) > HELD:
                        yield from taken(held)
        yield from taken(held)

    def taken(held):
        while held:
            lang, (g, n) = held.popitem()
            for i in range(0, len(g), 100_000):
                yield rows(lang, g[i : i + 100_000], n[i : i + 100_000])

    def rows(lang, g, n):
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    pieces = train.select("text", "lang").mapInArrow(count, "lang string, gram long, n long")
    return pieces.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class _Array:
    """One file's sorted hashes; from begin[k] on, the languages of hash k and their values.

    Looking up starts where ``first`` says that the hash's top bits begin, those left out that all
    hashes of the file share.
    """

    def __init__(self, path: str, common: int):
        data = _mapped(path)
        n, m, bits, self.longest = np.frombuffer(data, np.int64, 4).tolist()
        at, parts = 32, []
        for kind, size in ((np.uint64, n), (np.int64, n + 1), (np.int32, (1 << bits) + 1), (np.int32, m), (np.float32, m)):
            parts.append(np.frombuffer(data, kind, size, at))
            at += parts[-1].nbytes
        self.hashes, self.begin, self.first, self.lang, self.values = parts
        self.common, self.shift = np.uint64(common), np.uint64(64 - bits)

    @staticmethod
    def write(stream, hashes: np.ndarray, lang: np.ndarray, values: np.ndarray, common: int) -> None:
        order = np.lexsort((lang, hashes))
        kinds, begin = np.unique(hashes[order], return_index=True)
        bits = max(8, min(22, len(kinds).bit_length() + 1))
        tops = np.bincount(((kinds << np.uint64(common)) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        stream.write(np.array([len(kinds), len(order), bits, tops.max()], np.int64).tobytes())
        for part in (kinds, np.append(begin, len(order)).astype(np.int64), np.append(0, np.cumsum(tops)).astype(np.int32),
                     lang[order].astype(np.int32), values[order].astype(np.float32)):
            stream.write(part.tobytes())

    def entries(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the hashes that are there, once for each language, with language and value."""
        last = len(self.hashes) - 1
        at = np.minimum(self.first[((h << self.common) >> self.shift).astype(np.int64)], last)
        hit = self.hashes[at] == h
        todo = np.flatnonzero(~hit)
        for _ in range(1, self.longest):
            if not len(todo):
                break
            at[todo] = np.minimum(at[todo] + 1, last)
            found = self.hashes[at[todo]] == h[todo]
            hit[todo[found]] = True
            todo = todo[~found & (self.hashes[at[todo]] < h[todo])]
        rows = np.flatnonzero(hit)
        begin = self.begin[at[rows]]
        counts = self.begin[at[rows] + 1] - begin
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        places = np.repeat(begin, counts) + inside
        return np.repeat(rows, counts), self.lang[places], self.values[places]


def _mapped(path: str) -> pa.Buffer:
    """A file's bytes: mapped, so that all workers of a machine share them, or read from a remote store."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    if path.startswith("file:/") and not path.startswith("file://"):
        path = f"file://{path[5:]}"
    fs, inner = FileSystem.from_uri(path)
    with pa.memory_map(inner) if isinstance(fs, LocalFileSystem) else fs.open_input_file(inner) as stream:
        return stream.read_buffer()


@dataclass
class _Level:
    """The files of one order's grams; a file has the hashes that start with ``bits`` given bits."""

    bits: int
    files: dict[int, str]
    size: int

    def entries(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the grams that are there, once for each language, with language and value."""
        h = grams * _ODD
        which = (h >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(h), np.int64)
        order = np.argsort(which, kind="stable")
        ends = np.cumsum(np.bincount(which, minlength=1 << self.bits))
        rows, lang, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.float32)]
        for k, path in self.files.items():
            mine = order[(ends[k - 1] if k else 0) : ends[k]]
            if len(mine):
                arrays = kept_in_worker(path.rpartition("/")[0])  # one folder for all files of the models
                if path not in arrays:
                    arrays[path] = _Array(path, self.bits)
                r, own, v = arrays[path].entries(h[mine])
                rows.append(mine[r])
                lang.append(own)
                values.append(v)
        return np.concatenate(rows), np.concatenate(lang), np.concatenate(values)


def _stored(tables: list[DataFrame]) -> list[_Level]:
    """Writes gram, lang, value of each table to files of about ``FILE`` entries, dealt by their hashes' first bits."""
    import pandas as pd

    entries = reduce(DataFrame.union, [t.select(F.lit(k).alias("table"), "gram", "lang", "value") for k, t in enumerate(tables)])
    sizes = dict(entries.groupBy("table").count().collect())
    folder, file = shared_folder(entries.sparkSession), FILE
    bits = np.array([(sizes.get(k, 0) // file).bit_length() for k in range(len(tables))])

    def deal(batches):
        for batch in batches:
            table, gram = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            h, own = gram.view(np.uint64) * _ODD, bits[table]
            part = np.where(own > 0, h >> (64 - np.maximum(own, 1)).astype(np.uint64), 0).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(part), pa.array(h.view(np.int64)), *batch.columns[2:]], names=["table", "part", "hash", "lang", "value"])

    def store(key, rows):
        name = f"{folder}/{uuid.uuid4().hex}.grams"  # a task that runs again writes another file
        with _open(name, write=True) as stream:
            _Array.write(stream, rows["hash"].to_numpy().view(np.uint64), rows["lang"].to_numpy(), rows["value"].to_numpy(), int(bits[key[0]]))
        return pd.DataFrame({"table": [key[0]], "part": [key[1]], "file": [name]})

    dealt = entries.mapInArrow(deal, "table int, part int, hash long, lang int, value double")
    files = written(dealt.groupBy("table", "part").applyInPandas(store, "table int, part int, file string"), "files").collect()
    return [_Level(int(bits[k]), {r["part"]: r["file"] for r in files if r["table"] == k}, sizes.get(k, 0)) for k in range(len(tables))]


@dataclass
class Models:
    """All languages' models: levels[n] for n-grams, backoff[n] for their contexts, both in files."""

    langs: list[str]
    levels: dict[int, _Level]
    backoff: dict[int, _Level]
    floor: np.ndarray
    centre: np.ndarray | None = None  # of the cross-entropy of a language's own texts
    between: np.ndarray | None = None  # its variance between texts
    within: np.ndarray | None = None  # and what a character adds
    sharp: float = 1.0

    def log_probabilities(self, grams: np.ndarray, n: int = ORDER) -> np.ndarray:
        if n == 0:
            return np.broadcast_to(self.floor, (len(grams), len(self.langs))).astype(np.float32)
        kinds, where = np.unique(grams & np.uint64((1 << (16 * (n - 1))) - 1), return_inverse=True)
        out = self.log_probabilities(kinds, n - 1)[where]
        rows, lang, values = self.backoff[n].entries(grams >> np.uint64(16))
        out[rows, lang] += values
        rows, lang, values = self.levels[n].entries(grams)
        out[rows, lang] = values
        return out

    def cross_entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Nats per character by text and language, and characters; no character gives 0."""
        sums, total = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        for owner, grams, counts in _grams(texts, min(1_000_000, max(10_000, 8_000_000 // max(1, len(self.langs))))):
            some = np.flatnonzero(counts)
            if len(some):
                starts = (np.cumsum(counts) - counts)[some]
                kinds, where = np.unique(grams, return_inverse=True)
                found = np.add.reduceat(self.log_probabilities(kinds)[where], starts, axis=0, dtype=np.float64)
                np.add.at(sums, owner[some], found)
            np.add.at(total, owner, counts)
        return -sums / np.maximum(total, 1)[:, None], total

    def judge(self, texts: list[str | None], strict: float) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, confidence and rejection of each text."""
        letters = [t is not None and any(map(str.isalpha, t)) for t in texts]
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        entropy, n = self.cross_entropy([t if ok else "" for t, ok in zip(texts, letters)])
        best = entropy.argmin(axis=1)
        gap = -(entropy - entropy.min(axis=1, keepdims=True)) * np.minimum(n, 30)[:, None] * self.sharp
        score = 1 / np.exp(gap).sum(axis=1)
        low = entropy[np.arange(len(texts)), best]
        spread = np.sqrt(self.between[best] + self.within[best] / np.maximum(n, 1))
        odd = (low - self.centre[best]) > strict * spread
        names = [self.langs[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), letters)]
        return names, np.where(letters, score, 0.0), odd | ~np.array(letters, bool)


def _kneser_ney(counts: DataFrame, langs: list[str]) -> Models:
    """Models from lang, gram, n, all in Spark; the driver gets counts of rare grams by language."""
    m = len(langs)
    number = F.create_map(*[F.lit(x) for k, lang in enumerate(langs) for x in (lang, k)])

    def last(n: int) -> Column:
        return F.col("gram").bitwiseAND(F.lit((1 << (16 * n)) - 1))

    tables = {ORDER: counts.select("gram", number[F.col("lang")].alias("lang"), F.col("n").alias("c"))}
    for k in range(ORDER - 1, 0, -1):  # continuation counts: different grams one longer
        tables[k] = written(tables[k + 1].groupBy(last(k).alias("gram"), "lang").agg(F.count("*").alias("c")), f"order{k}")
    alphabet = max(2, tables[1].select("gram").distinct().count() + 1)
    found, below = [], None
    for k in range(1, ORDER + 1):
        discount = [0.5] * m
        for lang, ones, twos in tables[k].groupBy("lang").agg(F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).collect():
            if ones + twos:
                discount[lang] = min(0.9, max(0.1, ones / (ones + 2 * twos)))
        rows = tables[k].withColumns({
            "context": F.shiftrightunsigned("gram", 16), "d": F.array(*map(F.lit, discount))[F.col("lang")], "low": last(k - 1)})
        contexts = written(rows.groupBy("context", "lang").agg(
            F.sum("c").alias("total"), (F.max("d") * F.count("*") / F.sum("c")).alias("weight")), f"contexts{k}")
        rows = rows.join(contexts, ["context", "lang"])
        if below is None:
            rows = rows.withColumn("lower", F.lit(1 / alphabet))
        else:
            rows = rows.join(below.select(F.col("gram").alias("low"), "lang", F.col("p").alias("lower")), ["low", "lang"])
        p = (F.col("c") - F.col("d")) / F.col("total") + F.col("weight") * F.col("lower")
        below = written(rows.select("gram", "lang", p.alias("p")), f"p{k}")
        found.append(below.withColumn("value", F.log("p")))
        found.append(contexts.select(F.col("context").alias("gram"), "lang", F.log("weight").alias("value")))
    stored, orders = _stored(found), range(1, ORDER + 1)
    return Models(langs, dict(zip(orders, stored[::2])), dict(zip(orders, stored[1::2])), np.full(m, -np.log(alphabet)))


def learn(train: DataFrame) -> Models:
    """Models of all languages of text, lang (rows with a null in either are left out).

    All texts and all grams count, and the models keep all grams, in files of the shared folder.
    All texts calibrate them, too, rows that repeat once. No language: models that know none.
    """
    train = columns_of(train, "doc_id", "text", "lang").where("text is not null and lang is not null")
    counts = written(count_grams(train), "grams")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not langs:
        return Models([], {}, {}, np.zeros(0))
    models = _kneser_ney(counts, langs)
    _calibrate(models, train)
    return models


def _calibrate(models: Models, train: DataFrame) -> None:
    """Centre and spread of each language's cross-entropy, and the sharpness of confidence.

    Every text gives one short row where it is read. Medians are the middle rows of one distributed
    sort. Sums are decimals, so that they don't depend on the order of the rows.
    """
    m = len(models.langs)
    hashed = train.where(F.col("lang").isin(models.langs)).withColumn("_h", F.xxhash64("doc_id", "text", "lang"))
    judged = written(scored(hashed, models).dropDuplicates(["_h", "lang", "n"]), "judged")  # rows that repeat are one
    some = judged.where("n > 0")
    counts = np.zeros(m, np.int64)
    for lang, count in some.groupBy("lang").count().collect():
        counts[lang] = count
    length = F.col("n").cast("double")
    values = some.select("lang", F.lit(0).alias("kind"), F.col("own").alias("value"), "_h").union(
        some.select("lang", F.lit(1), length, "_h"))
    begin = 2 * (np.cumsum(counts) - counts)[:, None] + np.outer(counts, [0, 1])  # of each language's values of a kind
    low, high = begin + (counts[:, None] - 1) // 2, begin + counts[:, None] // 2
    places = sorted({*low[counts > 0].ravel().tolist(), *high[counts > 0].ravel().tolist()})
    middle = dict(numbered(values, ["lang", "kind", "value", "_h"]).where(F.col("_position").isin(places)).select("_position", "value").collect())
    medians = [[(middle[i] + middle[j]) / 2 if n else 0.0 for i, j in zip(*ends)] for n, *ends in zip(counts, low.tolist(), high.tolist())]

    def of(kind: int) -> Column:
        return F.array(*[F.lit(x[kind]) for x in medians])[F.col("lang")]

    def total(x: Column) -> Column:
        return F.coalesce(F.sum(x.cast("decimal(28,12)")), F.lit(0))

    square, long = F.pow(F.col("own") - of(0), F.lit(2.0)), length >= of(1)
    sums = judged.groupBy("lang").agg(
        F.count("*"), F.count_if((F.col("n") > 0) & long), total(F.when((F.col("n") > 0) & long, square)),
        total(F.when(F.col("n") > 0, square * length)), *[total(F.col(f"loss{k}")) for k in range(len(SHARP))]).collect()
    models.centre, models.between, models.within = np.full(m, np.log(1e3)), np.ones(m), np.ones(m)
    for k, _, longer, spread, weighted, *_ in sums:
        if counts[k]:
            models.centre[k] = medians[k][0]
            models.between[k] = max(float(spread) / longer, 1e-4)
            models.within[k] = max(float(weighted) / int(counts[k]), 0.5)
    rows = sum(r[1] for r in sums)
    models.sharp = min((float(sum(r[5 + k] for r in sums)) / rows, sharp) for k, sharp in enumerate(SHARP))[1]


def scored(docs: DataFrame, models: Models) -> DataFrame:
    """_h, number of lang, n, the cross-entropy of the text's own language and its log loss at each sharpness."""
    shared = docs.sparkSession.sparkContext.broadcast(models)
    names = ["_h", "lang", "n", "own", *[f"loss{k}" for k in range(len(SHARP))]]

    def run(batches):
        number = {lang: k for k, lang in enumerate(shared.value.langs)}
        for batch in batches:
            truth = np.array([number[lang] for lang in batch.column(1).to_pylist()], np.int32)
            for a, b, texts in text_slices(batch.column(2)):
                entropy, n = shared.value.cross_entropy(texts)
                rows, mine = np.arange(b - a), truth[a:b]
                gap = -(entropy - entropy.min(axis=1, keepdims=True)) * np.minimum(n, 30)[:, None]
                losses = [np.log(np.exp(gap * sharp).sum(axis=1)) - gap[rows, mine] * sharp for sharp in SHARP]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], *map(pa.array, (mine, n, entropy[rows, mine], *losses))], names=names)

    return docs.select("_h", "lang", "text").mapInArrow(
        run, "_h long, lang int, n long, own double, " + ", ".join(f"{x} double" for x in names[4:]))


def identify(docs: DataFrame, models: Models, keep: list[str], strict: float = 8.0) -> DataFrame:
    """The ``keep`` columns of all rows with lang_pred, score and rejected.

    A text is rejected if it has no letter or its cross-entropy lies more than ``strict``
    deviations above that of its language's own texts. A null text or one without letters gets
    "und" and score 0. Only the text decides; repeated rows repeat; an empty table gives no row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)
    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))

    def run(batches):
        for batch in batches:
            for a, b, texts in text_slices(batch.column(batch.num_columns - 1)):
                names, score, odd = shared.value.judge(texts, strict)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(odd)],
                    names=[*keep, "lang_pred", "score", "rejected"])

    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

    schema = StructType(rows.schema.fields[:-1]).add("lang_pred", StringType()).add("score", DoubleType()).add("rejected", BooleanType())
    return rows.mapInArrow(run, schema)


def accept(docs: DataFrame, models: Models, strict: float = 8.0) -> DataFrame:
    """The rows that ``identify`` would not reject, with the columns and types they have.

    Null texts and those without letters go; rows that repeat are judged each; a text of any length
    is judged whole. Columns stay, whatever their names; an empty table gives no row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)
    plain, _ = by_position(docs, "text")
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for a, b, texts in text_slices(batch.column(at)):
                odd = shared.value.judge(texts, strict)[2]
                yield batch.slice(a, b - a).filter(pa.array(~odd))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
