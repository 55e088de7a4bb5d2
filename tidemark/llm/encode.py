"""Token ids of whole texts from a tokenizers file, encoding each distinct piece once per worker.

Both vocabularies in use cut a text into pre-tokens before merging, and no pre-token crosses the
cut points used here, so the ids of a text are the ids of its chunks one after the other. Chunks
are looked up in a bounded dictionary that lives as long as the Python worker; only unknown ones
are encoded, by the library itself and in one call for many. Chunks with characters outside
ASCII and Latin-1 letters are handed to the library as they are.
"""

from __future__ import annotations

import gc
import json
import os
import re
from itertools import chain

import numpy as np

from .common import kept_in_worker

#: Chunks kept per worker before the dictionary starts anew; bounds a worker's memory.
MAX_CHUNKS = 900_000
MAX_CHARS = 30_000_000
#: Pre-tokens that the library encodes in one call; it needs far more memory for them than their ids do.
PIECES = 20_000
#: Characters beyond which one text is encoded in parts.
LONG = 1_000_000

LETTER = "a-zA-ZÀ-ÖØ-öø-ÿ"
SAFE = "!-~À-ÖØ-öø-ÿ"
_SPECIAL = "<|"


class _Rules:
    """How to cut texts and how to find the ends of many joined pre-tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.words = spec["model"].get("end_of_word_suffix") == "</w>"
        self.cut = re.compile(rf"(?<=[{SAFE}])(?=[ \n][{SAFE}])")
        self.controls = re.compile(r"[\x00\x1c-\x1f]")
        self.plain = re.compile(rf"[{SAFE} \n]+\Z")
        short = "'s|'t|'re|'ve|'m|'ll|'d"
        low = "a-zß-öø-ÿ"
        if self.words:
            self.safe = re.compile(rf"[{SAFE}]+\Z")
            self.pre = re.compile(rf"{short}|[{low}]+|[0-9]|[^{low}0-9]+")
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        else:
            self.safe = re.compile(rf"[ \n]?[{SAFE}]+\Z")
            self.pre = re.compile(rf"{short}| ?[{LETTER}]+| ?[0-9]+| ?[^ \n{LETTER}0-9]+|\n")
            self.newline = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
            self.lengths = np.zeros(self.tokenizer.get_vocab_size() + 1, np.int32)
            for t, i in vocab.items():
                self.lengths[i] = len(t)  # one character stands for one byte

    def parts(self, text: str):
        begin = 0
        while len(text) - begin > LONG and (m := self.cut.search(text, begin + LONG)):
            yield text[begin : m.start()]
            begin = m.start()
        yield text[begin:]

    def keys(self, text: str) -> list[str]:
        """The chunks of a text in order; without word ends, a chunk's first space is left out.

        A first chunk without a space before it, and any chunk that is not a plain word, starts
        with NUL so that it can't be taken for a word after a space.
        """
        if self.words:
            return ["\0" + text] if self.controls.search(text) else text.split()
        gaps = "  " in text or "\n\n" in text or " \n" in text or "\n " in text
        if not gaps and text[0] not in " \n" and text[-1] not in " \n" and self.plain.match(text):
            keys = text.replace("\n", " \n").split(" ")
            keys[0] = "\0" + keys[0]
            return keys
        return [c[1:] if c[:1] == " " and self.safe.match(c) else c if c[:1] == "\n" and self.safe.match(c) else "\0" + c
                for c in self.cut.split(text)]

    def chunk(self, key: str) -> str:
        if key[:1] == "\0":
            return key[1:]
        return key if self.words or key[:1] == "\n" else " " + key

    def encode_many(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for safe pre-tokens, joined so that the library is called once."""
        joined = (" " if self.words else "\n").join(pieces)
        got = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids
        ids = np.array(got, np.uint16)
        if self.words:
            lengths = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        else:
            breaks = ids == self.newline
            lengths = np.diff(np.flatnonzero(breaks), prepend=-1, append=len(ids)) - 1
            ids = ids[~breaks]
        if len(lengths) != len(pieces):  # a file with other rules: encode them one by one
            each = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            lengths = np.fromiter(map(len, each), np.int64, len(each))
            ids = np.fromiter(chain.from_iterable(each), np.uint16, int(lengths.sum()))
        return ids, lengths


class _Store:
    """Growing list of id lists in flat arrays, found by string."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.flat = np.zeros(1 << 20, np.uint16)
        self.start, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.used = 0

    def add(self, keys: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        n, m = len(self.index), len(keys)
        while n + m > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.length[n : n + m] = lengths
        self.start[n : n + m] = self.used + np.cumsum(lengths) - lengths
        self.used += len(ids)
        self.index.update(zip(keys, range(n, n + m)))

    def gather(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all strings of all lists in order; how many ids each list has."""
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum()))
        n = self.length[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        where = np.repeat(self.start[at] - ends[:-1], n)
        where += np.arange(ends[-1])
        return self.flat[where], np.diff(ends[np.concatenate([[0], np.cumsum(sizes)])])


class Encoder:
    """Encodes batches of texts; get one per worker and file with ``encoder``."""

    def __init__(self, path: str):
        self.rules = _Rules(path)
        self.clear()

    def clear(self) -> None:
        self.chunks, self.parts, self.chars = _Store(), _Store(), 0

    def _learn(self, keys: list[str]) -> None:
        rules, store = self.rules, self.parts
        plain, pres, odd = [], [], []
        for key in keys:
            c = rules.chunk(key)
            if rules.safe.match(c) and _SPECIAL not in c:
                plain.append(key)
                pres.append(rules.pre.findall(c.lower() if rules.words else c))
            else:
                odd.append(key)
        want = set(chain.from_iterable(pres)).difference(store.index)
        if "\n" in want and not rules.words:
            want.remove("\n")
            store.add(["\n"], np.array([rules.newline], np.uint16), np.array([1]))
        if want:
            want = list(want)
            for i in range(0, len(want), PIECES):
                store.add(want[i : i + PIECES], *rules.encode_many(want[i : i + PIECES]))
        self.chunks.add(plain, *store.gather(pres))
        if odd:
            got = [e.ids for e in rules.tokenizer.encode_batch_fast([rules.chunk(k) for k in odd], add_special_tokens=False)]
            lengths = np.fromiter(map(len, got), np.int64, len(got))
            self.chunks.add(odd, np.fromiter(chain.from_iterable(got), np.uint16, int(lengths.sum())), lengths)
        self.chars += sum(map(len, keys))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other (uint16), and how many each text has.

        A very long text is taken in parts that end where no pre-token can cross.
        """
        if not any(t and len(t) > LONG for t in texts):
            return self._encode(texts)
        found = [[self._encode([p])[0] for p in self.rules.parts(t or "")] for t in texts]
        ids = np.concatenate([np.zeros(0, np.uint16), *chain.from_iterable(found)])
        return ids, np.array([sum(map(len, x)) for x in found], np.int64)

    def _encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.chunks.index) > MAX_CHUNKS or self.chars > MAX_CHARS:
            self.clear()
        lists = [self.rules.keys(t) if t else [] for t in texts]
        new = set(chain.from_iterable(lists)).difference(self.chunks.index)
        if new:
            collecting = gc.isenabled()
            gc.disable()  # many short lists live at once and none of them in a cycle
            try:
                self._learn(list(new))
            finally:
                if collecting:
                    gc.enable()
        return self.chunks.gather(lists)


def encoder(path: str) -> Encoder:
    """The worker's encoder of this file. Vocabularies must have fewer than 65,536 ids."""
    encoders = kept_in_worker("encoders")
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]


def text_slices(column, chars: int = 1_500_000):
    """A string column of a record batch as lists of about so many characters: begin, end, texts.

    Only one list lives at a time, so memory is bounded by this size or the longest text.
    """
    import pyarrow.compute as pc

    begin = size = 0
    for k, n in enumerate(pc.utf8_length(column).fill_null(0).to_pylist()):
        if size and size + n > chars:
            yield begin, k, column.slice(begin, k - begin).to_pylist()
            begin, size = k, 0
        size += n
    if begin < len(column):
        yield begin, len(column), column.slice(begin).to_pylist()
