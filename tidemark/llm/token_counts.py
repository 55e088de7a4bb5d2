"""Token counts of document sections by offset-mapped attribution.

Each document is encoded once and whole. The spans of its tokens, in code points, are joined to
the spans of its sections; a token that crosses a border goes by an explicit rule:

* ``first``: to the section of its first character,
* ``last``: to the section of its last character,
* ``most``: to the section with most of its characters, the earlier one in a tie.

So the counts of all sections add up to the count of the whole document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of
from .encode import encoder, text_slices

SECTIONS = "doc_id long, section int, start long, n_chars long, n_tokens long, n_crossing long"


def join_spans(starts: np.ndarray, ends: np.ndarray, borders: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The section of each token, and the number of tokens that cross a border in each section.

    ``borders``: ascending ends of sections that lie side by side. Empty tokens don't occur.
    """
    first = np.searchsorted(borders, starts, "right")
    last = np.searchsorted(borders, ends - 1, "right")
    at = last.copy() if rule == "last" else first.copy()
    crossing = np.flatnonzero(first != last)
    if rule == "most":
        for k in crossing.tolist():
            inner = np.arange(first[k], last[k] + 1)
            low = np.concatenate([[starts[k]], borders[inner[:-1]]])
            at[k] = inner[np.argmax(np.minimum(borders[inner], ends[k]) - low)]
    return at, np.bincount(at[crossing], minlength=len(borders))


def attribute_tokens(docs: DataFrame, tokenizer: str, rule: str = "most", ends: str | None = None) -> DataFrame:
    """A row for each section of each document with the number of tokens attributed to it.

    ``tokenizer`` must be a byte-level file: its tokens' bytes are those of the text. ``ends``
    names an array column with the ascending ends of sections in code points; the rest after the
    last end is one more section. Without it, sections are lines with their line feeds.
    Null texts count as empty; an empty text has one empty section. Repeated rows repeat.
    """
    if rule not in ("first", "last", "most"):
        raise ValueError(f"rule {rule!r} is none of first, last, most")
    given = columns_of(docs, "doc_id", "text", *([ends] if ends else []))
    rows = given.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *([F.col(ends).cast("array<long>")] if ends else []))

    def count(batches):
        coder = encoder(tokenizer)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            cuts = batch.column(2).to_pylist() if ends else None
            for a, b, texts in text_slices(batch.column(1)):
                yield one(coder, ids[a:b], texts, cuts[a:b] if cuts else None)

    def one(coder, ids, texts, cuts):
        raw = [(t or "").encode() for t in texts]
        buf = np.frombuffer(b"".join(raw), np.uint8)
        before = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])  # characters begun before each byte
        tokens, _ = coder.encode(texts)
        stops = np.cumsum(coder.rules.lengths[tokens], dtype=np.int64)
        if len(buf) != (stops[-1] if len(stops) else 0):
            raise ValueError("the tokens' bytes aren't those of the text: not a byte-level vocabulary")
        firsts = np.concatenate([[0], stops[:-1]]).astype(np.int64)[: len(stops)]
        doc_stop = np.cumsum([len(x) for x in raw])  # in bytes
        doc_end = before[doc_stop]
        doc_begin = np.concatenate([[0], doc_end[:-1]])
        if cuts is None:
            lines = np.flatnonzero(buf == 10) + 1
            owner = np.searchsorted(doc_stop, lines - 1, "right")
            inside = lines < doc_stop[owner]
            marks, owner = before[lines[inside]], owner[inside]
        else:
            size = doc_end - doc_begin
            pairs = [(doc_begin[k] + e, k) for k, x in enumerate(cuts) for e in sorted({e for e in x or [] if e is not None}) if 0 < e < size[k]]
            marks = np.array([p[0] for p in pairs], np.int64)
            owner = np.array([p[1] for p in pairs], np.int64)
        borders = np.concatenate([marks, doc_end])
        owner = np.concatenate([owner, np.arange(len(texts))])
        order = np.lexsort((borders, owner))
        borders, owner = borders[order], owner[order]
        at, crossing = join_spans(before[firsts + 1] - 1, before[stops], borders, rule)
        starts = np.concatenate([[0], borders[:-1]])
        begin = np.searchsorted(owner, np.arange(len(texts)))
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()).take(pa.array(owner)),
            pa.array((np.arange(len(owner)) - begin[owner]).astype(np.int32)),
            pa.array(starts - doc_begin[owner]), pa.array(borders - starts),
            pa.array(np.bincount(at, minlength=len(borders)).astype(np.int64)),
            pa.array(crossing.astype(np.int64))],
            names=["doc_id", "section", "start", "n_chars", "n_tokens", "n_crossing"])

    return rows.mapInArrow(count, SECTIONS)
