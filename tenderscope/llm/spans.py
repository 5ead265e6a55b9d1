"""Substring dedup by sliding sentence spans.

A text is cut into sentences: after a word that ends in ``.``, ``!`` or ``?`` and
at line ends.  Only inside a sentence of more than ``LONG`` words are there
further cuts, after words whose hash is the least among ``NEAR`` words to both
sides; these depend on a few words alone, so a copied passage is cut alike
wherever it stands.  From every piece the run of pieces is hashed that holds at
least ``RUN`` pieces and ``WORDS`` words, so every longer run is covered too; a
text with less is one run by itself.  Runs are compared by their words, not by
their white space.

All runs of all documents meet by hash.  The first run (smallest id, then
place) of each hash stays; the pieces of every other one go.  Repeated hashes
are found by a count with map-side combining, and the joins back to the runs
are ones that Spark can split, so a line that a third of the documents share
makes no hot task.
"""

from __future__ import annotations

from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lead as columns
from .common import saved

RUN, WORDS, LONG, NEAR = 2, 12, 20, 3
#: white space and line ends by code point; the last entry stands for all code points beyond
_SPACE = np.array([chr(c).isspace() for c in range(0x3001)] + [False])
_LINE = np.array([len(f"a{chr(c)}b".splitlines()) > 1 for c in range(0x3001)] + [False])
#: hash of a word: sum of code points times powers of BASE, mixed; hash of a run: the same over its words' hashes
BASE, STEP = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_POWERS = np.array([pow(BASE, k, 1 << 64) for k in range(4096)], dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Pieces(NamedTuple):
    """first: number of each piece's first word, then the number of words;
    start: character at which each piece begins, then the length of the text;
    hashes: of the words."""
    first: np.ndarray
    start: np.ndarray
    hashes: np.ndarray


def pieces(text: str) -> Pieces:
    """The pieces of a text; white space goes with the piece before it.  A text
    without words is one piece without words, an empty one has none."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    at = np.minimum(code, len(_SPACE) - 1)
    word = ~_SPACE[at]
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    start, stop = edge[::2], edge[1::2]
    n = len(start)
    if not n:
        return Pieces(np.zeros(2 if len(code) else 1, np.int64), np.array([0, len(code)] if len(code) else [0]), np.zeros(0, np.uint64))
    begin = np.repeat(np.append(0, start), np.diff(start, prepend=0, append=len(code)))  # of the word at or before each character
    place = np.arange(len(code)) - begin
    value = np.where(word, code.astype(np.uint64) * _POWERS[place % len(_POWERS)], np.uint64(0))
    h = _mixed(np.add.reduceat(value, start))
    lines = np.cumsum(_LINE[at])
    ends = np.isin(code[stop - 1], (33, 46, 63))
    ends[:-1] |= lines[start[1:] - 1] > lines[stop[:-1] - 1]
    ends[-1] = True
    sentence = np.cumsum(ends) - ends
    size = np.bincount(sentence)
    if size.max() > LONG:
        least = (size > LONG)[sentence]
        for d in range(1, min(NEAR, n - 1) + 1):
            least[:-d] &= h[:-d] < h[d:]
            least[d:] &= h[d:] <= h[:-d]
        ends |= least
    first = np.concatenate([[0], np.flatnonzero(ends) + 1])
    begin = start[first[:-1]]
    begin[0] = 0
    return Pieces(first, np.append(begin, len(code)), h)


def runs(p: Pieces, run: int = RUN, words: int = WORDS):
    """(hashes, first pieces, numbers of pieces) of all runs."""
    n, total = len(p.first) - 1, int(p.first[-1]) if len(p.first) else 0
    if not total:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    if n < run or total < words:  # the whole text
        stop, first = np.array([n]), np.zeros(1, np.int64)
    else:
        stop = np.maximum(np.searchsorted(p.first, p.first[:-1] + words), np.arange(n) + run)
        first = np.flatnonzero(stop <= n)
        stop = stop[first]
    up, down = _powers(STEP, total), _powers(pow(STEP, -1, 1 << 64), total)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(p.hashes * up, dtype=np.uint64)])
    a, z = p.first[first], p.first[stop]
    value = (sums[z] - sums[a]) * down[a]  # the words' hashes times powers from the run's first word on
    short = np.uint64(n < run or total < words)
    return _mixed(value + (z - a).astype(np.uint64) * np.uint64(2) + short).view(np.int64), first, stop - first


def _spans(batches, run: int, words: int):
    """place: first piece, and number of pieces in the low byte; a run has
    at most ``max(run, words)`` pieces, as each has a word."""
    for b in batches:
        hashes, counts, places = [np.empty(0, np.int64)], [], [np.empty(0, np.int64)]
        for i in range(0, len(b), 256):
            for text in b.column(1).slice(i, 256).to_pylist():
                value, first, size = runs(pieces(text or ""), run, words)
                hashes.append(value)
                counts.append(len(value))
                places.append(first << 8 | size)
        row = np.repeat(np.arange(len(counts)), counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hashes)), b.column(0).take(pa.array(row)), b.column(2).take(pa.array(row)),
                                          pa.array(np.concatenate(places))], ["hash", "doc_id", "h", "place"])


def repeated_spans(docs: DataFrame, run: int = RUN, words: int = WORDS) -> DataFrame:
    """(doc_id, h, a, z, first_doc): sentences a..z-1 of a document repeat a run
    that stands earlier, in ``first_doc``; h: the hash of its text."""
    if max(run, words) > 255:
        raise ValueError("runs hold at most 255 sentences")
    rows = columns(docs, "doc_id", "text").withColumn("h", F.xxhash64("text"))
    spans = saved(rows.mapInArrow(partial(_spans, run=run, words=words), "hash long, doc_id long, h long, place long"), "spans")
    # written, so that the joins deal both their sides anew and Spark can split a hot hash
    often = saved(spans.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"), "repeated-hashes")
    again = saved(spans.join(often, "hash", "left_semi"), "repeated-spans")
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "place")
    first = saved(again.groupBy("hash").agg(F.min(at).alias("first")), "first-spans")
    return again.join(first, "hash").where(~F.col("first").eqNullSafe(at)).select(
        "doc_id", "h", F.shiftright("place", 8).alias("a"), (F.shiftright("place", 8) + F.col("place").bitwiseAND(0xFF)).alias("z"),
        F.col("first.doc_id").alias("first_doc"))


def _clean(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_sentences", pa.int64()), ("n_removed", pa.int64()),
                        ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        ("first_docs", pa.list_(pa.int64()))])
    for b in batches:
        for i in range(0, len(b), 256):
            out = []
            for doc_id, text, cover, first_docs in zip(*(c.slice(i, 256).to_pylist() for c in b.columns)):
                start = pieces(text or "").start
                gone = np.zeros(len(start), dtype=np.int64)
                for s in cover or []:
                    gone[s["a"]] += 1
                    gone[s["z"]] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                edge = start[np.flatnonzero(np.diff(gone, prepend=False, append=False))].tolist()
                spans = [{"start": a, "end": z} for a, z in zip(edge[::2], edge[1::2])]
                keep = [0, *edge, len(text or "")]
                kept = None if text is None else "".join(text[a:z] for a, z in zip(keep[::2], keep[1::2]))
                out.append({"doc_id": doc_id, "text": kept, "n_sentences": len(gone), "n_removed": int(gone.sum()),
                            "removed": spans, "first_docs": sorted(first_docs or [], key=lambda x: (x is None, x))})
            yield pa.RecordBatch.from_pylist(out, schema=schema)


def remove_repeats(docs: DataFrame, run: int = RUN, words: int = WORDS) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: the text without its repeated
    sentences, the counts, the character ranges removed and the documents that
    keep the passages.

    Null texts stay null, empty ones empty; null ids come last in order; rows
    with the same id and text are one document (both keep what is first in
    them); an empty table gives no rows; other columns are ignored."""
    # spans of one document that share an end merge map-side, so a document's list has at most one entry per sentence
    cover = repeated_spans(docs, run, words).groupBy("doc_id", "h", "a").agg(F.max("z").alias("z"), F.collect_set("first_doc").alias("f"))
    cover = cover.groupBy("doc_id", "h").agg(F.collect_list(F.struct("a", "z")).alias("cover"),
                                             F.array_distinct(F.flatten(F.collect_list("f"))).alias("first_docs"))
    rows = columns(docs, "doc_id", "text").withColumn("h", F.xxhash64("text"))
    both = rows.alias("r").join(cover.alias("c"), F.col("r.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("r.h") == F.col("c.h")), "left")
    return both.select("r.doc_id", "r.text", "cover", "first_docs").mapInArrow(
        _clean, "doc_id long, text string, n_sentences long, n_removed long, "
                "removed array<struct<start:long,end:long>>, first_docs array<long>")
