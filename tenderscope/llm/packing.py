"""Packing documents into training sequences by vector best-fit.

Every document is tokenised, closed with an end id and, if longer than a
sequence, cut into pieces.  A piece asks for three resources: tokens, one
document slot, and attention cost (its length squared).  Pieces go in
decreasing length to the open sequence that satisfies every capacity and leaves
the smallest weighted norm of residual capacities; where none fits, a new
sequence opens.

Tokenising is one map over the texts that keeps only lengths and checksums, so
no text or id is shuffled.  The piece rows are written out, dealt at random
into groups of about ``GROUP_PIECES`` (an even split whatever the key skew) and
each group is packed by one task; a group leaves at most a few sequences
partly filled.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc, lead, saved, tidy
from .words import GROUP, encoder, vocabulary_path

SEQUENCE_TOKENS = 2048
MAX_DOCUMENTS = SEQUENCE_TOKENS  # every piece has a token, so this never opens a needless sequence
GROUP_PIECES = 16384
END_ID = 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@tidy
def _pieces(batches, path: str, size: int, end: int):
    enc, tail = encoder(path), np.array([end], dtype="<u4").tobytes()
    for b in (batch.slice(i, GROUP) for batch in batches for i in range(0, len(batch), GROUP)):
        rows = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
        for doc, ids in zip(b.column(0).to_pylist(), enc.encode(b.column(1).to_pylist())):
            ids += tail
            for k, at in enumerate(range(0, len(ids), 4 * size)):
                piece = ids[at:at + 4 * size]
                rows["doc_id"].append(doc)
                rows["piece"].append(k)
                rows["start"].append(at // 4)
                rows["length"].append(len(piece) // 4)
                rows["ids_crc32"].append(crc(piece))
        yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([
            ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
            ("ids_crc32", pa.int64())]))


def pieces(docs: DataFrame, size: int = SEQUENCE_TOKENS, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """One row per piece: where it starts in its document, its length and the
    crc32 of its ids.  A null or empty text is one piece holding the end id."""
    path = path or vocabulary_path("word_bpe_49k.json")
    return lead(docs, "doc_id", "text").mapInArrow(partial(_pieces, path=path, size=size, end=end_id), PIECES)


def best_fit(lengths: np.ndarray, tokens: int, documents: int, cost: int, weights=(1.0, 0.01, 0.01)):
    """Vector best-fit of ``lengths``: (bin, offset) of each item.  Capacities
    hold for every bin: sum of lengths, number of items, sum of squares."""
    n = len(lengths)
    bins, offsets = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    if not n:
        return bins, offsets
    least = int(lengths.min())
    res = np.empty((3, 1024))  # residual capacities of the open bins
    name = np.empty(1024, dtype=np.int64)
    full = np.array([tokens, documents, cost], dtype=float)
    w = (np.array(weights) / full ** 2)[:, None]
    opened = live = 0
    for done, i in enumerate(np.argsort(-lengths, kind="stable")):
        need = np.array([lengths[i], 1.0, float(lengths[i]) ** 2])[:, None]
        if done % 256 == 0 and live:  # bins that nothing fits any more
            keep = np.flatnonzero((res[0, :live] >= least) & (res[1, :live] >= 1) & (res[2, :live] >= least ** 2))
            res[:, :len(keep)], name[:len(keep)] = res[:, keep], name[keep]
            live = len(keep)
        fits = np.flatnonzero((res[:, :live] >= need).all(axis=0))
        if len(fits):
            left = res[:, fits] - need
            at = fits[np.argmin((w * left * left).sum(axis=0))]
        else:
            if live == res.shape[1]:
                res, name = np.concatenate([res, np.empty_like(res)], axis=1), np.concatenate([name, name])
            at = live
            res[:, at], name[at] = full, opened
            live, opened = live + 1, opened + 1
        bins[i], offsets[i] = name[at], tokens - res[0, at]
        res[:, at] -= need[:, 0]
    return bins, offsets


def _pack(pdf: pd.DataFrame, tokens: int, documents: int, cost: int) -> pd.DataFrame:
    bins, offsets = best_fit(pdf["length"].to_numpy(), tokens, documents, cost)
    return pdf.drop(columns="group").assign(sequence_id=pdf["group"].to_numpy() * (1 << 32) + bins, offset=offsets)


def pack(docs: DataFrame, tokens: int = SEQUENCE_TOKENS, documents: int = MAX_DOCUMENTS, cost: int | None = None,
         end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)`` with its sequence and its
    place there.

    tokens, documents, cost: capacities of a sequence (cost: sum of squared
    piece lengths; default tokens squared).  A cost below tokens squared must
    still admit the longest piece, else that piece has a sequence to itself.
    Null ids and repeated rows are pieces like any other (repeated rows are
    packed once each); an empty table gives no rows; other columns are ignored."""
    rows = saved(pieces(docs, tokens, end_id, path), "pieces")
    groups = max(1, -(-rows.count() // GROUP_PIECES))
    # the table's row order is fixed now, so the dealing survives a rerun
    dealt = rows.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("group").applyInPandas(
        partial(_pack, tokens=tokens, documents=documents, cost=cost or tokens * tokens),
        PIECES + ", sequence_id long, offset long")
