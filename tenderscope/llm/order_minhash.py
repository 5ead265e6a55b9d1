"""Document fingerprints by Order MinHash.

The k-mers are the runs of ``K`` code points of the text, each numbered by how
often it has occurred before, so repeats count.  For each of ``SIGNATURES`` hash
functions the ``TUPLE`` smallest k-mers are selected, put back into text order
and hashed together.  Two texts agree in a signature only if they share those
k-mers in the same order, so the share of equal signatures falls with edit
distance, also for edits that merely move passages.

Successors in descending id order without a global window: one range exchange
on the id, a sort inside each partition, and a stream that holds one text back.
Only the first and last text of a partition wait for a neighbour elsewhere;
those edge rows (two per partition) are matched by one small window.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lead, parts, saved

K, TUPLE, SIGNATURES = 8, 2, 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MUL = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MUL[2]
    x = (x ^ (x >> np.uint64(29))) * _MUL[0]
    return x ^ (x >> np.uint64(32))


def kmers(codes: np.ndarray) -> np.ndarray:
    """Hash of each occurrence-numbered k-mer, in text order (a text shorter
    than K is one k-mer; an empty text has none)."""
    if not len(codes):
        return np.empty(0, dtype=np.uint64)
    x = codes.astype(np.uint64)
    if len(x) < K:
        h = np.full(1, len(x), dtype=np.uint64)
        for c in x:
            h = (h ^ c) * _MUL[0]
        x = h
    else:
        width = 1
        while width < K:  # K is a power of two: pairs, quadruples, ...
            x = x[:-width] * _MUL[0] + (x[width:] ^ _MUL[1])
            x ^= x >> np.uint64(31)
            width *= 2
    x = _mix(x)
    n = len(x)
    bits = np.uint64(max(1, (n - 1).bit_length()))
    order = np.sort((x >> bits << bits) | np.arange(n, dtype=np.uint64))  # by k-mer, then by place
    place = (order & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    key = order >> bits
    new = np.ones(n, dtype=bool)
    new[1:] = key[1:] != key[:-1]
    if not new.all():
        at = np.arange(n)
        number = at - np.maximum.accumulate(np.where(new, at, 0))
        again = number > 0
        x[place[again]] = _mix(x[place[again]] + number[again].astype(np.uint64) * _ODD)
    return x


_SEEDS = _mix(np.arange(1, SIGNATURES + 1, dtype=np.uint64) * _ODD) | np.uint64(1)


def _smallest(x: np.ndarray, odd: np.uint64) -> np.ndarray:
    """Places of the TUPLE smallest values of one hash function, in text order."""
    v = x * odd
    v ^= v >> np.uint64(32)
    if len(v) > 64:  # first only what lies under a bound that rarely holds too few
        low = np.flatnonzero(v < np.uint64((1 << 64) // len(v) * 12))
        if len(low) >= TUPLE:
            return np.sort(low[np.argsort(v[low], kind="stable")[:TUPLE]])
    return np.sort(np.argsort(v, kind="stable")[:TUPLE])


def fingerprint(text: str) -> str:
    """SIGNATURES times eight hex digits; the empty text's are all zero."""
    x = kmers(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4"))
    if not len(x):
        return "0" * 8 * SIGNATURES
    picked = x[np.stack([_smallest(x, odd) for odd in _SEEDS])]  # text order within a signature
    sign = _SEEDS
    for k in range(picked.shape[1]):
        sign = (sign ^ picked[:, k]) * _MUL[0] + _ODD
        sign = sign ^ (sign >> np.uint64(31))
    return (sign >> np.uint64(32)).astype(">u4").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of equal signatures."""
    return sum(a[i:i + 8] == b[i:i + 8] for i in range(0, len(a), 8)) / (len(a) // 8)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the start of the next one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
_EDGE = _RESULT + ", head string, tail string, h long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
                    ("head", pa.string()), ("tail", pa.string()), ("h", pa.int64())])


def _judged(doc_id, text: str, fp: str, following: str, next_fp: str) -> dict:
    new = edited(text, following)
    efp = fp if new == text else fingerprint(new)
    return {"doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": fp, "edited_fingerprint": efp, "near_edited": likeness(fp, efp), "near_next": likeness(fp, next_fp)}


def _stream(batches):
    """Rows come in descending order.  A row is judged once the next one is
    known; the partition's first text goes out as ``head``, its last row, which
    waits for another partition, with its text as ``tail``."""
    last = None
    for b in batches:
        ids, texts, hashes = (c.to_pylist() for c in b.columns)
        out = []
        for doc_id, text, h in zip(ids, texts, hashes):
            text = text or ""
            fp = last[2] if last and last[1] == text else fingerprint(text)
            if last is None:
                out.append({"doc_id": doc_id, "fingerprint": fp, "head": text, "h": h})
            else:
                out.append(_judged(*last[:3], text, fp))
            last = (doc_id, text, fp, h)
        yield pa.RecordBatch.from_pylist(out, schema=_ARROW)
    if last is not None:
        yield pa.RecordBatch.from_pylist([{"doc_id": last[0], "fingerprint": last[2], "tail": last[1], "h": last[3]}], schema=_ARROW)


def _edges(batches):
    for b in batches:
        yield pa.RecordBatch.from_pylist(
            [_judged(r["doc_id"], r["tail"], r["fingerprint"], r["head"], r["next_fp"]) for r in b.to_pylist()],
            schema=pa.schema(list(_ARROW)[:7]))


def order_fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: the fingerprints of its text and of
    its edited text, and the likeness to the edited and to the next text.

    Null texts count as empty; two empty texts are alike (1.0).  Null ids come
    last; rows with one id are ordered by text hash; after the last row comes
    the first, so a single row is its own next one.  An empty table gives no
    rows; other columns are ignored."""
    rows = lead(docs, "doc_id", "text").withColumn("h", F.xxhash64("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("h").desc()]
    dealt = rows.repartitionByRange(parts(docs.sparkSession), *order).sortWithinPartitions(*order)
    found = saved(dealt.mapInArrow(_stream, _EDGE), "order-minhash")
    edge = found.where("head is not null or tail is not null")
    # two rows a partition, in order: head, tail, head, tail, ...
    w = Window.orderBy(*order, F.col("tail").isNotNull())
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follow = [F.coalesce(F.lead(c).over(w), F.first(c).over(whole)).alias(n) for c, n in (("head", "next_head"), ("fingerprint", "next_fp"))]
    edge = edge.select("doc_id", "fingerprint", "head", "tail", *follow).drop("head").withColumnRenamed("next_head", "head")
    edge = edge.where("tail is not null").select("doc_id", "fingerprint", "tail", "head", "next_fp")
    inner = found.where("head is null and tail is null").select(*[f.name for f in _ARROW][:7])
    return inner.union(edge.mapInArrow(_edges, _RESULT))
