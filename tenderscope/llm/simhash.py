"""SimHash near-duplicates by tiled exact comparison.

Fingerprint: the text in lower case (A-Z only), its white-space separated
words, every run of ``shingle`` words (fewer words: all of them), each run's
XXH64 with seed 42; a bit is set if it is set in over half of the hashes.

Comparison: distinct fingerprints, in order of population count, are cut into
tiles, a few tiles make a group, and a task gets a pair of groups.  Two tiles are compared only if their population counts come within the
radius; inside a pair, strips are skipped whose population counts of the four
16-bit quarters differ by more than the radius in sum (each differing bit moves
one quarter's count by one, so no link is lost).  The rest is numpy exclusive-or
and bit counts.  A tile pair gives the links' spanning forest, at most one row
per fingerprint, never all pairs of a group.

Equal fingerprints meet once, in a group-by with map-side combining; only
(fingerprint, smallest id) pairs go on, so groups of copies cost one row.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forest, lead, parts, saved, tidy

SHINGLE, RADIUS = 4, 4
TILE, STRIP = 16384, 512
#: tiles of a group: a task holds one group and sees the tiles of another one by one, so a tile is read once per group, not once per tile
SIDE, TASKS = 8, 20_000
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint of a UTF-8 text; 0 without words."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    stop = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    start = np.concatenate([[0], stop[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    start, stop = start[:n], stop[-n:]
    bits = np.zeros(64, dtype=np.int64)
    one = xxhash.xxh64_intdigest
    for i in range(0, n, 1 << 16):  # bounds the unpacked bits of very long texts
        h = [one(joined[a:z], 42) for a, z in zip(start[i:i + (1 << 16)].tolist(), stop[i:i + (1 << 16)].tolist())]
        bits += np.unpackbits(np.array(h, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(bits * 2 > n).tobytes(), "big")


@tidy
def _fingerprints(batches, shingle: int):
    for b in batches:
        found = [fingerprint(t or b"", shingle) for t in b.column(1).cast(pa.binary()).to_pylist()]
        fp = pa.array(np.array(found, dtype="<u8").view("<i8"))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), fp], ["doc_id", "h", "fp"])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, h, fp) per row: fp the fingerprint as a signed 64-bit number, h
    a hash of the text as it is."""
    rows = lead(docs, "doc_id", "text").withColumn("h", F.xxhash64("text"))
    return rows.mapInArrow(partial(_fingerprints, shingle=shingle), "doc_id long, h long, fp long")


@tidy
def _tiles(batches):
    held = []

    def emit(fp):
        pop = np.bitwise_count(fp)
        return pa.RecordBatch.from_pydict({"tile": [int(fp[:1].view("<i8")[0])], "lo": [int(pop[0])], "hi": [int(pop[-1])],
                                           "fps": [fp.tobytes()]},
                                          schema=pa.schema([("tile", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()),
                                                            ("fps", pa.binary())]))

    for b in batches:
        held.append(b.column(0).to_numpy().view("<u8"))
        if sum(map(len, held)) >= TILE:
            whole = np.concatenate(held)
            for i in range(0, len(whole) - TILE + 1, TILE):
                yield emit(whole[i:i + TILE])
            held = [whole[len(whole) // TILE * TILE:]]
    whole = np.concatenate(held) if held else np.empty(0, dtype="<u8")
    if len(whole):
        yield emit(whole)


def quarters(fp: np.ndarray) -> np.ndarray:
    """Population counts of the four 16-bit quarters, one row each."""
    return np.bitwise_count(fp.view("<u2").reshape(-1, 4)).astype(np.int16)


def linked(a: np.ndarray, b: np.ndarray | None, radius: int):
    """Spanning forest of the links between tiles ``a`` and ``b`` (None: inside
    ``a``), as two arrays of fingerprints."""
    both = a if b is None else np.concatenate([a, b])
    other, shift = (a, 0) if b is None else (b, len(a))
    boxes = []
    for t in (a, other):
        q = quarters(t)
        cut = range(0, len(t), STRIP)
        boxes.append((np.array([q[i:i + STRIP].min(axis=0) for i in cut]), np.array([q[i:i + STRIP].max(axis=0) for i in cut])))
    (alo, ahi), (blo, bhi) = boxes
    left, right, found = [], [], 0
    for k in range(len(alo)):
        gap = np.maximum(np.maximum(blo - ahi[k], alo[k] - bhi), 0).sum(axis=1)
        near = np.flatnonzero(gap <= radius)
        if b is None:
            near = near[near >= k]
        rows = a[k * STRIP:(k + 1) * STRIP]
        for some in np.array_split(near, max(1, -(-len(near) // 8))):
            if not len(some):
                continue
            at = np.concatenate([np.arange(j * STRIP, min((j + 1) * STRIP, len(other))) for j in some])
            x, y = np.nonzero(np.bitwise_count(rows[:, None] ^ other[at][None, :]) <= radius)
            left.append(x + k * STRIP)
            right.append(at[y] + shift)
            found += len(x)
            if found > 1 << 20:  # keep only a forest of what was found so far
                root = forest(np.concatenate(left), np.concatenate(right), len(both))
                node = np.flatnonzero(root != np.arange(len(both)))
                left, right, found = [node], [root[node]], 0
    if not left:
        return both[:0], both[:0]
    root = forest(np.concatenate(left), np.concatenate(right), len(both))
    node = np.flatnonzero(root != np.arange(len(both)))
    return both[node], both[root[node]]


@tidy
def _compare(batches, radius: int):
    """Rows of one cell come one after the other, the tiles of its first group
    before those of its second."""
    cell, first = None, []

    def told(x, y):
        left, right = linked(x, y, radius)
        return pa.RecordBatch.from_arrays([pa.array(left.view("<i8")), pa.array(right.view("<i8"))], ["a", "b"])

    for b in batches:
        for row in b.to_pylist():
            at, x = (row["lo1"], row["cut1"], row["lo2"], row["cut2"]), np.frombuffer(row["fps"], dtype="<u8")
            if at != cell:
                cell, first = at, []
            same = at[:2] == at[2:]
            if row["side"] == 1 or same:
                for lo, hi, y in first:
                    if max(lo, row["lo"]) <= min(hi, row["hi"]) + radius:
                        yield told(y, x)
            if same:
                yield told(x, None)
            if row["side"] == 0:
                first.append((row["lo"], row["hi"], x))
    yield told(np.empty(0, "<u8"), None)


def tasks(cells: int, least: int) -> int:
    """Partitions for the cells: one each up to ``TASKS``, several in one beyond."""
    return max(least, min(cells, TASKS))


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b), a spanning forest per pair of tiles, among the distinct
    fingerprints of ``fps(fp)``."""
    spark = fps.sparkSession
    quarter = [F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(0xFFFF)) for i in range(3)]
    tiles = max(1, -(-fps.count() // TILE))
    order = ["pop", "q0", "q1", "q2", "fp"]
    dealt = fps.select("fp", F.bit_count("fp").alias("pop"), *[q.alias(f"q{i}") for i, q in enumerate(quarter)])
    dealt = dealt.repartitionByRange(tiles, *order).sortWithinPartitions(*order).select("fp")
    t = saved(dealt.mapInArrow(_tiles, "tile long, lo int, hi int, fps binary"), "tiles")
    # groups of about SIDE tiles that start at the same count, and the pairs of groups within reach (cells): numbers only
    cuts = t.groupBy("lo").agg(F.ceil(F.count(F.lit(1)) / F.lit(SIDE)).cast("int").alias("cuts"))
    t = t.join(F.broadcast(cuts), "lo").withColumn("cut", F.pmod(F.xxhash64("tile"), F.col("cuts")).cast("int"))  # a row per bit count at most
    groups = t.groupBy("lo", "cut").agg(F.max("hi").alias("hi"))
    one = groups.select(F.col("lo").alias("lo1"), F.col("cut").alias("cut1"), F.explode(F.sequence("lo", F.col("hi") + radius)).alias("lo2"))
    cells = one.join(groups.select(F.col("lo").alias("lo2"), F.col("cut").alias("cut2")), "lo2").where("lo1 < lo2 or cut1 <= cut2")
    cells = saved(cells.select("lo1", "cut1", "lo2", "cut2"), "cells")
    key = ["lo1", "cut1", "lo2", "cut2"]
    body = t.select("lo", "cut", "hi", "tile", "fps")
    left = cells.join(body, (cells["lo1"] == body["lo"]) & (cells["cut1"] == body["cut"])).withColumn("side", F.lit(0))
    other = cells.where("not (lo1 = lo2 and cut1 = cut2)")
    right = other.join(body, (other["lo2"] == body["lo"]) & (other["cut2"] == body["cut"])).withColumn("side", F.lit(1))
    columns = [*key, "side", "tile", "lo", "hi", "fps"]
    dealt = left.select(columns).union(right.select(columns)).repartition(tasks(cells.count(), parts(spark)), *key).sortWithinPartitions(*key, "side", "tile")
    return dealt.mapInArrow(partial(_compare, radius=radius), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, h, fp, root, component_id) per row of ``docs(doc_id, text)``.

    root is the smallest fingerprint of the group, component_id the smallest
    id (null only if the whole group has null ids).  Null and empty texts have
    fingerprint 0 and link like any other; repeated rows are one group; an
    empty table gives no rows; other columns are ignored."""
    rows = saved(fingerprints(docs, shingle), "fingerprints")
    fps = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(fps.select("fp"), radius))
    fps = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    group = fps.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(fps.select("fp", "root").join(group, "root"), "fp").select("doc_id", "h", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the row with the smallest
    id (null ids last; among equal ids the smallest text hash; of equal rows
    one)."""
    key = ["none", "id", "h"]
    name = lambda c: [F.col(c).isNull().alias("none"), F.coalesce(c, F.lit(0)).alias("id"), "h"]
    stay = near_duplicates(docs, shingle, radius).groupBy("root").agg(F.min(F.struct(*name("doc_id"))).alias("k")).select("k.*")
    rows = docs.select(F.struct("*").alias("row")).withColumn("h", F.xxhash64("row.text")).select(*name("row.doc_id"), "row")
    return rows.join(stay, key, "left_semi").dropDuplicates(key).select("row.*")
