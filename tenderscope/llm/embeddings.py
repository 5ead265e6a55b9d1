"""Embedding near-duplicates: inverted lists with product-quantised residuals.

Unit vectors x and y have cosine >= t exactly if their distance is at most
``r = sqrt(2 - 2t)``.

* Copies first: vectors of one label that are equal component by component
  become one row with a count.
* Index: k-means centroids (coarse) and per-subspace codebooks of the residuals
  are fitted on a sample of at most ``SAMPLE`` rows; then every row is indexed.
* Probes: y, in the list of centroid c, can be within r of x (nearest centroid
  a) only if x is within r of the bisecting plane of a and c.  x probes every
  list that passes this test, so no link is lost.
* Distances: a table of squared distances from x's residual to each codeword
  gives the distance to every code by lookups; a code whose distance exceeds
  r by more than its own quantisation error is dropped.  That too loses no link.
* Rerank: what is left is compared by cosine in double precision.

Vectors travel in the precision of their column; all arithmetic is in doubles.
A list is cut into blocks of about ``BLOCK`` rows by hash, and its probes too;
one task compares two blocks and returns link counts and a spanning forest, a
row or two per vector, so a hot list is many tasks and no list of all pairs.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forest, lead, saved

COSINE = 0.98
SAMPLE, BLOCK = 20_000, 1024
SUBSPACES, CODEWORDS = 8, 32
#: pairs reranked at once
STEP = 1 << 14


def _means(x: np.ndarray, k: int, rng, rounds: int = 8) -> np.ndarray:
    c = x[rng.choice(len(x), size=min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = np.argmin((c * c).sum(1) - 2 * x @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=len(c))
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


class Index:
    """Coarse centroids and residual codebooks for unit vectors of one length."""

    def __init__(self, x: np.ndarray, lists: int):
        rng = np.random.default_rng(1)
        self.dim = x.shape[1]
        self.cuts = np.array_split(np.arange(self.dim), min(SUBSPACES, self.dim))
        self.coarse = _means(x, lists, rng)
        rest = x - self.coarse[np.argmin((self.coarse ** 2).sum(1) - 2 * x @ self.coarse.T, axis=1)]
        self.books = [_means(rest[:, c], CODEWORDS, rng) for c in self.cuts]

    def place(self, x: np.ndarray, r: float):
        """Nearest list, and for every vector the lists with a higher number
        that a vector within r of it can be in."""
        size = (self.coarse ** 2).sum(1)
        apart = np.sqrt(np.maximum(size[:, None] + size - 2 * self.coarse @ self.coarse.T, 0))
        near, reach = np.zeros(len(x), np.int64), np.zeros((len(x), len(self.coarse)), bool)
        for i in range(0, len(x), 512):
            part = x[i:i + 512]
            d = np.maximum((part * part).sum(1)[:, None] + size - 2 * part @ self.coarse.T, 0)
            near[i:i + 512] = at = np.argmin(d, axis=1)
            reach[i:i + 512] = (d - d[np.arange(len(part)), at][:, None]) <= 2 * r * apart[at] + 1e-6
        reach &= np.arange(len(self.coarse)) > near[:, None]
        return near, reach

    def codes(self, rest: np.ndarray):
        code = np.stack([np.argmin((b * b).sum(1) - 2 * rest[:, c] @ b.T, axis=1) for c, b in zip(self.cuts, self.books)], axis=1)
        back = np.concatenate([b[code[:, k]] for k, b in enumerate(self.books)], axis=1)
        return code, np.sqrt(((rest - back) ** 2).sum(1))

    def near(self, q: np.ndarray, code: np.ndarray, error: np.ndarray, centre: np.ndarray, r: float) -> np.ndarray:
        """Which (query, code) pairs may be within r, by table lookups."""
        rest = q - centre
        d = np.zeros((len(q), len(code)))
        for k, (c, b) in enumerate(zip(self.cuts, self.books)):
            table = ((rest[:, c][:, None, :] - b[None]) ** 2).sum(2)
            d += table[:, code[:, k]]
        return np.sqrt(d) <= r + error + 1e-6


def _units(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _valid(batches, kind: str):
    """Rows as bytes of their own precision (``kind``); null where the vector
    links with nothing."""
    for b in batches:
        out = []
        for v, label in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            ok = v is not None and label is not None and len(v) > 0 and None not in v
            x = np.array(v, dtype=kind) + 0.0 if ok else None  # -0.0 becomes 0.0
            out.append(x.tobytes() if ok and np.isfinite(x).all() and x.any() else None)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(out, type=pa.binary())], ["vec_id", "label", "v"])


def _indexed(batches, index: dict, r: float, kind: str):
    """A list row for each vector, and a probe row for each list it must also
    be compared with."""
    for b in batches:
        for dim in sorted(set(b.column(3).to_pylist())):
            t = b.filter(pa.compute.equal(b.column(3), dim))
            x = _units(np.frombuffer(b"".join(t.column(2).to_pylist()), dtype=kind).reshape(-1, dim))
            near, reach = index[dim].place(x, r) if dim in index else (np.zeros(len(x), dtype=np.int64), np.zeros((len(x), 1), dtype=bool))
            who, where = np.nonzero(reach)
            take = np.concatenate([np.arange(len(x)), who])
            yield pa.RecordBatch.from_arrays(
                [t.column(0).take(pa.array(take)), t.column(1).take(pa.array(take)), t.column(2).take(pa.array(take)),
                 t.column(3).take(pa.array(take)), t.column(4).take(pa.array(take)),
                 pa.array(np.concatenate([near, where]).astype(np.int32)), pa.array(take.size * [False] if not len(who) else
                                                                                  [False] * len(x) + [True] * len(who))],
                ["rep", "label", "v", "dim", "copies", "list", "probe"])


def _block(pdf: pd.DataFrame) -> pd.DataFrame:
    one = pdf.iloc[:1][["label", "dim", "list", "probe", "block"]].reset_index(drop=True)
    return one.assign(reps=[pdf["rep"].to_numpy(dtype="<i8").tobytes()], copies=[pdf["copies"].to_numpy(dtype="<i8").tobytes()],
                      vs=[b"".join(pdf["v"])])


def _compare(batches, index: dict, cosine: float, r: float, kind: str):
    schema = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
    for b in batches:
        for row in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows)):  # one pair of blocks in memory
            dim, same = row["dim"], row["vs2"] is None
            side = lambda s: (np.frombuffer(row["reps" + s], dtype="<i8"), np.frombuffer(row["copies" + s], dtype="<i8"),  # noqa: E731, B023
                              _units(np.frombuffer(row["vs" + s], dtype=kind).reshape(-1, dim)))  # noqa: B023
            rep, copies, y = side("")
            rep2, copies2, q = (rep, copies, y) if same else side("2")
            ix, nodes = index.get(dim), len(rep) if same else len(rep) + len(rep2)
            count, count2 = np.zeros(len(rep), dtype=np.int64), np.zeros(len(rep2), dtype=np.int64)
            left, right = [], []
            if ix is not None:
                code, error = ix.codes(y - ix.coarse[row["list"]])
            for i in range(0, len(q), 256):
                if ix is not None:
                    a, z = np.nonzero(ix.near(q[i:i + 256], code, error, ix.coarse[row["list"]], r))
                else:  # a vector length outside the sample: one list, all compared
                    a, z = (g.ravel() for g in np.meshgrid(np.arange(len(q[i:i + 256])), np.arange(len(y)), indexing="ij"))
                a = a + i
                if same:
                    a, z = a[a < z], z[a < z]
                for k in range(0, len(a), STEP):
                    aa, zz = a[k:k + STEP], z[k:k + STEP]
                    hit = np.einsum("ij,ij->i", q[aa], y[zz]) >= cosine
                    aa, zz = aa[hit], zz[hit]
                    np.add.at(count2, aa, copies[zz])
                    np.add.at(count, zz, copies2[aa])
                    left.append(zz)
                    right.append(aa if same else aa + len(rep))
                if sum(map(len, left)) > 1 << 16:  # keep only a forest of what was found so far
                    root = forest(np.concatenate(left), np.concatenate(right), nodes)
                    node = np.flatnonzero(root != np.arange(nodes))
                    left, right = [node], [root[node]]
            if same:
                count = count + count2
                names, counts = rep, count
            else:
                names, counts = np.concatenate([rep, rep2]), np.concatenate([count, count2])
            root = forest(np.concatenate(left) if left else np.empty(0, np.int64),
                          np.concatenate(right) if right else np.empty(0, np.int64), len(names))
            some = np.flatnonzero(counts > 0)
            yield pa.RecordBatch.from_arrays([pa.array(names[some]), pa.array(counts[some]), pa.array(names[root[some]])], schema=schema)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, lists: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of
    ``vectors(vec_id, embedding, label)``.

    Vectors that are null, empty or zero, or hold null or non-finite components,
    and rows with a null label, link with nothing; vectors of different length
    do not link.  Equal rows link like different ones.  A row with a null id
    counts as a partner; component_id is the smallest id that is not null (a
    row's own, null or not, if it has no links).  An empty table gives no rows;
    other columns are ignored.

    ``sample`` rows at most fit the index; all are indexed.  ``lists``: coarse
    lists, by default the square root of a fifth of the distinct vectors, so a list
    grows with the square root of the table as long as the sample holds eight
    vectors for each list."""
    spark, r = vectors.sparkSession, float(np.sqrt(2 - 2 * cosine))
    rows = lead(vectors, "vec_id", "embedding", "label").withColumn("label", F.col("label").cast("long"))
    kind = "<f4" if rows.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"
    rows = rows.mapInArrow(partial(_valid, kind=kind), "vec_id long, label long, v binary")
    rows = saved(rows.withColumn("hash", F.md5("v")), "vectors")
    reps = rows.where("v is not null").groupBy("label", "hash").agg(
        F.first("v").alias("v"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    reps = saved(reps.select(F.xxhash64("label", "hash").alias("rep"), "label", "hash", "v", (F.length("v") / np.dtype(kind).itemsize).cast("int").alias("dim"),
                             "least", "copies"), "distinct-vectors")
    taken = reps.select("rep", "v", "dim").orderBy("rep").limit(sample).collect()  # bounded by ``sample``
    root = (reps.count() / 5) ** 0.5
    index = {}
    for dim in sorted({t["dim"] for t in taken}):
        x = _units(np.array([np.frombuffer(t["v"], dtype=kind) for t in taken if t["dim"] == dim]))
        index[dim] = Index(x, lists or int(max(1, min(root, len(x) / 8))))
    spread = reps.select("rep", "label", "v", "dim", "copies").mapInArrow(
        partial(_indexed, index=index, r=r, kind=kind), "rep long, label long, v binary, dim int, copies long, list int, probe boolean")
    spread = saved(spread, "lists")
    key = ["label", "dim", "list", "probe"]
    sizes = spread.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks"))
    blocks = spread.join(sizes, key).withColumn("block", F.pmod(F.xxhash64("rep", F.lit(3)), "blocks")).drop("blocks")
    blocks = saved(blocks.groupBy(*key, "block").applyInPandas(
        _block, "label long, dim int, list int, probe boolean, block long, reps binary, copies binary, vs binary"), "blocks")
    base = blocks.where("not probe").drop("probe")
    other = blocks.withColumnsRenamed({"block": "block2", "reps": "reps2", "copies": "copies2", "vs": "vs2"})
    pairs = base.join(other, ["label", "dim", "list"]).where("probe or block <= block2")
    same = (~F.col("probe")) & (F.col("block") == F.col("block2"))
    pairs = pairs.withColumn("vs2", F.when(~same, F.col("vs2")))
    pairs = pairs.repartition(max(12, int(spark.conf.get("spark.sql.shuffle.partitions"))), "label", "list", "block", "block2", "probe")
    found = saved(pairs.drop("label", "probe", "block", "block2").mapInArrow(
        partial(_compare, index=index, cosine=cosine, r=r, kind=kind), "rep long, links long, root long"), "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    reps = reps.join(links, "rep", "left").join(roots, reps["rep"] == roots["node"], "left").select(
        "label", "hash", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("root"))
    smallest = reps.groupBy("root").agg(F.min("least").alias("smallest"))
    reps = reps.join(smallest, "root").select(F.col("label").alias("label_"), F.col("hash").alias("hash_"), "n_links", "smallest")
    out = rows.join(reps, (rows["label"] == reps["label_"]) & (rows["hash"] == reps["hash_"]), "left")
    n, least = F.coalesce("n_links", F.lit(0)).cast("long"), F.when(F.coalesce("n_links", F.lit(0)) > 0, F.col("smallest")).otherwise(F.col("vec_id"))
    return out.select("vec_id", n.alias("n_links"), least.alias("component_id"), F.col("vec_id").eqNullSafe(least).alias("kept"))
