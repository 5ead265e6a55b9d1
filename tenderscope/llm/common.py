"""Helpers shared by the operators: scratch tables, column names, folds, and
connected components."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``.  Only a local
    session without one (tests) gets a temporary folder of its own."""
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tenderscope-llm-"))
        base = sc.getCheckpointDir()
    return base.rstrip("/")


def saved(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` to a scratch table in the shared folder and read it back:
    later steps start from the files, so a lost executor repeats none of the
    work above them and every reader sees the same rows."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hand_back() -> None:
    """Free memory of this process goes back to the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def tidy(step):
    """A task function over batches that hands free memory back to the machine
    when it ends: idle Python workers live on between stages."""

    @functools.wraps(step)
    def run(batches, *args, **kwargs):
        yield from step(batches, *args, **kwargs)
        hand_back()

    return run


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lead(df: DataFrame, *cols: str) -> DataFrame:
    """Only the named columns; extra columns (also ones whose names clash with
    an operator's own) never reach the operator."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.crc32(doc_id.cast("string")) % 5


def crc(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Root (smallest index) of every node 0..n-1 under the links (a, b)."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            break
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        low = np.minimum(ra, rb)
        np.minimum.at(root, ra, low)
        np.minimum.at(root, rb, low)
        while True:
            jumped = root[root]
            if (jumped == root).all():
                break
            root = jumped
    return root


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges(a, b)`` can
    reach.  Alternating large-star / small-star rounds; every round is a
    group-by minimum plus an equi-join (a hot node is combined map-side and its
    join side can be split), written to a scratch table.  Rounds grow with the
    logarithm of the longest chain; nothing is collected but the edge count
    and checksum that show the fixed point."""
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
    hi, lo = F.greatest("a", "b"), F.least("a", "b")
    e = saved(edges.where("a <> b").select(hi.alias("a"), lo.alias("b")).distinct(), "edges")
    before = mark(e)
    while before[0]:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(floor, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                              F.col("m").alias("b"))
        # each (a, b) gives (b, m) when b is not yet the minimum; (a, m) always
        small = small.union(floor.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        e = saved(small, "edges")
        after = mark(e)
        if after == before:
            break
        before = after
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select("b", "b")).distinct()
