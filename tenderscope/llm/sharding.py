"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a prime-sized table
(a start and a step drawn from its name).  The shards take turns, each claiming
the first slot of its order that is still free, until the table is full: every
shard holds the same number of slots to within one, and adding or removing a
shard moves few slots besides its own.  A key's slot is its hash modulo the
table size, so placement is one lookup in a table whose size is a parameter;
that table (``slots`` rows of two integers) is the only thing broadcast.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARDS, SLOTS = 64, 16381


def lookup_table(names: list[str], slots: int = SLOTS) -> list[int]:
    """Index of the shard that owns each slot; ``slots`` must be prime and
    larger than the number of shards."""
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("the table size must be a prime")
    if not names or len(names) > slots or len(set(names)) != len(names):
        raise ValueError("shard names must be distinct, at least one and at most as many as slots")
    draw = lambda name, salt: int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "big")
    at = [draw(n, "start") % slots for n in names]
    step = [draw(n, "step") % (slots - 1) + 1 for n in names]
    owner, left = [-1] * slots, slots
    while left:
        for k in range(len(names)):
            while owner[at[k]] >= 0:
                at[k] = (at[k] + step[k]) % slots
            owner[at[k]], left = k, left - 1
            if not left:
                break
    return owner


def slot_of(key: Column, slots: int) -> Column:
    """First eight hex digits of the key's md5, modulo the table size; a null
    key counts as the empty text."""
    return F.pmod(F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long"), F.lit(slots))


def place(docs: DataFrame, key: str = "doc_id", names: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """(row, slot, shard) for every row; ``row`` holds the columns of ``docs``.
    Equal keys share a shard; rows are kept as they are, null keys and repeated
    rows too; an empty table gives no rows."""
    names = names or [f"shard-{i:03d}" for i in range(SHARDS)]
    table = docs.sparkSession.createDataFrame(list(enumerate(lookup_table(names, slots))), "slot long, shard int")
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.withColumn("slot", slot_of(F.col(f"row.`{key}`"), slots))
    return rows.join(F.broadcast(table), "slot").select("row", "slot", "shard")  # at most ``slots`` rows


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", names: list[str] | None = None, slots: int = SLOTS,
                 spread: int = 8) -> None:
    """Write ``docs`` as Parquet, one folder per shard; a shard's rows go to
    ``spread`` tasks, so that a hot key's neighbours do not share one task."""
    placed = place(docs, key, names, slots).select("row.*", F.col("shard").alias("_shard"),
                                                   F.floor(F.rand(7) * spread).cast("int").alias("_part"))
    placed.repartition("_shard", "_part").drop("_part").write.partitionBy("_shard").parquet(path)


def sharding_sql() -> str:
    """DuckDB text of the placement; the table is written out as a list."""
    table = lookup_table([f"shard-{i:03d}" for i in range(SHARDS)])
    return (f"WITH t AS (SELECT [{','.join(map(str, table))}] AS owners), d AS (SELECT doc_id, "
            f"CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) % {SLOTS} AS slot FROM documents) "
            "SELECT doc_id, slot, CAST(owners[slot + 1] AS INTEGER) AS shard FROM d, t")
