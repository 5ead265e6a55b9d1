"""Benchmark decontamination by a prefix-filtered set join (DataFrame functions only).

Every benchmark item is cut into item-sized windows of ``WINDOW`` words (a
shorter item is one window).  A window is the set of its ``SHINGLE``-word
shingles.  The shingles are ordered by rarity, that is by their occurrences in
all documents.  A window is contained only where all its shingles are, so its
prefix, the shingles that any match must hit, is the single rarest one; a window
with a shingle that stands in no document cannot occur and leaves the join.

Documents meet the windows by the prefix shingle alone.  The place of the
shingle inside the window gives the place of the window in the document; the
length bound (the document has that many words) and the positional bound (the
window starts and ends inside it) drop what cannot match, and the rest is
verified word by word.

Shingles travel as 64-bit hashes; the verification compares the words, so a
collision costs time and changes no result.  The window side is broadcast only
up to ``BROADCAST_ROWS`` rows, counted first; beyond that Spark joins by shuffle.
"""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lead, saved

WINDOW, SHINGLE = 10, 5
#: rows (about 100 bytes at most) of the window side up to which it is broadcast
BROADCAST_ROWS = 500_000
#: everything but digits, a to z and what is beyond ASCII
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """Only A-Z in lower case; a text of ASCII alone takes the quick way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _BETWEEN), "")


def _bounded(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _key() -> Column:
    """A document by its id and text: copies under other ids stay apart, so no group of copies shares a key."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("text"))))


def _gram(hashes: str, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(hashes, at + k) for k in range(size)])


def _shingles(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """``rows`` with words ``w``, once per shingle: ``n`` words, place ``at`` and hash ``gram``."""
    hashed = rows.withColumn("h", F.transform("w", lambda w: F.xxhash64(w))).withColumn("n", F.size("h")).drop("w")
    keep = [c for c in hashed.columns if c != "h"]
    placed = hashed.select("*", F.posexplode("h").alias("at", "one"))
    found = [F.struct(F.lit(s).alias("size"), _gram("h", F.col("at"), s).alias("gram")) for s in sizes]
    if len(sizes) == 1:
        return placed.where(F.col("at") + sizes[0] <= F.col("n")).select(*keep, "at", found[0]["gram"].alias("gram"))
    return placed.select(*keep, "at", F.inline(F.array(*found))).where("at + size <= n").drop("size")


def item_windows(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(id, window, length) of the distinct windows, and (id, item_id) of the items that hold them."""
    listed = lead(items, "item_id", "text").select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    cut = listed.select("item_id", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))).alias("from"))
    cut = cut.select("item_id", F.slice("w", F.col("from"), window).alias("w"))
    cut = saved(cut.select("item_id", F.array_join("w", " ").alias("window"), F.size("w").alias("length")).distinct(), "item-windows")
    distinct = saved(cut.select("window", "length").distinct().withColumn("id", F.monotonically_increasing_id()), "windows")
    return distinct, cut.join(distinct, ["window", "length"]).select("id", "item_id")


def prefixes(documents: DataFrame, windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(id, length, offset, gram): the rarest shingle of each window that can occur, counted over ``documents(w)``."""
    sized = windows.withColumn("w", F.split("window", " "))
    sizes = sorted(r[0] for r in windows.select(F.least("length", F.lit(shingle))).distinct().collect())  # at most `shingle` numbers
    if not sizes:
        return windows.select("id", "length", F.lit(0).alias("offset"), F.lit(0).cast("long").alias("gram"))
    kinds = [_shingles(sized.where(F.least("length", F.lit(shingle)) == s).select("id", "length", "w"), [s]) for s in sizes]
    grams = saved(reduce(DataFrame.union, kinds).select("id", "length", F.col("at").alias("offset"), "gram"), "item-shingles")
    counts = _shingles(documents.select("w"), sizes).join(_bounded(grams.select("gram").distinct()), "gram").groupBy("gram").agg(F.count(F.lit(1)).alias("seen"))
    ordered = grams.join(counts, "gram", "left").groupBy("id", "length").agg(
        F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "gram", "offset")).alias("rarest"))
    return ordered.where("rarest.seen > 0").select("id", "length", "rarest.offset", "rarest.gram")


def occurrences(docs: DataFrame, windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(key, n_hit, ids): documents that hold windows, their words inside any occurrence, and the windows' ids.
    ``docs(key, text)``; a repeated row gives one."""
    split = docs.where("text is not null").select("key", words(F.col("text")).alias("w"))
    first = saved(prefixes(split, windows, shingle), "rarest-shingles")
    sizes = sorted(r[0] for r in first.select(F.least("length", F.lit(shingle))).distinct().collect())
    if not sizes:
        return docs.limit(0).select("key", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<long>").alias("ids"))
    near = _shingles(split, sizes).join(_bounded(first), "gram").withColumn("start", F.col("at") - F.col("offset"))
    near = near.where("start >= 0 and start + length <= n").select("key", "start", "id")  # positional and length bounds
    told = near.distinct().join(_bounded(windows), "id").groupBy("key").agg(F.collect_list(F.struct("start", "length", "id", "window")).alias("near"))
    told = saved(told, "candidates")
    both = split.withColumn("n", F.size("w")).join(told, "key")
    same = F.filter("near", lambda c: F.array_join(F.slice("w", c["start"] + 1, c["length"]), " ") == c["window"])
    true = both.select("key", "n", F.array_sort(same).alias("near")).where(F.size("near") > 0)
    end = lambda c: c["start"] + c["length"]
    covered = F.aggregate("near", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit")), lambda a, c: F.struct(
        F.greatest(a["end"], end(c)).alias("end"), (a["hit"] + F.greatest(F.lit(0), end(c) - F.greatest(a["end"], c["start"]))).alias("hit")))
    rows = true.select("key", covered["hit"].alias("n_hit"), F.array_distinct(F.transform("near", lambda c: c["id"])).alias("ids"))
    return rows.dropDuplicates(["key"])


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id``, ``n_words``, ``n_hit`` (words
    inside an occurrence of a window of ``items(item_id, text)``), ``n_items``,
    ``items_sha256`` (over the sorted item ids), ``contaminated``, and
    ``item_ids`` themselves.

    Null and blank texts have no words and are clean; a document shorter than
    every window is clean; null document ids stay, repeated rows repeat; items
    that share an id are one item, items without an id count as one more that
    is not listed; an item without words matches nothing; overlapping and equal
    windows count a word once; an empty table of documents gives no rows, of
    items none that is contaminated.  Other columns of both are ignored."""
    rows = lead(docs, "doc_id", "text").withColumn("key", _key())
    windows, held = item_windows(items, window)
    found = saved(occurrences(rows.select("key", "text"), windows, shingle), "occurrences")
    ids = found.select("key", F.explode("ids").alias("id")).join(_bounded(held), "id").select("key", "item_id").distinct()
    ids = ids.groupBy("key").agg(F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("item_ids"))
    hits = found.select("key", "n_hit").join(ids, "key")
    listed = F.coalesce("item_ids", F.array().cast("array<string>"))
    counted = rows.select("doc_id", "key", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return counted.join(hits, "key", "left").select(
        "doc_id", "n_words", zero("n_hit"), zero("n_items"), F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), listed.alias("item_ids"))


def contamination_sql(window: int = WINDOW) -> str:
    """The same rows by comparing every place of every document with every window text."""
    split = r"regexp_extract_all(translate(coalesce(text, ''), '%s', '%s'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')" % (ascii_uppercase, ascii_lowercase)
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {split} AS w FROM documents),
    i AS (SELECT item_id, w, greatest(len(w) - {window - 1}, 1) AS places FROM (SELECT item_id, {split} AS w FROM benchmark) WHERE len(w) > 0),
    c AS (SELECT DISTINCT item_id, least(len(w), {window}) AS m, array_to_string(w[p:p + {window - 1}], ' ') AS t
          FROM (SELECT item_id, w, unnest(range(1, places + 1)) AS p FROM i)),
    m AS (SELECT DISTINCT m FROM c),
    g AS (SELECT r, p, m, array_to_string(w[p:p + m - 1], ' ') AS t
          FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, m WHERE len(w) >= m)),
    o AS (SELECT DISTINCT r, p, g.m, g.t FROM g JOIN (SELECT DISTINCT m, t FROM c) k ON g.m = k.m AND g.t = k.t),
    hit AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(p, p + m)) AS place FROM o) GROUP BY r),
    it AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
           FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM o JOIN c ON o.m = c.m AND o.t = c.t) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)"""
