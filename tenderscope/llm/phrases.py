"""Phrase collocation mining over FM-indexes of word ids, one per shard.

A shard is a run of documents of one language, about ``SHARD`` words, cut into
pieces and words where the documents lie; its words become ids of its own.  The
word counts are summed across shards, and the words that stand ``least`` times
or more get one id for all shards: a phrase stands no more often than any of its
words.  Every shard builds an FM-index of these ids: its rows are suffixes
sorted as deep as needed, with the word before each (the Burrows-Wheeler
column) for extension to the left and the word after for extension to the
right; an interval of rows is a phrase, its length the count in the shard.

Two rounds enumerate the intervals.  The first extends every word to the left
and gives the pairs; their counts are summed across shards and each shard is
told which of its own pairs stand ``least`` times in all.  The second extends
those pairs to the right and their phrases to the left, to ``DEPTH`` words, and
never into a pair that is too rare.  No count is estimated and none is cut.

Counts travel sorted and packed, one block per shard and bucket.  A bucket is a
hash of the phrase; the number of buckets grows with the entries, about
``BUCKET`` to each.  A phrase comes once per shard however frequent it is, so
none is hot.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lead, parts, saved

DEPTH, LEAST, SHARE, TOP, SCALE = 4, 30, 80, 2000, 2_000_000
#: words of a shard (a longer text is a shard by itself) and entries of a bucket: memory bounds, they change no result
SHARD, BUCKET = 1 << 21, 1 << 21
_ENDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b"\xff" * 10)  # 0xff stands in no UTF-8 text
_END = b"\xff"


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _unpack(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=dtype)


# -- shards ----------------------------------------------------------------------

def split(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text, A-Z in lower case, and 0xff between pieces."""
    return text.lower().translate(_ENDS).replace(_END, b" \xff ").split()


class _Words:
    """Documents of one shard as ids in order of appearance, 0 between pieces and documents."""

    def __init__(self):
        self.ids = defaultdict(itertools.count().__next__)
        self.ids[_END]  # 0
        self.runs, self.size = [np.zeros(1, np.int32)], 0

    def add(self, words: list[bytes]) -> None:
        self.runs += [np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)), np.zeros(1, np.int32)]
        self.size += len(words)

    def row(self, shard: int, lang: str) -> pa.RecordBatch:
        seq = np.concatenate(self.runs)
        seq = seq[np.concatenate([[True], (seq[1:] != 0) | (seq[:-1] != 0)])]
        words = list(self.ids)[1:]
        counts = np.bincount(seq, minlength=len(self.ids))[1:]
        crcs = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        packed = zstandard.ZstdCompressor(level=1).compress(_END.join(words))
        return pa.RecordBatch.from_pylist([{"shard": shard, "lang": lang, "n": int(counts.sum()), "vocabulary": len(words), "seq": _pack(seq),
                                            "words": packed, "counts": _pack(counts), "crcs": _pack(crcs)}], schema=_SHARDS)


_SHARDS = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("vocabulary", pa.int64()),
                     ("seq", pa.binary()), ("words", pa.binary()), ("counts", pa.binary()), ("crcs", pa.binary())])
_SHARDS_DDL = "shard long, lang string, n long, vocabulary long, seq binary, words binary, counts binary, crcs binary"


def _shards(batches, size: int):
    number, open_ = itertools.count(TaskContext.get().partitionId() << 32), {}
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            shard = open_.setdefault(lang, _Words())
            shard.add(split(text))
            if shard.size >= size:
                yield open_.pop(lang).row(next(number), lang)
    for lang, shard in open_.items():
        if shard.size:
            yield shard.row(next(number), lang)


class FMIndex:
    """Rows of the suffixes of ``text`` (ids, 0 between pieces) at ``places``, sorted by their first ``depth`` ids."""

    def __init__(self, text: np.ndarray, places: np.ndarray, depth: int):
        base, key = int(text.max()) + 1, text[places].astype(np.int64)
        for d in range(1, depth):
            if int(key.max(initial=0)) >= (1 << 62) // base:
                key = np.unique(key, return_inverse=True)[1]
            key = key * base + text[places + d]
        order = np.argsort(key, kind="stable")
        self.base, self.rows, key = base, places[order], key[order]
        new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        #: first row of each interval, its length, and the interval of each row
        self.low, self.interval = np.flatnonzero(new), np.cumsum(new) - 1
        self.count = np.diff(np.append(self.low, len(key)))
        self.before = text[self.rows - 1]

    def left(self, keep: np.ndarray):
        """Extend the intervals by the word before, on the rows that ``keep`` marks: (a row of each new interval, count)."""
        rows = np.flatnonzero(keep & (self.before > 0))
        key = self.before[rows].astype(np.int64) * max(len(self.low), 1) + self.interval[rows]
        _, first, count = np.unique(key, return_index=True, return_counts=True)
        return rows[first], count


# -- blocks and buckets -------------------------------------------------------------

_BLOCKS = "shard long, lang string, size int, bucket int, x binary, y binary, n binary"
_ANSWERS = "shard long, lang string, size int, bucket int, asked binary, ids array<long>, x array<long>, y array<long>, n array<long>, word array<binary>"


def _bucket(x: np.ndarray, y: np.ndarray, buckets: int) -> np.ndarray:
    h = (x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (y.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


def _dealt(bucket: np.ndarray, buckets: int) -> list[np.ndarray]:
    """For each bucket the entries that fall into it, in their own order."""
    small = bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket
    order = np.argsort(small, kind="stable")
    return np.split(order, np.searchsorted(bucket[order], np.arange(1, buckets)))


def _blocks(shard: int, lang: str, size: int, x, y, n, buckets: int) -> list[tuple]:
    return [(shard, lang, size, b, _pack(x[i]), _pack(y[i]), _pack(n[i].astype(np.int32)))
            for b, i in enumerate(_dealt(_bucket(x, y, buckets), buckets)) if len(i)]


def _word_blocks(batches, buckets: int):
    for batch in batches:
        for r in batch.to_pylist():
            words = np.array(zstandard.ZstdDecompressor().decompress(r["words"]).split(_END), dtype=object)
            counts, bucket = _unpack(r["counts"], np.int64), (_unpack(r["crcs"], np.uint32) % buckets).astype(np.int32)
            out = [(r["shard"], r["lang"], 1, b, zstandard.ZstdCompressor(level=1).compress(_END.join(words[i])), b"", _pack(counts[i].astype(np.int32)))
                   for b, i in enumerate(_dealt(bucket, buckets)) if len(i)]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out), (
                pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=["shard", "lang", "size", "bucket", "x", "y", "n"])


def _sum(blocks: pd.DataFrame, least: int, buckets: int) -> pd.DataFrame:
    """One bucket: totals of all shards; the entries that reach ``least`` get an
    id, and every shard hears which of the entries it sent did."""
    n = np.concatenate([_unpack(b, np.int32) for b in blocks["n"]]).astype(np.int64)
    ends = np.cumsum([0] + [len(_unpack(b, np.int32)) for b in blocks["n"]])
    size, bucket, word = int(blocks["size"].iloc[0]), int(blocks["bucket"].iloc[0]), None
    if size == 1:
        coded = pa.chunked_array([pa.array(zstandard.ZstdDecompressor().decompress(b).split(_END), type=pa.binary()) for b in blocks["x"]])
        coded = coded.combine_chunks().dictionary_encode()
        code, word = coded.indices.to_numpy(), coded.dictionary
        total = np.bincount(code, weights=n, minlength=len(word)).astype(np.int64)  # exact up to 2^53
    else:
        x = np.concatenate([_unpack(b, np.int64) for b in blocks["x"]])
        y = np.concatenate([_unpack(b, np.int64) for b in blocks["y"]])
        order = np.argsort(x << 32 | y) if max(x.max(), y.max()) < 1 << 31 else np.lexsort((y, x))
        x, y = x[order], y[order]
        new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
        low = np.flatnonzero(new)
        total = np.add.reduceat(n[order], low)
        code = np.empty(len(order), dtype=np.int64)
        code[order] = np.cumsum(new) - 1
        x, y = x[low], y[low]
    often = np.flatnonzero(total >= least)
    ids = np.full(len(total), -1, dtype=np.int64)
    ids[often] = np.arange(len(often)) * buckets + bucket + 1  # dense over all buckets, about
    empty = np.zeros(0, np.int64)
    rows = [(-1, blocks["lang"].iloc[0], size, bucket, b"", ids[often], x[often] if size > 1 else empty, y[often] if size > 1 else empty, total[often],
             word.take(pa.array(often)).to_pylist() if size == 1 else [])]
    if size < 3:
        for shard, a, z in zip(blocks["shard"], ends[:-1], ends[1:]):
            told = ids[code[a:z]]
            rows.append((shard, blocks["lang"].iloc[0], size, bucket, np.packbits(told > 0).tobytes(), told[told > 0], empty, empty, empty, []))
    return pd.DataFrame(rows, columns=["shard", "lang", "size", "bucket", "asked", "ids", "x", "y", "n", "word"])


def _told(answers: pd.DataFrame, size: int, dealt: list[np.ndarray], length: int) -> np.ndarray:
    """Ids of a shard's entries from the answers of the buckets; -1 for the rare."""
    ids = np.full(length, -1, dtype=np.int64)
    for b, asked, found in answers.loc[answers["size"] == size, ["bucket", "asked", "ids"]].itertuples(index=False):
        mark = np.unpackbits(np.frombuffer(asked, np.uint8), count=len(dealt[b])).astype(bool)
        ids[dealt[b][mark]] = found
    return ids


def _text(shard, answers: pd.DataFrame, buckets: int):
    """(text, global id of each local one): the shard's frequent words in the order of their ids, 0 for all else."""
    crcs = _unpack(shard["crcs"], np.uint32)
    ids = _told(answers, 1, _dealt((crcs % buckets).astype(np.int32), buckets), len(crcs))
    often = np.sort(ids[ids > 0])
    local = np.zeros(len(ids) + 1, dtype=np.int32)
    local[1:][ids > 0] = np.searchsorted(often, ids[ids > 0]) + 1
    return local[_unpack(shard["seq"], np.int32)], np.concatenate([[0], often])


def _pairs(key, shards: pd.DataFrame, answers: pd.DataFrame, buckets: list[int]) -> pd.DataFrame:
    out = []
    for _, shard in shards.iterrows():
        text, ids = _text(shard, answers, buckets[0])
        index = FMIndex(text, np.flatnonzero(text), 1)
        row, count = index.left(np.ones(len(index.rows), bool))
        out += _blocks(shard["shard"], shard["lang"], 2, ids[index.before[row]], ids[text[index.rows[row]]], count, buckets[1])
    return pd.DataFrame(out, columns=["shard", "lang", "size", "bucket", "x", "y", "n"])


def _longer(key, shards: pd.DataFrame, answers: pd.DataFrame, buckets: list[int]) -> pd.DataFrame:
    out = []
    for _, shard in shards.iterrows():
        text, ids = _text(shard, answers, buckets[0])
        index = FMIndex(text, np.flatnonzero(text), 1)
        row, _ = index.left(np.ones(len(index.rows), bool))
        x, y = index.before[row], text[index.rows[row]]
        found = _told(answers, 2, _dealt(_bucket(ids[x], ids[y], buckets[1]), buckets[1]), len(row))
        # the pair at each place of the text, -1 where it is too rare or a piece ends
        at = np.flatnonzero((text[:-1] > 0) & (text[1:] > 0))
        known = x.astype(np.int64) * index.base + y  # in ascending order
        pair = np.full(len(text) + 1, -1, dtype=np.int64)
        pair[at] = found[np.searchsorted(known, text[at].astype(np.int64) * index.base + text[at + 1])]
        index = FMIndex(text, np.flatnonzero((pair[:-1] > 0) & (pair[1:] > 0)), 3)  # pairs, extended to the right
        three = index.rows[index.low]
        out += _blocks(shard["shard"], shard["lang"], 3, pair[three], ids[text[three + 2]], index.count, buckets[2])
        row, count = index.left(pair[index.rows - 1] > 0)
        four = index.rows[row] - 1
        out += _blocks(shard["shard"], shard["lang"], 4, pair[four], pair[four + 2], count, buckets[2])
    return pd.DataFrame(out, columns=["shard", "lang", "size", "bucket", "x", "y", "n"])


# -- the operator ---------------------------------------------------------------------

def phrase_counts(docs: DataFrame, least: int = LEAST, shard: int = SHARD, bucket: int = BUCKET) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, n) of all words, (lang, id, word) and (lang, p, f) for every phrase
    of 1 to 4 words that stands ``least`` times: ``p`` holds the words' ids."""
    spark = docs.sparkSession
    rows = lead(docs, "lang", "text").where("text is not null").select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    shards = saved(rows.mapInArrow(partial(_shards, size=shard), _SHARDS_DDL), "shards")
    totals = shards.groupBy("lang").agg(F.sum("n").alias("n"))

    def deal(entries) -> int:
        return max(parts(spark), -(-int(entries or 0) // bucket))

    def summed(blocks: DataFrame, buckets: int) -> DataFrame:
        return saved(blocks.groupBy("lang", "size", "bucket").applyInPandas(
            lambda b: _sum(b, least, buckets), _ANSWERS), "phrase-sums")

    held = shards.select("shard", "lang", "seq", "crcs")
    words, n_words = shards.agg(F.sum("vocabulary"), F.sum("n")).first()
    buckets = [deal(words), deal(n_words), deal(n_words)]
    blocks = shards.select("shard", "lang", "words", "counts", "crcs").mapInArrow(partial(_word_blocks, buckets=buckets[0]), _BLOCKS)
    ones = summed(blocks, buckets[0])
    heard = ones.where("shard >= 0").select("shard", "size", "bucket", "asked", "ids")
    blocks = held.groupBy("shard").cogroup(heard.groupBy("shard")).applyInPandas(lambda k, s, a: _pairs(k, s, a, buckets), _BLOCKS)
    twos = summed(blocks, buckets[1])
    heard = heard.union(twos.where("shard >= 0").select("shard", "size", "bucket", "asked", "ids"))
    blocks = held.groupBy("shard").cogroup(heard.groupBy("shard")).applyInPandas(lambda k, s, a: _longer(k, s, a, buckets), _BLOCKS)
    more = summed(blocks, buckets[2])

    one = ones.where("shard < 0").select("lang", F.inline(F.arrays_zip("ids", "word", F.col("n").alias("f")))).toDF("lang", "id", "word", "f")
    rest = twos.union(more).where("shard < 0").select("lang", "size", F.inline(F.arrays_zip("ids", "x", "y", "n"))).toDF("lang", "size", "id", "x", "y", "f")
    one = saved(one.withColumn("word", F.col("word").cast("string")), "words")
    two = saved(rest.where("size = 2").select("lang", "id", F.array("x", "y").alias("p"), "f"), "pairs")
    first = two.select("lang", F.col("id").alias("x"), F.col("p").alias("left"))
    last = two.select("lang", F.col("id").alias("y"), F.col("p").alias("right"))
    three = rest.where("size = 3").join(first, ["lang", "x"]).select("lang", F.concat("left", F.array("y")).alias("p"), "f")
    four = rest.where("size = 4").join(first, ["lang", "x"]).join(last, ["lang", "y"]).select("lang", F.concat("left", "right").alias("p"), "f")
    all_ = [one.select("lang", F.array("id").alias("p"), "f"), two.select("lang", "p", "f"), three, four]
    return totals, one.select("lang", "id", "word"), saved(reduce(DataFrame.union, all_), "phrases")


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP, shard: int = SHARD, bucket: int = BUCKET) -> DataFrame:
    """The best ``top`` phrases of 2 to 4 words of each language of ``docs(lang, text)``:
    ``lang``, ``rank``, ``phrase``, ``a`` (its count), ``l`` and ``r`` (counts of
    the two parts of its lowest-scoring cut), ``n`` (all words of the
    language), ``score``.

    A null language is ``und``, an empty one a language of its own; null and
    empty texts have no words; repeated rows and copies count again; equal
    scores go by count, then by the phrase's bytes; a text of any length is one
    run of words; an empty table, or one without a frequent phrase, gives no
    rows.  Other columns are ignored."""
    totals, words, phrases = phrase_counts(docs, least, shard, bucket)
    whole = phrases.where(F.size("p") > 1).select("lang", "p", F.col("f").alias("a"))
    # counts of the parts of every cut
    cuts = whole.select("lang", "p", "a", F.explode(F.sequence(F.lit(1), F.size("p") - 1)).alias("k"))
    sides = cuts.select("lang", "p", "a", "k", F.posexplode(F.array(
        F.slice("p", F.lit(1), F.col("k")), F.slice("p", F.col("k") + 1, F.size("p") - F.col("k")))).alias("side", "part"))
    known = sides.join(phrases.withColumnRenamed("p", "part"), ["lang", "part"])
    cut = known.groupBy("lang", "p", "a", "k").agg(F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r"))
    cut = cut.withColumn("score", F.expr(f"cast(a as decimal(20,0)) * {SCALE} div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    best = cut.groupBy("lang", "p", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    # the most frequent longer phrase around each
    longer = whole.where(F.size("p") > 2).select("lang", "p", "a", F.explode(F.sequence(F.lit(2), F.size("p") - 1)).alias("m"))
    longer = longer.select("lang", "p", "a", "m", F.explode(F.sequence(F.lit(1), F.size("p") - F.col("m") + 1)).alias("from"))
    around = longer.groupBy("lang", F.slice("p", F.col("from"), F.col("m")).alias("p")).agg(F.max("a").alias("most"))
    dec = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("decimal(20,0)")
    kept = best.join(around, ["lang", "p"], "left").where(dec("most") * 100 < dec("a") * share)
    kept = kept.select("lang", "p", "a", "best.l", "best.r", "best.score")
    # the best of each bucket of a language, then of the language; ties stay until their words are known
    order = [F.col("score").desc(), F.col("a").desc()]
    dealt = kept.withColumn("bucket", F.pmod(F.xxhash64("p"), F.lit(parts(docs.sparkSession))))
    dealt = dealt.withColumn("at", F.rank().over(Window.partitionBy("lang", "bucket").orderBy(*order))).where(F.col("at") <= top)
    dealt = dealt.withColumn("at", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("at") <= top).drop("at", "bucket")
    named = dealt.select("*", F.posexplode("p").alias("at", "id")).join(words, ["lang", "id"]).groupBy("lang", "p", "a", "l", "r", "score").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ").alias("phrase"))
    named = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long"))
    return named.where(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql(least: int = LEAST, share: int = SHARE, top: int = TOP) -> str:
    """The same rows from all phrases of all pieces, counted as text."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    cuts = " UNION ALL ".join(f"SELECT lang, p, f, {m} AS m, {k} AS k, w[1:{k}] AS lp, w[{k + 1}:{m}] AS rp FROM g WHERE m = {m}"
                              for m in range(2, DEPTH + 1) for k in range(1, m))
    subs = " UNION ALL ".join(f"SELECT lang, w[{s}:{s + m - 1}] AS p, f FROM g WHERE m = {big}"
                              for big in range(3, DEPTH + 1) for m in range(2, big) for s in range(1, big - m + 2))
    grams = " UNION ALL ".join(f"SELECT lang, unnest([w[i:i + {m - 1}] FOR i IN range(1, len(w) - {m} + 2)]) AS x FROM p" for m in range(1, DEPTH + 1))
    return f"""
    WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(text, '{upper}', '{lower}') AS t FROM documents WHERE text IS NOT NULL),
    s AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
    p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM s),
    n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
    f AS (SELECT lang, x AS w, count(*) AS f FROM ({grams}) GROUP BY lang, x HAVING count(*) >= {least}),
    g AS (SELECT lang, w, w AS p, f, len(w) AS m FROM f WHERE len(w) > 1),
    c AS (SELECT c.lang, c.p, c.f AS a, c.k, l.f AS l, r.f AS r, (c.f::HUGEINT * {SCALE}) // (l.f::HUGEINT + r.f::HUGEINT) AS score
          FROM ({cuts}) c JOIN f l ON l.lang = c.lang AND l.w = c.lp JOIN f r ON r.lang = c.lang AND r.w = c.rp),
    b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
    o AS (SELECT lang, p, max(f) AS most FROM ({subs}) GROUP BY lang, p),
    k AS (SELECT b.*, array_to_string(b.p, ' ') AS phrase FROM b LEFT JOIN o ON o.lang = b.lang AND o.p = b.p
          WHERE coalesce(most, 0)::HUGEINT * 100 < a::HUGEINT * {share}),
    q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM k)
    SELECT q.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
    FROM q JOIN n USING (lang) WHERE rank <= {top}"""
