"""Toxicity scores from class-conditional Kneser-Ney models.

Two interpolated bigram models, toxic and ordinary, over lower-cased words:

    p_c(w | h) = max(n_c(h, w) - e, 0) / n_c(h) + l_c(h) * p_c(w)
    p_c(w)     = max(n_c(w) - d, 0) / n_c       + g_c * s(w)
    s(w)       proportional to the number of distinct words seen before w

``l_c`` and ``g_c`` are the masses the absolute discounts take away, so each
model sums to one.  As Kneser-Ney counts contexts rather than occurrences, a
word or pair counts once per document.  ``s`` is shared: it is counted over all
documents, labelled or not, so a word that is rare in the labelled rows falls
back to the same corpus count in both classes.

A document's evidence is its log-likelihood ratio per word: over the whole text
and over its strongest ``STRONG`` share of words.  A logistic fit on rows kept
out of the counts turns the two into a score between 0 and 1; the same rows
choose the discounts (d, e) among ``DISCOUNTS``.

Rows learnt from: at most ``SAMPLE`` labelled documents of each class (smallest
id hash first) and of those as many as begin within the class's first ``CHARS``
characters; never ones whose crc32(doc_id) mod 5 is 0; remainder 1 is for the
logistic fit.  Every word and pair counted there is in the model, none is too
rare: a pair at or below the discount in both classes scores by its head's
masses and its word, which is what the formula gives, so only the others need an
entry.  A word is known by its 64-bit hash; the model is a few sorted arrays.

The distinct words before a word are counted over the whole corpus: (word, word
before) as one number, made distinct where the text lies, sent to the bucket of
its hash as sorted differences, and made distinct again there, so a hot word is
spread over all buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fold, hand_back, lead, parts, saved, tidy
from .words import chunk_hashes

SAMPLE, CHARS, STRONG = 20_000, 64_000_000, 0.015
#: absolute discounts of words and of pairs
DISCOUNTS = ((0.75, 3.0), (2.0, 8.0), (4.0, 16.0))
#: words read before a map task hands on its distinct pairs; bytes of text per bucket of pairs; characters worked on at once
FLUSH, BUCKET, SLICE = 1_500_000, 24_000_000, 1_000_000
#: everything in ASCII but letters, digits and underscores parts words
_SPACE = bytes(c if c >= 128 or c == 95 or chr(c).isalnum() else 32 for c in range(256))


def _texts(column: pa.Array, step: int = 256):
    """The strings of a column, a few at a time in Python's memory."""
    for i in range(0, len(column), step):
        yield from column.slice(i, step).to_pylist()


def _cleaned(text) -> bytes:
    return (text or "").lower().encode().translate(_SPACE)


def words_of(text) -> list[bytes]:
    return _cleaned(text).split()


def _hash(words) -> np.ndarray:
    return chunk_hashes(pa.array(words, type=pa.large_binary()).cast(pa.large_string()))[0]


def coded(texts):
    """For groups of whole texts: hashes of the distinct words, the place among
    them of every word, and the number of words up to the end of each text.
    The distinct words are found by Arrow; none becomes a Python object."""
    held, size = [], 0

    def told():
        lists = pc.ascii_split_whitespace(pa.array(held, type=pa.large_binary()).cast(pa.large_string()))
        found = lists.flatten().dictionary_encode()
        code, ends = found.indices.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
        some = pc.binary_length(found.dictionary).to_numpy(zero_copy_only=False)[code] > 0  # the splitter gives an empty word at an edge
        return chunk_hashes(found.dictionary)[0], code[some], np.concatenate([[0], np.cumsum(some)])[ends]

    for text in texts:
        held.append(_cleaned(text))
        size += len(held[-1])
        if size >= SLICE:
            yield told()
            held, size = [], 0
    if held:
        yield told()


class Known:
    """Texts as places of their words in the sorted ``hashes`` of the model's words (-1: not among them)."""

    def __init__(self, hashes: np.ndarray):
        self.model = hashes

    def read(self, texts):
        """(places, hashes, first word of each text and the end) for groups of whole texts."""
        for h, code, ends in coded(texts):
            place = np.full(len(h), -1)
            if len(self.model):
                order = np.argsort(h)
                at = np.minimum(np.searchsorted(self.model, h[order]), len(self.model) - 1)
                place[order] = np.where(self.model[at] == h[order], at, -1)
            yield place[code], h[code], np.concatenate([[0], ends])


# -- counts of the labelled rows ---------------------------------------------------

@tidy
def _count_words(batches):
    """Documents of each class that hold a word, by its hash."""
    held = [np.zeros((0, 2), np.int64)], [np.zeros(0, np.uint64)]

    def merge():
        h, row = np.unique(np.concatenate(held[1]), return_inverse=True)
        total, counts = np.zeros((len(h), 2), np.int64), np.concatenate(held[0])
        for k in (0, 1):
            total[:, k] = np.bincount(row, counts[:, k], minlength=len(h))
        held[0][:], held[1][:] = [total], [h]

    for b in batches:
        toxic, done = np.array(b.column(1).to_pylist(), dtype=np.int64), 0
        for h, code, ends in coded(_texts(b.column(0))):
            doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
            once = np.unique(doc * len(h) + code)
            label = toxic[done + once // max(len(h), 1)]
            held[0].append(np.column_stack([np.bincount(once[label == k] % max(len(h), 1), minlength=len(h)) for k in (0, 1)]))
            held[1].append(h)
            done += len(ends)
            if sum(map(len, held[1])) > FLUSH:
                merge()
    merge()
    some = held[0][0].sum(axis=1) > 0
    yield pa.RecordBatch.from_arrays([pa.array(held[1][0][some].view(np.int64)), *[pa.array(held[0][0][some, k]) for k in (0, 1)]], ["word", "ordinary", "toxic"])


@tidy
def _count_pairs(batches, hashes: np.ndarray):
    known, n = Known(hashes), len(hashes)
    for b in batches:
        found = ([np.empty(0, np.int64)], [np.empty(0, np.int64)])
        toxic = b.column(1).to_pylist()
        done = 0
        for x, _, ends in known.read(_texts(b.column(0))):
            pair = x[:-1] * n + x[1:]
            for i, (a, z) in enumerate(zip(ends[:-1], ends[1:])):
                if z - a > 1:
                    found[toxic[done + i]].append(np.unique(pair[a:z - 1]))
            done += len(ends) - 1
        for k in (0, 1):
            pair, count = np.unique(np.concatenate(found[k]), return_counts=True)
            side = [pa.array(np.zeros_like(count)), pa.array(count)]
            yield pa.RecordBatch.from_arrays([pa.array(pair), side[1 - k], side[k]], ["pair", "ordinary", "toxic"])


# -- distinct preceding words of the corpus ---------------------------------------------

def _pack(keys: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte by byte of all of them."""
    planes = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


@tidy
def _preceding(batches, hashes: np.ndarray, buckets: int, bits: int):
    """Numbers of ``bits`` low bits for the word before (a word of the model by
    its place, any other by its hash in the upper half) and the word's place above."""
    known, held, size = Known(hashes), [], 0
    half = np.uint64(1 << bits - 1)

    def dealt():
        keys = np.unique(np.concatenate(held))
        held.clear()
        bucket = (keys & np.uint64((1 << bits) - 1)) * np.uint64(0x9E3779B97F4A7C15)
        bucket >>= np.uint64(40)
        bucket = (bucket % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.uint32)
        order = np.argsort(bucket, kind="stable")
        keys, cuts = keys[order], np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])
        some = [(b, a, z) for b, (a, z) in enumerate(zip(cuts[:-1], cuts[1:])) if z > a]
        return pa.RecordBatch.from_arrays([pa.array([b for b, _, _ in some], type=pa.int32()), pa.array([_pack(keys[a:z]) for _, a, z in some], type=pa.binary())],
                                          ["bucket", "keys"])

    for b in batches:
        for x, h, ends in known.read(_texts(b.column(0))):
            use = x >= 0
            use[ends[:-1][ends[:-1] < len(x)]] = False  # a text's first word has none before it
            at = np.flatnonzero(use)
            before = np.where(x[at - 1] >= 0, x[at - 1].astype(np.uint64), half | h[at - 1] >> np.uint64(65 - bits))
            held.append(x[at].astype(np.uint64) << np.uint64(bits) | before)
            size += len(at)
            if size >= FLUSH:
                yield dealt()
                size = 0
    if held:
        yield dealt()


def _distinct(blocks: pd.DataFrame, n: int, bits: int, ranges: int) -> pd.DataFrame:
    keys = np.unique(np.concatenate([_unpack(k) for k in blocks["keys"]]))
    count = np.bincount((keys >> np.uint64(bits)).astype(np.int64), minlength=n)
    cut = np.array_split(count, ranges)
    return pd.DataFrame({"part": np.arange(ranges, dtype=np.int32), "counts": [zstandard.compress(c.astype(np.int64).tobytes(), 1) for c in cut]})


def _added(blocks: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zstandard.decompress(c), np.int64) for c in blocks["counts"])
    return pd.DataFrame({"part": blocks["part"].iloc[:1], "counts": [zstandard.compress(total.tobytes(), 1)]})


def preceding_words(docs: DataFrame, hashes: np.ndarray) -> np.ndarray:
    """For each of the words (sorted hashes) the number of distinct words that stand before it in ``docs(text)``."""
    n, spark = len(hashes), docs.sparkSession
    bits = 64 - max(n, 1).bit_length()
    texts = lead(docs, "text")
    buckets = max(parts(spark), -(-(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET))
    ranges = max(1, min(64, n // 4096))
    blocks = texts.mapInArrow(partial(_preceding, hashes=hashes, buckets=buckets, bits=bits), "bucket int, keys binary")
    each = blocks.groupBy("bucket").applyInPandas(lambda b: _distinct(b, n, bits, ranges), "part int, counts binary")
    total = each.groupBy("part").applyInPandas(_added, "part int, counts binary").collect()  # eight bytes a word in all
    if not total:
        return np.zeros(n)
    return np.concatenate([np.frombuffer(zstandard.decompress(r["counts"]), np.int64) for r in sorted(total, key=lambda r: r["part"])]).astype(np.float64)


# -- the models ------------------------------------------------------------------------

class Model:
    """The log ratio of the two language models as lookup tables, and the logistic weights.

    words: hashes and document counts per class (ordinary, toxic); contexts: distinct
    preceding words; heads: per class and word the sum of its pairs' counts, and
    of what the discount takes from them; pairs: those above the discount in a class."""

    def __init__(self, hashes, counts, contexts, discounts, heads, taken, pairs, pair_counts):
        self.discounts = d, e = discounts
        self.hashes, self.n, self.weights = hashes, len(hashes), np.zeros(3)
        shared = np.maximum(contexts, 0.5)
        shared = shared / shared.sum()
        above = [np.maximum(c - d, 0) / c.sum() for c in counts]
        p = [a + (1 - a.sum()) * shared for a in above]
        mass = [np.where(h > 0, t / np.maximum(h, 1), 1.0) for h, t in zip(heads, taken)]
        self.word = np.append(np.log(p[1] / p[0]), 0.0)  # place -1: a word outside the models
        self.head = np.append(np.log(mass[1] / mass[0]), 0.0)
        some = np.maximum(*pair_counts) > e
        order = np.argsort(pairs[some])
        self.pairs = pairs[some][order]
        before, after = self.pairs // max(self.n, 1), self.pairs % max(self.n, 1)
        two = [np.maximum(c[some][order] - e, 0) / np.maximum(heads[k][before], 1) + mass[k][before] * p[k][after] for k, c in enumerate(pair_counts)]
        self.pair = np.log(two[1] / two[0])

    def __getstate__(self):
        """Packed, as every executor keeps a copy; few ratios differ, so they pack well."""
        small = {n: zstandard.compress(getattr(self, n).astype(np.float32).tobytes(), 3) for n in ("word", "head", "pair")}
        return self.__dict__ | small | {"hashes": _pack(self.hashes), "pairs": _pack(self.pairs.view(np.uint64))}

    def __setstate__(self, state):
        wide = {n: np.frombuffer(zstandard.decompress(state[n]), np.float32) for n in ("word", "head", "pair")}
        self.__dict__ = state | wide | {"hashes": _unpack(state["hashes"]), "pairs": _unpack(state["pairs"]).view(np.int64)}

    def ratios(self, x: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log p_toxic - log p_ordinary of every word, given the word before it in the same text; 0 for words outside the models."""
        r = self.word[x].astype(np.float64)
        if len(x) < 2:
            return r
        both = (x[:-1] >= 0) & (x[1:] >= 0)
        inner = ends[1:-1]
        both[inner[(inner > 0) & (inner < len(x))] - 1] = False
        r[1:][both] += self.head[x[:-1][both]]
        if len(self.pairs):
            key = np.where(both, x[:-1] * self.n + x[1:], -1)
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            hit = self.pairs[at] == key
            r[1:][hit] = self.pair[at[hit]]
        return r

    def evidence(self, x: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Per text the mean ratio of its words, and of its strongest words."""
        r, out = self.ratios(x, ends), np.zeros((len(ends) - 1, 2))
        for i, (a, z) in enumerate(zip(ends[:-1], ends[1:])):
            if z > a:
                top = (z - a) - min(z - a, max(2, int(np.ceil(STRONG * (z - a)))))
                out[i] = r[a:z].mean(), np.partition(r[a:z], top)[top:].mean()
        return out

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + evidence @ self.weights[1:], -500, 500)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Ridge logistic regression by Newton steps, on standardised columns."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w, pull = np.zeros(z.shape[1]), np.full(z.shape[1], ridge * len(x) / 100)
    pull[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(pull + 1e-9), z.T @ (p - y) + pull * w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return np.concatenate([[w[0] - (w[1:] / scale * mean).sum()], w[1:] / scale])


@tidy
def _evidence(batches, models: list[Model]):
    """Evidence under each model, flat, and the label."""
    known = Known(models[0].hashes)
    for b in batches:
        found = [np.column_stack([m.evidence(x, ends) for m in models]) for x, _, ends in known.read(_texts(b.column(0)))]
        rows = np.concatenate(found).tolist() if found else []
        yield pa.RecordBatch.from_arrays([pa.array(rows, type=pa.list_(pa.float64())), b.column(1)], ["x", "toxic"])


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, chars: int = CHARS) -> DataFrame:
    """(text, toxic, fold) of the rows to learn from.  Labels that are null or contradict each other are not used."""
    marks = lead(labels, "doc_id", "toxic").where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(
        F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most")
    marks = marks.withColumn("fold", fold(F.col("doc_id"))).where("fold <> 0")
    take = lambda c: marks.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = take(0).union(take(1)).select("doc_id", F.col("toxic").cast("int").alias("toxic"), "fold")  # at most 2 * sample rows
    texts = saved(lead(docs, "doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id").select(
        F.xxhash64("doc_id").alias("h"), F.md5("text").alias("t"), "text", "toxic", "fold", F.length("text").alias("size")), "labelled")
    order = Window.partitionBy("toxic").orderBy("h", "t").rowsBetween(Window.unboundedPreceding, -1)
    sizes = texts.groupBy("h", "t", "toxic").agg(F.sum("size").alias("size"))
    within = sizes.withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0))).where(F.col("before") < chars).select("h", "t", "toxic")
    within = saved(within, "within")
    within = F.broadcast(within) if within.count() <= 4 * sample else within  # more only where ids repeat
    return texts.join(within, ["h", "t", "toxic"], "left_semi").select("text", "toxic", "fold")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, chars: int = CHARS) -> Model | None:
    """The model for ``docs(doc_id, text)`` with ``labels(doc_id, toxic)``; None if one of the classes has no word to learn from."""
    texts = labelled(docs, labels, sample, chars)
    for_counts, for_fit = texts.where("fold <> 1").select("text", "toxic"), texts.where("fold = 1").select("text", "toxic")
    classes = ("ordinary", "toxic")
    counted = for_counts.mapInArrow(_count_words, "word long, ordinary long, toxic long").groupBy("word").agg(
        *[F.sum(c).cast("int").alias(c) for c in classes]).toArrow()  # the words of the bounded sample, sixteen bytes each
    hashes = counted["word"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    hashes, counts = hashes[order], [counted[c].to_numpy()[order].astype(np.float64) for c in classes]
    del counted, order
    if not all(c.sum() > 0 for c in counts):
        return None
    two = for_counts.mapInArrow(partial(_count_pairs, hashes=hashes), "pair long, ordinary long, toxic long").groupBy("pair").agg(
        *[F.sum(c).cast("int").alias(c) for c in classes])
    size = len(hashes)
    sums = [F.sum(c).cast("int").alias(c) for c in classes]
    sums += [F.sum(F.least(F.col(c).cast("double"), F.lit(e))).cast("float").alias(f"{c}{i}") for c in classes for i, (_, e) in enumerate(DISCOUNTS)]
    some = F.when(F.greatest(*classes) > min(e for _, e in DISCOUNTS), F.struct("pair", *classes))
    rows = two.groupBy(F.expr(f"pair div {size}").alias("head")).agg(*sums, F.collect_list(some).alias("often")).toArrow()  # at most one row a word
    at = rows["head"].to_numpy()

    def column(name: str) -> np.ndarray:
        out = np.zeros(size)
        out[at] = rows[name].to_numpy()
        return out

    heads = [column(c) for c in classes]
    often = rows["often"].combine_chunks().flatten()
    pairs, pair_counts = often.field("pair").to_numpy(), [often.field(c).to_numpy().astype(np.float64) for c in classes]
    often = None
    contexts = preceding_words(docs, hashes)
    models = [Model(hashes, counts, contexts, d, heads, [column(f"{c}{i}") for c in classes], pairs, pair_counts) for i, d in enumerate(DISCOUNTS)]
    rows = heads = contexts = counts = None
    hand_back()
    judge = lambda df: df.mapInArrow(partial(_evidence, models=models), "x array<double>, toxic int").collect()
    found = judge(for_fit)  # at most 2 * sample rows
    if len({r["toxic"] for r in found}) < 2:
        found = judge(for_counts)
    x, y = np.array([r["x"] for r in found]), np.array([r["toxic"] for r in found], dtype=np.float64)
    loss = []
    for k, m in enumerate(models):
        z = x[:, 2 * k:2 * k + 2]
        m.weights = _logistic(z, y)
        odds = np.clip(m.weights[0] + z @ m.weights[1:], -30, 30)
        loss.append(np.logaddexp(0, np.where(y == 1, -odds, odds)).mean())
    best = models[int(np.argmin(loss))]
    models = found = x = None
    hand_back()
    return best


def score_column(model: Model | None, text):
    """Score of a text column; 0 without a model.  Null texts score as empty."""
    if model is None:
        return F.lit(0.0)

    @tidy
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Known(model.hashes)
        for texts in batches:
            found = [model.score(model.evidence(x, ends)) for x, _, ends in known.read(texts)]
            yield pd.Series(np.concatenate(found) if found else [], dtype="float64")

    return F.pandas_udf(scores, "double")(text)


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(row, score) for every row of ``docs``; ``row`` holds its columns, of
    which only the text is scored.  Null and empty texts get the score of no
    evidence; an empty table gives no rows."""
    model = fit(docs, labels, **options)
    rows = docs.select(F.struct("*").alias("row"))
    return rows.withColumn("score", score_column(model, F.col("row.text")))
