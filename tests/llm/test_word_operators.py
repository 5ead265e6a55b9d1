"""Spelling variants, benchmark decontamination and phrases against brute force."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tenderscope.llm import decontaminate, phrases, queries, spelling

SMALL = "/root/testdata/sf0.001"
Q = queries.queries()
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


# -- spelling ----------------------------------------------------------------------

def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(docs, letters=6, count=5, ratio=5, drop=199):
    seen = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if drop and h % drop == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= letters:
                seen[run] += 1
    n = {w: c for w, c in seen.items() if c >= count}
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_apart(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= ratio * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def by_word(rows):
    return sorted(rows, key=lambda r: r[0])


def test_spelling(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert by_word(rows_of(Q["op11_spelling"](spark, SMALL), *COLUMNS)) == brute_variants(rows_of(docs, "doc_id", "text"))


def test_spelling_large_partitions(spark):
    """Words that share their first or last half are split until few are together, and no pair is lost or found twice."""
    rng = random.Random(1)
    words = {"commonstart" + "".join(rng.choice("abc") for _ in range(rng.randint(0, 5))) for _ in range(150)}
    words |= {"".join(rng.choice("ab") for _ in range(rng.randint(6, 9))) for _ in range(150)}
    words |= {"".join(rng.choice("xyé") for _ in range(3)) + "thesameend" for _ in range(30)} | {"aaaaaa", "aaaaaaa", "aaaaaaaa", "ab" * 600, "ab" * 600 + "a"}
    text = " ".join(w for w in sorted(words) for _ in range(rng.choice([1, 1, 7, 40])))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    want = brute_variants([(1, text)], count=1)
    for most in (1 << 20, 40, 5):
        assert by_word(rows_of(spelling.variants(docs, count=1, most=most), *COLUMNS)) == want
    assert any(w[3] and w[4] for w in want)


def test_spelling_chain_of_forms(spark):
    text = " ".join(["letters"] * 500 + ["letterz"] * 100 + ["lettorz"] * 20 + ["lottorz"] * 4 + ["élettorz"] * 1)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = {r.word: r.root for r in spelling.variants(docs, count=1, drop=None).collect()}
    assert got == {w: "letters" for w in ("letters", "letterz", "lettorz", "lottorz")} | {"élettorz": "letters"}


def test_spelling_odd_rows(spark, odd_docs, no_docs):
    got = spelling.variants(odd_docs)
    assert by_word(rows_of(got, *COLUMNS)) == brute_variants(rows_of(odd_docs, "doc_id", "text"))
    assert spelling.variants(no_docs).count() == 0


# -- decontamination ------------------------------------------------------------------

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_contamination(docs, items, window=10):
    held = collections.defaultdict(set)
    for item_id, text in items:
        w = WORD.findall((text or "").translate(LOWER))
        for i in range(max(len(w) - window + 1, 1) if w else 0):
            held[tuple(w[i:i + window])].add(item_id)
    out = []
    for doc_id, text in docs:
        w = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in {len(k) for k in held}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in held:
                    hit |= set(range(i, i + size))
                    found |= held[tuple(w[i:i + size])]
        ids = ",".join(sorted(str(i) for i in found if i is not None))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return collections.Counter(out)


FOUND = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_decontaminate(spark):
    docs, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    got = collections.Counter(rows_of(Q["op12_decontaminate"](spark, SMALL), *FOUND))
    assert got == brute_contamination(rows_of(docs, "doc_id", "text"), rows_of(items, "item_id", "text"))
    assert any(r[5] for r in got)


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_ROWS, 0])
def test_decontaminate_odd_rows(spark, odd_docs, no_docs, monkeypatch, limit):
    """Short, empty, null, repeated and overlapping items; beyond the broadcast limit the rows are the same."""
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
    items = [(1, "the quick BROWN fox"), (2, "jumps over the lazy dog near the river bank today it was seen by many people there"), (3, ""), (4, None),
             (None, "nobody knew why"), (5, "nobody knew why"), (5, "here"), (6, "x"), (7, "word1 and1 word2 and2 word3 and3 word4 and4 word5 and5 word6"),
             (8, "another text under a used id"), (9, "not in any text at all"), (10, "and0 word0"), (11, "???"), (12, "10 0 0 25")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit(1)).withColumn("w", F.lit(1))
    docs = odd_docs.withColumn("key", F.lit("a")).withColumn("n_hit", F.lit(9))
    got = collections.Counter(rows_of(decontaminate.contamination(docs, bench), *FOUND))
    assert got == brute_contamination(rows_of(odd_docs, "doc_id", "text"), items)
    assert decontaminate.contamination(no_docs, bench).count() == 0
    none = decontaminate.contamination(odd_docs, bench.limit(0))
    assert none.count() == odd_docs.count() and none.where("contaminated").isEmpty()


def test_decontaminate_runs_without_python(spark):
    found = decontaminate.contamination(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/benchmark.parquet"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# -- phrases ----------------------------------------------------------------------------

def brute_phrases(docs, least, share=80, top=2000):
    count, total = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for m in range(1, 5):
                count[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in count.items():
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = collections.Counter()
        for p, a in good.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i:i + m]] = max(inside[p[i:i + m]], a)
        rows = []
        for p, a in good.items():
            score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            if 100 * inside[p] < share * a:
                rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, total[lang], -score) for i, (score, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


RANKED = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def test_phrases(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert sorted(rows_of(Q["op13_phrases"](spark, SMALL), *RANKED)) == brute_phrases(rows_of(docs, "lang", "text"), 30)


def test_phrases_small_shards_and_buckets(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(7)
    got = phrases.collocations(docs, least=3, top=500, shard=3000, bucket=500)
    assert sorted(rows_of(got, *RANKED)) == brute_phrases(rows_of(docs, "lang", "text"), 3, top=500)


def test_phrases_odd_rows(spark, odd_docs, no_docs):
    more = spark.createDataFrame([(None, "a b a b. a B\tA b!! a\x0bb \x00c d\x00 c d é É", "é", None, None)] * 3 + [(1, "a b c d e", None, None, None)] * 4 +
                                 [(2, "", "", None, None), (3, "a b a b", "", None, None), (4, ".;:", "", None, None)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs = odd_docs.select(more.columns).union(more).withColumn("p", F.lit(1)).withColumn("rank", F.lit(1))
    got = sorted(rows_of(phrases.collocations(docs, least=2), *RANKED))
    assert got == brute_phrases(rows_of(docs, "lang", "text"), 2)
    assert {r[0] for r in got} == {"en", "é", "und", ""}
    assert phrases.collocations(no_docs).count() == 0
    assert phrases.collocations(more, least=1000).count() == 0


def test_fm_index_extends_both_ways():
    rng = random.Random(3)
    text = [0] + [rng.randint(0, 4) for _ in range(400)] + [0, 0, 0]
    import numpy as np
    seq = np.array(text, np.int32)
    places = np.array([i for i in range(1, 400) if all(text[i:i + 3])])
    index = phrases.FMIndex(seq, places, 3)
    want = collections.Counter(tuple(text[i:i + 3]) for i in places)
    got = {tuple(text[r:r + 3]): c for r, c in zip(index.rows[index.low], index.count)}
    assert got == want
    row, count = index.left(np.ones(len(index.rows), bool))
    four = {tuple(text[index.rows[r] - 1:index.rows[r] + 3]): c for r, c in zip(row, count)}
    assert four == collections.Counter(tuple(text[i - 1:i + 3]) for i in places if text[i - 1])
