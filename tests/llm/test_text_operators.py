"""Toxicity, token files, fingerprints, spans, SimHash and packing against
brute force, on sf0.001 / sf0.01 and on odd rows."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tenderscope.llm import order_minhash, packing, queries, simhash, spans, token_files, toxicity, words

SMALL, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
Q = queries.queries()


def documents(spark, sf):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(words.vocabulary_path("word_bpe_49k.json"))


def as_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_word_cache_gives_the_librarys_ids(tokenizer):
    odd = ["a<|endoftext|>b C", "Don't I'LL x's", "ΣΑΣ Σας", "naïve café é é", "x\x1cy\x85z a​b", "İstanbul ŉ ǅ", "漢字 テスト。１２３ ½",
           "", "  ", "a" * 3000, "!!?.,,; :a.b,c. it's. 12.5", 'word."x ß ẞ', "\x00a\x01 b", "a b c"]
    odd += [f"a{chr(c)}B {chr(c)}.{chr(c)}c" for c in range(1, 0x250)]
    got = words.WordEncoder(words.vocabulary_path("word_bpe_49k.json")).encode(odd)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [as_ids(tokenizer, t) for t in odd]


def test_word_cache_bound(monkeypatch, tokenizer):
    monkeypatch.setattr(words, "CACHE_CHUNKS", 50)
    texts = [f"alpha{i} beta{i}. gamma" for i in range(300)]
    got = words.WordEncoder(words.vocabulary_path("word_bpe_49k.json")).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [as_ids(tokenizer, t) for t in texts]


def brute_files(tokenizer, rows):
    out, at = [], 0
    for doc_id, text in rows:
        ids = as_ids(tokenizer, text) + [1]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_files(spark, tokenizer):
    got = sorted(tuple(r) for r in Q["op3_token_files"](spark, SMALL).collect())
    assert got == brute_files(tokenizer, sorted(documents(spark, SMALL).items()))


def test_token_files_many_shards(spark, tokenizer):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = sorted(tuple(r) for r in token_files.write_and_read(docs, shard_ids=500).collect())
    assert got == brute_files(tokenizer, sorted(documents(spark, SMALL).items()))


def test_token_files_odd_rows(spark, odd_docs, no_docs, tokenizer):
    got = token_files.write_and_read(odd_docs).collect()
    want = odd_docs.select("doc_id", "text").collect()
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == collections.Counter(
        (w[0], w[2], w[3]) for w in brute_files(tokenizer, [(r.doc_id, r.text) for r in want]))
    rows = sorted(got, key=lambda r: r.start)
    assert [r.start for r in rows] == np.concatenate([[0], np.cumsum([r.n_tokens for r in rows])[:-1]]).tolist()
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))
    assert token_files.write_and_read(no_docs).count() == 0


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(0)
    ids = rng.choice(np.arange(2, 60), size=20_000, p=(w := 1 / np.arange(1, 59)) / w.sum())
    ids = np.where(rng.random(len(ids)) < 0.01, 1, ids)
    ids[-1] = 1
    s, rules, lengths, base = token_files.compress(ids)
    assert len(s) < 0.8 * len(ids) and len(rules)
    assert (token_files.expand(s, rules, base) == ids).all()
    cut = np.flatnonzero(ids == 1) + 1
    docs = [ids[a:z].astype("<u4").tobytes() for a, z in zip([0, *cut[:-1]], cut)]
    shard = token_files._shard(0, 0, list(range(len(docs))), docs, 1)
    for k in (0, 1, len(docs) // 2, len(docs) - 1):
        assert token_files.decode_document(shard, k).tobytes() == docs[k]


def test_order_minhash(spark):
    docs = sorted(documents(spark, SMALL).items(), reverse=True)
    got = {r.doc_id: r for r in Q["op4_order_minhash"](spark, SMALL).collect()}
    assert len(got) == len(docs)
    for k, (doc_id, text) in enumerate(docs):
        text, following = text or "", docs[(k + 1) % len(docs)][1] or ""
        half = len(text) // 2
        new = text[:len(text) - half] + following[:half]
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        fp, efp = order_minhash.fingerprint(text), order_minhash.fingerprint(new)
        assert (r.fingerprint, r.edited_fingerprint) == (fp, efp)
        assert r.near_edited == order_minhash.likeness(fp, efp)
        assert r.near_next == order_minhash.likeness(fp, order_minhash.fingerprint(following))


def test_order_minhash_selects_the_smallest_and_keeps_order():
    text = "abcdefgh" * 5 + "the quick brown fox jumps over the lazy dog"
    x = order_minhash.kmers(np.frombuffer(text.encode("utf-32-le"), "<u4"))
    assert len(set(x.tolist())) == len(x)  # repeats are numbered apart
    for odd in order_minhash._SEEDS:
        v = [(int(y) * int(odd)) % (1 << 64) for y in x]
        v = [y ^ (y >> 32) for y in v]
        assert order_minhash._smallest(x, odd).tolist() == sorted(sorted(range(len(v)), key=v.__getitem__)[:2])
    words_ = [f"w{i} lorem{i * 7 % 31}" for i in range(200)]
    a, moved, other = " ".join(words_), " ".join(words_[100:] + words_[:100]), " ".join(f"q{i} ipsum{i * 5 % 31}" for i in range(200))
    near = lambda b: order_minhash.likeness(order_minhash.fingerprint(a), order_minhash.fingerprint(b))
    assert near(a) == 1.0 and near(a.replace("w50 ", "v50 ")) > near(moved) > near(other)


def test_order_minhash_odd_rows(spark, odd_docs, no_docs):
    got = order_minhash.order_fingerprints(odd_docs).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r.doc_id for r in odd_docs.select("doc_id").collect())
    assert all(r.fingerprint == "0" * 256 and r.near_edited == 1.0 for r in got if r.n_chars == 0)
    assert order_minhash.order_fingerprints(no_docs).count() == 0
    one = order_minhash.order_fingerprints(odd_docs.where("doc_id = 1")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def brute_simhash(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, radius):
    fp = np.array(fps, dtype=np.uint64)
    root = list(range(len(fp)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fp)):
        for j in np.flatnonzero(np.bitwise_count(fp[i + 1:] ^ fp[i]) <= radius) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(ids))]


def test_simhash(spark):
    docs = sorted(documents(spark, MID).items())
    fps = [brute_simhash(t) for _, t in docs]
    want = brute_components([d for d, _ in docs], fps, 4)
    got = {r.doc_id: r for r in Q["op8_simhash"](spark, MID).collect()}
    assert [(f"{f:016x}", c) for f, c in zip(fps, want)] == [(got[d].fingerprint, got[d].component_id) for d, _ in docs]
    assert len(set(want)) < len(docs)


def test_simhash_links_lose_nothing(monkeypatch):
    monkeypatch.setattr(simhash, "STRIP", 32)
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, size=150, dtype=np.uint64)
    flips = base[rng.integers(0, 150, 400)]
    for _ in range(4):
        flips = flips ^ np.where(rng.random(400) < 0.7, np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64), np.uint64(0))
    fp = np.unique(np.concatenate([base, flips]))
    fp = fp[np.argsort(np.bitwise_count(fp), kind="stable")]
    want = brute_components(list(range(len(fp))), fp, 4)
    a, b = fp[:len(fp) // 2], fp[len(fp) // 2:]
    edges = [simhash.linked(a, None, 4), simhash.linked(b, None, 4), simhash.linked(a, b, 4)]
    at = {int(f): i for i, f in enumerate(fp)}
    from tenderscope.llm.common import forest
    left, right = (np.array([at[int(x)] for e in edges for x in e[k]]) for k in (0, 1))
    assert forest(left, right, len(fp)).tolist() == want


def test_simhash_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 64)
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    few = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    monkeypatch.undo()
    assert few == {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}


def test_simhash_many_groups_in_few_tasks(spark, monkeypatch):
    """One tile per group and a bounded number of tasks: the same components."""
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    want = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    for name, value in (("TILE", 16), ("SIDE", 2), ("TASKS", 5)):
        monkeypatch.setattr(simhash, name, value)
    assert want == {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    monkeypatch.undo()
    tiles = 610_000  # a hundred times those of 100 million fingerprints
    assert simhash.tasks(tiles * tiles // simhash.SIDE ** 2, 8) <= simhash.TASKS


def test_simhash_odd_rows(spark, odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    want = brute_components([r.doc_id for r in rows], [brute_simhash(r.text) for r in rows], 4)
    got = simhash.near_duplicates(odd_docs).collect()
    assert collections.Counter((r.doc_id, r.component_id) for r in got) == collections.Counter(zip([r.doc_id for r in rows], want))
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    kept = kept.select("doc_id", "text").collect()
    assert len(kept) == len({(brute_simhash(r.text), c) for r, c in zip(rows, want)} and {c for c in want})
    assert {r.doc_id for r in kept} == set(want)
    assert simhash.keep_one(no_docs).count() == 0


def own_hash(word):
    h = sum(ord(c) * pow(0x9E3779B97F4A7C15, k % 4096, 1 << 64) for k, c in enumerate(word)) % (1 << 64)
    h = (h ^ h >> 32) * 0xD6E8FEB86659FD93 % (1 << 64)
    return h ^ h >> 29


def own_pieces(text):
    """Word lists of the pieces, written from the rules alone: a word ends its
    piece if it ends a sentence or line, or if in a sentence of more than 20 words
    its hash is the least among three words to both sides."""
    tokens = re.findall(r"\S+|\s+", text)
    sentences, now = [], []
    for t in tokens:
        if t.isspace():
            if now and (now[-1][-1] in ".!?" or len(f"a{t}b".splitlines()) > 1):
                sentences.append(now)
                now = []
        else:
            now.append(t)
    sentences += [now] if now else []
    words = [w for s in sentences for w in s]
    hashes, out, k = [own_hash(w) for w in words], [], 0
    for s in sentences:
        piece = []
        for w in s:
            piece.append(w)
            least = all(hashes[k] < x for x in hashes[k + 1:k + 4]) and all(hashes[k] <= x for x in hashes[max(0, k - 3):k])
            k += 1
            if len(s) > 20 and least:
                out.append(piece)
                piece = []
        out += [piece] if piece else []
    return out


def brute_spans(docs):
    """Words that a non-first run of two pieces and twelve words covers, walking the documents in order."""
    seen, left = set(), {}
    for doc_id, text in docs:
        pieces = own_pieces(text or "")
        keys = []
        if pieces and (len(pieces) < 2 or sum(map(len, pieces)) < 12):
            keys = [(0, len(pieces), ("whole", *[w for p in pieces for w in p]))]
        else:
            for k in range(len(pieces)):
                z = k + 2
                while z <= len(pieces) and sum(map(len, pieces[k:z])) < 12:
                    z += 1
                if z <= len(pieces):
                    keys.append((k, z, tuple(w for p in pieces[k:z] for w in p)))
        gone = set()
        for a, z, key in keys:
            if key in seen:
                gone.update(range(a, z))
            seen.add(key)
        left[doc_id] = (len(gone), [w for i, p in enumerate(pieces) if i not in gone for w in p])
    return left


def test_sentence_spans(spark):
    docs = sorted(documents(spark, MID).items())
    want = brute_spans(docs)
    got = {r.doc_id: (r.n_removed, (r.text or "").split()) for r in Q["op5_sentence_spans"](spark, MID).collect()}
    assert got == want
    assert sum(w[0] for w in want.values()) > 0


def test_planted_passages_go_and_clean_texts_stay(spark):
    """Passages of 51 to 60 words in sentences of every length, put between any two words of other texts, lose most of
    their later copies; texts without one lose nothing, though they share short sentences and openings."""
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abcdefgh"), size=int(rng.integers(3, 8))))

    def prose(n, most):
        out = []
        while len(out) < n:
            s = [word() for _ in range(min(int(rng.integers(2, most)), n - len(out)))]
            out += [s[0].capitalize(), *s[1:-1], s[-1] + "."] if len(s) > 1 else [s[0] + "."]
        return " ".join(out)

    passages = [prose(int(rng.integers(51, 61)), [8, 15, 25, 50][i % 4]) for i in range(80)]
    rows = []
    for i, p in enumerate(passages):
        for k in range(3):
            host = prose(120, 18).split()
            at = int(rng.integers(0, len(host)))
            rows.append((10 * i + k, " ".join(host[:at] + [p] + host[at:])))
    rows += [(10_000 + i, f"Good morning. How are you? {prose(80, 18)} Thank you for reading.") for i in range(200)]
    got = {r.doc_id: r for r in spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    most = [2 * len([w for w in p.split() if w in set(got[10 * i + k].text.split())]) < len(p.split()) for i, p in enumerate(passages) for k in (1, 2)]
    assert sum(most) >= 0.97 * len(most), sum(most)
    assert all(got[10 * i + k].n_removed > 0 for i in range(80) for k in (1, 2))
    assert all(got[10 * i].n_removed == 0 for i in range(80)) and all(got[10_000 + i].n_removed == 0 for i in range(200))


def test_pieces_keep_every_character():
    for t in ["", " \n ", "a", "a b.\n\n \n c d.\n", "One. Two!  Three?\n\nFour", "x " * 100, "a, b; c " * 50, "\r\n a.b.c  .\n", "w x. y\x0bz", "é\u2028ü 日本\u3000語. \U0001f600 x",
              "z" * 9000 + " " + "w" * 5000, " ".join(f"w{i % 17}{i % 5}" for i in range(500))]:
        p = spans.pieces(t)
        got = [t[a:z] for a, z in zip(p.start[:-1], p.start[1:])]
        assert "".join(got) == t and [x.split() for x in got if x.split()] == own_pieces(t)
        assert all(not x[0].isspace() for x in got[1:])


def test_passages_of_fifty_words_are_found(spark):
    """A passage of 51 to 60 words in the middle of other texts, cut off from its
    sentences or not, loses most of its second copy; the rest stays."""
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghij"), size=int(rng.integers(2, 9))))

    def prose(n):
        return " ".join(word() + ("" if rng.random() > 0.08 else rng.choice([".", ",", ".\n"])) for _ in range(n))

    rows = []
    for i in range(60):
        passage = prose(int(rng.integers(51, 61)))
        rows += [(2 * i, f"{prose(40)} {passage} {prose(40)}"), (2 * i + 1, f"{prose(40)} {passage} {prose(40)}")]
    got = {r.doc_id: r for r in spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = sum(got[2 * i + 1].n_removed > 0 for i in range(60))
    assert hit >= 57, hit
    assert all(got[2 * i].n_removed == 0 for i in range(60))
    assert all(got[2 * i + 1].first_docs == [2 * i] for i in range(60) if got[2 * i + 1].n_removed)


def test_sentence_spans_odd_rows(spark, odd_docs, no_docs):
    got = spans.remove_repeats(odd_docs).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r.doc_id for r in odd_docs.select("doc_id").collect())
    first = {r.doc_id: r for r in got if r.doc_id is not None}
    assert first[1].n_removed == 0 or first[1].text is not None
    assert all(r.text is None and r.n_sentences == 0 for r in got if r.doc_id == 0)
    assert spans.remove_repeats(no_docs).count() == 0


def brute_pieces(tokenizer, rows, size=2048):
    out = []
    for doc_id, text in rows:
        ids = as_ids(tokenizer, text) + [0]
        out += [(doc_id, k, at, len(ids[at:at + size]), zlib.crc32(np.array(ids[at:at + size], "<u4").tobytes()))
                for k, at in enumerate(range(0, len(ids), size))]
    return out


def check_bins(rows, tokens=2048, documents=packing.MAX_DOCUMENTS, cost=2048 * 2048):
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= tokens and len(parts) <= documents and sum(n * n for _, n in parts) <= max(cost, max(n * n for _, n in parts))
    return len(bins)


def test_packing(spark, tokenizer):
    rows = Q["op10_packing"](spark, MID).collect()
    assert collections.Counter(tuple(r)[:5] for r in rows) == collections.Counter(brute_pieces(tokenizer, documents(spark, MID).items()))
    total = sum(r.length for r in rows)
    assert check_bins(rows) <= 1.03 * -(-total // 2048) + 2


def test_packing_groups_and_capacities(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 100)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    check_bins(packing.pack(docs, documents=3, cost=1_500_000).collect(), documents=3, cost=1_500_000)


def test_best_fit_against_plain_loop():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 700, size=600)
    bins, _ = packing.best_fit(lengths, 1000, 6, 600_000)
    room, want = [], np.zeros(600, dtype=int)
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        best = None
        for k, (t, d, c) in enumerate(room):
            if t >= n and d >= 1 and c >= n * n:
                score = ((t - n) / 1000) ** 2 + 0.01 * ((d - 1) / 6) ** 2 + 0.01 * ((c - n * n) / 600_000) ** 2
                if best is None or score < best[0] - 1e-15:
                    best = (score, k)
        if best is None:
            room.append([1000, 6, 600_000])
            best = (0, len(room) - 1)
        want[i] = best[1]
        room[best[1]] = [room[best[1]][0] - n, room[best[1]][1] - 1, room[best[1]][2] - n * n]
    assert (bins == want).all()


def test_packing_odd_rows(spark, odd_docs, no_docs, tokenizer):
    rows = packing.pack(odd_docs).collect()
    want = brute_pieces(tokenizer, [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()])
    assert collections.Counter(tuple(r)[:5] for r in rows) == collections.Counter(want)
    check_bins(rows)
    assert packing.pack(no_docs).count() == 0


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = Q["op1_toxicity"](spark, sf).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    test = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    # 8 of these 97 toxic labels are on texts without any toxic word, which no text model can see
    hit = sum(1 for y, p in test if y and p)
    assert hit >= 0.87 * sum(y for y, _ in test), collections.Counter(test)
    assert sum(1 for y, p in test if p and not y) <= 0.01 * sum(1 for y, _ in test if not y), collections.Counter(test)


def test_toxicity_ignores_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{MID}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda lab: {r.id: r.score for r in toxicity.toxicity(docs, lab).select(F.col("row.doc_id").alias("id"), "score").collect()}
    a, b = score(labels), score(flipped)
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-9


def brute_kneser_ney(docs, labels, discounts):
    """(p(class, head or None, word), words) counted with dictionaries, straight from the formulas."""
    d, e = discounts
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i, _ in docs}
    split = lambda t: re.sub("[^a-z0-9_\x80-\U0010ffff]+", " ", (t or "").lower()).split(" ")
    words = {i: [w for w in split(t) if w] for i, t in docs}
    one, two, context = [collections.Counter(), collections.Counter()], [collections.Counter(), collections.Counter()], collections.defaultdict(set)
    for i, w in words.items():
        for a, b in zip(w, w[1:]):
            context[b].add(a)
        if fold[i] > 1 and i in labels:
            one[labels[i]].update(set(w))
            two[labels[i]].update(set(zip(w, w[1:])))
    known = set(one[0]) | set(one[1])
    all_contexts = sum(max(len(context[w]), 0.5) for w in known)
    heads = [collections.Counter(), collections.Counter()]
    taken = [collections.Counter(), collections.Counter()]
    for c in (0, 1):
        for (h, _), n in two[c].items():
            heads[c][h] += n
            taken[c][h] += min(n, e)

    def p(c, h, w):
        total = sum(one[c].values())
        back = sum(min(n, d) for n in one[c].values()) / total
        alone = max(one[c][w] - d, 0) / total + back * max(len(context[w]), 0.5) / all_contexts
        if h is None or not heads[c][h]:
            return alone
        return max(two[c][h, w] - e, 0) / heads[c][h] + taken[c][h] / heads[c][h] * alone
    return p, known, words


def test_toxicity_probabilities(spark):
    """Every ratio of the fitted model against the formulas, and each model sums to one."""
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "_x"]
    bad = ["You vile", "vile husk", "husk!"]
    docs, labels = [], {}
    for i in range(1500):
        toxic = i % 4 == 0
        text = " ".join(rng.choice(vocabulary + (bad if toxic else []), size=int(rng.integers(3, 30))))
        docs.append((i, text + ("." if i % 3 else "")))
        if i % 7:
            labels[i] = int(toxic)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    m = toxicity.fit(frame, spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"))
    p, known, words = brute_kneser_ney(docs, labels, m.discounts)
    assert len(m.pairs) > 20 and {toxicity._hash([w.encode()])[0] for w in known} == set(m.hashes.tolist())
    x, _, ends = next(toxicity.Known(m.hashes).read([t for _, t in docs]))
    got = m.ratios(x, ends)
    want = []
    for i, _ in docs:
        w = words[i]
        want += [np.log(p(1, h, v) / p(0, h, v)) if v in known else 0.0 for v, h in zip(w, [None] + [a if a in known else None for a in w])]
    assert got == pytest.approx(want, abs=1e-9)
    for c in (0, 1):
        for h in [None, "w1", "vile", "husk"]:
            assert sum(p(c, h, w) for w in known) == pytest.approx(1)


def test_toxicity_sample_bound(spark):
    docs = spark.createDataFrame([(i, "a b " * 50) for i in range(400)] + [(1, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    size = lambda **k: {r.toxic: r["count"] for r in toxicity.labelled(docs, marks, **k).groupBy("toxic").count().collect()}
    assert sum(size().values()) == sum(1 for i in range(400) if zlib.crc32(str(i).encode()) % 5)
    assert size(sample=30) == {0: 30, 1: 30} and size(chars=2000) == {0: 10, 1: 10}


def test_toxicity_odd_rows(spark, odd_docs, no_docs, labels):
    got = toxicity.toxicity(odd_docs, labels).select("row.*", "score").columns
    assert got == odd_docs.columns + ["score"]
    scores = toxicity.toxicity(odd_docs, labels).select(F.col("row.text").alias("t"), F.col("score").alias("s")).collect()
    assert len(scores) == odd_docs.count() and all(0 <= r.s <= 1 for r in scores)
    assert len({r.s for r in scores if not r.t}) == 1
    assert toxicity.toxicity(no_docs, labels).count() == 0
    assert toxicity.toxicity(odd_docs, labels.limit(0)).agg(F.max("score")).first()[0] == 0.0


def test_toxicity_model_holds_every_counted_word(spark):
    """More words than any fixed cap, most in one document."""
    learnt = [i for i in range(1200) if zlib.crc32(str(i).encode()) % 5 > 1]
    toxic = set(learnt[:60])
    text = lambda i: " ".join(f"w{i}x{j}" for j in range(170)) + (" you mere husk" if i in learnt[:9] else " you mere mortal" if i in learnt[30:300] else "")
    docs = spark.createDataFrame([(i, text(i)) for i in range(1200)], "doc_id long, text string")
    m = toxicity.fit(docs, spark.createDataFrame([(i, int(i in toxic)) for i in range(1200)], "doc_id long, toxic int"))
    words = {w for i in learnt for w in toxicity.words_of(text(i))}
    assert set(m.hashes.tolist()) == set(toxicity._hash(list(words)).tolist()) and m.n > 100_000
    x, _, ends = next(toxicity.Known(m.hashes).read(["you mere husk", "you mere mortal"]))
    r = m.ratios(x, ends)
    assert r[2] > 0 > r[5]


def test_toxicity_counts_preceding_words_exactly(spark, monkeypatch):
    for name, value in (("FLUSH", 500), ("SLICE", 600), ("BUCKET", 2000)):
        monkeypatch.setattr(toxicity, name, value)
    rows = [" ".join(f"w{(i * 7 + j) % 900} the" for j in range(40)) + f" w{i % 3} a" for i in range(200)] + [None, "", "the"]
    want = collections.defaultdict(set)
    for t in rows:
        w = toxicity.words_of(t)
        for a, b in zip(w, w[1:]):
            want[b].add(a)
    names = sorted(want) + [b"none"]
    hashes = toxicity._hash(names)
    order = np.argsort(hashes)
    got = toxicity.preceding_words(spark.createDataFrame([(t,) for t in rows], "text string").repartition(5), hashes[order])
    assert got.tolist() == [len(want.get(names[i], ())) for i in order] and max(got) > 800
    assert toxicity.preceding_words(spark.createDataFrame([], "text string"), hashes).tolist() == [0] * len(names)


def test_short_sentences_and_most_of_each_passage_are_removed(spark):
    short = "We ship to every country. Please allow for some days. Write us if parcels are late."
    two = "The red house at the end of our lane has been sold twice. Nobody who lives in the village knows the new owner."
    rows = [(0, f"Alpha beta gamma. {short} Delta."), (1, f"Other words here! {short} Last one."), (2, "Good morning. See you."), (3, "Good morning. See you."),
            (4, two), (5, two), (6, "Good morning. Not the same.")]
    rng = np.random.default_rng(6)
    prose = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), size=6)) for _ in range(n))
    passages = [prose(int(rng.integers(51, 61))) for _ in range(60)]
    rows += [(10 + 2 * i + k, f"{prose(40)} {p} {prose(40)}") for i, p in enumerate(passages) for k in (0, 1)]
    got = {r.doc_id: r for r in spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].text.split() == "Other words here! Last one.".split()
    assert [got[i].text for i in (3, 5, 6)] == ["", "", "Good morning. Not the same."]
    assert all(got[i].n_removed == 0 for i in (0, 2, 4))
    gone = [len(rows[8 + 2 * i][1].split()) - len(got[11 + 2 * i].text.split()) for i in range(60)]
    assert all(2 * n > len(p.split()) for n, p in zip(gone, passages)), gone


def test_empty_texts_fill_one_sequence(spark):
    rows = packing.pack(spark.range(2048).selectExpr("id doc_id", "'' text")).collect()
    assert len(rows) == 2048 and check_bins(rows) == 1


def test_grammar_is_lossless_and_leaves_no_frequent_pair():
    rng = np.random.default_rng(7)
    phrase = rng.integers(2, 40_000, 50)
    parts = [rng.integers(2, 60, 4000), np.full(701, 9), np.tile(phrase, 40), np.array([5, 5, 5, 1, 5, 5, 1, 1] * 30), np.tile([7, 8, 7], 200), rng.integers(2, 49_000, 3000)]
    ids = np.concatenate([np.concatenate([p, [1]]) for p in parts]).astype("<u4")
    s, rules, lengths, base = token_files.compress(ids, gain=0.0)
    assert (token_files.expand(s, rules, base) == ids).all() and (token_files.expand_all(s, rules, lengths, base) == ids).all()
    assert len(s) < 0.7 * len(ids) and (rules < base + np.arange(len(rules))[:, None]).all() and 1 not in rules
    left, k = collections.Counter(), 0
    while k < len(s) - 1:  # neighbours without the end id; of a run of one symbol every second place
        a, b = int(s[k]), int(s[k + 1])
        if a != 1 and b != 1:
            left[a, b] += 1
        if a == b and k + 2 < len(s) and s[k + 2] == a and a != 1:
            run = k
            while run < len(s) and s[run] == a:
                run += 1
            left[a, a] += (run - k) // 2 - 1
            k = run - 1
            continue
        k += 1
    assert max(left.values()) < token_files.MIN_PAIRS
    for n in (0, 1, 2):
        x = np.arange(n).astype("<u4")
        s, rules, lengths, base = token_files.compress(x)
        assert (token_files.expand_all(s, rules, lengths, base) == x).all()
    early, _, _, _ = token_files.compress(ids, gain=0.5)
    assert len(early) > len(token_files.compress(ids, gain=0.0)[0])
