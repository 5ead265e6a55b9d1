"""Token ids in grammar-compressed shard files (Re-Pair).

File format: a Parquet table with one row per shard of about ``SHARD_IDS`` ids.

=========  ============================================================
part       range partition the shard belongs to (ascending document id)
shard      number of the shard within its part
base       first nonterminal; smaller symbols are token ids
width      bytes of one symbol (2 or 4, little-endian unsigned)
rules      left and right symbol of every rule, 4 bytes each; rule r is
           the nonterminal ``base + r`` and only uses earlier symbols
lengths    ids that each rule expands to, 4 bytes each
symbols    the shard's symbols
doc_ids    its documents, ascending
ends       index after each document's last symbol
n_ids      ids in the shard
=========  ============================================================

The compressor repeatedly replaces frequent id pairs by nonterminals.  Each
round counts all neighbouring pairs of the shard, takes the pairs that stand
``MIN_PAIRS`` times or more from the most frequent on, such that no symbol is the
left part of one and the right part of another (so occurrences never overlap;
of a run of one symbol every second place counts), and replaces them all at once.
It ends when no pair is frequent any more, or when a round replaces less than
``GAIN`` of the shard's ids.  The end id takes part in no pair, so no symbol spans
two documents: ``decode_document`` expands one document from its own symbols, and
the rule lengths give positions without expanding anything.

Texts are dealt by one range exchange on (id, text hash) and are encoded and
compressed there as a stream; ``start`` comes from per-part totals (one row per
part) and per-shard sums within a part.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc, lead, parts, saved, tidy
from .words import GROUP, encoder, vocabulary_path

SHARD_IDS = 1 << 20
END_ID = 1
#: pairs seen less often stay as they are; a round that replaces a smaller share of the ids is the last
MIN_PAIRS, GAIN = 16, 0.02
SHARDS = ("part int, shard int, base long, width int, rules binary, lengths binary, symbols binary, "
          "doc_ids array<long>, ends array<long>, n_ids long")
_ARROW = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("base", pa.int64()), ("width", pa.int32()),
                    ("rules", pa.binary()), ("lengths", pa.binary()), ("symbols", pa.binary()),
                    ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("n_ids", pa.int64())])


def _sorted_pairs(s: np.ndarray, end_id: int, top: int):
    """(pairs in order, their places): all neighbours that may be replaced."""
    pair = s[:-1] * top
    pair += s[1:]
    none = top * top
    end = np.flatnonzero(s == end_id)
    pair[end[end < len(pair)]] = none
    pair[end[end > 0] - 1] = none
    same = np.flatnonzero(s[:-1] == s[1:])
    if len(same):  # in a run of one symbol every second place
        new = np.diff(same, prepend=-2) != 1
        pair[same[(same - same[new][np.cumsum(new) - 1]) % 2 == 1]] = none
    bits = int(len(s)).bit_length()
    if none.bit_length() + bits < 64:  # sorts pair and place as one number
        pair <<= bits
        pair |= np.arange(len(pair))
        pair.sort()
        pair = pair[:np.searchsorted(pair, none << bits)]
        return pair >> bits, pair & (1 << bits) - 1
    order = np.argsort(pair, kind="stable")
    order = order[:np.searchsorted(pair, none, sorter=order)]
    return pair[order], order


def compress(ids: np.ndarray, end_id: int = END_ID, gain: float = GAIN):
    """(symbols, rules, lengths, base) of the ids."""
    s = ids.astype(np.int64)
    base = top = int(s.max()) + 1 if len(s) else 1
    rules, spans = [np.zeros((0, 2), np.int64)], np.ones(base, np.int64)
    while len(s) > 1:
        pair, at = _sorted_pairs(s, end_id, top)
        begin = np.flatnonzero(pair[MIN_PAIRS - 1:] == pair[:max(0, len(pair) - MIN_PAIRS + 1)])  # a run of a frequent pair goes on for so many places
        begin = begin[(begin == 0) | (pair[begin] != pair[begin - 1])]
        count = np.searchsorted(pair, pair[begin], side="right") - begin
        often = np.argsort(-count, kind="stable")
        both = np.column_stack(np.divmod(pair[begin[often]], top))
        side, chosen = bytearray(top), []  # 1 left, 2 right, 3 both sides of a pair of equals
        for k, (a, b) in enumerate(both.tolist()):
            if a == b:
                if not side[a]:
                    side[a] = 3
                    chosen.append(k)
            elif side[a] < 2 and side[b] in (0, 2):
                side[a], side[b] = 1, 2
                chosen.append(k)
        if not chosen:
            break
        rules.append(both[chosen])
        spans = np.concatenate([spans, spans[both[chosen, 0]] + spans[both[chosen, 1]]])
        picked = often[chosen]
        n = count[picked]
        rule = np.repeat(np.arange(len(picked)), n)
        place = at[np.repeat(begin[picked] - (np.cumsum(n) - n), n) + np.arange(len(rule))]
        s[place] = top + rule
        keep = np.ones(len(s), dtype=bool)
        keep[place + 1] = False
        s, top = s[keep], top + len(picked)
        if len(place) < gain * len(ids):
            break
    return s, np.concatenate(rules).astype("<u4"), spans[base:].astype("<u4"), base


def expand(s: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that the symbols stand for."""
    s = s.astype(np.int64)
    while len(s):
        pair = s >= base
        if not pair.any():
            break
        out = np.repeat(s, 1 + pair)
        left = np.cumsum(1 + pair)[pair] - 2
        of = rules[s[pair] - base]
        out[left], out[left + 1] = of[:, 0], of[:, 1]
        s = out
    return s.astype("<u4")


def expand_all(s: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """The same for many symbols: every rule is expanded once."""
    table, at = np.empty(base + int(lengths.sum()), dtype="<u4"), base
    table[:base] = np.arange(base)
    begin = np.concatenate([np.arange(base), base + np.cumsum(lengths, dtype=np.int64) - lengths])
    size = np.concatenate([np.ones(base, np.int64), lengths.astype(np.int64)])
    for a, b in rules.tolist():
        for x in (a, b):
            table[at:at + size[x]] = table[begin[x]:begin[x] + size[x]]
            at += size[x]
    s = s.astype(np.int64)
    n = size[s]
    upto = np.cumsum(n)
    return table[np.repeat(begin[s] - (upto - n), n) + np.arange(int(upto[-1]) if len(upto) else 0)]


def _shard(part: int, shard: int, docs: list, ids: list[bytes], end_id: int) -> dict:
    whole = np.frombuffer(b"".join(ids), dtype="<u4")
    s, rules, lengths, base = compress(whole, end_id)
    size = np.ones(len(s), dtype=np.int64)
    size[s >= base] = lengths[s[s >= base] - base]
    ends = np.searchsorted(np.cumsum(size), np.cumsum([len(x) // 4 for x in ids])) + 1
    width = 2 if base + len(rules) <= 1 << 16 else 4
    return {"part": part, "shard": shard, "base": base, "width": width, "rules": rules.tobytes(),
            "lengths": lengths.tobytes(), "symbols": s.astype(f"<u{width}").tobytes(), "doc_ids": docs,
            "ends": ends.tolist(), "n_ids": len(whole)}


@tidy
def _write(batches, path: str, end_id: int, shard_ids: int):
    enc, part = encoder(path), TaskContext.get().partitionId()
    docs, ids, held, shard = [], [], 0, 0
    emit = lambda: pa.RecordBatch.from_pylist([_shard(part, shard, docs, ids, end_id)], schema=_ARROW)
    for b in batches:
        names = b.column(0).to_pylist()
        for i in range(0, len(names), GROUP):
            found, ends = enc.flat(b.column(1).slice(i, GROUP).to_pylist())
            data, last = np.insert(found, ends, end_id).tobytes(), 0
            for doc, end in zip(names[i:i + GROUP], (ends + np.arange(1, len(ends) + 1)).tolist()):
                docs.append(doc)
                ids.append(data[4 * last:4 * end])
                held, last = held + end - last, end
                if held >= shard_ids:
                    yield emit()
                    docs, ids, held, shard = [], [], 0, shard + 1
    if docs:
        yield emit()


def encode_shards(docs: DataFrame, end_id: int = END_ID, shard_ids: int = SHARD_IDS, path: str | None = None) -> DataFrame:
    """Shard rows of ``docs(doc_id, text)``, to be written as Parquet.  Null
    texts are empty; null ids come first; rows with one id are ordered by text;
    an empty table has no shards; other columns are ignored."""
    path = path or vocabulary_path("word_bpe_49k.json")
    rows = lead(docs, "doc_id", "text").withColumn("h", F.xxhash64("text"))
    dealt = rows.repartitionByRange(parts(docs.sparkSession), "doc_id", "h").sortWithinPartitions("doc_id", "h")
    return dealt.mapInArrow(partial(_write, path=path, end_id=end_id, shard_ids=shard_ids), SHARDS)


def decode_document(shard: dict, k: int) -> np.ndarray:
    """Ids of the shard's k-th document, from its own symbols alone."""
    s = np.frombuffer(shard["symbols"], dtype=f"<u{shard['width']}")
    begin = shard["ends"][k - 1] if k else 0
    return expand(s[begin:shard["ends"][k]], np.frombuffer(shard["rules"], dtype="<u4").reshape(-1, 2), shard["base"])


@tidy
def _read(batches):
    for b in batches:
        for row in b.to_pylist():
            s, base = np.frombuffer(row["symbols"], dtype=f"<u{row['width']}"), row["base"]
            lengths = np.frombuffer(row["lengths"], dtype="<u4")
            size = np.ones(len(s), dtype=np.int64)
            size[s >= base] = lengths[s[s >= base].astype(np.int64) - base]
            stop = np.cumsum(size)[np.array(row["ends"]) - 1]
            start = np.concatenate([[0], stop[:-1]])
            ids = memoryview(expand_all(s, np.frombuffer(row["rules"], dtype="<u4").reshape(-1, 2), lengths, base)).cast("B")
            sums = [crc(ids[4 * a:4 * z]) for a, z in zip(start.tolist(), stop.tolist())]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": row["doc_ids"], "start": start + row["before"], "n_tokens": stop - start, "ids_crc32": sums},
                schema=pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                                  ("ids_crc32", pa.int64())]))


def read_documents(shards: DataFrame) -> DataFrame:
    """Per document of the shard files: doc_id, start (ids before it),
    n_tokens, ids_crc32 of the decoded ids."""
    sizes = shards.select("part", "shard", "n_ids")
    total = sizes.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = total.select("part", before("ids", Window.orderBy("part")).alias("earlier"))
    sizes = sizes.select("part", "shard", before("n_ids", Window.partitionBy("part").orderBy("shard")).alias("inside"))
    place = sizes.join(total, "part").select("part", "shard", (F.col("earlier") + F.col("inside")).alias("before"))
    return shards.join(place, ["part", "shard"]).select(
        "base", "width", "rules", "lengths", "symbols", "doc_ids", "ends", "before").mapInArrow(
        _read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, **options) -> DataFrame:
    """Encode, write the shard files to the shared folder, read them back."""
    return read_documents(saved(encode_shards(docs, **options), "shards"))
