"""Token ids of whole texts with a public vocabulary file, cached by word.

No token crosses white space, so a text's ids are those of its white-space
separated chunks one after the other.  Each distinct chunk is encoded once by
the ``tokenizers`` library and then looked up: the distinct chunks of a few
thousand texts are found by Arrow, and known ones by two 64-bit hashes in sorted
arrays, so no Python string is made for a chunk seen before.  Texts that name a
special token, or hold characters whose case or white-space rules could depend
on the library's Unicode version, keep their case and are split at ASCII white
space only, so the library itself decides.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: characters for which Python's lower() and split() provably agree with the
#: tokenizer's own normalisation (tested code point by code point)
_ODD = re.compile("[^\x00-\x1b\x20-\x84\x86-\x9f\xa1-ɏ]|<\\|")
_CHUNK = re.compile("[^ \t\n\r\x0b\x0c]+")
_LETTERS = re.compile("([a-zß-öø-ÿ]+)([.,;:!?]*)")
#: chunks kept per Python worker, 40 bytes each; beyond it they are learnt anew (a memory bound, it changes no result)
CACHE_CHUNKS = 1_500_000
#: new chunks gathered before they join the known ones
RECENT = 60_000
#: texts looked up at once
GROUP = 1024
#: bytes up to which a chunk is kept
LONGEST = 4096
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_POWERS = [np.array([pow(b, k, 1 << 64) for k in range(1, LONGEST + 1)], dtype=np.uint64) for b in _BASES]


def _odd(text: str) -> bool:
    """``_ODD.search``, by quick tests where they decide."""
    if "<|" in text or any(c in text for c in "\x1c\x1d\x1e\x1f\x85\xa0"):
        return True
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
        return False
    except UnicodeEncodeError:
        return _ODD.search(text) is not None


def chunk_hashes(chunks: pa.LargeStringArray, hashes: int = 1) -> list[np.ndarray]:
    """So many independent 64-bit hashes of every string (0 for empty ones), by array operations."""
    offsets = np.frombuffer(chunks.buffers()[1], dtype=np.int64)[chunks.offset:chunks.offset + len(chunks) + 1]
    length = np.diff(offsets)
    some, out = np.flatnonzero(length), [np.zeros(len(chunks), np.uint64) for _ in range(hashes)]
    if len(some):
        n = length[some]
        begin = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(begin, n)
        # the strings lie one after the other, the empty ones take no place
        code = np.frombuffer(chunks.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]].astype(np.uint64) + np.uint64(1)
        if n.max() > LONGEST:
            place %= LONGEST
        for k in range(hashes):
            h = np.add.reduceat(code * _POWERS[k][place], begin)
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            out[k][some] = h ^ (h >> np.uint64(29))
    return out


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class _Known:
    """Chunks by two hashes, in order of the first: where their ids begin and how many they are."""

    def __init__(self):
        self.keys = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def find(self, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(which of the ordered keys are known, their places here)."""
        if not len(self.begin):
            return np.zeros(len(keys[0]), bool), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys[0], keys[0]), len(self.begin) - 1)
        hit = (self.keys[0][at] == keys[0]) & (self.keys[1][at] == keys[1])
        return hit, at[hit]

    def add(self, keys: list[np.ndarray], begin: np.ndarray, size: np.ndarray) -> None:
        keys = [np.concatenate([a, b]) for a, b in zip(self.keys, keys)]
        order = np.argsort(keys[0], kind="stable")
        self.keys = [k[order] for k in keys]
        self.begin, self.size = np.concatenate([self.begin, begin])[order], np.concatenate([self.size, size])[order]


class WordEncoder:
    """``flat(texts)`` gives the ids of all texts one after the other and the
    number of ids up to the end of each; ``encode(texts)`` each text's ids as
    little-endian unsigned 32-bit bytes (null: no ids)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers import pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        # a run of lower-case letters is left as it is by the file's
        # normaliser and splitter, so these may be skipped for it
        self.bare = Tokenizer(self.tok.model)  # the same model, not a second copy
        self.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.marks: dict[str, bytes] = {}  # punctuation behind words
        self._forget()

    def _forget(self) -> None:
        self.known, self.recent, self.table = _Known(), _Known(), np.zeros(0, "<u4")

    def _library(self, tok, chunks: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for i in range(0, len(chunks), 4096)
                for e in tok.encode_batch_fast(chunks[i:i + 4096], add_special_tokens=False)]

    def _encoded(self, chunks: list[str]) -> list[bytes]:
        """Ids of new chunks: "word." is put together from "word" and ".", so
        the library sees each run of letters once."""
        split = [_LETTERS.fullmatch(c) for c in chunks]
        both = [m for m in split if m and m[2]]
        bare = iter(self._library(self.bare, [c for c, m in zip(chunks, split) if m and not m[2]]))
        rest = iter(self._library(self.tok, [c for c, m in zip(chunks, split) if m is None]))
        of: dict[str, bytes] = {}
        if both:
            runs, marks = list({m[1] for m in both}), list({m[2] for m in both} - self.marks.keys())
            self.marks.update(zip(marks, self._library(self.tok, marks)))
            begin, size = self._found(pa.array(runs, type=pa.large_string()))
            data = memoryview(self.table).cast("B")
            of = {r: bytes(data[4 * a:4 * (a + n)]) for r, a, n in zip(runs, begin.tolist(), size.tolist())}
        return [next(rest) if m is None else of[m[1]] + self.marks[m[2]] if m[2] else next(bare) for m in split]

    def _found(self, chunks: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, size) in ``table`` of the ids of distinct chunks."""
        offsets = np.frombuffer(chunks.buffers()[1], dtype=np.int64)[chunks.offset:chunks.offset + len(chunks) + 1]
        length = np.diff(offsets)
        begin, size = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        some = np.flatnonzero((length > 0) & (length <= LONGEST))
        rest = np.flatnonzero(length > LONGEST)
        keys = [np.zeros(0, np.uint64)] * 2
        if len(some):
            keys = [h[some] for h in chunk_hashes(chunks, 2)]
            order = np.argsort(keys[0], kind="stable")
            keys, some = [h[order] for h in keys], some[order]
            for known in (self.known, self.recent):
                hit, at = known.find(keys)
                begin[some[hit]], size[some[hit]] = known.begin[at], known.size[at]
                keys, some = [h[~hit] for h in keys], some[~hit]
        new = np.concatenate([some, rest])
        if len(new):
            found = self._encoded(chunks.take(pa.array(new)).to_pylist())
            n = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
            size[new], begin[new] = n, len(self.table) + np.cumsum(n) - n
            self.table = np.concatenate([self.table, np.frombuffer(b"".join(found), dtype="<u4")])
            # the long ones stay for this call only: nothing points to them afterwards
            self.recent.add(keys, begin[some], size[some])
            if len(self.recent.begin) > RECENT:
                self.known.add(self.recent.keys, self.recent.begin, self.recent.size)
                self.recent = _Known()
        return begin, size

    def flat(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        texts = [t or "" for t in texts]
        odd = {i for i, t in enumerate(texts) if _odd(t)}
        lists = pc.ascii_split_whitespace(pa.array([t.lower() for t in texts], type=pa.large_string()))
        if odd:
            lists = pa.array([_CHUNK.findall(t) if i in odd else c for i, (t, c) in enumerate(zip(texts, lists.to_pylist()))], type=pa.large_list(pa.large_string()))
        if len(self.known.begin) + len(self.recent.begin) > CACHE_CHUNKS:
            self._forget()
        coded = lists.flatten().dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        begin, size = self._found(coded.dictionary)
        size = size[code]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.table[np.repeat(begin[code] - upto[:-1], size) + np.arange(upto[-1])]
        return ids, upto[lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()]

    def encode(self, texts: list) -> list[bytes]:
        out = []
        for i in range(0, len(texts), GROUP):
            ids, ends = self.flat(texts[i:i + GROUP])
            data = ids.tobytes()
            out += [data[4 * a:4 * z] for a, z in zip([0, *ends[:-1].tolist()], ends.tolist())]
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
