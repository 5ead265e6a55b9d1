"""Spelling variant grouping by composing finite-state machines.

The vocabulary, as a minimised acceptor, is composed with a transducer that
makes exactly one edit and with the acceptor again; the accepted pairs are the
words one edit apart.  The composition runs per initial state: a partition holds
the words that leave the same state, so the machines of a task are small.

Partitions.  Take two words one edit apart, the shorter of ``a`` letters, and
let ``h = a // 2``.  Either they share their first ``h`` letters, and the
composition starts at the state those lead to (forwards), or they share the last
``a - h``, and it starts at the state those lead to in the reversed acceptor.
Every word enters four partitions, two as the shorter and two as the longer
word.  The first place at which a pair differs decides which of the two finds
it, so each pair is found once.  Partitions beyond ``WORDS`` are split again by
the same rule on what is left of their words, until they are small: what is left
ends at one letter, or two, of which the 90 letters of runs give 8,190 at most.
So a beginning that a third of the vocabulary shares is no hot task.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lead, saved
from .decontaminate import ascii_lower

LETTERS, COUNT, RATIO, DROP = 6, 5, 5, 199
#: words of one composition (a memory bound; more are split further)
WORDS = 4096
_BETWEEN = r"[^A-Za-zÀ-ÿ]+"


def vocabulary(docs: DataFrame, letters: int = LETTERS, count: int = COUNT, drop: int | None = DROP) -> DataFrame:
    """(word, n): the runs of letters of ``docs(doc_id, text)`` with their counts.
    Where ``drop`` divides the checksum of id and run, the run has lost a letter."""
    runs = lead(docs, "doc_id", "text").where("text is not null").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.split(ascii_lower(F.col("text")), _BETWEEN)).alias("run"))
    runs = runs.where(F.char_length("run") >= letters)
    if drop:
        runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
        at = (F.col("h") % F.char_length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
        runs = runs.select(F.when(F.col("h") % drop == 0, cut).otherwise(F.col("run")).alias("run")).where(F.char_length("run") >= letters)
    return runs.groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= count)


# -- partitions ------------------------------------------------------------------

def _halves(short: Column) -> Column:
    """The two partitions of a word (or of what is left of it, ``rest``) beside a
    shorter word whose own rest has ``short`` letters: ``left`` and ``right`` are
    the letters shared, ``inner`` excludes pairs that differ by an appended letter only."""
    head = F.floor(short / 2).cast("int")
    tail, size = short - head, F.char_length("rest")
    return F.array(
        F.struct((short - head).alias("short"), F.concat("left", F.substring("rest", F.lit(1), head)).alias("left"), F.col("right").alias("right"),
                 F.col("inner").alias("inner"), F.substring("rest", head + 1, size).alias("rest")),
        F.struct(head.alias("short"), F.col("left").alias("left"), F.concat(F.substring("rest", size - tail + 1, tail), "right").alias("right"),
                 F.lit(True).alias("inner"), F.substring("rest", F.lit(1), size - tail).alias("rest")))


_KEY = ["short", "left", "right", "inner"]


def partitions(words: DataFrame, letters: int = LETTERS, most: int = WORDS) -> DataFrame:
    """(short, left, right, inner, rest, n): every word in the partitions where its pairs can be."""
    size = F.char_length("word")
    start = words.select("n", F.lit("").alias("left"), F.lit("").alias("right"), F.lit(False).alias("inner"), F.col("word").alias("rest"),
                         F.explode(F.array(size, size - 1)).alias("of")).where(F.col("of") >= letters)
    step = lambda df, short: df.select("n", F.explode(_halves(F.col(short))).alias("p")).select("p.*", "n")
    open_, done = saved(step(start, "of"), "word-parts"), None
    while True:
        big = saved(open_.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("size")).where((F.col("size") > most) & (F.col("short") > 1)).drop("size"), "large-parts")
        if big.isEmpty():
            return open_ if done is None else done.union(open_)
        small = open_.join(big, _KEY, "left_anti")
        done = small if done is None else done.union(small)
        open_ = saved(step(open_.join(big, _KEY, "left_semi"), "short"), "word-parts")


# -- machines --------------------------------------------------------------------

class Acceptor:
    """Minimal acyclic acceptor of sorted distinct words: ``arcs[state]`` lists (letter, state), ``final`` the accepting states."""

    def __init__(self, words: list[str]):
        self.arcs, self.final, known = [], set(), {}
        path, last = [[False, []]], ""  # open states along the last word: accepting, arcs

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                state = path.pop()
                key = (state[0], *state[1])
                if key not in known:
                    known[key] = len(self.arcs)
                    self.arcs.append(state[1])
                    if state[0]:
                        self.final.add(known[key])
                path[-1][1].append((last[len(path) - 1], known[key]))

        for w in words:
            same = 0
            while same < len(last) and same < len(w) and last[same] == w[same]:
                same += 1
            close(same)
            last = w
            path += [[False, []] for _ in range(len(w) - same)]
            path[-1][0] = True
        close(0)
        self.start = len(self.arcs)
        self.arcs.append(path[0][1])
        if path[0][0]:
            self.final.add(self.start)


def one_edit(machine: Acceptor, inner: bool, short: int):
    """Accepted pairs of acceptor, one-edit transducer, acceptor: u of ``short``
    letters and v one letter longer, or as long and greater.  Up to the edit both acceptors are in
    one state; behind it in two, which read the same letters.  An insertion
    counts at the last place where it can stand, so each pair comes once;
    ``inner`` leaves out the letters appended to u."""
    arcs, final = machine.arcs, machine.final

    def both(p: int, q: int, not_first: str | None, u: str, v: str):
        left = short - len(u)
        todo = [(p, q, "")]
        while todo:
            p, q, tail = todo.pop()
            if len(tail) == left:
                if p in final and q in final and (tail or not inner or not_first is None):
                    yield u + tail, v + tail
            elif p == q:
                todo += [(a, a, tail + c) for c, a in arcs[p] if tail or c != not_first]
            else:
                to = dict(arcs[q])
                todo += [(a, to[c], tail + c) for c, a in arcs[p] if c in to and (tail or c != not_first)]

    open_ = [(machine.start, "")]
    while open_:
        state, read = open_.pop()
        out = arcs[state]
        for i, (c, a) in enumerate(out):
            open_.append((a, read + c))
            for d, b in out[i + 1:]:
                yield from both(a, b, None, read + c, read + d)  # c becomes d (arcs are in letter order)
            yield from both(state, a, c, read, read + c)  # c comes in


def _compose(batches):
    schema = pa.schema([("u", pa.string()), ("n_u", pa.int64()), ("v", pa.string()), ("n_v", pa.int64())])

    def pairs(key, members: dict[str, int]):
        short, left, right, inner = key
        for u, v in one_edit(Acceptor(sorted(members)), inner, short):
            yield left + u + right, members[u], left + v + right, members[v]

    def told(rows: list):
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows) if rows else [[]] * 4, schema)], schema=schema)

    out, key, members = [], None, {}
    for b in batches:
        short, left, right, inner, rest, n = (c.to_pylist() for c in b.columns)
        for k, r, m in zip(zip(short, left, right, inner), rest, n):
            if k != key:
                if len(members) > 1:
                    out += pairs(key, members)
                    if len(out) > 20_000:
                        yield told(out)
                        out = []
                key, members = k, {}
            members[r] = m
    if len(members) > 1:
        out += pairs(key, members)
    yield told(out)


def near_words(words: DataFrame, letters: int = LETTERS, most: int = WORDS) -> DataFrame:
    """(u, n_u, v, n_v): every two of ``words(word, n)`` that are one edit apart, once."""
    dealt = partitions(words, letters, most).select(*_KEY, "rest", "n").repartition(*_KEY).sortWithinPartitions(*_KEY)
    return dealt.mapInArrow(_compose, "u string, n_u long, v string, n_v long")


def variants(docs: DataFrame, letters: int = LETTERS, count: int = COUNT, ratio: int = RATIO, drop: int | None = DROP, most: int = WORDS) -> DataFrame:
    """One row per word of ``docs(doc_id, text)``: ``word``, ``form`` (its near word
    of largest n, the first in code-point order of several, if that n reaches
    ``ratio`` times its own; else null), ``root`` (the end of the chain of
    forms), ``n``, ``n_near``, ``form_n``.

    Null texts have no words, null ids count as empty text, repeated rows and
    copies count again, runs of any length are words; an empty table gives no
    rows; other columns are ignored."""
    words = saved(vocabulary(docs, letters, count, drop), "vocabulary")
    pairs = near_words(words, letters, most)
    ends = pairs.select(F.explode(F.array(F.struct(F.col("u").alias("word"), F.col("v").alias("near"), F.col("n_v").alias("near_n")),
                                          F.struct(F.col("v").alias("word"), F.col("u").alias("near"), F.col("n_u").alias("near_n")))).alias("e")).select("e.*")
    best = ends.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    strong = -F.col("best.n") >= F.col("n") * ratio
    forms = saved(words.join(best, "word", "left").select(
        "word", F.when(strong, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(strong, -F.col("best.n")).alias("form_n")), "forms")
    # the chain doubles its reach each round; a step multiplies n by `ratio`, so there are few
    chain = saved(forms.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        on = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        chain = saved(chain.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if chain.where("moved").isEmpty():
            break
        chain = chain.drop("moved")
    return forms.join(chain.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
