"""Personal data: base patterns, and boosted trees over candidate spans.

Everything that touches the rows is a DataFrame expression: regular expressions
split a text into what lies between the matches, and running sums of lengths
give the spans in code points.

* Base spans: e-mail, ip, card and phone by fixed patterns and checks (parts
  of an address at most 255, digit counts, Luhn); they always stay.
* Generators propose more, overlapping spans with high recall: addresses with
  "(at)" and "(dot)", and of every chain of digit groups each part that begins
  and ends with a group and holds 7 to 19 digits (or four groups like an ip), so
  of neighbouring numbers each is proposed by itself, whatever parts them.
* Each candidate has a few small features of format (digits, groups, separator,
  brackets) and context (key words, what stands before it, what follows).  What
  makes a candidate known is no feature of its kind, so the trees learn what
  personal data look like from known candidates against the rest.  Known are an
  address with "@" or a letter ending, an ip with parts up to 255, a card that
  passes Luhn, a phone with a plus sign or in a chain right after a key word
  (context is no feature of phones), the last two only where the number ends.
  Counts per feature combination over all candidates of all rows (at most a few
  thousand combinations, a product of small ranges) are all the trees need.
* The rest are not errors but unlabelled: where a share ``c`` of personal data is
  known, a combination with a share ``g`` of known candidates holds g / c of
  personal data (Elkan and Noto; c is the mean g over known candidates).
  Thresholds per kind are calibrated so on rows kept from the trees: the lowest
  score from which on at least ``PRECISION`` of the candidates are personal data
  by that measure, and never one below even odds (none if there is no such score).  The scores of the accepted feature
  combinations become a lookup table.
* Accepted candidates that touch a base span go; of overlapping ones the best
  score stays.  Both are sweeps in order of place, and lists grow in chunks, so a
  text of many numbers takes time in proportion.

Patterns use possessive quantifiers and start conditions that match exactly
where the plain ones do, so long runs of letters or digits take linear time.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.util import deep_expressions

KINDS = ("email", "ip", "card", "phone")
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: candidates
_AT, _DOT = r"(?:@|\x20?[(\[]at[)\]]\x20?)", r"(?:\.|\x20?[(\[]dot[)\]]\x20?)"
MAIL_LIKE = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++{_AT}{_HOST}++(?:{_DOT}{_HOST}++)++"
#: what may stand between the digit groups of one chain; where a phone of the base pattern would go on
_LINK, _ON = r"^[\x20().,:/+-]{1,3}$", r"^[\x20().-]+$"
DIGITS = 19
#: key words before a candidate, by kind
CONTEXT = (r"mail|contact|write", r"\bip\b|host|server|address", r"card|visa|credit|debit|payment", r"phone|tel|call|fax|mobile|cell")
#: a key word right before a phone
CALLED = r"\b(?:tele)?(?:phone|tel|call|fax|mobile|cell)\b(?:[\x20.:]|\bat\b|\bus\b|\bme\b|\bon\b|\bno\b|\bnumber\b|\bis\b){0,6}$"
TREES, RATE, PRECISION, LEAST = 24, 0.3, 0.95, 20
#: share of other candidates that pass the check of their kind by chance (one number in ten passes Luhn)
CHANCE = (0.0, 0.0, 0.1, 0.0)
FEATURES = ("digits", "groups", "mark", "bracket", "context", "edge", "tail")
#: elements folded at once, so that a growing list is not copied for each of them
CHUNK = 256
_SPAN = "struct<start:int,end:int,value:string,before:string,gap:int>"
_FOUND = "struct<kind:int,start:int,end:int," + ",".join(f"{f}:int" for f in FEATURES) + ",good:boolean>"
_EVENT = "struct<start:int,cand:int,end:int,score:double,rank:int,kind:int>"


def _none(of: str) -> Column:
    return F.expr(f"cast(array() as array<{of}>)")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def _fold(items: Column, state: Column, step, of: str) -> Column:
    """Struct of the last state ``st`` and the list ``out`` of what ``step(state,
    item)``, a struct of the next ``st`` and a short list ``out``, gave out."""

    def one(acc, x):
        return _let(step(acc["st"], x), lambda n: F.struct(n["st"].alias("st"), F.concat(acc["out"], n["out"]).alias("out")))

    def whole(a):
        def chunk(acc, k):
            part = F.aggregate(F.slice(a, k * CHUNK + 1, CHUNK), F.struct(acc["st"].alias("st"), _none(of).alias("out")), one)
            return _let(part, lambda p: F.struct(p["st"].alias("st"), F.array_append(acc["out"], p["out"]).alias("out")))

        chunks = F.transform(F.array_repeat(F.lit(0), F.ceil(F.size(a) / CHUNK).cast("int")), lambda x, i: i)
        return F.aggregate(chunks, F.struct(state.alias("st"), _none(f"array<{of}>").alias("out")), chunk,
                           lambda acc: F.struct(acc["st"].alias("st"), F.flatten(acc["out"]).alias("out")))

    return _let(items, whole)


def _spans(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value, before, gap>> of the matches, in code
    points; gap: distance from the match before, before: its last characters."""
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def step(at, x):
        gap = F.length(x["piece"])
        end = at + gap + F.coalesce(F.length(x["match"]), F.lit(0))
        span = F.struct((at + gap).alias("start"), end.alias("end"), x["match"].alias("value"), F.right(x["piece"], F.lit(24)).alias("before"), gap.alias("gap"))
        return F.struct(end.alias("st"), F.when(x["match"].isNull(), _none(_SPAN)).otherwise(F.array(span)).alias("out"))

    both = F.zip_with(pieces, found, lambda p, m: F.struct(p.alias("piece"), m.alias("match")))
    return _fold(both, F.lit(0), step, _SPAN)["out"]


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn: from the right, every second
    digit doubled and its digits summed; the sum ends in 0."""
    each = F.split(F.reverse(digits), "")
    value = lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2))
    return F.aggregate(F.transform(each, lambda d, i: value(d.cast("int"), i)), F.lit(0), lambda a, x: a + x) % 10 == 0


def _base(text: Column) -> Column:
    """All base spans: array<struct<kind, start, end>>, by kind, then start."""
    n = lambda s: F.length(_digits(s["value"]))
    part = r"^0*+(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])?$"
    small = lambda s: F.forall(F.split(s["value"], r"\."), lambda p: p.rlike(part))
    kept = (
        (F.contains(text, F.lit("@")), EMAIL, lambda s: F.lit(True)),
        (text.rlike(r"[0-9]\.[0-9]"), IP, small),
        (text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"), CARD, lambda s: n(s).between(13, 19) & luhn(_digits(s["value"]))),
        (F.contains(text, F.lit("+")), PHONE, lambda s: n(s).between(9, 15)),
    )
    none = F.expr("cast(array() as array<struct<kind:int,start:int,end:int>>)")
    as_kind = lambda k: lambda s: F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    return F.concat(*[F.when(may, F.transform(F.filter(_spans(text, pattern), ok), as_kind(k))).otherwise(none)
                      for k, (may, pattern, ok) in enumerate(kept)])


def _context(before: Column) -> Column:
    """Per kind: 2 a key word of the kind, 1 one of another kind, 0 none."""
    low = F.lower(before)
    return F.when(low.rlike("|".join(CONTEXT)), F.array(*[F.when(low.rlike(c), 2).otherwise(1) for c in CONTEXT])).otherwise(F.array(*[F.lit(0)] * len(CONTEXT)))


def _edge(before: Column) -> Column:
    return F.when(before == "", 0).when(before.rlike(r"[\x20\n]$"), 1).when(before.rlike(r"[\x09-\x0D(:\[\"'<]$"), 2).otherwise(3)


def _found(kind: int, s: Column, good: Column, **features) -> Column:
    zero = {f: F.lit(0) for f in FEATURES} | features
    return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), *[zero[f].cast("int").alias(f) for f in FEATURES], good.alias("good"))


def _mails(text: Column) -> Column:
    found = F.transform(_spans(text, MAIL_LIKE), lambda s: _found(
        0, s, s["value"].contains("@") | s["value"].rlike("[A-Za-z]{2}$"), context=_context(s["before"])[0], edge=_edge(s["before"])))
    return F.when(text.rlike(r"@|[(\[]at[)\]]"), found).otherwise(_none(_FOUND))


def _numbers(text: Column) -> Column:
    """Candidates from every chain of digit groups."""
    # 0 no chain, 1 a list goes on, 2 the number may go on
    link = lambda a: F.when(a.isNull() | (a["gap"] > 3) | ~a["before"].rlike(_LINK), 0).when(a["before"].rlike("[,/:+]"), 1).otherwise(2)

    def told(atoms):
        """Digit groups with their links to both sides, and whether a key word of phones stands before their chain."""

        def call(was, a):
            now = F.when(link(a) > 0, was).otherwise(F.lower(F.regexp_replace(a["before"], "[+(]$", "")).rlike(CALLED))
            return F.struct(now.alias("st"), F.array(now).alias("out"))

        return _let(_fold(atoms, F.lit(False), call, "boolean")["out"], lambda called: F.transform(atoms, lambda a, i: F.struct(
            a["start"].alias("start"), a["end"].alias("end"), a["value"].alias("value"), a["before"].alias("before"), F.get(called, i).alias("called"),
            F.when(i == 0, 0).otherwise(link(a)).alias("link"), link(F.get(atoms, i + 1)).alias("tail"),
            F.coalesce(F.get(atoms, i + 1)["before"].rlike(_ON), F.lit(False)).alias("on"))))

    def chains(groups):
        return F.flatten(F.transform(groups, lambda g, i: F.when(g["before"].rlike("[0-9A-Za-z]$"), _none(_FOUND)).otherwise(parts(groups, g, i))))

    def parts(groups, g, i):
        """Of all parts that begin with group g, those with an admissible number of digits."""
        sign = F.when(g["before"].rlike("[+(]$"), F.right(g["before"], F.lit(1))).otherwise("")
        begin = F.struct(F.lit(True).alias("open"), F.lit(0).alias("n"), F.lit(0).alias("groups"), sign.alias("value"), F.lit("").alias("inner"),
                         F.array().cast("array<struct<n:int,groups:int,value:string,inner:string,end:int,tail:int,on:boolean>>").alias("out"))

        def step(acc, a):
            n, first = acc["n"] + F.length(a["value"]), acc["groups"] == 0
            gap = F.when(first, "").otherwise(a["before"])
            value, inner = F.concat(acc["value"], gap, a["value"]), F.concat(acc["inner"], gap)
            part = F.struct(n.alias("n"), (acc["groups"] + 1).alias("groups"), value.alias("value"), inner.alias("inner"), a["end"].alias("end"), a["tail"].alias("tail"), a["on"].alias("on"))
            fits = (n >= 7) | (acc["groups"] == 3)
            more = F.struct(F.lit(True).alias("open"), n.alias("n"), (acc["groups"] + 1).alias("groups"), value.alias("value"), inner.alias("inner"),
                            F.when(fits, F.array_append(acc["out"], part)).otherwise(acc["out"]).alias("out"))
            shut = F.struct(F.lit(False).alias("open"), acc["n"].alias("n"), acc["groups"].alias("groups"), acc["value"].alias("value"), acc["inner"].alias("inner"), acc["out"].alias("out"))
            return F.when(acc["open"] & (first | (a["link"] > 0)) & (n <= DIGITS), more).otherwise(shut)

        whole = F.aggregate(F.slice(groups, i + 1, DIGITS), begin, step, lambda acc: acc["out"])
        start = g["start"] - F.length(sign)
        before = F.substring(g["before"], F.lit(1), F.length(g["before"]) - F.length(sign))
        facts = F.struct(start.alias("start"), F.when(g["link"] == 2, 5).when(g["link"] == 1, 4).otherwise(_edge(before)).alias("edge"),
                         _context(before).alias("context"), (g["called"] & (g["link"] < 2)).alias("called"))
        return F.when(F.size(whole) > 0, _let(facts, lambda f: F.flatten(F.transform(whole, lambda p: kinds(p, f))))).otherwise(_none(_FOUND))

    def kinds(p, f):
        span = F.struct(f["start"].alias("start"), p["end"].alias("end"))
        marks = F.translate(p["inner"], "()", "")
        mark = F.when(marks == "", 0).when(marks.rlike(r"^\x20+$"), 1).when(marks.rlike("^-+$"), 2).when(marks.rlike(r"^\.+$"), 3).otherwise(4)
        same = dict(digits=sum((F.when(p["n"] > c, 1).otherwise(0) for c in (6, 8, 9, 10, 11, 12, 15, 16)), F.lit(0)), groups=F.least(p["groups"], F.lit(5)),
                    mark=mark, bracket=p["value"].contains("(").cast("int"), edge=f["edge"], tail=p["tail"])
        ended = ~p["on"]
        ip = F.when((p["groups"] == 4) & p["value"].rlike(r"^[(+]?[0-9]{1,3}[.,:-][0-9]{1,3}[.,:-][0-9]{1,3}[.,:-][0-9]{1,3}$"), F.array(_found(
            1, span, p["value"].rlike(r"^(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(?:\.|$)){4}$"), context=f["context"][1], **same))).otherwise(_none(_FOUND))
        card = F.when(p["n"] >= 13, F.array(_found(2, span, ended & luhn(_digits(p["value"])), context=f["context"][2], **same))).otherwise(_none(_FOUND))
        phone = F.when(p["n"].between(7, 15), F.array(_found(3, span, ended & (((p["n"] >= 9) & p["value"].startswith("+")) | (f["called"] & ~p["inner"].rlike("[,+]"))), **same))).otherwise(_none(_FOUND))
        return F.concat(ip, card, phone)

    found = _let(_spans(text, "[0-9]++"), lambda atoms: _let(told(atoms), chains))
    return F.when(text.rlike("[0-9](?:[^0-9]{0,3}[0-9]){3}"), found).otherwise(_none(_FOUND))


def _marked(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.struct("*").alias("row")).withColumn("text", F.coalesce("row.text", F.lit("")))
    with deep_expressions(docs.sparkSession):
        return rows.withColumn("base", _base(F.col("text"))).withColumn("found", F.concat(_mails(F.col("text")), _numbers(F.col("text"))))


class Trees:
    """Boosted trees of two levels on integer features, weighted by counts."""

    def __init__(self, x: np.ndarray, good: np.ndarray, bad: np.ndarray):
        n = np.maximum(good + bad, 1e-9)
        self.start = float(np.log((good.sum() + 1) / (bad.sum() + 1)))
        self.trees, f = [], np.full(len(x), self.start)
        cuts = [(c, int(v)) for c in range(x.shape[1]) for v in np.unique(x[:, c])[:-1]]
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-f))
            g, h = good - n * p, n * p * (1 - p)

            def gain(rows):
                return g[rows].sum() ** 2 / (h[rows].sum() + 1)

            def split(rows):
                best = max(((gain(rows & (x[:, c] <= v)) + gain(rows & (x[:, c] > v)), c, v) for c, v in cuts), default=(0, 0, 0))
                return best if best[0] > gain(rows) + 1e-6 else None

            def leaf(rows):
                return float(np.clip(RATE * g[rows].sum() / (h[rows].sum() + 1), -2, 2))

            def grow(rows, depth):
                cut = split(rows) if depth else None
                if cut is None:
                    return leaf(rows)
                low = x[:, cut[1]] <= cut[2]
                return (cut[1], cut[2], grow(rows & low, depth - 1), grow(rows & ~low, depth - 1))

            tree = grow(np.ones(len(x), dtype=bool), 2)
            self.trees.append(tree)
            f = f + np.array([self._value(tree, row) for row in x])

    def _value(self, tree, row) -> float:
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree

    def score(self, row) -> float:
        return self.start + sum(self._value(t, row) for t in self.trees)


def fit(docs: DataFrame) -> dict[int, dict[tuple, float]]:
    """For each kind, the scores of the feature combinations that pass its
    threshold.  Candidates of all rows are counted; one row in five, by id
    hash, is for the thresholds."""
    one = _marked(docs).select(F.pmod(F.xxhash64("row.doc_id"), F.lit(5)).alias("fold"), F.explode("found").alias("c"))
    seen = one.groupBy((F.col("fold") == 0).alias("later"), "c.kind", *[F.col(f"c.{f}") for f in FEATURES]).agg(
        F.sum(F.col("c.good").cast("long")).alias("good"), F.count(F.lit(1)).alias("all")).collect()  # a product of small ranges
    passed: dict[int, dict[tuple, float]] = {}
    for kind in range(len(KINDS)):
        rows = {later: [r for r in seen if r["kind"] == kind and r["later"] == later] for later in (False, True)}
        if not rows[False] or not rows[True]:
            continue
        sure = lambda r: max(0.0, r["good"] - CHANCE[kind] * r["all"]) / (1 - CHANCE[kind])
        x = np.array([[r[f] for f in FEATURES] for r in rows[False]])
        good = np.array([sure(r) for r in rows[False]], dtype=float)
        trees = Trees(x, good, np.array([r["all"] for r in rows[False]], dtype=float) - good)
        judged = sorted(((trees.score([r[f] for f in FEATURES]), sure(r), r["all"]) for r in rows[True]), reverse=True)
        known = sum(ok for _, ok, _ in judged)
        c = sum(ok * ok / every for _, ok, every in judged) / known if known else 1.0
        even = float(np.log(c / (2 - c)))  # the score at g = c / 2
        limit, hits, n = None, 0, 0
        for i, (score, ok, every) in enumerate(judged):
            hits, n = hits + ok, n + every
            if n >= LEAST and score >= even and hits >= PRECISION * c * n and (i + 1 == len(judged) or judged[i + 1][0] < score):
                limit = score
        if limit is not None:
            every = {tuple(r[f] for f in FEATURES) for later in rows.values() for r in later}
            passed[kind] = {f: s for f in every if (s := trees.score(f)) >= limit}
    return passed


def _chosen(found: Column, base: Column, passed: dict) -> Column:
    """Accepted candidates as array<struct<kind, start, end>>."""
    code = lambda c: F.concat_ws(",", c["kind"], *[c[f] for f in FEATURES])
    table = {",".join(map(str, (k, *f))): s for k, scores in passed.items() for f, s in scores.items()}
    none = _none("struct<kind:int,start:int,end:int>")
    if not table:
        return none
    scores = F.create_map(*[F.lit(x) for item in sorted(table.items()) for x in item])
    event = lambda c, cand, score: F.struct(c["start"].alias("start"), F.lit(cand).alias("cand"), c["end"].alias("end"), score.cast("double").alias("score"),
                                            (-c["kind"]).alias("rank"), c["kind"].alias("kind"))
    good = F.filter(F.transform(found, lambda c: event(c, 1, F.element_at(scores, code(c)))), lambda e: e["score"].isNotNull())
    give = lambda state, keep, e: F.struct(state.alias("st"), F.when(keep, F.array(e)).otherwise(_none(_EVENT)).alias("out"))

    def after(end, e):
        """Nothing that begins inside a base span."""
        is_base = e["cand"] == 0
        return give(F.when(is_base, F.greatest(end, e["end"])).otherwise(end), is_base | (e["start"] >= end), e)

    def before(start, e):
        """From the back: nothing that ends inside one; the base spans go."""
        is_base = e["cand"] == 0
        return give(F.when(is_base, F.least(start, e["start"])).otherwise(start), ~is_base & (e["end"] <= start), e)

    def best(held, e):
        """The held span until one that begins behind it, or a better one that overlaps it."""
        order = lambda x: F.struct(x["score"], x["rank"], -x["start"], x["end"])
        apart = e["start"] >= held["end"]
        return give(F.when(apart | (order(e) > order(held)), e).otherwise(held), apart & (held["cand"] == 1), held)

    def sweep(events):
        clear = _fold(events, F.lit(0), after, _EVENT)["out"]
        clear = _fold(F.reverse(clear), F.lit(2**31 - 1), before, _EVENT)["out"]
        nothing = F.lit(0).cast("int")
        start = F.struct(nothing.alias("start"), nothing.alias("cand"), nothing.alias("end"), F.lit(0.0).alias("score"), nothing.alias("rank"), nothing.alias("kind"))
        return _let(_fold(F.reverse(clear), start, best, _EVENT), lambda r: F.concat(r["out"], F.filter(F.array(r["st"]), lambda e: e["cand"] == 1)))

    def chosen(some):
        events = F.array_sort(F.concat(some, F.transform(base, lambda b: event(b, 0, F.lit(0.0)))))
        return F.when(F.size(some) > 0, F.transform(_let(events, sweep), lambda e: F.struct(e["kind"].alias("kind"), e["start"].alias("start"), e["end"].alias("end")))).otherwise(none)

    return F.when(F.size(found) > 0, _let(good, chosen)).otherwise(none)


def find(docs: DataFrame) -> DataFrame:
    """(row, base, spans) for every row of ``docs``: ``row`` holds its columns,
    ``base`` and ``spans`` are arrays of (kind, start, end) by kind, then start;
    kind is a place in ``KINDS``, positions are code points, end exclusive.

    Null texts are empty; empty texts have no spans; a row with a null id is
    like any other; repeated rows get the same spans; an empty table gives no
    rows."""
    passed = fit(docs)
    marked = _marked(docs)
    with deep_expressions(docs.sparkSession):
        return marked.select("row", "base", F.array_sort(F.concat("base", _chosen(F.col("found"), F.col("base"), passed))).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; where spans
    overlap, the first one's kind stands for their union."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        inside = s["start"] < acc["at"]
        add = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.element_at(names, s["kind"] + 1))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(inside, acc["out"]).otherwise(add).alias("out"))

    whole = F.aggregate(by_start, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
