"""Description categorisation (C1–C6) as native expressions.

The catalogue (one prototype vector per category) may hold any number of
categories.  It is kept in blocks of about ``BLOCK`` categories that lie on the
same side of the first axes.  A catalogue of one block is attached to every
description and its members are scored in ``transform`` / ``aggregate``.  With
more blocks, descriptions and blocks are dealt into a grid of cells, each cell
compares its descriptions with its members by matrix products, and the best of
all cells is kept; the members that come near the best are scored again in the
order of the native expression, so both ways give the same scores and ties.
No cell holds more than ``SIDE`` descriptions or (about) ``SIDE`` members.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..sources.files import save_table
from .quality import NEEDS_REVIEW, NO_DESCRIPTION
from .util import broadcast_small, materialize, rnd, with_one_row

THRESHOLD = 0.25
BLOCK = 256
#: members this close to the best are scored again in the native order
SLACK = 1e-9
#: rows of a side of a grid cell: at most, and few enough to use several tasks
SIDE, SMALL_SIDE, SPREAD = 16_384, 512, 8
#: descriptions and (description, member) pairs looked at together inside a cell
TILE, PAIRS = 512, 200_000


def prototypes(vectors: DataFrame, label: str = "label", vec: str = "embedding", name_prefix: str = "categoria_") -> DataFrame:
    """Catalogue from labelled vectors: per label the mean vector; ``idx`` is
    the label's position in ascending order (the catalogue order)."""
    e = vectors.select(label, F.posexplode(vec).alias("pos", "x"))
    m = e.groupBy(label, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    v = m.groupBy(label).agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("_p"))
    return v.select(
        F.concat(F.lit(name_prefix), F.col(label).cast("string")).alias("name"),
        F.col(label).alias("_ord"),
        F.transform("_p", lambda p: p["x"]).alias("vec"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _norm(v: str) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def catalogue_blocks(cats: DataFrame, size: int = BLOCK) -> DataFrame:
    """The catalogue (name, _ord, vec) in blocks: ``block`` and ``members`` (in catalogue
    order, with norms).  Categories without direction are never best."""
    c = cats.select("name", "_ord", "vec", _norm("vec").alias("norm")).where(F.col("norm") > 0)
    total = c.count()
    axes = max(0, math.ceil(math.log2(max(total, 1) / size)))
    c = c.withColumn("cell", F.array_join(F.transform(F.slice("vec", 1, max(axes, 1)), lambda x: F.when(x < 0, "-").otherwise("+")), "") if axes else F.lit(""))
    # cells are cut evenly, so none is larger than a block
    cut = c.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("long").alias("cuts"))
    c = c.join(broadcast_small(cut, total), "cell").withColumn("block", F.struct("cell", F.pmod(F.xxhash64("_ord", "name"), F.col("cuts")).alias("cut")))
    members = c.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("_ord", "name", "vec", "norm"))).alias("members"))
    return materialize(members)


def _best_of(v: str, norm: str) -> Column:
    """(negative score, order, name) of the best member; ties go to the first in catalogue order."""
    scored = F.transform("members", lambda m: F.struct(
        (-F.try_divide(_dot(F.col(v), m["vec"]), F.col(norm) * m["norm"])).alias("neg"), m["_ord"].alias("ord"), m["name"].alias("name")))
    return F.array_min(F.filter(scored, lambda x: x["neg"].isNotNull()))


def _deals(rows: int) -> int:
    """Parts into which a side of ``rows`` rows is dealt."""
    return max(math.ceil(rows / SIDE), min(SPREAD, math.ceil(rows / SMALL_SIDE)), 1)


def _grid_best(q: DataFrame, blocks: DataFrame) -> DataFrame:
    """Per description (``_key``, ``_v``, ``_vn``) and part of the catalogue the best
    member, as ``_best`` (negative score, order, name).  A row goes to one cell per
    part of the other side, so the rows moved grow with the parts, not the pairs."""
    wide, tall = _deals(q.count()), _deals(blocks.agg(F.sum(F.size("members"))).first()[0] or 0)
    part = lambda n, *c: F.pmod(F.xxhash64(*c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = q.select(part(wide, "_key", "_v").alias("_a"), every(tall).alias("_b"), "_key", "_v", "_vn")
    m = blocks.select(part(tall, "block").alias("_b"), F.explode("members").alias("m"))
    right = m.select(every(wide).alias("_a"), "_b", "m._ord", "m.name", "m.vec", "m.norm")
    left, right = (x.repartition(wide * tall, "_a", "_b").groupBy("_a", "_b") for x in (left, right))
    kind = {f.name: f.dataType.simpleString() for f in [*q.schema, *blocks.schema["members"].dataType.elementType]}
    found = left.cogroup(right).applyInPandas(_cell_best, f"_key {kind['_key']}, neg double, ord {kind['_ord']}, name string")
    neg = F.coalesce("neg", F.lit(float("nan"))).alias("neg")  # pandas hands NaN over as null
    return found.select("_key", F.struct(neg, "ord", "name").alias("_best"))


def _cell_best(texts: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
    """The best member of the cell for each of its descriptions; only vectors of one length compare."""
    found = []
    members = members.sort_values(["_ord", "name"], na_position="first", kind="stable")
    sizes = members["vec"].map(len)
    for size, t in texts.groupby(texts["_v"].map(len)):
        m = members[sizes == size]
        if len(m) == 0:
            continue
        mv = np.stack(m["vec"].to_numpy())
        first = np.sort(np.unique(mv.view(f"V{8 * size}").ravel(), return_index=True)[1])  # of equal vectors the first
        m, mv = m.iloc[first], np.ascontiguousarray(mv[first])
        mn = m["norm"].to_numpy()
        for i in range(0, len(t), TILE):
            some = t.iloc[i:i + TILE]
            at, score = _tile_best(np.stack(some["_v"].to_numpy()), some["_vn"].to_numpy(), mv, mn)
            found.append(pd.DataFrame({"_key": some["_key"].to_numpy(), "neg": -score, "ord": m["_ord"].to_numpy()[at], "name": m["name"].to_numpy()[at]}))
    return pd.concat(found) if found else pd.DataFrame(columns=["_key", "neg", "ord", "name"])


def _tile_best(v, vn, mv, mn):
    """Place of the best member (the first of equal ones) and its score, per row of ``v``."""
    with np.errstate(all="ignore"):
        near = (v @ mv.T) / vn[:, None] / mn
        odd = ~np.isfinite(near)  # left to the exact step
        near[odd] = -np.inf
        row, col = np.nonzero((near >= near.max(axis=1)[:, None] - SLACK) | odd)
        at, best = np.full(len(v), -1), np.full(len(v), np.nan)
        for i in range(0, len(row), PAIRS):
            r, c = row[i:i + PAIRS], col[i:i + PAIRS]
            dot = np.zeros(len(r))
            for k in range(v.shape[1]):  # summed in the order of ``_dot``
                dot = dot + v[r, k] * mv[c, k]
            s = dot / (vn[r] * mn[c])
            order = np.lexsort((c, -s, r))  # NaN last, ties in catalogue order
            r, c, s = r[order], c[order], s[order]
            lead = np.r_[True, r[1:] != r[:-1]]
            r, c, s = r[lead], c[lead], s[lead]
            better = (at[r] < 0) | (s > best[r]) | (np.isnan(best[r]) & ~np.isnan(s))
            at[r[better]], best[r[better]] = c[better], s[better]
    return at, best


def score_best(texts: DataFrame, blocks: DataFrame, vec: str = "embedding", key: str | None = None) -> DataFrame:
    """Best category by cosine similarity; exact ties → the first in the
    catalogue.  Adds ``best_name``, ``best_score`` (null without a vector or
    direction).  ``key`` names a column that tells the texts apart; it is needed
    when the catalogue has more than one block."""
    n = blocks.count()
    v = F.transform(F.col(vec), lambda x: x.cast("double"))
    t = texts.withColumn("_v", v).withColumn("_vn", _norm("_v"))
    if n <= 1:
        one = with_one_row(t, blocks) if n else t.withColumn("members", F.lit(None).cast(blocks.schema["members"].dataType))
        one = one.withColumn("_best", _best_of("_v", "_vn"))
    else:
        if key is None:
            raise ValueError("a catalogue of several blocks needs the key of the texts")
        q = t.where((F.col("_vn") > 0) & F.col(key).isNotNull()).select(F.col(key).alias("_key"), "_v", "_vn")
        best = _grid_best(q, blocks).groupBy("_key").agg(F.min("_best").alias("_best"))
        one = t.join(best, F.col(key) == F.col("_key"), "left")
    return one.select(*texts.columns, F.col("_best.name").alias("best_name"), (-F.col("_best.neg")).alias("best_score"))


def apply_threshold(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """C4: at or above the threshold → the category, below → needs review;
    the confidence is the score rounded to 2 (compared before rounding)."""
    return scored.withColumn("categoria_ia", F.when(F.col("best_score") >= threshold, F.col("best_name")).otherwise(F.lit(NEEDS_REVIEW))) \
                 .withColumn("confianca", rnd("best_score", 2))


def build_map(descriptions: DataFrame, blocks: DataFrame, text: str = "descricao", vec: str = "embedding",
              threshold: float = THRESHOLD) -> DataFrame:
    """C6 (with C1, C2): one row per distinct description → (category,
    confidence).  Empty cleaned text → ``Sem Descrição`` with 0.0, no scoring;
    a text without a vector needs review and has no confidence."""
    d = descriptions.withColumn("_clean", clean_text(text))
    # one pass: every description is scored, the empty ones then take the
    # no-description label (scoring an empty one is cheaper than a second
    # pass over the descriptions)
    scored = apply_threshold(score_best(d, blocks, vec, text), threshold)
    empty = F.col("_clean") == ""
    return scored.select(F.col(text).alias("descricao_original"),
                         F.when(empty, F.lit(NO_DESCRIPTION)).otherwise(F.col("categoria_ia")).alias("categoria_ia"),
                         F.when(empty, F.lit(0.0)).otherwise(F.col("confianca")).alias("confianca"))


def save_map(mapa: DataFrame, name: str) -> None:
    """The map as a catalog table; a later map replaces it."""
    save_table(mapa, name)
