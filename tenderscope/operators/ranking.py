"""Rankings, top-N and concentration.

Every ranking runs over the rows *after* aggregation to one row per ranked
key (category, supplier), partial aggregation having combined a hot key on
the map side.  Ties follow the BI semantics: RANKX … DENSE is ``dense_rank``;
TOPN keeps ties, so "top n" is ``rank() <= n``; the Pareto share of a value
includes every key with a value ≥ it (range frame)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import ordered_stats
from .util import join_on_keys, keys_list, money, ratio


def dense_rank_by_value(fact: DataFrame, key, part=(), value: str = "valor") -> DataFrame:
    """Dense rank (1 = largest value) of ``key`` inside ``part``."""
    key, part = keys_list(key), keys_list(part)
    g = ordered_stats(fact.groupBy(*part, *key).agg(F.sum(value).alias("_v")), part, "_v")
    return g.select(*part, *key, money("_v").alias("valor_total"), F.col("_dense").cast("bigint").alias("rank"))


def top1(fact: DataFrame, key: str, part=(), value: str = "valor", name_col: str = "top_nome",
         value_col: str = "top_valor") -> DataFrame:
    """The top key per partition; the name is null when several keys
    tie for first (TOPN keeps ties, SELECTEDVALUE then has no single value);
    the value stays."""
    part = keys_list(part)
    g = ordered_stats(fact.groupBy(*part, key).agg(F.sum(value).alias("_v")), part, "_v")
    r = g.where("_rank = 1")
    out = r.groupBy(*part).agg(
        F.when(F.count(F.lit(1)) == 1, F.first(key)).alias(name_col),
        F.max("_v").alias("_v"),
    )
    return out.select(*part, name_col, money("_v").alias(value_col))


def top_n_keys(df: DataFrame, key: str, n: int, by: str = "count", value: str = "valor") -> DataFrame:
    """The n keys with most rows (``by='count'``, null keys not
    counted) or the largest total value (``by='value'``); ties broken by key
    so the cut is deterministic."""
    base = df.where(F.col(key).isNotNull())
    agg = F.count(F.lit(1)) if by == "count" else F.sum(value)
    g = base.groupBy(key).agg(agg.alias("_m"))
    return g.orderBy(F.desc("_m"), F.asc(key)).limit(n).select(key)


def concentration(fact: DataFrame, n: int, part=(), key: str = "cpfCnpjVencedor", value: str = "valor") -> DataFrame:
    """K1–K4 (and K6 with ``part``): value of the top-n suppliers (ties at n
    all count) and its share of the total over all suppliers."""
    part = keys_list(part)
    g = ordered_stats(fact.groupBy(*part, key).agg(F.sum(value).alias("_v")), part, "_v")
    a = g.groupBy(*part).agg(F.sum(F.when(F.col("_rank") <= n, F.col("_v"))).alias("_top"), F.sum("_v").alias("_t"))
    return a.select(*part, money("_top").alias(f"valor_top{n}"),
                    ratio(F.try_divide(F.col("_top").cast("double"), F.col("_t").cast("double"))).alias(f"pct_top{n}"))


def pareto(fact: DataFrame, key: str = "nome", part=(), value: str = "valor") -> DataFrame:
    """K5: for each key, Σ of the keys with value ≥ its own / total."""
    part = keys_list(part)
    g = fact.groupBy(*part, key).agg(F.sum(value).alias("_v"))
    tot = g.groupBy(*part).agg(F.sum("_v").alias("_t")) if part else g.agg(F.sum("_v").alias("_t"))
    s = join_on_keys(ordered_stats(g, part, "_v"), tot, part)
    return s.select(*part, key, money("_v").alias("valor_total"),
                    ratio(F.try_divide(F.col("_cum").cast("double"), F.col("_t").cast("double"))).alias("pct_pareto"))
