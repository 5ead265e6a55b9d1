"""Small plan helpers shared by the operators."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _name(c) -> str | None:
    """A plain column name usable inside SQL text, else None."""
    return c if isinstance(c, str) and c.replace("_", "").isalnum() else None


def money(c) -> Column:
    """Exact decimal money → double rounded to 4 places (output hygiene)."""
    n = _name(c)
    if n:  # one JVM call instead of a chain of Column calls
        return F.expr(f"round(cast(`{n}` as double) * 10000D, 0) / 10000D")
    return rnd(as_col(c).cast("double"), 4)


def ratio(c) -> Column:
    n = _name(c)
    if n:
        return F.expr(f"round(cast(`{n}` as double) * 1000000D, 0) / 1000000D")
    return rnd(as_col(c).cast("double"), 6)


def month_seq(date_col) -> Column:
    """year*12 + month: calendar shifts by month are integer shifts of this."""
    d = as_col(date_col)
    return F.year(d) * 12 + F.month(d)


def with_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a frame that holds exactly one row (a global
    aggregate).  The side is one row by construction, so broadcasting it is
    bounded; the join is a per-row projection, not a pair expansion."""
    return df.join(F.broadcast(one_row), how="cross")


#: rows up to which a counted frame is broadcast
BROADCAST_ROWS = 200_000


def broadcast_small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of ``rows`` counted rows at most, marked for broadcast if that is
    few; beyond, Spark joins it by shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def keys_list(keys) -> list[str]:
    if keys is None:
        return []
    if isinstance(keys, str):
        return [keys]
    return list(keys)


def qcol(alias: str, name: str) -> Column:
    return F.col(f"{alias}.`{name}`")


def join_on_keys(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null matches null (group keys may be null).
    Both sides are aliased, so self-joins of one lineage resolve.  With no
    keys the right side must be a one-row frame."""
    keys = keys_list(keys)
    if not keys:
        return with_one_row(left, right)
    lf, rt = left.alias("_jl"), right.alias("_jr")
    cond = None
    for k in keys:
        c = qcol("_jl", k).eqNullSafe(qcol("_jr", k))
        cond = c if cond is None else cond & c
    out = lf.join(rt, cond, how)
    keep_r = [c for c in right.columns if c not in keys]
    return out.select(*[qcol("_jl", c).alias(c) for c in left.columns], *[qcol("_jr", c).alias(c) for c in keep_r])


def rnd(c, k: int) -> Column:
    """Round to ``k`` places as ``round(x·10^k) / 10^k``.  Used for every
    compared output so that Spark and the SQL oracle round the same IEEE value
    the same way (a direct ``round(x, k)`` rounds the shortest decimal text of
    the double instead, which disagrees on near-ties)."""
    s = 10.0 ** k
    n = _name(c)
    if n:
        return F.expr(f"round(`{n}` * {s!r}D, 0) / {s!r}D")
    return F.round(as_col(c) * F.lit(s), 0) / F.lit(s)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small derived frame that later steps use many
    times (e.g. a monthly series after the big aggregation): a reliable
    ``checkpoint`` into the cluster's shared ``spark.checkpoint.dir``.  The
    frame is persisted first so the checkpoint job writes the cached blocks
    instead of recomputing the plan; a lost executor recomputes nothing above
    the checkpoint."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist()
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


@contextmanager
def deep_expressions(spark: SparkSession, passes: int = 2000):
    """While it lasts, the analyser may take more passes: functions nested in
    functions of arrays resolve one level a pass.  The session's own limit is
    put back."""
    name = "spark.sql.analyzer.maxIterations"
    old = spark.conf.get(name)
    spark.conf.set(name, str(max(passes, int(old))))
    try:
        yield
    finally:
        spark.conf.set(name, old)
