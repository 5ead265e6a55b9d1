"""Registry of named queries: each is ``fn(spark, sf_dir) -> DataFrame`` with
an optional DuckDB oracle SQL text (absent → rows-only check)."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def symmetric_round(sql: str) -> str:
    """Rewrite ``ROUND(x, k)`` (k an integer literal) as
    ``(ROUND((x) * 1e k) / 1e k + 0.0)``: the same rounding the Spark side
    applies (``operators.util.rnd``), so both round the same double
    identically, and a rounded-away negative becomes 0.0 on both sides."""
    out, i, key = [], 0, "ROUND("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k, comma = 1, j + len(key), None
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        inner_end = k - 1
        digits = sql[comma + 1:inner_end].strip() if comma is not None else ""
        out.append(sql[i:j])
        if comma is not None and digits.isdigit():
            expr = symmetric_round(sql[j + len(key):comma])
            # "+ 0.0" turns DuckDB's -0.0 (round of a small negative) into the
            # 0.0 Spark produces; it changes no other value
            out.append(f"(ROUND(({expr}) * 1e{digits}) / 1e{digits} + 0.0)")
        else:
            out.append(key + symmetric_round(sql[j + len(key):inner_end]) + ")")
        i = k


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = symmetric_round(sql)
        return fn
    return deco
