"""Base measures M1–M10 compiled into one ``groupBy().agg()``.

All measures are decomposable (partial aggregation on the map side) except
the exact median, which ``operators.quantile`` selects without ordering a group.
Several distinct counts in one aggregation would make Spark write every row once
per counted column; here each column has its own narrow scan and a two-step
aggregate over (keys, value), and the small results are joined on the keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dax import distinct_count_blank, div
from .quantile import exact_quantiles
from .util import join_on_keys, keys_list, money, ratio

BASE = ["valor_total", "qtd_itens", "qtd_licitacoes", "qtd_fornecedores", "qtd_categorias", "qtd_linhas"]
DERIVED = ["ticket_medio", "valor_medio_item", "itens_por_licitacao"]
ALL = BASE + DERIVED + ["valor_mediano_item"]


DISTINCT = {"qtd_licitacoes": "id", "qtd_fornecedores": "cpfCnpjVencedor", "qtd_categorias": "categoria_ia"}


def _sums():
    return {
        "valor_total": F.sum("valor").alias("_valor"),
        "qtd_itens": F.sum("quantidade").alias("qtd_itens"),
        "qtd_linhas": F.count(F.lit(1)).alias("qtd_linhas"),
    }


_NEEDS = {
    "ticket_medio": ["valor_total", "qtd_licitacoes"],
    "valor_medio_item": ["valor_total", "qtd_itens"],
    "itens_por_licitacao": ["qtd_itens", "qtd_licitacoes"],
}


def measures(fact: DataFrame, by=(), names=None) -> DataFrame:
    """Measures ``names`` (default all) grouped by ``by`` (may be empty).

    Output: the keys, then one column per requested measure.  Money is
    rounded to 4 places as double, ratios to 6 places.
    """
    by = keys_list(by)
    names = list(names or ALL)
    need = set(n for n in names if n in BASE)
    for n in names:
        need.update(_NEEDS.get(n, []))
    sums = [e for n, e in _sums().items() if n in need]
    counts = [distinct_count_blank(c).alias(n) for n, c in DISTINCT.items() if n in need]
    first = sums + counts[:1]  # one distinct count beside sums needs no second copy of the rows
    g = fact.groupBy(*by).agg(*first) if first else fact.select(*by).distinct()
    for c in counts[1:]:
        g = join_on_keys(g, fact.groupBy(*by).agg(c), by)
    if "valor_total" in need:
        g = g.withColumn("valor_total", F.col("_valor").cast("double")).drop("_valor")
    out = []
    for n in names:
        if n in BASE:
            out.append(money(n).alias(n) if n == "valor_total" else F.col(n))
        elif n == "ticket_medio":
            out.append(ratio(div("valor_total", "qtd_licitacoes")).alias(n))
        elif n == "valor_medio_item":
            out.append(ratio(div("valor_total", "qtd_itens")).alias(n))
        elif n == "itens_por_licitacao":
            out.append(ratio(div("qtd_itens", "qtd_licitacoes")).alias(n))
    res = g.select(*by, *out)
    if "valor_mediano_item" in names:
        med = exact_quantiles(fact, by, "valor", [0.5], names=["valor_mediano_item"])
        med = med.select(*by, money("valor_mediano_item").alias("valor_mediano_item"))
        res = join_on_keys(res, med, by, "left")
    return res
