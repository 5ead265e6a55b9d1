"""Queries: text cleaning and categorisation (C1–C6) and the quality of the
resulting map (D1–D3 on the map)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..operators import classify as cl
from ..operators import quality as dq
from ..operators.util import materialize, rnd, with_one_row
from ..sources.tables import read_table
from .oracle import with_ctes
from .registry import register

_CLEAN_SQL = "trim(regexp_replace(regexp_replace(lower(coalesce({c}, '')), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"

_CATS = """pe AS (SELECT label, i AS pos, AVG(CAST(embedding[i] AS DOUBLE)) AS x
       FROM embeddings, range(1, 65) r(i) WHERE i <= len(embedding) GROUP BY 1, 2),
cats AS (SELECT 'categoria_' || CAST(label AS VARCHAR) AS name, ROW_NUMBER() OVER (ORDER BY label) - 1 AS idx,
                list(x ORDER BY pos) AS vec FROM pe GROUP BY label),
catn AS (SELECT *, SQRT(list_reduce(list_transform(vec, lambda a: a * a), lambda a, b: a + b)) AS norm FROM cats)"""

_SCORE = """sc AS (SELECT t.*, c.name, c.idx,
          list_reduce(list_transform(range(1, len(t.v) + 1), lambda i: t.v[i] * c.vec[i]), lambda a, b: a + b)
            / (SQRT(list_reduce(list_transform(t.v, lambda a: a * a), lambda a, b: a + b)) * c.norm) AS score
        FROM {src} t, catn c),
best AS (SELECT * EXCLUDE (rk) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY score DESC, idx) AS rk FROM sc) x WHERE rk = 1)"""


def _cats(spark, d):
    return cl.catalogue_blocks(cl.prototypes(read_table(spark, d, "embeddings")))


@register("clean_text", f"SELECT doc_id, {_CLEAN_SQL.format(c='text')} AS texto_limpo FROM documents")
def q_clean_text(spark, d):
    return read_table(spark, d, "documents").select("doc_id", clean_text("text").alias("texto_limpo"))


_VEC_SRC = "(SELECT vec_id, list_transform(embedding, lambda e: CAST(e AS DOUBLE)) AS v FROM embeddings)"


@register("nearest_category", with_ctes(
    "SELECT vec_id, name AS best_name, ROUND(score, 6) AS best_score FROM best",
    _CATS, _SCORE.format(src=_VEC_SRC, key="vec_id")))
def q_nearest_category(spark, d):
    s = cl.score_best(read_table(spark, d, "embeddings").select("vec_id", "embedding"), _cats(spark, d))
    return s.select("vec_id", "best_name", rnd("best_score", 6).alias("best_score"))


@register("classify_threshold", with_ctes(
    """SELECT vec_id, CASE WHEN score >= 0.25 THEN name ELSE 'Outros / Necessita Revisão' END AS categoria_ia,
         ROUND(score, 2) AS confianca FROM best""",
    _CATS, _SCORE.format(src=_VEC_SRC, key="vec_id")))
def q_classify_threshold(spark, d):
    s = cl.apply_threshold(cl.score_best(read_table(spark, d, "embeddings").select("vec_id", "embedding"), _cats(spark, d)))
    return s.select("vec_id", "categoria_ia", "confianca")


def _descriptions(spark, d):
    """Distinct description texts of all documents, each with the embedding of
    the smallest of its ids that has one (none: null).  Texts meet by their
    hash, so whole texts are no sort or join keys."""
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    emb = read_table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    j = docs.join(emb, on="doc_id", how="left")
    at = F.when(F.col("embedding").isNotNull(), F.col("doc_id"))
    return j.groupBy(F.sha2("text", 256).alias("_h")).agg(F.first("text").alias("descricao"), F.min_by("embedding", at).alias("embedding")).drop("_h")


_DESC_SRC = """descs AS (SELECT text AS descricao, arg_min(embedding, doc_id) AS embedding
          FROM documents d LEFT JOIN embeddings e ON d.doc_id = e.vec_id GROUP BY text),
dcl AS (SELECT descricao, embedding, {clean} AS cl FROM descs)""".format(clean=_CLEAN_SQL.format(c="descricao"))

_MAP_SQL = with_ctes(
    """SELECT descricao AS descricao_original, CASE WHEN score >= 0.25 THEN name ELSE 'Outros / Necessita Revisão' END AS categoria_ia,
         ROUND(score, 2) AS confianca FROM best
       UNION ALL
       SELECT descricao, 'Outros / Necessita Revisão', NULL FROM dcl WHERE cl <> '' AND embedding IS NULL
       UNION ALL
       SELECT descricao, 'Sem Descrição', 0.0 FROM dcl WHERE cl = ''""",
    _CATS, _DESC_SRC,
    _SCORE.format(src="(SELECT descricao, list_transform(embedding, lambda e: CAST(e AS DOUBLE)) AS v FROM dcl WHERE cl <> '' AND embedding IS NOT NULL)", key="descricao"))


@register("build_map", _MAP_SQL)
def q_build_map(spark, d):
    return cl.build_map(_descriptions(spark, d), _cats(spark, d))


@register("saved_map", _MAP_SQL)
def q_saved_map(spark, d):
    """The map stored as a catalog table, by name, and read back."""
    cl.save_map(cl.build_map(_descriptions(spark, d), _cats(spark, d)), "mapa_descricao")
    return spark.table("mapa_descricao")


@register("map_quality", with_ctes(
    """SELECT COUNT(*) AS qtd_linhas,
         COUNT(*) FILTER (WHERE categoria_ia IS NULL OR categoria_ia IN ('Sem Descrição', 'Outros / Necessita Revisão')) AS qtd_sem_categoria,
         ROUND(1 - COALESCE(CAST(COUNT(*) FILTER (WHERE categoria_ia IS NULL OR categoria_ia IN ('Sem Descrição', 'Outros / Necessita Revisão')) AS DOUBLE)
               / NULLIF(COUNT(*), 0), 0), 6) AS pct_bem_categorizados,
         ROUND(AVG(confianca), 6) AS confianca_media
       FROM mp""",
    _CATS, _DESC_SRC,
    _SCORE.format(src="(SELECT descricao, list_transform(embedding, lambda e: CAST(e AS DOUBLE)) AS v FROM dcl WHERE cl <> '' AND embedding IS NOT NULL)", key="descricao"),
    """mp AS (SELECT descricao AS descricao_original, CASE WHEN score >= 0.25 THEN name ELSE 'Outros / Necessita Revisão' END AS categoria_ia,
         ROUND(score, 2) AS confianca FROM best
       UNION ALL SELECT descricao, 'Outros / Necessita Revisão', NULL FROM dcl WHERE cl <> '' AND embedding IS NULL
       UNION ALL SELECT descricao, 'Sem Descrição', 0.0 FROM dcl WHERE cl = '')"""))
def q_map_quality(spark, d):
    m = materialize(cl.build_map(_descriptions(spark, d), _cats(spark, d)).select("categoria_ia", "confianca"))  # read twice
    return with_one_row(dq.uncategorised(m, []), dq.mean_confidence(m))


_PER_TEXT = "(SELECT vec_id, list_transform(embedding, lambda e: CAST(e AS DOUBLE)) AS v FROM embeddings WHERE vec_id % 2 = 0)"


@register("nearest_in_large_catalogue", with_ctes(
    "SELECT vec_id, name AS best_name, ROUND(score, 6) AS best_score FROM best",
    """catn AS (SELECT 'v' || CAST(vec_id AS VARCHAR) AS name, vec_id AS idx, vec, SQRT(list_reduce(list_transform(vec, lambda a: a * a), lambda a, b: a + b)) AS norm
       FROM (SELECT vec_id, list_transform(embedding, lambda e: CAST(e AS DOUBLE)) AS vec FROM embeddings WHERE vec_id % 2 = 1) e)""",
    _SCORE.format(src=_PER_TEXT, key="vec_id")))
def q_nearest_in_large_catalogue(spark, d):
    """C3 against a catalogue as large as the table: every vector of odd id is a category of its own."""
    e = read_table(spark, d, "embeddings")
    cats = e.where("vec_id % 2 = 1").select(F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("name"), F.col("vec_id").alias("_ord"),
                                            F.transform("embedding", lambda x: x.cast("double")).alias("vec"))
    s = cl.score_best(e.where("vec_id % 2 = 0").select("vec_id", "embedding"), cl.catalogue_blocks(cats, size=32), key="vec_id")
    return s.select("vec_id", "best_name", rnd("best_score", 6).alias("best_score"))
