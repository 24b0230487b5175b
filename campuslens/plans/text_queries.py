"""Registered queries on free text: whole documents stand for the orientation notes."""

from __future__ import annotations

from pyspark.sql import functions as F

from campuslens.functions import text as T
from campuslens.operators import documents as D
from campuslens.plans import testbed as B
from campuslens.plans.registry import query
from campuslens.session import spread

NONE = "indeterminada"

B.CTES["normales"] = (["notas"], """
    SELECT nota_id, alerta_id, lang, nivel, trim(regexp_replace(regexp_replace(regexp_replace(
      strip_accents(replace(replace(' ' || lower(text) || ' ', 'est.', 'estudiante'), ' q ', ' que ')),
      '[^\\x00-\\x7F]', '', 'g'), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS norm FROM notas""")
_STOPS = ", ".join(f"'{w}'" for w in T.STOP_WORDS)
B.CTES["palabras"] = (["normales"], f"""
    SELECT nota_id, palabra FROM (SELECT nota_id, unnest(string_split(norm, ' ')) AS palabra FROM normales)
    WHERE length(palabra) > 2 AND palabra NOT IN ({_STOPS})""")
_HITS = ", ".join(
    f"count(*) FILTER (WHERE regexp_matches(palabra, '^({'|'.join(ps)})')) AS {lang}"
    for lang, ps in B.LANGUAGE_LEXICON.items())
_LANGS = list(B.LANGUAGE_LEXICON)
_BEST = f"greatest({', '.join(_LANGS)})"
_LEADERS = " + ".join(f"CAST({c} = {_BEST} AS INTEGER)" for c in _LANGS)
_ARMS = " ".join(f"WHEN {c} = {_BEST} THEN '{c}'" for c in _LANGS)
B.CTES["categorias"] = (["normales", "palabras"], f"""
    SELECT n.nota_id, n.alerta_id, n.lang, n.nivel, CASE WHEN h.nota_id IS NULL OR {_BEST} = 0 OR {_LEADERS} > 1
      THEN '{NONE}' {_ARMS} END AS categoria
    FROM normales n LEFT JOIN (SELECT nota_id, {_HITS} FROM palabras GROUP BY nota_id) h USING (nota_id)""")


def normal_notes(spark, sf):
    return spread(B.notes(spark, sf)).select("nota_id", "alerta_id", "lang", "nivel",
                                             T.normalise_text(F.col("text")).alias("norm"))


def categorised(spark, sf):
    return normal_notes(spark, sf).withColumn(
        "categoria", T.categorise(F.col("norm"), B.LANGUAGE_LEXICON))


@query("normalise_text", B.sql("SELECT nota_id, norm FROM normales", "normales"))
def normalise_text(spark, sf):
    return normal_notes(spark, sf).select("nota_id", "norm")


@query("categorise_text", B.sql("SELECT nota_id, categoria FROM categorias", "categorias"))
def categorise_text(spark, sf):
    return categorised(spark, sf).select("nota_id", "categoria")


@query("notes_category_level", B.sql(
    "SELECT categoria, nivel, count(*) AS n FROM categorias GROUP BY ALL", "categorias"))
def notes_category_level(spark, sf):
    return D.notes_category_level(categorised(spark, sf))


@query("text_search", B.sql(f"""
    SELECT nivel, count(DISTINCT alerta_id) AS n_alertas FROM normales
    WHERE regexp_matches(norm, '(^| )({'|'.join(B.SEARCH_STEMS)})') GROUP BY nivel""", "normales"))
def text_search(spark, sf):
    return D.search_by_level(normal_notes(spark, sf), "alerta_id",
                             T.mentions(F.col("norm"), B.SEARCH_STEMS))


@query("top_terms", B.sql("""
    SELECT palabra AS termino, count(*) AS frecuencia FROM palabras GROUP BY palabra
    ORDER BY frecuencia DESC, termino LIMIT 15""", "palabras"))
def top_terms(spark, sf):
    words = normal_notes(spark, sf).select(F.explode(T.tokens(F.col("norm"))).alias("termino"))
    return (words.groupBy("termino").agg(F.count(F.lit(1)).alias("frecuencia"))
            .orderBy(F.desc("frecuencia"), "termino").limit(15))


@query("text_confusion", B.sql(f"""
    SELECT lang AS real, {', '.join(f"count(*) FILTER (WHERE categoria = '{c}') AS {c}" for c in _LANGS + [NONE])},
      round(avg(CAST(categoria = lang AS INTEGER)), 6) AS exactitud FROM categorias GROUP BY lang""", "categorias"))
def text_confusion(spark, sf):
    """Category against the known language; accuracy per true class."""
    hits = [F.count_if(F.col("categoria") == c).alias(c) for c in _LANGS + [NONE]]
    return categorised(spark, sf).groupBy(F.col("lang").alias("real")).agg(
        *hits, F.round(F.avg((F.col("categoria") == F.col("lang")).cast("int")), 6)
        .alias("exactitud"))


@query("seeded_sample", """
    SELECT doc_id AS nota_id, text FROM documents ORDER BY md5('42-' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 4""")
def seeded_sample(spark, sf):
    """Four notes drawn by hash order: the same draw on any partitioning."""
    key = F.md5(F.concat(F.lit("42-"), F.col("nota_id").cast("string")))
    return B.notes(spark, sf).select("nota_id", "text").orderBy(key, "nota_id").limit(4)
