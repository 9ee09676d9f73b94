"""Review-shaped views over the test tables.

One SQL text per view serves Spark and DuckDB, so it uses only what both read alike.
Views keep every document and its whole text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REVIEWS = """
SELECT doc_id AS review_id,
  CASE doc_id % 7 WHEN 0 THEN '  ' || source || ' ' WHEN 1 THEN upper(source)
                  WHEN 2 THEN NULL ELSE source END AS name,
  CASE doc_id % 13 WHEN 0 THEN '4.7/5' WHEN 1 THEN '4,2/5' WHEN 2 THEN ' 3 ' WHEN 3 THEN NULL
                   WHEN 4 THEN '' WHEN 5 THEN '100' WHEN 6 THEN '87' WHEN 7 THEN '1000'
                   WHEN 8 THEN '0/5' WHEN 9 THEN '2.0' WHEN 10 THEN 'n/d' WHEN 11 THEN '5.5'
                   ELSE '1' END AS rating,
  CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN '10'
                  WHEN 3 THEN '2.0' ELSE 'abc' END AS number_of_photos,
  CASE doc_id % 9
    WHEN 0 THEN text || ' https://ex.com/p?id=' || doc_id || '  FIM '
    WHEN 1 THEN text
    WHEN 2 THEN text || chr(10) || 'Geral. Comida: 3/5 / Serviço: 5/5 / Ambiente: 4/5'
    WHEN 3 THEN 'nota 4.7/5 e depois 2,1 / 5 e 6/5 ' || text
    WHEN 4 THEN ''
    WHEN 5 THEN NULL
    WHEN 6 THEN '⭐ ótimo 😀❤️ ' || text
    WHEN 7 THEN '@user' || doc_id || ' #tag-x  ' || text
    ELSE 'ok' END AS message
FROM documents
"""

# One comment per document, as a page shows it.
COMMENTS = """
SELECT source, doc_id,
  CASE WHEN doc_id % 11 = 10 THEN '' ELSE
    'Autor ' || source
    || CASE WHEN doc_id % 3 = 0 THEN ' Local Guide·' ELSE ' ' END
    || (doc_id % 40 + 1)
    || CASE WHEN doc_id % 4 = 0 THEN ' avaliação' WHEN doc_id % 4 = 1 THEN ' AVALIAÇÕES'
            ELSE ' avaliações' END
    || CASE doc_id % 5 WHEN 0 THEN '·1 foto' WHEN 1 THEN ''
            ELSE '·' || (doc_id % 9 + 2) || ' fotos' END
    || ' ' END
  || CASE WHEN doc_id % 6 = 0 THEN 'Comida: 4,5/5 Ambiente: ' || (doc_id % 5) || '/5 ' ELSE '' END
  || text
  || CASE WHEN doc_id % 8 = 0 THEN ' Passe o cursor para reagir' ELSE '' END
  || CASE WHEN doc_id % 10 = 0 THEN ' Ofner - Perdizes (proprietário) obrigado 5/5' ELSE '' END
  AS comment
FROM documents
"""

# A small dump per document: its comment, a second one, odd line ends and separators.
MINI_DUMPS = f"""
SELECT doc_id,
  comment || chr(13) || chr(10) || '|' || chr(9) || chr(13) || 'Eco ' || source
  || ' 3 avaliações·12 fotos 2/5 e 4,5 / 5.' || chr(10) || chr(10) || chr(10) || source
  || CASE WHEN doc_id % 2 = 0 THEN '  ||  ' || source || ' sem cabeçalho' ELSE ' |' END AS dump
FROM ({COMMENTS}) AS c
"""

SENTENCES = """
SELECT l.doc_id, d.text AS message,
  CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS label
FROM labels AS l JOIN documents AS d ON l.doc_id = d.doc_id
"""

# Predictions made by rule, to check scores by value.
PREDICTIONS = f"""
SELECT doc_id, label,
  CASE WHEN doc_id % 3 = 0 THEN 'positive' WHEN doc_id % 5 = 0 THEN 'neutral'
       ELSE label END AS pred,
  (1 + doc_id % 7) / CAST(18 + doc_id % 7 + doc_id % 4 AS DOUBLE) AS p_negative,
  (2 + doc_id % 4) / CAST(18 + doc_id % 7 + doc_id % 4 AS DOUBLE) AS p_neutral,
  15 / CAST(18 + doc_id % 7 + doc_id % 4 AS DOUBLE) AS p_positive
FROM ({SENTENCES}) AS s
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """``sql`` over the tables of ``sf_dir``."""
    tables = {n: table(spark, sf_dir, n) for n in ("documents", "labels") if f" {n}" in sql}
    for name in tables:
        sql = sql.replace(f"FROM {name}", f"FROM {{{name}}}").replace(
            f"JOIN {name}", f"JOIN {{{name}}}"
        )
    return spark.sql(sql, **tables)
