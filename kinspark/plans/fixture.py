"""Entities derived from the documents table, in Spark SQL and DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _sql(table: str, first: int, words: str) -> str:
    """The same text for both engines; they count array places from 0 and from 1, and get at the words in their own ways."""
    w = lambda k: f"ws[{first + k}]"
    size = "size" if first == 0 else "len"
    return rf"""
SELECT concat('S', CAST(1 + doc_id % 3 AS STRING), '-', lpad(CAST(doc_id AS STRING), 7, '0')) AS entity_id,
       concat_ws(' ', {w(0)}, {w(1)}, {w(2)}, CASE WHEN doc_id % 2 = 0 THEN 'Pvt Ltd' ELSE 'Intl & Co.' END) AS business_name,
       concat_ws(' ', CAST(h % 97 + 1 AS STRING), {w(3)}, {w(4)}, CASE WHEN doc_id % 5 = 0 THEN 'Rd' ELSE 'road' END,
                 {w(5)}, 'TX', CASE WHEN lang = 'en' THEN CAST(10000 + h % 90000 AS STRING)
                 ELSE CAST(100000 + h % 900000 AS STRING) END) AS business_address,
       upper(lang) AS country, grp
FROM (SELECT doc_id, lang, grp, ws, length({w(0)}) * 1000 + length({w(1)}) * 100 + length({w(2)}) * 10 + length({w(3)}) AS h
      FROM (SELECT doc_id, lang, left(text, 60) AS grp, {words} AS ws FROM {table}) AS d
      WHERE {size}(ws) >= 8) AS k"""


#: For DuckDB, over the view ``documents``.
ENTITIES_SQL = _sql("documents", 1, r"regexp_extract_all(text, '([^ \n\t]+)', 1)")
#: For Spark: the first eight words and the rest of the text, which is never cut into words.
_FIRST_WORDS = r"filter(split(trim(LEADING ' \n\t' FROM text), '[ \n\t]+', 9), x -> x <> '')"


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, business_name, business_address, country, grp, split, source."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = spark.sql(_sql("{docs}", 0, _FIRST_WORDS), docs=docs)
    return rows.withColumns({"split": F.lit("test"), "source": F.substring("entity_id", 2, 1).cast("int")})


def truth(rows: DataFrame) -> DataFrame:
    """(s1_id, cand_id) of entities with the same ``grp``."""
    a = rows.where("source = 1").select(F.col("entity_id").alias("s1_id"), "grp")
    return a.join(rows.where("source <> 1").select(F.col("entity_id").alias("cand_id"), "grp"), "grp").select("s1_id", "cand_id")
