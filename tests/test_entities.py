"""Entities are derived once, from the first words of a text."""

import duckdb

from kinspark.plans import catalogue
from kinspark.plans.fixture import ENTITIES_SQL, entities

TEXTS = (
    " a b c d e f g h", "\n\ta b  c\td\ne f g h i j \n", "a b c d e f g ", "a b c d e f g", None, "", " \n",
    "a b c d e f g h ", "a\x0bb c d e f g h i", "a\r\nb c d e f g h", "a b c d e f g   h", "ab cd ef gh ij kl mn op " * 50,
)


def test_views_do_not_cut_the_text_again(spark, sf_dir):
    """Before, the plan held the words' extraction from the whole text once for every use of a word, in either branch of NFKC."""
    plan = catalogue.Tables(spark, sf_dir).rows._jdf.queryExecution().optimizedPlan().toString()
    assert "text#" not in plan


def test_words_at_odd_separators(spark, tmp_path):
    rows = [(k, text, "en" if k % 2 else "fr") for k, text in enumerate(TEXTS)]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1).write.parquet(path)
    columns = "entity_id, business_name, business_address, country, grp"
    want = duckdb.sql(f"WITH documents AS (SELECT * FROM '{path}/*.parquet') SELECT {columns} FROM ({ENTITIES_SQL})").fetchall()
    got = [tuple(r) for r in entities(spark, str(tmp_path)).select(*columns.split(", ")).collect()]
    assert sorted(got) == sorted(want) and len(got) == 7
