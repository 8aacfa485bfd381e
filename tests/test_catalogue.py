"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import duckdb
import pytest

from kinspark.plans import catalogue


def rows(frame):
    names = sorted(frame.columns)
    return names, sorted(repr([round(v, 9) if isinstance(v, float) else str(v) for v in r]) for r in frame[names].astype(object).values.tolist())


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_oracle(spark, sf_dir, name):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    assert rows(catalogue.QUERIES[name](spark, sf_dir).toPandas()) == rows(con.sql(catalogue.ORACLE_SQL[name]).df())


def test_model_scores_every_pair_once(spark, sf_dir):
    scores = catalogue.QUERIES["gbt_calibrated_scores"](spark, sf_dir).toPandas()
    assert len(scores) and not scores.duplicated(["s1_id", "cand_id"]).any() and scores["p"].between(0, 1).all()
