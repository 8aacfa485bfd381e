"""Checks of a written result (V1-V4); no rows means no problem."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def problems(matches: DataFrame, candidates: DataFrame, queries: DataFrame, others: DataFrame) -> DataFrame:
    """(problem, s1_id, detail). ``matches`` is (s1_id, ids); ``candidates`` (s1_id, cand_id); the others have entity_id."""
    known = queries.select(F.col("entity_id").alias("s1_id"))
    listed = matches.select("s1_id", F.explode("ids").alias("cand_id"))
    row = lambda df, name, detail: df.select(F.lit(name).alias("problem"), "s1_id", detail.alias("detail"))
    missing = row(known.join(matches, "s1_id", "left_anti"), "missing entity", F.lit(""))
    unknown = row(matches.join(known, "s1_id", "left_anti"), "unknown entity", F.lit(""))
    twice = row(matches.where(F.size("ids") != F.size(F.array_distinct("ids"))), "repeated id", F.lit(""))
    foreign = listed.join(others.select(F.col("entity_id").alias("cand_id")), "cand_id", "left_anti")
    foreign = foreign.groupBy("s1_id").agg(F.array_join(F.slice(F.array_sort(F.collect_set("cand_id")), 1, 3), ",").alias("d"))
    unproposed = listed.join(candidates, ["s1_id", "cand_id"], "left_anti").select("s1_id").distinct()
    parts = [missing, unknown, twice, row(foreign, "id not in sources", F.col("d")), row(unproposed, "match not a candidate", F.lit(""))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
