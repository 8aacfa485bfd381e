"""Decisions and their measure."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinspark.config import Decision


def scored_lists(scored: DataFrame) -> DataFrame:
    """(s1_id, scored), the (p, cand_id) of an entity from the highest down, ids descending among ties."""
    return scored.groupBy("s1_id").agg(F.sort_array(F.collect_list(F.struct("p", "cand_id")), asc=False).alias("scored"))


def f_hat(mean: Column) -> Column:
    """D1 by the mean probability of the picks: expected recall is 1, so only precision is left."""
    return F.when(mean > 0, 1.25 * mean / (0.25 * mean + 1.0)).otherwise(0.0)


def greedy_picks(scored: Column, t_open: float, t_add: float, max_matches: int = 0, mode: str = "reference") -> Column:
    """Ids picked from a sorted list.

    F-hat grows with the mean probability, and candidates come in descending order, so what joins the top candidate is what
    ties with it. In "reference" mode the cap is tested after a pick beyond the first, so a cap of 1 lets two through; "fixed" mode keeps to it."""
    top = F.try_element_at(scored, F.lit(1))["p"]
    tied = F.filter(scored, lambda x, i: (i == 0) | ((x["p"] >= top) & (x["p"] >= t_add)))
    if max_matches:
        tied = F.slice(tied, 1, max(2, max_matches) if mode == "reference" else max_matches)
    none = F.array().cast("array<string>")
    return F.when(top >= t_open, F.transform(tied, lambda x: x["cand_id"])).otherwise(none)


def threshold_picks(scored: Column, t_open: float, t_add: float) -> Column:
    """D3: all at or above t_add if the top reaches t_open; no cap."""
    none = F.array().cast("array<string>")
    good = F.transform(F.filter(scored, lambda x: x["p"] >= t_add), lambda x: x["cand_id"])
    return F.when(F.try_element_at(scored, F.lit(1))["p"] >= t_open, good).otherwise(none)


def f05(n_pred: Column, n_true: Column, hits: Column) -> Column:
    """E1."""
    p, r = hits / n_pred, hits / n_true
    return F.when((n_pred == 0) & (n_true == 0), 1.0).when((n_pred == 0) | (n_true == 0) | (hits == 0), 0.0).otherwise(1.25 * p * r / (0.25 * p + r))


def entity_f05(entities: DataFrame, picks: DataFrame, truth: DataFrame) -> DataFrame:
    """(s1_id, f05) of every entity; ``picks`` and ``truth`` are (s1_id, cand_id)."""
    flagged = picks.distinct().withColumn("pred", F.lit(1)).join(truth.distinct().withColumn("true", F.lit(1)), ["s1_id", "cand_id"], "full")
    counts = flagged.groupBy("s1_id").agg(F.count("pred").alias("n_pred"), F.count("true").alias("n_true"), F.count(F.when(F.col("pred").isNotNull() & F.col("true").isNotNull(), 1)).alias("hits"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    found = entities.select("s1_id").join(counts, "s1_id", "left")
    return found.select("s1_id", f05(zero("n_pred"), zero("n_true"), zero("hits")).alias("f05"))


def macro_f05(scores: DataFrame) -> DataFrame:
    """0 over no entities."""
    return scores.agg(F.coalesce(F.avg("f05"), F.lit(0.0)).alias("macro_f05"))


def grid(start: float, stop: float, step: float) -> list[float]:
    """start, start + step, ... up to stop and a rounding error; each value is start + i * step."""
    n = max(0, math.ceil((stop + 1e-9 - start) / step))
    return [start + i * step for i in range(n)]


def threshold_scores(entities: DataFrame, lists: DataFrame, truth: DataFrame, cfg: Decision) -> DataFrame:
    """(t_open, t_add, macro_f05) for each cell of the grid (t_add up to t_open).

    With greedy picks an entity has two outcomes, opened or not, and t_add is without effect: one pass aggregates entities by
    their top probability, so the grid meets distinct tops, never entities. Otherwise each t_add is scored for each entity at once."""
    cells = [(o, a) for o in grid(*cfg.t_open_grid) for a in grid(cfg.t_add_grid[0], o, cfg.t_add_grid[2])]
    spark = entities.sparkSession
    table = F.broadcast(spark.createDataFrame(cells, "t_open double, t_add double"))
    known = truth.groupBy("s1_id").agg(F.collect_set("cand_id").alias("true"))
    rows = entities.select("s1_id").join(lists, "s1_id", "left").join(known, "s1_id", "left")
    none = F.array().cast("array<string>")
    rows = rows.select("scored", F.coalesce("true", none).alias("true"), F.coalesce(F.try_element_at("scored", F.lit(1))["p"], F.lit(-1.0)).alias("top"))

    def score(picks: Column) -> Column:
        return f05(F.size(picks), F.size("true"), F.size(F.array_intersect(picks, "true")))

    closed = score(none)
    if cfg.greedy_per_entity:
        opened = score(F.coalesce(greedy_picks(F.col("scored"), -1.0, -1.0, cfg.max_matches), none))
        tops = rows.select("top", opened.alias("opened"), closed.alias("closed")).groupBy("top").agg(F.sum("opened").alias("opened"), F.sum("closed").alias("closed"), F.count("*").alias("n"))
        met = tops.join(table).groupBy("t_open", "t_add")
        total = F.sum(F.when(F.col("top") >= F.col("t_open"), F.col("opened")).otherwise(F.col("closed")))
        return met.agg((total / F.sum("n")).alias("macro_f05"))
    adds = F.broadcast(spark.createDataFrame([(a,) for a in sorted({a for _, a in cells})], "t_add double"))
    picks = F.coalesce(F.transform(F.filter("scored", lambda x: x["p"] >= F.col("t_add")), lambda x: x["cand_id"]), none)
    tops = rows.join(adds).select("t_add", "top", score(picks).alias("opened"), closed.alias("closed")).groupBy("t_add", "top")
    tops = tops.agg(F.sum("opened").alias("opened"), F.sum("closed").alias("closed"), F.count("*").alias("n"))
    total = F.sum(F.when(F.col("top") >= F.col("t_open"), F.col("opened")).otherwise(F.col("closed")))
    return tops.join(table, "t_add").groupBy("t_open", "t_add").agg((total / F.sum("n")).alias("macro_f05"))


def best_thresholds(scores: DataFrame) -> DataFrame:
    """The cell with the highest score, the first in grid order among equals."""
    return scores.orderBy(F.desc("macro_f05"), "t_open", "t_add").limit(1)
