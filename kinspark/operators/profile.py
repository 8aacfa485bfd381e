"""Figures about sources and truth (A1-A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def truth_sizes(queries: DataFrame, truth: DataFrame) -> DataFrame:
    """(s1_id, n_true) of every query entity."""
    n = truth.groupBy("s1_id").agg(F.count("*").alias("n_true"))
    return queries.select(F.col("entity_id").alias("s1_id")).join(n, "s1_id", "left").withColumn("n_true", F.coalesce("n_true", F.lit(0)).cast("long"))


def singletons(sizes: DataFrame) -> DataFrame:
    """A1."""
    alone = F.count(F.when(F.col("n_true") == 0, 1))
    return sizes.agg(alone.alias("n_singletons"), F.coalesce(F.try_divide(alone.cast("double"), F.count("*")), F.lit(0.0)).alias("singleton_fraction"))


def match_histogram(sizes: DataFrame) -> DataFrame:
    """A2."""
    return sizes.groupBy("n_true").agg(F.count("*").alias("n_entities"))


def repeated_ids(truth: DataFrame) -> DataFrame:
    """A3."""
    return truth.agg((F.count("*") - F.count_distinct("cand_id")).alias("repeated_ids"))


def country_counts(entities: DataFrame) -> DataFrame:
    """A4, A5."""
    return entities.groupBy("source", "country").agg(F.count("*").alias("n_entities"))
