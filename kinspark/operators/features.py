"""Features of candidate pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinspark.functions.similarity import SIMILARITIES, similarities
from kinspark.operators.tfidf import cosines

EXACT = ("name_phon", "name_init", "name_len_ratio", "pin_match", "zip_match", "house_match", "city_match", "state_match", "country_eq", "landmark_any", "src_is_s3")
# Names and order of the columns of the training matrix.
FEATURES = (
    "name_ratio", "name_partial", "name_tsort", "name_tset", "name_wratio", "name_lev",
    "name_phon", "name_init", "name_len_ratio", "addr_ratio", "addr_tsort", "addr_tset",
    "pin_match", "zip_match", "house_match", "city_match", "state_match", "country_eq",
    "landmark_any", "src_is_s3", "name_tfidf", "addr_tfidf",
)
#: Extra features: name to a column over the two sides ``a_*`` and ``b_*``.
EXTRA_FEATURES: dict[str, Callable[[], Column]] = {}

_USED = ("entity_id", "name_no_legal", "name_meta", "name_init", "addr_full", "addr_no_digits", "pincode", "zip5", "house_no", "city", "state", "country", "is_landmark")


def pair_rows(pairs: DataFrame, queries: DataFrame, others: DataFrame) -> DataFrame:
    """Both sides of each pair as ``a_*`` and ``b_*``; ids without a row, or not of source 2 or 3, drop out."""
    side = lambda df, p: df.select(*(F.col(c).alias(f"{p}_{c}") for c in _USED))
    b = side(others.where(F.col("entity_id").startswith("S2-") | F.col("entity_id").startswith("S3-")), "b")
    found = pairs.join(side(queries, "a"), F.col("s1_id") == F.col("a_entity_id")).join(b, F.col("cand_id") == F.col("b_entity_id"))
    return found.drop("a_entity_id")


def exact_features() -> dict[str, Column]:
    """F7-F9, F13-F20."""
    same = lambda c: ((F.col(f"a_{c}") != "") & (F.col(f"a_{c}") == F.col(f"b_{c}"))).cast("int")
    la, lb = F.length("a_name_no_legal"), F.length("b_name_no_legal")
    return {
        "name_phon": same("name_meta"),
        "name_init": same("name_init"),
        "name_len_ratio": F.least(la, lb) / (F.greatest(la, lb) + F.lit(1e-9)),
        "pin_match": same("pincode"),
        "zip_match": same("zip5"),
        "house_match": same("house_no"),
        "city_match": same("city"),
        "state_match": same("state"),
        "country_eq": (F.col("a_country") == F.col("b_country")).cast("int"),
        "landmark_any": F.greatest("a_is_landmark", "b_is_landmark"),
        "src_is_s3": F.col("b_entity_id").startswith("S3-").cast("int"),
    }


def levenshtein_similarity(a: str, b: str) -> Column:
    """F6."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(F.lit(1.0) - F.levenshtein(a, b) / longest)


def pair_features(pairs: DataFrame, queries: DataFrame, others: DataFrame, vectors: DataFrame) -> DataFrame:
    """(s1_id, cand_id) and all features; the eight string similarities cross into Python once a batch."""
    rows = pair_rows(pairs, queries, others)
    fuzzy = similarities("a_name_no_legal", "b_name_no_legal", "a_addr_full", "b_addr_full", "a_addr_no_digits", "b_addr_no_digits")
    extra = {k: make() for k, make in EXTRA_FEATURES.items()}
    rows = rows.withColumns({"_fuzzy": fuzzy}).withColumns({"name_lev": levenshtein_similarity("a_name_no_legal", "b_name_no_legal")} | exact_features() | extra)
    out = rows.select("s1_id", "cand_id", *(F.col(f"_fuzzy.{c}").alias(c) for c in SIMILARITIES), "name_lev", *EXACT, *extra)
    return out.join(cosines(pairs, vectors), ["s1_id", "cand_id"]).select("s1_id", "cand_id", *FEATURES, *extra)


def with_labels(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """``label`` 1 where the pair is a true one."""
    true = truth.select("s1_id", "cand_id").distinct().withColumn("label", F.lit(1))
    return pairs.join(true, ["s1_id", "cand_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))
