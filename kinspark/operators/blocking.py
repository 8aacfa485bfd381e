"""Candidate generation by a union of blocking keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinspark.config import Blocking

#: Extra key generators: name to a function of the settings that gives an array column of strings.
KEY_GENERATORS: dict[str, Callable[[Blocking], Column]] = {}


def _words(c: str) -> Column:
    return F.filter(F.split(c, " "), lambda t: t != "")


def _tagged(tag: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.concat(F.lit(f"{tag}:"), v))


def _one(tag: str, value: Column, given: Column) -> Column:
    return F.when(given, F.array(F.concat(F.lit(f"{tag}:"), value))).otherwise(F.array().cast("array<string>"))


def _name_grams(n: int) -> Column:
    compact = F.col("name_compact")
    starts = F.when(F.length(compact) >= n, F.sequence(F.lit(1), F.length(compact) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: compact.substr(i, F.lit(n)))


def lsh_keys(cfg: Blocking) -> Column:
    """B13, off by default: bands of two least hashes each over the name's n-grams; as many bands as put the middle of their curve at ``minhash_threshold``."""
    grams = _name_grams(cfg.char_ngram_n)
    least = lambda seed: F.array_min(F.transform(grams, lambda g: F.xxhash64(F.lit(seed), g)))
    bands = [F.concat(F.lit(f"lsh:{b}_"), F.hex(F.xxhash64(least(2 * b), least(2 * b + 1)))) for b in range(max(1, round(cfg.minhash_threshold**-2)))]
    return F.when(F.size(grams) > 0, F.array(*bands)).otherwise(F.array().cast("array<string>"))


def blocking_keys(cfg: Blocking) -> Column:
    """B1: the set of tagged keys of a normalized row."""
    ordered = _words("name_sorted")
    first = F.try_element_at(ordered, F.lit(1))
    parts = [
        _tagged("ntok", _words("name_no_legal")),
        _one("nfirst", first, F.size(ordered) > 0),
        _one("nfirst2", F.concat(first, F.lit("_"), F.try_element_at(ordered, F.lit(2))), F.size(ordered) > 1),
        _one("meta", F.col("name_meta"), F.col("name_meta") != ""),
        _one("init", F.col("name_init"), F.length("name_init") >= 2),
        _one("pin", F.col("pincode"), F.col("pincode") != ""),
        _one("zip", F.col("zip5"), F.col("zip5") != ""),
        _one("cs", F.concat("city", F.lit("_"), "state"), (F.col("city") != "") & (F.col("state") != "")),
        _tagged("atok", _words("addr_no_digits")),
        _tagged("ng", _name_grams(cfg.char_ngram_n)),
        *([lsh_keys(cfg)] if cfg.use_lsh else []),
        *(make(cfg) for make in KEY_GENERATORS.values()),
    ]
    return F.array_distinct(F.concat(*parts))


def key_rows(entities: DataFrame, cfg: Blocking) -> DataFrame:
    """(entity_id, key), a row for each key of an entity."""
    return entities.select("entity_id", F.explode(blocking_keys(cfg)).alias("key"))


def within_bounds(cfg: Blocking) -> Column:
    """B2: whether ``df`` is within the bounds of the kind of ``key``."""
    kind, df = F.split_part("key", F.lit(":"), F.lit(1)), F.col("df")
    locality = cfg.loc_token_df_max if cfg.loc_token_df_max is not None else cfg.rare_token_df_max
    return (
        F.when(kind.isin("ntok", "ng", "lsh"), df.between(cfg.rare_token_df_min, cfg.rare_token_df_max))
        .when(kind == "atok", df <= cfg.addr_token_df_max)
        .when(kind.isin("cs", "nfirst", "nfirst2", "meta", "init"), df <= locality)
        .when(kind.isin("pin", "zip"), df <= cfg.pin_token_df_max)
        .otherwise(F.lit(True))
    )


def key_frequencies(others: DataFrame, cfg: Blocking, keys: DataFrame | None = None) -> DataFrame:
    """How many candidate rows hold each key, with the B4 verdict; ``keys`` are the key rows of ``others`` where the caller has them."""
    return (key_rows(others, cfg) if keys is None else keys).groupBy("key").agg(F.count("*").alias("df")).withColumn("kept", within_bounds(cfg))


def largest_buckets(frequencies: DataFrame, n: int = 5) -> DataFrame:
    """B5."""
    return frequencies.where("kept").select("key", "df").orderBy(F.desc("df"), F.desc("key")).limit(n)


def key_statistics(frequencies: DataFrame, others: DataFrame) -> DataFrame:
    """B6."""
    kept = F.count(F.when(F.col("kept"), 1))
    found = frequencies.agg(F.count("*").alias("distinct_keys"), kept.alias("kept_keys"), (F.count("*") - kept).alias("dropped_keys"))
    return found.join(others.agg(F.count("*").alias("rows_read")))


def inverted_index(others: DataFrame, cfg: Blocking, keys: DataFrame | None = None) -> DataFrame:
    """(key, cand_id) on kept keys."""
    keys = key_rows(others, cfg) if keys is None else keys
    kept = key_frequencies(others, cfg, keys).where("kept").select("key")
    return keys.join(kept, "key", "left_semi").select("key", F.col("entity_id").alias("cand_id"))


def candidates(queries: DataFrame, others: DataFrame, cfg: Blocking, keys: DataFrame | None = None, other_keys: DataFrame | None = None) -> DataFrame:
    """Distinct (s1_id, cand_id), at most ``max_candidates_per_entity`` for each query entity.

    The cap keeps the least ids, or with ``rank_candidates`` those that share most keys. Bounds cap every bucket, so the
    join's rows are at most the query's key rows times the largest bound. ``keys`` and ``other_keys`` are key rows of the two
    sides where the caller has them written."""
    keys = key_rows(queries, cfg) if keys is None else keys
    met = keys.select(F.col("entity_id").alias("s1_id"), "key").join(inverted_index(others, cfg, other_keys), "key")
    cap = cfg.max_candidates_per_entity
    if cfg.rank_candidates and cap:
        pairs = met.groupBy("s1_id", "cand_id").agg(F.count("*").alias("shared"))
        order = [F.desc("shared"), F.col("cand_id")]
    else:
        pairs, order = met.select("s1_id", "cand_id").distinct(), [F.col("cand_id")]
    if cap:
        pairs = pairs.withColumn("_rank", F.row_number().over(Window.partitionBy("s1_id").orderBy(*order))).where(F.col("_rank") <= cap)
    return pairs.select("s1_id", "cand_id")


def candidate_lists(queries: DataFrame, pairs: DataFrame) -> DataFrame:
    """Every query entity with its sorted candidates, none included."""
    lists = pairs.groupBy("s1_id").agg(F.array_sort(F.collect_list("cand_id")).alias("ids"))
    empty = F.array().cast("array<string>")
    return queries.select(F.col("entity_id").alias("s1_id")).join(lists, "s1_id", "left").withColumn("ids", F.coalesce("ids", empty))


def average_candidates(queries: DataFrame, pairs: DataFrame) -> DataFrame:
    """B12, entities without candidates included; counted without building lists."""
    totals = pairs.agg(F.count("*").alias("n")).join(queries.agg(F.count("*").alias("m")))
    return totals.select(F.coalesce(F.try_divide(F.col("n").cast("double"), F.col("m")), F.lit(0.0)).alias("avg_candidates"))
