"""Registered queries of the engine over the derived entities, with the DuckDB SQL of each."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.config import Blocking, Decision, Model
from kinspark.functions import normalize as n
from kinspark.operators import blocking, checks, decide, features, profile, sampling, tfidf
from kinspark.operators.written import written
from kinspark.plans.fixture import ENTITIES_SQL, entities, truth

CFG, DECISION = Blocking(), Decision()
BUDGET = 20_000


class Tables:
    """Plans that several queries share. Normalized rows and keys are written when a query first needs them more than once.

    Entities are written first: the optimizer would put their words in place of every column of a view and cut the text again for each."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.entities = written(entities(spark, sf_dir))
        #: For queries that read the rows once.
        self.rows = n.normalize(self.entities)
        self.candidates_of = self.rows.where("source <> 1")

    @cached_property
    def all(self) -> DataFrame:
        return written(self.rows)

    @property
    def queries(self) -> DataFrame:
        return self.all.where("source = 1")

    @property
    def others(self) -> DataFrame:
        return self.all.where("source <> 1")

    @cached_property
    def truth(self) -> DataFrame:
        return truth(self.all)

    @cached_property
    def keys(self) -> DataFrame:
        """Key rows of all entities with their source."""
        return written(self.all.select("source", "entity_id", F.explode(blocking.blocking_keys(CFG)).alias("key")))

    @property
    def other_keys(self) -> DataFrame:
        return self.keys.where("source <> 1").select("entity_id", "key")

    def candidates(self, cfg: Blocking) -> DataFrame:
        return blocking.candidates(self.queries, self.others, cfg, self.keys.where("source = 1"), self.other_keys)

    @cached_property
    def pairs(self) -> DataFrame:
        return written(self.candidates(CFG))

    @property
    def sides(self) -> DataFrame:
        return features.pair_rows(self.pairs, self.queries, self.others)

    @property
    def scored(self) -> DataFrame:
        """A stand-in score with ties: exact agreements and the length ratio."""
        x = features.exact_features()
        flags = sum(x[c] for c in ("name_init", "house_match", "zip_match", "pin_match", "city_match"))
        return self.sides.select("s1_id", "cand_id", F.round(flags / F.lit(10.0) + F.lit(0.5) * x["name_len_ratio"], 2).alias("p"))

    @cached_property
    def lists(self) -> DataFrame:
        return decide.scored_lists(self.scored)

    @property
    def picks(self) -> DataFrame:
        return self.lists.select("s1_id", F.explode(decide.greedy_picks(F.col("scored"), 0.6, 0.3)).alias("cand_id"))


def _case(table: dict[str, str], t: str) -> str:
    return f"CASE {t} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in table.items()) + f" ELSE {t} END"


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _base(c: str) -> str:
    return rf"trim(regexp_replace(replace(lower({c}), '&', ' and '), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'))"


def _words(c: str) -> str:
    return f"list_filter(string_split({c}, ' '), lambda t: t <> '')"


def _join(c: str, sep: str = " ") -> str:
    return f"coalesce(array_to_string({c}, '{sep}'), '')"


_NORM = rf"""
ent AS MATERIALIZED ({ENTITIES_SQL}),
tok AS (SELECT *, list_transform({_words(_base("business_name"))}, lambda t: {_case(n.NAME_ABBREVIATIONS, "t")}) AS nf,
               list_transform({_words(_base("business_address"))}, lambda t: {_case(n.ADDRESS_ABBREVIATIONS, "t")}) AS af,
               regexp_extract_all(business_address, '[0-9]+') AS runs FROM ent),
cln AS (SELECT *, list_filter(nf, lambda t: NOT list_contains({_list(n.LEGAL)}, t)) AS nc,
               list_filter(af, lambda t: NOT regexp_full_match(t, '[0-9]+')) AS ap,
               coalesce(list_filter(af, lambda t: list_contains({_list(n.STATES)}, t))[1], '') AS state FROM tok),
norm AS MATERIALIZED (
  SELECT entity_id, business_name, business_address, country, grp, CAST(substr(entity_id, 2, 1) AS INTEGER) AS source,
         {_base("business_name")} AS name_raw, {_join("nf")} AS name_full, {_join("nc")} AS name_no_legal, {_join("list_sort(nc)")} AS name_sorted,
         {_join("nc", "")} AS name_compact, {_join("list_transform(nc, lambda t: left(t, 1))", "")} AS name_init,
         {_base("business_address")} AS addr_raw, {_join("af")} AS addr_full, {_join("ap")} AS addr_no_digits, {_join("list_sort(ap)")} AS addr_sorted,
         coalesce(list_filter(runs, lambda d: length(d) = 6)[1], '') AS pincode, coalesce(list_filter(runs, lambda d: length(d) = 5)[1], '') AS zip5,
         coalesce(runs[1], '') AS house_no, CAST(list_has_any(af, {_list(n.LANDMARKS)}) AS INTEGER) AS is_landmark,
         CASE WHEN list_position(ap, state) > 1 THEN ap[list_position(ap, state) - 1] ELSE '' END AS city, state
  FROM cln)"""
_KEYS = rf"""
keys AS MATERIALIZED (
  SELECT DISTINCT entity_id, source, key FROM (
    SELECT entity_id, source, unnest(list_concat(
      list_transform({_words("name_no_legal")}, lambda t: 'ntok:' || t),
      CASE WHEN name_sorted <> '' THEN ['nfirst:' || string_split(name_sorted, ' ')[1]] ELSE [] END,
      CASE WHEN len(string_split(name_sorted, ' ')) > 1 THEN ['nfirst2:' || string_split(name_sorted, ' ')[1] || '_' || string_split(name_sorted, ' ')[2]] ELSE [] END,
      CASE WHEN name_init <> '' THEN ['meta:' || name_init] ELSE [] END,
      CASE WHEN length(name_init) >= 2 THEN ['init:' || name_init] ELSE [] END,
      CASE WHEN pincode <> '' THEN ['pin:' || pincode] ELSE [] END,
      CASE WHEN zip5 <> '' THEN ['zip:' || zip5] ELSE [] END,
      CASE WHEN city <> '' AND state <> '' THEN ['cs:' || city || '_' || state] ELSE [] END,
      list_transform({_words("addr_no_digits")}, lambda t: 'atok:' || t),
      list_transform(generate_series(1, length(name_compact) - 2), lambda i: 'ng:' || substr(name_compact, i, 3)))) AS key
    FROM norm)),
freq AS MATERIALIZED (
  SELECT key, df, CASE WHEN kind IN ('ntok', 'ng') THEN df BETWEEN {CFG.rare_token_df_min} AND {CFG.rare_token_df_max}
                       WHEN kind = 'atok' THEN df <= {CFG.addr_token_df_max}
                       WHEN kind IN ('cs', 'nfirst', 'nfirst2', 'meta', 'init') THEN df <= {CFG.loc_token_df_max}
                       WHEN kind IN ('pin', 'zip') THEN df <= {CFG.pin_token_df_max} ELSE true END AS kept
  FROM (SELECT key, split_part(key, ':', 1) AS kind, count(*) AS df FROM keys WHERE source <> 1 GROUP BY key))"""
_INDEX = "idx AS (SELECT key, entity_id AS cand_id FROM keys JOIN freq USING (key) WHERE source <> 1 AND kept)"
_PAIRS = f"""
{_INDEX},
met AS MATERIALIZED (SELECT DISTINCT k.entity_id AS s1_id, cand_id FROM keys k JOIN idx USING (key) WHERE k.source = 1),
pairs AS MATERIALIZED (SELECT s1_id, cand_id FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY cand_id) AS r FROM met) WHERE r <= {CFG.max_candidates_per_entity})"""
_TRUTH = "truth AS MATERIALIZED (SELECT a.entity_id AS s1_id, b.entity_id AS cand_id FROM norm a JOIN norm b USING (grp) WHERE a.source = 1 AND b.source <> 1)"
_FLAG = lambda c: f"CAST(a.{c} <> '' AND a.{c} = b.{c} AS INTEGER)"
_LENGTHS = "least(length(a.name_no_legal), length(b.name_no_legal)) / (greatest(length(a.name_no_legal), length(b.name_no_legal)) + 1e-9)"
_SIDES = "FROM pairs p JOIN norm a ON a.entity_id = p.s1_id JOIN norm b ON b.entity_id = p.cand_id"
_SCORED = f"""
scored AS MATERIALIZED (SELECT s1_id, cand_id, round(({" + ".join(_FLAG(c) for c in ("name_init", "house_no", "zip5", "pincode", "city"))}) / 10.0::DOUBLE + 0.5::DOUBLE * ({_LENGTHS}), 2) AS p {_SIDES}),
top AS MATERIALIZED (SELECT s1_id, max(p) AS top FROM scored GROUP BY s1_id),
picks AS MATERIALIZED (SELECT s1_id, cand_id FROM scored JOIN top USING (s1_id) WHERE p = top AND top >= 0.6)"""
_F05 = "CASE WHEN n_pred = 0 AND n_true = 0 THEN 1.0::DOUBLE WHEN n_pred = 0 OR n_true = 0 OR hits = 0 THEN 0.0::DOUBLE ELSE 1.25::DOUBLE * (hits / n_pred) * (hits / n_true) / (0.25::DOUBLE * (hits / n_pred) + hits / n_true) END"


def _lcs(a: str, b: str) -> str:
    return f"""CASE WHEN {a} = '' AND {b} = '' THEN 1.0::DOUBLE WHEN {a} = '' OR {b} = '' THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * list_reduce(string_split({a}, ''), lambda acc, ch:
    list_reduce(generate_series(1, length({b})), lambda r, j: list_append(r, CASE WHEN substr({b}, j, 1) = ch THEN acc[j] + 1 ELSE greatest(acc[j + 1], r[j]) END), [0]::BIGINT[]),
    list_transform(generate_series(0, length({b})), lambda i: 0::BIGINT))[-1] / (length({a}) + length({b})) END"""


_GRAMS = """
words AS (SELECT entity_id, 'name' AS field, unnest(string_split(lower(name_no_legal), ' ')) AS w FROM norm
          UNION ALL SELECT entity_id, 'addr', unnest(string_split(lower(addr_full), ' ')) FROM norm),
pad AS (SELECT entity_id, field, ' ' || w || ' ' AS w FROM words WHERE w <> ''),
terms AS MATERIALIZED (SELECT entity_id, field, term, count(*) AS tf FROM (
  SELECT entity_id, field, unnest(list_concat(list_transform(generate_series(1, length(w) - 1), lambda i: substr(w, i, 2)), list_transform(generate_series(1, length(w) - 2), lambda i: substr(w, i, 3)))) AS term FROM pad)
  GROUP BY entity_id, field, term),
vocab AS MATERIALIZED (SELECT field, term, df, ln((1.0::DOUBLE + (SELECT count(*) FROM norm)) / (1.0::DOUBLE + df)) + 1.0::DOUBLE AS idf FROM (
  SELECT field, term, count(*) AS df, row_number() OVER (PARTITION BY field ORDER BY sum(tf) DESC, term) AS r FROM terms GROUP BY field, term HAVING count(*) >= 2) WHERE r <= 100000),
raw AS (SELECT entity_id, field, term, tf * idf AS w FROM terms JOIN vocab USING (field, term)),
wts AS MATERIALIZED (SELECT entity_id, field, term, w / sqrt(sum(w * w) OVER (PARTITION BY entity_id, field)) AS w FROM raw)"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _query(build):
    return lambda spark, sf_dir: build(Tables(spark, sf_dir))


def _vectors(t: Tables, cfg: Model = Model()) -> DataFrame:
    return tfidf.fit_weights(t.all, cfg.tfidf_max_features, cfg.tfidf_min_df, cfg.tfidf_fit_sample_per_frame)


def _fuzzy(t: Tables) -> DataFrame:
    from kinspark.functions.similarity import similarities

    found = similarities("a_name_no_legal", "b_name_no_legal", "a_addr_full", "b_addr_full", "a_addr_no_digits", "b_addr_no_digits")
    return t.sides.withColumn("x", found).select("s1_id", "cand_id", "x.*")


def _indel(t: Tables) -> DataFrame:
    from kinspark.functions.similarity import name_ratios

    return t.sides.withColumn("x", name_ratios("a_name_no_legal", "b_name_no_legal")).select("s1_id", "cand_id", "x.*")


def _trained(t: Tables, cfg: Model = Model()) -> DataFrame:
    """M1-M6: models of the pairs of the budget sample; every candidate pair gets a score."""
    from kinspark.operators import model

    kept = sampling.budget_sample(t.queries, t.pairs, t.truth, cfg.max_train_pairs).select("s1_id")
    rows = written(features.with_labels(features.pair_features(t.pairs, t.queries, t.others, _vectors(t)), t.truth))
    return model.score_all(rows, kept, cfg)


def _best(t: Tables) -> DataFrame:
    queries = t.queries.select(F.col("entity_id").alias("s1_id"))
    return _rounded(decide.best_thresholds(decide.threshold_scores(queries, t.lists, t.truth, DECISION)), "macro_f05", "t_open", "t_add")


def _checked(t: Tables) -> DataFrame:
    """Checks of a result with planted faults: every fifth entity left out, an id repeated, a foreign id."""
    lists = t.picks.groupBy("s1_id").agg(F.array_sort(F.collect_list("cand_id")).alias("ids"))
    last = F.substring("s1_id", -1, 1)
    ids = F.when(last == "1", F.concat("ids", "ids")).when(last == "2", F.concat("ids", F.array(F.lit("S9-x")))).otherwise(F.col("ids"))
    return checks.problems(lists.where(~last.isin("0", "5")).withColumn("ids", ids), t.pairs, t.queries, t.others)


_ids = lambda t: t.queries.select(F.col("entity_id").alias("s1_id"))

QUERIES = {
    "normalize_name_views": _query(lambda t: t.rows.select("entity_id", *n.NAME_VIEWS)),
    "normalize_address_views": _query(lambda t: t.rows.select("entity_id", *n.ADDRESS_VIEWS)),
    "blocking_keys": _query(lambda t: blocking.key_rows(t.rows, CFG)),
    "key_document_frequency": _query(lambda t: blocking.key_frequencies(t.candidates_of, CFG)),
    "key_stats": _query(lambda t: blocking.key_statistics(blocking.key_frequencies(t.others, CFG, t.other_keys), t.others)),
    "top_buckets": _query(lambda t: blocking.largest_buckets(blocking.key_frequencies(t.candidates_of, CFG))),
    "inverted_index": _query(lambda t: blocking.inverted_index(t.others, CFG, t.other_keys)),
    "candidates_uncapped": _query(lambda t: t.candidates(Blocking(max_candidates_per_entity=None))),
    "candidates_capped": _query(lambda t: t.candidates(CFG)),
    "candidate_lists": _query(lambda t: blocking.candidate_lists(t.queries, t.pairs).select("s1_id", F.array_join("ids", ",").alias("candidate_entity_ids"))),
    "avg_candidates": _query(lambda t: _rounded(blocking.average_candidates(t.queries, t.pairs), "avg_candidates")),
    "blocking_recall": _query(lambda t: t.truth.join(t.pairs.withColumn("hit", F.lit(1)), ["s1_id", "cand_id"], "left").agg(F.count("*").alias("n_true"), F.count("hit").alias("n_kept"))),
    "truth_pairs": _query(lambda t: t.truth),
    "singleton_fraction": _query(lambda t: _rounded(profile.singletons(profile.truth_sizes(t.queries, t.truth)), "singleton_fraction")),
    "match_count_histogram": _query(lambda t: profile.match_histogram(profile.truth_sizes(t.queries, t.truth))),
    "repeated_truth_ids": _query(lambda t: profile.repeated_ids(t.truth)),
    "country_counts": _query(lambda t: profile.country_counts(t.all)),
    "pair_labels": _query(lambda t: features.with_labels(t.pairs, t.truth)),
    "pair_exact_features": _query(lambda t: _rounded(t.sides.select("s1_id", "cand_id", *(c.alias(k) for k, c in features.exact_features().items())), "name_len_ratio")),
    "pair_levenshtein": _query(lambda t: t.sides.select("s1_id", "cand_id", F.round(features.levenshtein_similarity("a_name_init", "b_name_init"), 6).alias("init_lev"))),
    "pair_name_levenshtein": _query(lambda t: t.sides.select("s1_id", "cand_id", F.round(features.levenshtein_similarity("a_name_no_legal", "b_name_no_legal"), 6).alias("name_lev"))),
    "pair_indel_ratio": _query(lambda t: _rounded(_indel(t), "name_ratio", "name_tsort")),
    "pair_fuzzy_metrics": _query(_fuzzy),
    "tfidf_vocabulary": _query(lambda t: _rounded(tfidf.vocabulary(tfidf.term_counts(t.all), t.all.agg(F.count("*").alias("n"))), "idf")),
    "tfidf_weights": _query(lambda t: _rounded(_vectors(t).select("entity_id", "field", "term", "w"), "w")),
    "pair_tfidf_cosine": _query(lambda t: _rounded(tfidf.cosines(t.pairs, _vectors(t)), "name_tfidf", "addr_tfidf")),
    "pair_budget_sample": _query(lambda t: sampling.budget_sample(t.queries, t.pairs, t.truth, BUDGET, seed=None)),
    "pair_budget_sample_default": _query(lambda t: sampling.budget_sample(t.queries, t.pairs, t.truth, Model().max_train_pairs, seed=None)),
    "normalize_metaphone": _query(lambda t: n.normalize(t.entities, phonetic="metaphone").select("entity_id", "name_no_legal", "name_meta")),
    "scored_lists": _query(lambda t: t.lists.select("s1_id", F.array_join(F.transform("scored", lambda x: x["cand_id"]), ",").alias("ids"))),
    "greedy_decision": _query(lambda t: t.picks),
    "nongreedy_decision": _query(lambda t: t.lists.select("s1_id", F.explode(decide.threshold_picks(F.col("scored"), 0.6, 0.5)).alias("cand_id"))),
    "threshold_grid": _query(lambda t: _rounded(decide.threshold_scores(_ids(t), t.lists, t.truth, DECISION), "macro_f05", "t_open", "t_add")),
    "threshold_grid_nongreedy": _query(lambda t: _rounded(decide.threshold_scores(_ids(t), t.lists, t.truth, Decision(greedy_per_entity=False, t_open_grid=(0.4, 0.7, 0.1))), "macro_f05", "t_open", "t_add")),
    "threshold_grid_nongreedy_full": _query(lambda t: _rounded(decide.threshold_scores(_ids(t), t.lists, t.truth, Decision(greedy_per_entity=False)), "macro_f05", "t_open", "t_add")),
    "best_thresholds": _query(_best),
    "entity_f05": _query(lambda t: _rounded(decide.entity_f05(_ids(t), t.picks, t.truth), "f05")),
    "macro_f05": _query(lambda t: _rounded(decide.macro_f05(decide.entity_f05(_ids(t), t.picks, t.truth)), "macro_f05")),
    "self_check_problems": _query(_checked),
    "gbt_calibrated_scores": _query(_trained),
}

_NK, _NKP = (_NORM, _KEYS), (_NORM, _KEYS, _PAIRS)
_COUNTS = """
cnt AS (SELECT s1_id, count(pred) AS n_pred, count(tr) AS n_true, count(*) FILTER (pred IS NOT NULL AND tr IS NOT NULL) AS hits
        FROM (SELECT coalesce(p.s1_id, t.s1_id) AS s1_id, p.cand_id AS pred, t.cand_id AS tr FROM picks p FULL JOIN truth t ON p.s1_id = t.s1_id AND p.cand_id = t.cand_id) GROUP BY s1_id),
score AS (SELECT e.entity_id AS s1_id, """ + _F05 + """ AS f05 FROM (SELECT entity_id, coalesce(n_pred, 0) AS n_pred, coalesce(n_true, 0) AS n_true, coalesce(hits, 0) AS hits
          FROM norm LEFT JOIN cnt ON s1_id = entity_id WHERE source = 1) e)"""
_SIZES = "sizes AS (SELECT entity_id AS s1_id, count(cand_id) AS n_true FROM norm LEFT JOIN truth ON s1_id = entity_id WHERE source = 1 GROUP BY entity_id)"


def _grid(opens: tuple[float, float, float], greedy: bool) -> str:
    """Cells as start + i * step, and the score of each over all entities."""
    o, a = opens, DECISION.t_add_grid
    pick = "p = top" if greedy else "p >= t_add"
    return f"""
opens AS (SELECT {o[0]}::DOUBLE + i * {o[2]}::DOUBLE AS t_open FROM generate_series(0, {len(decide.grid(*o)) - 1}) g(i)),
adds AS (SELECT {a[0]}::DOUBLE + i * {a[2]}::DOUBLE AS t_add FROM generate_series(0, 60) g(i)),
cells AS (SELECT t_open, t_add FROM opens JOIN adds ON t_add < t_open + 1e-9),
one AS MATERIALIZED (SELECT s1_id, t_add, any_value(top) AS top, count(*) FILTER ({pick}) AS n_pred, count(t.cand_id) FILTER ({pick}) AS hits
        FROM scored JOIN top USING (s1_id) CROSS JOIN (SELECT DISTINCT t_add FROM cells) LEFT JOIN truth t USING (s1_id, cand_id) GROUP BY s1_id, t_add),
grid AS (SELECT t_open, c.t_add, avg({_F05}) AS macro_f05 FROM (
  SELECT t_open, c.t_add, n_true, CASE WHEN top >= t_open THEN n_pred ELSE 0 END AS n_pred, CASE WHEN top >= t_open THEN hits ELSE 0 END AS hits
  FROM cells c CROSS JOIN sizes LEFT JOIN one ON one.s1_id = sizes.s1_id AND one.t_add = c.t_add) c GROUP BY t_open, c.t_add)"""


def _first_fit(budget: int) -> str:
    """Entities walked one at a time in the order of their ids."""
    parts = _with(
        *_NKP, _TRUTH, _SIZES,
        """offer AS MATERIALIZED (SELECT s.s1_id, count(p.cand_id) AS n_pairs, any_value(s.n_true) > 0 AS positive FROM sizes s LEFT JOIN pairs p ON p.s1_id = s.s1_id GROUP BY s.s1_id)""",
        "queue AS MATERIALIZED (SELECT s1_id, n_pairs, row_number() OVER (ORDER BY s1_id) AS turn FROM offer WHERE NOT positive)",
        f"""walk AS (SELECT CAST(0 AS BIGINT) AS turn, CAST((SELECT coalesce(sum(n_pairs), 0) FROM offer WHERE positive) AS BIGINT) AS spent, CAST(NULL AS VARCHAR) AS taken
UNION ALL SELECT q.turn, CASE WHEN w.spent < {budget} AND w.spent + q.n_pairs <= {budget} THEN w.spent + q.n_pairs ELSE w.spent END,
  CASE WHEN w.spent < {budget} AND w.spent + q.n_pairs <= {budget} THEN q.s1_id END FROM walk w JOIN queue q ON q.turn = w.turn + 1)""",
        select="SELECT s1_id, n_pairs, positive FROM offer WHERE positive OR s1_id IN (SELECT taken FROM walk WHERE taken IS NOT NULL)",
    )
    return parts.replace("WITH ", "WITH RECURSIVE ", 1)


def _edits(c: str) -> str:
    """1 - edit distance / longer length, row by row over code points (DuckDB's own function counts bytes)."""
    a, b = f"a.{c}", f"b.{c}"
    return f"""round(CASE WHEN {a} = '' AND {b} = '' THEN 1.0::DOUBLE WHEN {a} = '' OR {b} = '' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE - list_reduce(string_split({a}, ''), lambda acc, ch:
    list_reduce(generate_series(1, length({b})), lambda r, j: list_append(r, least(acc[j] + CASE WHEN substr({b}, j, 1) = ch THEN 0 ELSE 1 END, acc[j + 1] + 1, r[j] + 1)), [acc[1] + 1]::BIGINT[]),
    list_transform(generate_series(0, length({b})), lambda i: i::BIGINT))[-1] / greatest(length({a}), length({b}))::DOUBLE END, 6)"""


_GRID_SELECT = "SELECT round(macro_f05, 6) AS macro_f05, round(t_open, 6) AS t_open, round(t_add, 6) AS t_add FROM grid"
_LAST = "right(s1_id, 1)"

ORACLE_SQL = {
    "normalize_name_views": _with(_NORM, select=f"SELECT entity_id, {', '.join(n.NAME_VIEWS)} FROM norm"),
    "normalize_address_views": _with(_NORM, select=f"SELECT entity_id, {', '.join(n.ADDRESS_VIEWS)} FROM norm"),
    "blocking_keys": _with(*_NK, select="SELECT entity_id, key FROM keys"),
    "key_document_frequency": _with(*_NK, select="SELECT * FROM freq"),
    "key_stats": _with(*_NK, select="SELECT count(*) AS distinct_keys, count(*) FILTER (kept) AS kept_keys, count(*) FILTER (NOT kept) AS dropped_keys, (SELECT count(*) FROM norm WHERE source <> 1) AS rows_read FROM freq"),
    "top_buckets": _with(*_NK, select="SELECT key, df FROM freq WHERE kept ORDER BY df DESC, key DESC LIMIT 5"),
    "inverted_index": _with(*_NK, _INDEX, select="SELECT key, cand_id FROM idx"),
    "candidates_uncapped": _with(*_NKP, select="SELECT * FROM met"),
    "candidates_capped": _with(*_NKP, select="SELECT * FROM pairs"),
    "candidate_lists": _with(*_NKP, select="SELECT entity_id AS s1_id, coalesce(string_agg(cand_id, ',' ORDER BY cand_id), '') AS candidate_entity_ids FROM norm LEFT JOIN pairs ON s1_id = entity_id WHERE source = 1 GROUP BY entity_id"),
    "avg_candidates": _with(*_NKP, select="SELECT round((SELECT count(*) FROM pairs) / count(*), 6) AS avg_candidates FROM norm WHERE source = 1"),
    "blocking_recall": _with(*_NKP, _TRUTH, select="SELECT count(*) AS n_true, count(p.cand_id) AS n_kept FROM truth t LEFT JOIN pairs p ON p.s1_id = t.s1_id AND p.cand_id = t.cand_id"),
    "truth_pairs": _with(_NORM, _TRUTH, select="SELECT * FROM truth"),
    "singleton_fraction": _with(_NORM, _TRUTH, _SIZES, select="SELECT count(*) FILTER (n_true = 0) AS n_singletons, round(count(*) FILTER (n_true = 0) / count(*), 6) AS singleton_fraction FROM sizes"),
    "match_count_histogram": _with(_NORM, _TRUTH, _SIZES, select="SELECT n_true, count(*) AS n_entities FROM sizes GROUP BY n_true"),
    "repeated_truth_ids": _with(_NORM, _TRUTH, select="SELECT count(*) - count(DISTINCT cand_id) AS repeated_ids FROM truth"),
    "country_counts": _with(_NORM, select="SELECT source, country, count(*) AS n_entities FROM norm GROUP BY source, country"),
    "pair_labels": _with(*_NKP, _TRUTH, select="SELECT p.s1_id, p.cand_id, CAST(t.cand_id IS NOT NULL AS INTEGER) AS label FROM pairs p LEFT JOIN (SELECT DISTINCT * FROM truth) t ON p.s1_id = t.s1_id AND p.cand_id = t.cand_id"),
    "pair_exact_features": _with(
        *_NKP,
        select=f"""SELECT s1_id, cand_id, {_FLAG("name_init")} AS name_phon, {_FLAG("name_init")} AS name_init, round({_LENGTHS}, 6) AS name_len_ratio, {_FLAG("pincode")} AS pin_match, {_FLAG("zip5")} AS zip_match,
{_FLAG("house_no")} AS house_match, {_FLAG("city")} AS city_match, {_FLAG("state")} AS state_match, CAST(a.country = b.country AS INTEGER) AS country_eq, greatest(a.is_landmark, b.is_landmark) AS landmark_any,
CAST(b.entity_id LIKE 'S3-%' AS INTEGER) AS src_is_s3 {_SIDES}""",
    ),
    "pair_indel_ratio": _with(*_NKP, select=f"""SELECT s1_id, cand_id, round({_lcs("a.name_no_legal", "b.name_no_legal")}, 6) AS name_ratio, round({_lcs("a.name_sorted", "b.name_sorted")}, 6) AS name_tsort {_SIDES}"""),
    "tfidf_vocabulary": _with(_NORM, _GRAMS, select="SELECT field, term, df, round(idf, 6) AS idf FROM vocab"),
    "tfidf_weights": _with(_NORM, _GRAMS, select="SELECT entity_id, field, term, round(w, 6) AS w FROM wts"),
    "pair_tfidf_cosine": _with(
        *_NKP, _GRAMS,
        select="""SELECT p.s1_id, p.cand_id, round(coalesce(sum(a.w * b.w) FILTER (a.field = 'name'), 0), 6) AS name_tfidf, round(coalesce(sum(a.w * b.w) FILTER (a.field = 'addr'), 0), 6) AS addr_tfidf
FROM pairs p LEFT JOIN wts a ON a.entity_id = p.s1_id LEFT JOIN wts b ON b.entity_id = p.cand_id AND b.field = a.field AND b.term = a.term GROUP BY p.s1_id, p.cand_id""",
    ),
    "pair_budget_sample": _first_fit(BUDGET),
    "pair_budget_sample_default": _first_fit(Model().max_train_pairs),
    "pair_levenshtein": _with(*_NKP, select=f"SELECT s1_id, cand_id, {_edits('name_init')} AS init_lev {_SIDES}"),
    "pair_name_levenshtein": _with(*_NKP, select=f"SELECT s1_id, cand_id, {_edits('name_no_legal')} AS name_lev {_SIDES}"),
    "scored_lists": _with(*_NKP, _SCORED, select="SELECT s1_id, string_agg(cand_id, ',' ORDER BY p DESC, cand_id DESC) AS ids FROM scored GROUP BY s1_id"),
    "greedy_decision": _with(*_NKP, _SCORED, select="SELECT * FROM picks"),
    "nongreedy_decision": _with(*_NKP, _SCORED, select="SELECT s1_id, cand_id FROM scored JOIN top USING (s1_id) WHERE top >= 0.6 AND p >= 0.5"),
    "threshold_grid": _with(*_NKP, _SCORED, _TRUTH, _SIZES, _grid(DECISION.t_open_grid, True), select=_GRID_SELECT),
    "threshold_grid_nongreedy": _with(*_NKP, _SCORED, _TRUTH, _SIZES, _grid((0.4, 0.7, 0.1), False), select=_GRID_SELECT),
    "threshold_grid_nongreedy_full": _with(*_NKP, _SCORED, _TRUTH, _SIZES, _grid(DECISION.t_open_grid, False), select=_GRID_SELECT),
    "best_thresholds": _with(*_NKP, _SCORED, _TRUTH, _SIZES, _grid(DECISION.t_open_grid, True), select=f"{_GRID_SELECT} ORDER BY round(grid.macro_f05, 12) DESC, grid.t_open, grid.t_add LIMIT 1"),
    "entity_f05": _with(*_NKP, _SCORED, _TRUTH, _COUNTS, select="SELECT s1_id, round(f05, 6) AS f05 FROM score"),
    "macro_f05": _with(*_NKP, _SCORED, _TRUTH, _COUNTS, select="SELECT round(avg(f05), 6) AS macro_f05 FROM score"),
    "self_check_problems": _with(
        *_NKP, _SCORED,
        select=f"""SELECT 'missing entity' AS problem, entity_id AS s1_id, '' AS detail FROM norm WHERE source = 1 AND (entity_id NOT IN (SELECT s1_id FROM picks) OR right(entity_id, 1) IN ('0', '5'))
UNION ALL SELECT DISTINCT 'repeated id', s1_id, '' FROM picks WHERE {_LAST} = '1'
UNION ALL SELECT DISTINCT 'id not in sources', s1_id, 'S9-x' FROM picks WHERE {_LAST} = '2'
UNION ALL SELECT DISTINCT 'match not a candidate', s1_id, '' FROM picks WHERE {_LAST} = '2'""",
    ),
}
