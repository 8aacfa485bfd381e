"""The registered queries of this subpackage: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, jaccard, line_dedup, packing, quality, secrets, suffix_dedup, token_counts, topk, toxicity

#: Files of public vocabularies; a cluster may name others.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = toxicity.fit_severity(docs, _table(spark, sf_dir, "labels"))
    return toxicity.grade_severity(docs, model)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = line_dedup.mark_repeated_lines(_documents(spark, sf_dir))
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return marked.select(
        F.col("row.doc_id").alias("doc_id"),
        number(F.size(F.coalesce("lines", F.array().cast("array<string>")))).alias("n_lines"),
        number(F.size(F.coalesce("removed", F.array().cast("array<int>")))).alias("n_removed"),
        number(F.col("n_runs")).alias("n_runs"),
        number(F.col("longest")).alias("longest_run"),
        F.sha2(F.coalesce(line_dedup.kept_text(), F.lit("")), 256).alias("kept_sha256"),
    )


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(topk.integer_vectors(_table(spark, sf_dir, "embeddings")), F.expr("vec_id % 50 = 0"), 5)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_documents(spark, sf_dir), size=4, percent=85)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), BYTE_BPE, 2048)


def op6_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(_documents(spark, sf_dir), WORD_BPE)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_documents(spark, sf_dir), 100)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"), count("entropy").alias("n_entropy"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, sf_dir), BYTE_BPE, 512)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_toxicity, op2_line_dedup, op3_topk_search, op4_jaccard_join, op5_best_fit_packing, op6_bpe_roundtrip, op7_suffix_dedup, op8_secret_scan, op9_quality_rules, op10_token_counts)
}

_OP2 = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS x, unnest(generate_series(0, len(ls) - 1)) AS line FROM d WHERE text <> ''),
n AS (SELECT doc_id, x, line, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words,
             row_number() OVER (PARTITION BY doc_id ORDER BY line) AS pos
      FROM l WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
w AS (SELECT *, lead(x, 1) OVER o AS x1, lead(x, 2) OVER o AS x2, lead(words, 1) OVER o AS words1 FROM n WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
hit AS (
  SELECT doc_id, pos, 1 AS depth FROM (SELECT *, row_number() OVER (PARTITION BY x ORDER BY doc_id, pos) AS k FROM w WHERE words >= 50) WHERE k > 1
  UNION ALL
  SELECT doc_id, pos, 2 FROM (SELECT *, row_number() OVER (PARTITION BY x, x1 ORDER BY doc_id, pos) AS k FROM w WHERE x1 IS NOT NULL AND words + words1 >= 50) WHERE k > 1
  UNION ALL
  SELECT doc_id, pos, 3 FROM (SELECT *, row_number() OVER (PARTITION BY x, x1, x2 ORDER BY doc_id, pos) AS k FROM w WHERE x2 IS NOT NULL) WHERE k > 1),
gone AS (SELECT DISTINCT n.doc_id, n.pos, n.line FROM hit JOIN n ON n.doc_id = hit.doc_id AND n.pos >= hit.pos AND n.pos < hit.pos + hit.depth),
mark AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (first) AS n_runs
         FROM (SELECT *, coalesce(pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) > 1, true) AS first FROM gone) GROUP BY doc_id),
deep AS (
  SELECT 1 AS depth, doc_id, pos, words, g, row_number() OVER (PARTITION BY g ORDER BY doc_id, pos) > 1 AS later FROM (SELECT doc_id, pos, words, dense_rank() OVER (ORDER BY x) AS g FROM n)
  UNION ALL
  SELECT depth, doc_id, pos, words, g, row_number() OVER (PARTITION BY g ORDER BY doc_id, pos) > 1 FROM (
    SELECT *, count(*) OVER (PARTITION BY g) AS k FROM (
      SELECT r.depth + 1 AS depth, r.doc_id, r.pos, CASE WHEN r.depth = 1 THEN r.words + n.words ELSE r.words END AS words, dense_rank() OVER (ORDER BY r.g, n.x) AS g
      FROM deep r JOIN n ON n.doc_id = r.doc_id AND n.pos = r.pos + r.depth)) WHERE k > 1),
longest AS (SELECT doc_id, max(depth) AS longest_run FROM deep WHERE later AND (depth >= 3 OR words >= 50) GROUP BY doc_id),
kept AS (SELECT l.doc_id, string_agg(l.x, chr(10) ORDER BY l.line) AS t FROM l ANTI JOIN gone ON gone.doc_id = l.doc_id AND gone.line = l.line GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(len(d.ls), 0) AS n_lines, coalesce(mark.n_removed, 0) AS n_removed, coalesce(mark.n_runs, 0) AS n_runs, coalesce(longest.longest_run, 0) AS longest_run, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN longest ON longest.doc_id = d.doc_id LEFT JOIN mark ON mark.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

_OP3 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
           FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, b.vec_id, CAST(list_dot_product(q.e, b.e) AS BIGINT) AS score
      FROM v q JOIN v b ON q.vec_id <> b.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLE_SQL: dict[str, str] = {"op2_line_dedup": _OP2, "op3_topk_search": _OP3}
