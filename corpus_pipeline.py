"""A corpus pipeline over the documents table: five stages, each one operator of ``kinspark.llm`` on all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.llm import jaccard, line_dedup, packing, secrets, toxicity
from kinspark.llm.queries import BYTE_BPE
from kinspark.llm.shared import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: Rows of text that go to a Python worker at a time, at most.
ARROW_ROWS = 2000


def _in_small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """Lowers the session's Arrow batch size for a stage and what reads it, so that workers that live through all stages stay small."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
        if not 0 < int(spark.conf.get(setting)) <= ARROW_ROWS:
            spark.conf.set(setting, ARROW_ROWS)
        return stage(spark, docs, sf_dir)

    return run_stage


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text where a stage has changed it."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


@_in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model rejects go. Null and empty texts have no toxic word and stay; an empty table stays empty;
    repeated rows fare alike; without labels of both kinds every document stays."""
    model = toxicity.fit_severity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs.select(COLUMNS), model)


@_in_small_batches
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go, and documents that are left without a word by that.

    Documents that repeat nothing stay as they are, null, empty and blank texts among them; of repeated rows with one id and text
    all stay or go alike; an empty table stays empty."""
    return _with_length(line_dedup.drop_repeated_lines(docs.select(COLUMNS), emptied=False))


@_in_small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the least id stays: sets of five words, similarity 0.8.

    Null, empty and blank texts link with nothing and all stay; null ids come last; rows that repeat id and text are copies."""
    return jaccard.keep_one(docs.select(COLUMNS), size=5, percent=80)


@_in_small_batches
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text give way to a mark; every document stays, null texts as null."""
    return _with_length(secrets.redact_secrets(docs.select(COLUMNS)))


@_in_small_batches
def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 2048, as places of pieces. A null or empty text is one piece of its end id; an empty table gives no rows."""
    return packing.pack(docs, BYTE_BPE, 2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table, each result written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.table(name, stage(spark, docs, sf_dir))
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs


#: The toxicity model is fitted, near duplicates are found by hashes and tokens come from a vocabulary file: no SQL.
ORACLE_SQL = None
