"""Sources and sinks of entity files."""

from __future__ import annotations

import json
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

COLUMNS = ("entity_id", "business_name", "business_address", "country")
# Fields that a delimited file uses for "no value".
NO_VALUE = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _text(c: str) -> Column:
    return F.when(F.col(c).isNull() | F.col(c).isin(*NO_VALUE), F.lit("")).otherwise(F.col(c)).alias(c)


def read_strings(spark: SparkSession, path: str, required: tuple[str, ...], no_value: bool = True, multiline: bool = False) -> DataFrame:
    """A tab-separated file with header and ``"`` quotes, all strings; required columns only, in their order.

    Files are split between tasks at line ends; with ``multiline`` quoted fields may hold line ends, and a file is one task's."""
    options = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "multiLine": multiline, "encoding": "UTF-8"}
    names = spark.read.options(**options).csv(path).columns
    missing = [c for c in required if c not in names]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}")
    # The schema is given, so the file's values are never looked at to guess types.
    rows = spark.read.options(**options).schema(StructType([StructField(n, StringType()) for n in names])).csv(path)
    return rows.select(*(_text(c) if no_value else F.coalesce(c, F.lit("")).alias(c) for c in required))


def read_entities(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """S1, S1a, S1b."""
    return read_strings(spark, path, COLUMNS, multiline=multiline)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store Spark reads it from."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def read_sources(spark: SparkSession, folder: str, split: str, names: tuple[str, ...] | None = None) -> DataFrame:
    """The three files of a split as one table with columns ``split`` and ``source`` (1 to 3)."""
    names = tuple(names or (f"{split}_source{k}.tsv" for k in (1, 2, 3)))
    if len(names) != 3:
        raise ValueError(f"three source files are needed, got {len(names)}")
    if lacking := [n for n in names if not _exists(spark, f"{folder}/{n}")]:
        raise FileNotFoundError(f"{lacking} not in {folder}; expected {list(names)}")
    parts = [read_entities(spark, f"{folder}/{n}").withColumns({"split": F.lit(split), "source": F.lit(k)}) for k, n in enumerate(names, 1)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """S3: (s1_id, ids); blank pieces go, kept ones aren't trimmed, the last row of a repeated key counts."""
    rows = read_strings(spark, path, ("source1_entity_id", "matched_entity_ids"))
    last = rows.withColumn("_row", F.monotonically_increasing_id()).groupBy("source1_entity_id").agg(F.max_by("matched_entity_ids", "_row").alias("ids"))
    return last.select(F.col("source1_entity_id").alias("s1_id"), F.filter(F.split("ids", ","), lambda x: F.trim(x) != "").alias("ids"))


def truth_pairs(truth: DataFrame) -> DataFrame:
    return truth.select("s1_id", F.explode("ids").alias("cand_id"))


def read_lists(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(s1_id, ids) of a written result; only empty pieces go."""
    rows = read_strings(spark, path, ("source1_entity_id", column))
    return rows.select(F.col("source1_entity_id").alias("s1_id"), F.filter(F.split(column, ","), lambda x: x != "").alias("ids"))


def write_lists(lists: DataFrame, path: str, column: str) -> None:
    """One tab-separated row for each entity, by id, ids comma-joined and unquoted, one part file."""
    lines = lists.orderBy("s1_id").select(F.concat_ws("\t", "s1_id", F.array_join("ids", ",")).alias(f"source1_entity_id\t{column}"))
    lines.coalesce(1).write.mode("overwrite").option("header", True).option("quote", "").option("delimiter", "\x01").option("emptyValue", "").option("ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False).csv(path)


def write_results(lists: DataFrame, path: str) -> None:
    write_lists(lists, path, "matched_entity_ids")


def write_candidates(lists: DataFrame, path: str) -> None:
    write_lists(lists.withColumn("ids", F.array_sort("ids")), path, "candidate_entity_ids")


def cache_path(cache_dir: str, name: str) -> str:
    """S14; writers create what is missing."""
    return f"{cache_dir.rstrip('/')}/{name}"


def write_cache(df: DataFrame, path: str) -> DataFrame:
    """A table between stages (normalized rows, truth, candidates, vectors) as Parquet, read back; an empty table is written too."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return read_cache(df.sparkSession, path)


def read_cache(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A table between stages, of the named columns."""
    found = spark.read.parquet(path)
    return found.select(columns) if columns else found


def write_thresholds(path: str, t_open: float, t_add: float, score: float) -> None:
    """S9."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps({"t_open": t_open, "t_add": t_add, "oof_f05": score}))


def read_thresholds(path: str) -> dict[str, float]:
    """S10."""
    return json.loads(Path(path).read_text())


def package(output: str, code: str, target: str, extras: tuple[str, ...] = ()) -> None:
    """Zip the output folder and the code (under ``code/``), caches left out, with extra files that exist."""
    skip = ("__pycache__", ".pyc", ".DS_Store")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for top, prefix in ((Path(output), "output"), (Path(code), f"code/{Path(code).name}")):
            for p in sorted(top.rglob("*")):
                if p.is_file() and not any(s in str(p) for s in skip):
                    out.write(p, f"{prefix}/{p.relative_to(top)}")
        for p in map(Path, extras):
            if p.exists():
                out.write(p, f"code/{p.name}")
