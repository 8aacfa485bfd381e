"""Tables written to the folder that driver and executors share, to cut lineage and survive lost executors."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from kinspark.operators.written import release_native_memory

#: Written tables since the last sweep from which on one is worth its garbage collection.
SWEEP_BYTES = 4 << 20
#: Written tables after which the driver gives native memory back, however small they are.
RELEASE_TABLES = 8


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; in local mode, where it is unset, a temporary one of this process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="kinspark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", f"file://{folder}")
    return f"file://{folder}"


def _files(spark: SparkSession, path: str):
    """The file system and the path as Spark's JVM has them."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


#: Folders of operator calls whose tables may still be read.
_roots: list[str] = []


def clear(spark: SparkSession) -> None:
    """Delete the written tables of all operator calls so far; for callers who have used or saved the results."""
    while _roots:
        files, place = _files(spark, _roots.pop())
        files.delete(place, True)


class Scratch:
    """Written intermediate tables of one operator call. Results read from them, so they stay until ``clear``."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.fresh, self.written = spark, 0, 0
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        _roots.append(self.root)

    def table(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` and return it as read back; a lost executor then costs no recomputation."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        files, place = _files(self.spark, path)
        self.fresh += files.getContentSummary(place).getLength()
        self.written += 1
        if self.written % RELEASE_TABLES == 0:
            release_native_memory(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)

    def sweep(self) -> None:
        """Let Spark's cleaner delete the shuffle files of queries that are over; it follows the driver's garbage collection.

        The session holds on to its last query, so an empty one comes first. After a few MB of tables there is nothing to gain
        on disk; native memory is given back all the same."""
        release_native_memory(self.spark)
        if self.fresh < SWEEP_BYTES:
            return
        self.fresh = 0
        self.spark.range(1).collect()
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, name: str) -> None:
        """Delete a written table that nothing reads any more."""
        files, place = _files(self.spark, f"{self.root}/{name}")
        files.delete(place, True)
