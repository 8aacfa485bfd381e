"""Tables written once and read by several plans of a query, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


def _folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; in local mode, where it is unset, a temporary one of this process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="kinspark-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        folder = f"file://{path}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def release_native_memory(spark: SparkSession) -> bool:
    """Give back, if the JVM has the command, what the C library of the driver's JVM holds of freed memory.

    Spark plans and broadcasts on some hundred threads, whose arenas keep what compilers and codecs have freed; so the
    driver grows with the number of queries, however small they are."""
    jvm = spark.sparkContext._jvm
    try:
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        name = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        # The server's class is hidden in its module: only its interface can be called.
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        given = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
        given[0], given[1] = name, "systemTrimNativeHeap"
        invoke.invoke(server, given)
    except Py4JError:
        return False
    return True


def written(df: DataFrame) -> DataFrame:
    """``df`` as read back from Parquet: whoever uses it computes it no more, and a lost executor costs no recomputation.

    Spark's cleaner then deletes the shuffle files and broadcasts that it was made from: it follows the driver's garbage
    collection, and the session holds on to its last query, so an empty one comes first. Native memory is given back, too."""
    spark = df.sparkSession
    path = f"{_folder(spark)}/linkage-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    spark.range(1).collect()
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    release_native_memory(spark)
    return spark.read.schema(df.schema).parquet(path)
