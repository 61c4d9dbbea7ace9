"""Session settings, table access and lineage cuts shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Settings the engine relies on; every one is a runtime or static Spark setting, none depends on the data.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, memory: str = "12g", app: str = "pairloom") -> SparkSession:
    """A single-JVM session for tests and benchmarks; a cluster brings its own."""
    build = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in (DEFAULTS | {"spark.driver.memory": memory, "spark.sql.shuffle.partitions": str(cores)}).items():
        build = build.config(k, v)
    spark = build.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` (a file or a folder) below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or in local mode a temporary one.

    A cluster without that setting is an error: a folder of one machine would not survive its loss.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="pairloom-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, so that its lineage ends and it is computed once."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def through_folder(spark: SparkSession, name: str, use: Callable[[str], DataFrame]) -> DataFrame:
    """What ``use`` gives for a folder of its own in the shared folder, computed; the folder is removed afterwards."""
    at = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    try:
        return cut(use(at))
    finally:
        remove(spark, at)


def remove(spark: SparkSession, at: str) -> None:
    """Removes a folder with all it holds."""
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def package_root() -> str:
    return os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
