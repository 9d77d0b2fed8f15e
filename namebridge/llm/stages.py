"""Written tables between the steps of an operator.

Steps are cut by tables in the folder that the cluster names in ``spark.checkpoint.dir``, which every
executor can read, so a lost executor costs a retry and never a result.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables; a temporary one only in local mode without a setting."""
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        directory = context._jsc.sc().getCheckpointDir()
        root = directory.get() if directory.isDefined() else None
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        context.setCheckpointDir(root)
        root = context._jsc.sc().getCheckpointDir().get()
    return root.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read again; the shuffle files of the step are freed."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/llm/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most so many rows, so that a batch of long texts fits a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) <= 0 or int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out(modulus: int, remainder: int):
    """crc32 of the id as text leaves the remainder; false for a null id."""
    crc = F.crc32(F.col("doc_id").cast("string"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))
