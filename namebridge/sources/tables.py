"""Stage tables: written in full on every run, read back by name.

A written stage cuts the lineage and survives lost executors, since it lies on shared storage.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder.

    Only in local mode, as in tests, a temporary folder of this machine may stand in for it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="namebridge-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class TableStore:
    """Stage tables either as Parquet folders below ``root`` or in the catalog under ``database``."""

    spark: SparkSession
    root: str | None = None
    database: str | None = None

    def __post_init__(self) -> None:
        if (self.root is None) == (self.database is None):
            raise ValueError("give either root or database")

    def create_database(self) -> None:
        if self.database is not None:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")

    def write(self, name: str, df: DataFrame, tags: dict[str, str] | None = None) -> DataFrame:
        """Overwrite the table, tag it (catalog only) and return it as read back."""
        if self.root is not None:
            df.write.mode("overwrite").parquet(f"{self.root}/{name}")
        else:
            table = f"{self.database}.{name}"
            df.write.mode("overwrite").format("parquet").saveAsTable(table)
            if tags:
                properties = ", ".join(f"'{key}'='{value}'" for key, value in tags.items())
                self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({properties})")
        return self.read(name)

    def _bucketed_name(self, name: str) -> str:
        if self.root is None:
            return f"{self.database}.{name}"
        return f"{name}_{hashlib.sha256(self.root.encode()).hexdigest()[:16]}"

    def write_bucketed(self, name: str, df: DataFrame, columns: list[str], buckets: int) -> DataFrame:
        """Overwrite the table, hashed by the columns into buckets, one sorted file each.

        Joins on the columns then read it without a shuffle. The catalog knows the buckets; for a store of folders
        that is the session's, and a later session reads the same files as a plain table.
        """
        table = self._bucketed_name(name)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        writer = df.repartition(buckets, *columns).write.mode("overwrite").format("parquet")
        writer = writer.bucketBy(buckets, *columns).sortBy(*columns)
        if self.root is not None:
            writer = writer.option("path", f"{self.root}/{name}")
        writer.saveAsTable(table)
        return self.read_bucketed(name)

    def read_bucketed(self, name: str) -> DataFrame:
        table = self._bucketed_name(name)
        return self.spark.table(table) if self.spark.catalog.tableExists(table) else self.read(name)

    def read(self, name: str) -> DataFrame:
        if self.root is not None:
            return self.spark.read.parquet(f"{self.root}/{name}")
        return self.spark.table(f"{self.database}.{name}")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a stage that later steps read more than once, and read it back."""
    spark = df.sparkSession
    return TableStore(spark, root=scratch_dir(spark, label)).write("stage", df)
