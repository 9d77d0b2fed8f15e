"""Client files matched as they arrive, against a static register and internal list.

Two streams run one after the other, each with a checkpoint of its own:

1. *Landing.* New files are told apart by their headers. Files whose normalised headers agree are read together, as
   the batch ingest reads them (any order and spelling of columns, optional ones absent); their clients are written
   in one shape. A file without a ``client_name`` column is set aside with its lines, and the stream goes on.
2. *Matching.* The landed clients pass a stateful de-duplication by client id, so a client that arrives again, in
   whatever file, run or batch, is not matched again and keeps its first rows. Each batch writes its candidates, match
   results, review queue, hierarchy and gold rows.

The state of a client lies in the stream's state store, so no table of earlier results is read again. A batch that is
repeated after a failure starts from the state before it and overwrites its own folders.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namebridge.config import MatchConfig
from namebridge.contracts import CLIENT_RAW, CLIENT_UPLOAD
from namebridge.operators.best_candidates import best_candidates
from namebridge.operators.hierarchy import enrich_hierarchy
from namebridge.operators.ingest import ingest_clients, rejected_clients
from namebridge.operators.mapping import map_to_internal
from namebridge.operators.normalise import clean_clients
from namebridge.operators.ranking import match_results, review_queue
from namebridge.operators.register_index import RegisterIndex
from namebridge.sources.csv_files import read_upload_csv, upload_headers
from namebridge.sources.headers import fill_missing
from namebridge.sources.tables import TableStore

_FILES = "path string, modificationTime timestamp, length long, content binary"
_LANDED = T.StructType([
    *CLIENT_RAW.fields, T.StructField("client_source", T.StringType()),
    T.StructField("ingestion_timestamp", T.TimestampType()),
])
_UPLOAD = T.StructType([*CLIENT_UPLOAD.fields, T.StructField("_source_file", T.StringType())])
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
#: Keeps the seen ids on disk instead of in the executors' heap.
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Header reads that run side by side.
_READERS = 8


def _literal_path(path: str) -> str:
    """A file name in which no character stands for a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


@dataclass
class LandingJob:
    """Lands the clients of the files in ``incoming`` that no earlier run has seen, and sets the others aside."""

    spark: SparkSession
    incoming: str
    output: str
    max_files_per_batch: int = field(default=100, kw_only=True)

    def run(self) -> None:
        """Land what has arrived, in batches of bounded size, and return."""
        files = (
            self.spark.readStream.format("binaryFile").schema(_FILES)
            .option("maxFilesPerTrigger", self.max_files_per_batch).load(self.incoming)
            .select("path")  # names only: contents are not read here
        )
        self._drain(files, self._land_batch, "landing")

    def _drain(self, stream: DataFrame, handle: Callable[[DataFrame, int], None], name: str) -> None:
        before = self.spark.conf.get(_STATE_STORE, None)
        self.spark.conf.set(_STATE_STORE, _ROCKSDB)
        try:
            stream.writeStream.foreachBatch(handle).option(
                "checkpointLocation", f"{self.output}/checkpoint/{name}"
            ).trigger(availableNow=True).start().awaitTermination()
        finally:
            if before is None:
                self.spark.conf.unset(_STATE_STORE)
            else:
                self.spark.conf.set(_STATE_STORE, before)

    # --- landing --------------------------------------------------------------------------------

    def _land_batch(self, files: DataFrame, batch_id: int) -> None:
        # At most max_files_per_batch names reach the driver.
        paths = sorted(_literal_path(r.path) for r in files.collect())
        with ThreadPoolExecutor(_READERS) as pool:
            headers = list(pool.map(lambda path: tuple(upload_headers(self.spark, path)), paths))
        groups: dict[tuple[str, ...], list[str]] = {}
        for path, names in zip(paths, headers, strict=True):
            groups.setdefault(names, []).append(path)
        uploads = [self.spark.createDataFrame([], _UPLOAD)]
        bad: list[tuple[str, str]] = []
        for names, members in groups.items():
            if "client_name" in names:
                upload = fill_missing(read_upload_csv(self.spark, members), CLIENT_UPLOAD.fieldNames())
                uploads.append(upload.select(*_UPLOAD.fieldNames()))
            else:
                bad += [(path, ",".join(names)) for path in members]
        upload = reduce(DataFrame.unionByName, uploads)
        ingest_clients(upload).select(*_LANDED.fieldNames()).write.mode("overwrite").parquet(
            f"{self.output}/landing/{batch_id:010d}")
        rejected = TableStore(self.spark, root=f"{self.output}/rejected/batch={batch_id}")
        rejected.write("rows", rejected_clients(upload))
        rejected.write("files", self.spark.createDataFrame(bad, "path string, headers string").select(
            "path", "headers", F.lit("no_client_name_column").alias("reject_reason")))
        if bad:
            lines = self.spark.read.text([path for path, _ in bad])
            rejected.write("lines", lines.select(F.col("_metadata.file_path").alias("_source_file"), "value"))

    # --- results so far -------------------------------------------------------------------------

    def _all(self, folder: str, table: str) -> DataFrame:
        root = f"{self.output}/{folder}"
        return self.spark.read.option("basePath", root).parquet(f"{root}/batch=*/{table}").drop("batch")

    def rejects(self) -> DataFrame:
        """Rows without a usable name."""
        return self._all("rejected", "rows")

    def rejected_files(self) -> DataFrame:
        """Files that were set aside, with their normalised headers."""
        return self._all("rejected", "files")

    def rejected_lines(self) -> DataFrame:
        """The lines of the files that were set aside; there must be one."""
        return self._all("rejected", "lines")


@dataclass
class ArrivalJob(LandingJob):
    """Matches the clients of the files in ``incoming`` that no earlier run has seen."""

    reference: DataFrame
    edges: DataFrame
    entities: DataFrame
    internal: DataFrame
    config: MatchConfig = field(default_factory=MatchConfig)
    #: The register's index, if it has one: batches then neither shuffle nor count the register.
    index: RegisterIndex | None = None

    def run(self) -> None:
        """Process what has arrived, in batches of bounded size, and return."""
        super().run()
        landed = (
            self.spark.readStream.schema(_LANDED)
            .option("maxFilesPerTrigger", self.max_files_per_batch).parquet(f"{self.output}/landing/*")
        )
        self._drain(landed.dropDuplicates(["client_entity_id"]), self._match_batch, "matching")

    # --- matching -------------------------------------------------------------------------------

    def _match_batch(self, arrived: DataFrame, batch_id: int) -> None:
        batch = self.config.with_(run_id=f"{self.config.run_id}-{batch_id}")
        store = TableStore(self.spark, root=f"{self.output}/batches/batch={batch_id}")
        # The stream's own plan, with its state, is run once: all else reads the written clients.
        clients = store.write("clients", clean_clients(arrived, batch))
        ranked = store.write("ranked", best_candidates(clients, self.reference, batch, index=self.index))
        matches = store.write("match_results", match_results(ranked, batch, clients))
        store.write("review_queue", review_queue(ranked, batch))
        hierarchy = store.write("hierarchy", enrich_hierarchy(matches, self.edges, self.entities, batch))
        store.write("gold", map_to_internal(hierarchy, self.internal, batch))

    # --- results so far ---------------------------------------------------------------------------

    def results(self) -> DataFrame:
        """Gold rows of all clients so far; a client that came again has those of its first batch."""
        return self._all("batches", "gold")

    def matches(self) -> DataFrame:
        """The best match of every client so far."""
        return self._all("batches", "match_results")

    def reviews(self) -> DataFrame:
        """The review queue of every client so far."""
        return self._all("batches", "review_queue")
