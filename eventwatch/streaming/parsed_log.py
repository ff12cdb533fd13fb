"""The parsed log: what the parser writes once and every other query of the monitor reads, trimmed behind its readers.

A micro-batch of the parser is one slice, a folder of parquet files named by the batch's number. It is written aside and
moved into the log by one rename, so readers see a whole slice or none; a repeated batch finds its slice in place and
leaves it. Every reader observes the largest slice number that it has read. A slice is deleted when all readers have
committed a batch with a later one: slices come one after another, so a reader that has seen slice n has all before n.

Marks are taken from the queries' progress and only ever grow. After a restart a reader has no mark until it commits
a batch with rows; until then nothing is deleted. A reader that has stopped keeps its slices until it runs again.
A query that is added to a monitor later reads what is left of the log.
"""

from __future__ import annotations

import threading
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

from eventwatch.config import _file_system

METRIC = "parsed_log"
SLICE = "log_slice"
KEEP_AGE = "3650d"   # files are read in whatever order they came, however old: deleting is the log's own business


class ParsedLog:
    """A log of the rows of one streaming query at ``path``; ``folder`` keeps the query's checkpoint."""

    def __init__(self, spark: SparkSession, path: str, folder: str):
        self.spark, self.path, self.folder = spark, path.rstrip("/"), folder.rstrip("/")
        self.aside = f"{self.path}_new"
        self._readers: list[StreamingQuery] = []
        self._marks: dict[str, int] = {}
        self._lock = threading.Lock()
        fs, log = _file_system(spark, self.path)
        fs.mkdirs(log)
        if self.slices() and not fs.exists(_file_system(spark, f"{self.folder}/commits")[1]):
            raise RuntimeError(f"{self.path} has slices of another run: its checkpoint {self.folder} is gone; take a new folder for both")

    def slices(self) -> list[int]:
        """The numbers of the slices that are there, in order."""
        fs, log = _file_system(self.spark, self.path)
        names = [s.getPath().getName() for s in fs.listStatus(log)]
        return sorted(int(n) for n in names if n.isdigit())

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Write a micro-batch as a slice, unless its slice is there; then trim."""
        fs, to = _file_system(self.spark, f"{self.path}/{batch_id}")
        if not fs.exists(to):
            new = f"{self.aside}/{batch_id}"
            batch.withColumn(SLICE, F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(new)
            if not fs.rename(_file_system(self.spark, new)[1], to):
                raise RuntimeError(f"could not move {new} to {self.path}")
        self.trim()

    def write(self, rows: DataFrame, name: str, trigger: dict | None = None) -> StreamingQuery:
        """Start the query that fills the log."""
        w = rows.writeStream.foreachBatch(self.append).option("checkpointLocation", self.folder).queryName(name)
        return (w.trigger(**trigger) if trigger else w).start()

    def read(self, schema: StructType) -> DataFrame:
        """The log as a stream of rows of ``schema``."""
        with_slice = StructType([*schema.fields]).add(SLICE, LongType())
        rows = (self.spark.readStream.schema(with_slice).option("recursiveFileLookup", "true").option("maxFileAge", KEEP_AGE)
                .parquet(self.path))
        return rows.observe(METRIC, F.max(SLICE).alias("slice")).drop(SLICE)

    def follow(self, readers: Iterable[StreamingQuery]) -> None:
        """Name the queries that read the log. Nothing is deleted before."""
        with self._lock:
            self._readers = list(readers)

    def _mark(self, reader: StreamingQuery) -> int | None:
        """The largest slice that a committed batch of the reader has read from."""
        key = str(reader.id)
        for p in reader.recentProgress:
            seen = (p["observedMetrics"] or {}).get(METRIC)
            if seen is not None and seen["slice"] is not None:
                self._marks[key] = max(self._marks.get(key, -1), seen["slice"])
        return self._marks.get(key)

    def trim(self) -> list[int]:
        """Delete the slices that every reader has left behind; returns their numbers."""
        with self._lock:
            marks = [self._mark(r) for r in self._readers]
            if not marks or None in marks:
                return []
            gone = [s for s in self.slices() if s < min(marks)]
            for s in gone:
                fs, folder = _file_system(self.spark, f"{self.path}/{s}")
                fs.delete(folder, True)
            return gone
