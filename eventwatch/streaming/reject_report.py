"""Failed-insert report of a running monitor: rows that tables refused, per table and fixed window (K2, W4).

A stream follows the tables' rejects (a rejected slice is written once, so a retry is not counted twice). Ticks move the
watermark when nothing is rejected, so a window is reported soon after its end; windows without rejects give no row.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventwatch.config import FAILED_INSERT_WINDOW, _file_system
from eventwatch.sinks.tables import _write, slice_of
from eventwatch.sources.ticks import ticks

LOG = logging.getLogger("eventwatch.rejects")


def rejects_stream(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """(table, rejected_ts) of every refused row, from the rejects of ``tables`` (name -> path)."""
    def one(name: str, path: str) -> DataFrame:
        fs, folder = _file_system(spark, f"{path}_rejected")
        fs.mkdirs(folder)
        rows = spark.readStream.schema("rejected_ts TIMESTAMP").option("recursiveFileLookup", "true").parquet(f"{path}_rejected")
        return rows.select(F.lit(name).alias("table"), "rejected_ts")
    return reduce(DataFrame.union, [one(n, p) for n, p in tables.items()])


def report_stream(rejects: DataFrame, window: str = FAILED_INSERT_WINDOW, delay: str = "30 seconds") -> DataFrame:
    """(table, window_start, window_end, failed_rows), each window once, when it is ``delay`` past."""
    beats = ticks(rejects.sparkSession, window).select(F.lit("").alias("table"), F.col("timestamp").alias("rejected_ts"), F.lit(0).alias("n"))
    counts = (rejects.withColumn("n", F.lit(1)).union(beats).withWatermark("rejected_ts", delay)
              .groupBy("table", F.window("rejected_ts", window).alias("w")).agg(F.sum("n").alias("failed_rows")))
    # On the sum, as a filter on the table would be pushed below the watermark and take the ticks away.
    return counts.filter(F.col("failed_rows") > 0).select(
        "table", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "failed_rows")


def start_report(spark: SparkSession, tables: dict[str, str], path: str, folder: str, window: str = FAILED_INSERT_WINDOW,
                 delay: str = "30 seconds", trigger: dict | None = None) -> StreamingQuery:
    """Write the report to the table ``path`` and to the log; ``folder`` is kept with the checkpoints."""
    checkpoint = f"{folder}/checkpoint"

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.collect()   # one row a table and closed window; most ticks close windows without any
        if rows:
            closed = spark.createDataFrame(rows, batch.schema)
            _write(closed, path, [], slice_of(spark, checkpoint, batch_id), "parquet")
        for r in rows:
            LOG.warning("%d rows refused by %s from %s to %s", r.failed_rows, r.table, r.window_start, r.window_end)

    w = (report_stream(rejects_stream(spark, tables), window, delay).writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint).queryName("reject_report"))
    return (w.trigger(**trigger) if trigger else w).start()
