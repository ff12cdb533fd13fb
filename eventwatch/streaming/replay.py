"""Line replay: text lines published as messages at a rate, each once over restarts (S8).

The lines are numbered once, into a table in ``folder`` cut into blocks, so a batch reads only the blocks of its lines.
Ticks pace the replay: every tick since this start allows ``rate`` lines. Before a batch publishes, it notes which lines
(``plans/<batch>.json``); a repeated batch follows its note, and a slice that is there is not written again. The end of
the newest note is the running count.
"""

from __future__ import annotations

import json
import logging
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventwatch.config import path_exists, read_text, write_text
from eventwatch.sinks.tables import _write_once, slice_of
from eventwatch.sources.ticks import ticks

LOG = logging.getLogger("eventwatch.replay")
BLOCK = 100_000   # lines


def numbered_lines(spark: SparkSession, paths: list[str], folder: str) -> DataFrame:
    """(place, value): the lines in the order of files and lines, from 0 on; numbered at the first call only."""
    raw, table = f"{folder}/raw", f"{folder}/lines"
    if not path_exists(spark, f"{table}/_SUCCESS"):
        i = F.monotonically_increasing_id()
        lines = spark.read.text(paths).select("value", F.shiftright(i, 33).alias("part"), i.bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))
        lines.write.mode("overwrite").parquet(raw)
        raw_lines = spark.read.parquet(raw)
        # One row a split of the files, so the running sum is over few rows.
        counts = raw_lines.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
        before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        places = raw_lines.join(counts.select("part", before.alias("first")), "part").select((F.col("first") + F.col("at")).alias("place"), "value")
        blocks = places.withColumn("block", F.floor(F.col("place") / BLOCK))
        blocks.repartition("block").write.mode("overwrite").partitionBy("block").parquet(table)
    return spark.read.schema("place LONG, value STRING, block LONG").parquet(table)


class LineReplay:
    def __init__(self, spark: SparkSession, paths: list[str], target: str, folder: str, rate: int, every: str = "1 second"):
        self.spark, self.target, self.folder = spark, target, folder.rstrip("/")
        self.rate, self.every, self.checkpoint = rate, every, f"{self.folder}/checkpoint"
        self.lines = numbered_lines(spark, paths, self.folder)
        self.total = self.lines.count()
        self.published = 0

    def _write(self, batch: DataFrame, batch_id: int, since: float) -> None:
        note = f"{self.folder}/plans/{batch_id}.json"
        text = read_text(self.spark, note)
        if text is None:
            last = read_text(self.spark, f"{self.folder}/plans/{batch_id - 1}.json")
            first = json.loads(last)["end"] if last else 0
            due = batch.filter(F.col("timestamp") >= F.timestamp_seconds(F.lit(since))).count()   # a pause allows no burst
            text = json.dumps({"first": first, "end": min(self.total, first + due * self.rate)})
            write_text(self.spark, note, text)
        plan = json.loads(text)
        if plan["end"] > plan["first"]:
            wanted = self.lines.filter(F.col("block").between(plan["first"] // BLOCK, (plan["end"] - 1) // BLOCK)
                                       & (F.col("place") >= plan["first"]) & (F.col("place") < plan["end"]))
            messages = wanted.select(F.encode("value", "UTF-8").alias("payload"), F.lit(None).cast("map<string,string>").alias("attributes"),
                                     F.concat(F.lit("line-"), F.col("place").cast("string")).alias("message_id"),
                                     F.current_timestamp().alias("publish_ts"))
            _write_once(messages, self.target, slice_of(self.spark, self.checkpoint, batch_id), "parquet")
            LOG.info("published %d of %d lines", plan["end"], self.total)
        self.published = plan["end"]

    @property
    def done(self) -> bool:
        return self.published >= self.total

    def start(self) -> StreamingQuery:
        since = time.time()
        return (ticks(self.spark, self.every).writeStream.foreachBatch(lambda b, n: self._write(b, n, since))
                .option("checkpointLocation", self.checkpoint).queryName("replay").start())

    def run(self) -> int:
        """Publish what is left, then stop; the running count."""
        query = self.start()
        try:
            while not self.done and query.isActive:
                time.sleep(0.2)
        finally:
            query.stop()
        if query.exception() is not None:
            raise query.exception()
        return self.published
