"""Raw export of a stream: one ``.json`` file a minute, written when the watermark closes the minute (K7).

Every micro-batch adds its rows to a staging table, partitioned by minute and batch, and keeps the watermark in a small
file (``marks/<batch>.json``) beside the checkpoint. Minutes that the watermark has passed are written from staging by
one job and moved into place by renames, so a reader sees no half file. A file's name is made from the query's id, the
minute and the closing batch: a repeated batch writes the same names again. A batch's staged rows are deleted by the next
batch, when the files they went to are committed for certain.

A row that comes behind the watermark is not dropped: its minute gets one further file. A message without a publish time
goes to the partition that Spark names for null. With ``close_all`` every micro-batch is a whole input (an ``availableNow``
run over the parsed log, which is one batch): it closes all its minutes, as the end of the input does. The rows of a minute pass through one task as a stream (``shards`` tasks
and files for very busy minutes).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventwatch.config import _file_system, read_text, write_text
from eventwatch.functions import formats
from eventwatch.operators.sessions import interval_ms
from eventwatch.sinks.tables import slice_of

MINUTE_MS = 60_000
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def minute_folder(minute: int | None) -> str:
    """eventDate=/eventHour=/eventMinute= of a minute since the epoch (UTC)."""
    if minute is None:
        return f"eventDate={NULL_PARTITION}/eventHour={NULL_PARTITION}/eventMinute={NULL_PARTITION}"
    t = dt.datetime(1970, 1, 1) + dt.timedelta(minutes=minute)
    return f"eventDate={t:%Y-%m-%d}/eventHour={t:%H}/eventMinute={t:%M}"


class MinuteExport:
    """Writes micro-batches of raw messages (payload, publish_ts) to ``path``; ``folder`` is kept with the checkpoints."""

    def __init__(self, path: str, folder: str, lateness: str = "0 seconds", shards: int = 1,
                 close_all: bool = False):
        self.close_all = close_all
        self.path, self.folder = path.rstrip("/"), folder.rstrip("/")
        self.lateness_ms, self.shards = interval_ms(lateness), shards
        self.staging, self.checkpoint = f"{self.folder}/staging", f"{self.folder}/checkpoint"

    def _mark(self, spark, batch_id: int) -> dict:
        text = read_text(spark, f"{self.folder}/marks/{batch_id}.json") if batch_id >= 0 else None
        return json.loads(text) if text else {"seen": None, "closed": []}

    def _forget(self, spark, batch_id: int) -> None:
        """Delete what ``batch_id``, now committed, has exported, and the mark before its own."""
        for minute in self._mark(spark, batch_id)["closed"]:
            fs, folder = _file_system(spark, f"{self.staging}/minute={NULL_PARTITION if minute is None else minute}")
            if not fs.exists(folder):
                continue
            for s in fs.listStatus(folder):  # a repeated batch may have staged rows of its own here
                if int(s.getPath().getName().split("=")[1]) <= batch_id:
                    fs.delete(s.getPath(), True)
            if not fs.listStatus(folder):
                fs.delete(folder, False)
        fs, old = _file_system(spark, f"{self.folder}/marks/{batch_id - 1}.json")
        fs.delete(old, False)

    def _staged(self, spark) -> list[int | None]:
        """The minutes that have staged rows, from the names of their folders."""
        fs, folder = _file_system(spark, self.staging)
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        values = [n.split("=")[1] for n in names if n.startswith("minute=")]
        return [None if v == NULL_PARTITION else int(v) for v in values]

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        self._forget(spark, batch_id - 1)
        minute = F.floor(F.unix_millis("publish_ts") / MINUTE_MS)
        rows = formats.normalised_json(batch).select("value", minute.alias("minute"), F.lit(batch_id).alias("batch"))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("minute", "batch").parquet(self.staging))
        newest = batch.agg(F.max(F.unix_millis("publish_ts"))).first()[0]
        seen = max((x for x in (self._mark(spark, batch_id - 1)["seen"], newest) if x is not None), default=None)
        closed = [m for m in self._staged(spark) if self.close_all or m is None or (seen is not None and (m + 1) * MINUTE_MS + self.lateness_ms <= seen)]
        if closed:
            self._publish(spark, closed, slice_of(spark, self.checkpoint, batch_id), batch_id)
        write_text(spark, f"{self.folder}/marks/{batch_id}.json", json.dumps({"seen": seen, "closed": closed}))

    def _publish(self, spark, minutes: list[int | None], slice_id: str, batch_id: int) -> None:
        work = f"{self.path}/temp/{slice_id}"
        staged = spark.read.schema("value STRING, minute LONG, batch LONG").parquet(self.staging)
        wanted = F.col("minute").isin([m for m in minutes if m is not None])
        if None in minutes:
            wanted = wanted | F.col("minute").isNull()
        part = F.pmod(F.xxhash64("value"), F.lit(self.shards))
        rows = staged.filter(wanted).select("value", "minute", part.alias("shard")).repartition("minute", "shard")
        rows.write.mode("overwrite").partitionBy("minute", "shard").text(work)
        fs, root = _file_system(spark, work)
        for m in minutes:
            source = f"minute={NULL_PARTITION if m is None else m}"
            to = _file_system(spark, f"{self.path}/data/{minute_folder(m)}")[1]
            fs.mkdirs(to)
            for shard in range(self.shards):
                folder = _file_system(spark, f"{work}/{source}/shard={shard}")[1]
                if not fs.exists(folder):
                    continue
                name = uuid.uuid5(uuid.NAMESPACE_OID, f"{slice_id}/{m}/{shard}")
                for s in fs.listStatus(folder):  # one file: one task has all rows of a minute and shard
                    if s.getPath().getName().startswith("part-"):
                        _replace(spark, s.getPath(), _file_system(spark, f"{self.path}/data/{minute_folder(m)}/{name}.json")[1])
        fs.delete(root, True)

    def start(self, messages: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        w = (messages.select("payload", "publish_ts").writeStream.foreachBatch(self.write)
             .option("checkpointLocation", self.checkpoint).queryName("export"))
        return (w.trigger(**trigger) if trigger else w).start()


def _replace(spark, source, to) -> None:
    """Move a file to its place; a file of that name is replaced as a whole."""
    jvm = spark._jvm
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(source, context.makeQualified(to), overwrite)
