"""Stop a streaming query after N input messages: cancel at once, or drain first.

``CountedStop`` counts in the state of a query of its own: every task sends one partial count a micro-batch to a processor
with one key, whose total is in the checkpoint, so it goes on after a restart and passes each threshold once. The stop
instruction is a file: one that a crash kept from being carried out is carried out after the restart. ``StopAfter``
counts progress events in the driver, for queries that need no restart.

Draining lets the query finish the data that was there when the instruction came, up to a time limit: on a live
topic new messages never end, so waiting until nothing is left may never return.
"""

from __future__ import annotations

import json
import sys
import threading
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventwatch.config import read_text, write_text
from eventwatch.operators.threshold import HowToStop, StopInstruction, crossing

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class ThresholdProcessor(StatefulProcessor):
    """One key: the total so far; a row for every threshold that a micro-batch takes it over."""

    def __init__(self, thresholds: list[int]):
        self.thresholds = sorted(thresholds)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total LONG")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        was = self.total.get()[0] if self.total.exists() else 0
        now = was + sum(int(pdf["n"].sum()) for pdf in rows)
        self.total.update((now,))
        passed = [n for n in self.thresholds if crossing(was, now - was, n)]
        if passed:
            yield pd.DataFrame({"threshold": passed, "total": [now] * len(passed)})

    def close(self) -> None:
        pass


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = sum(b.num_rows for b in batches)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])


def thresholds_reached_stream(stream: DataFrame, thresholds: list[int], message: str = "read at least {n} messages") -> DataFrame:
    """(threshold, total, message): one row when the number of elements of ``stream`` reaches a threshold, ever."""
    counts = stream.select(F.lit(1).cast("tinyint").alias("one")).mapInArrow(_partial_counts, "n long")
    passed = counts.withColumn("key", F.lit(0)).groupBy("key").transformWithStateInPandas(
        statefulProcessor=ThresholdProcessor(thresholds), outputStructType="threshold LONG, total LONG", outputMode="Append", timeMode="None")
    return passed.withColumn("message", F.format_string(message.replace("{n}", "%d"), "threshold"))


class CountedStop:
    """Stop after ``limit`` elements, counted over restarts. ``folder`` is kept with the checkpoints."""

    def __init__(self, spark: SparkSession, folder: str, limit: int, how: HowToStop = HowToStop.cancel):
        self.spark, self.folder, self.limit, self.how = spark, folder.rstrip("/"), limit, how
        self.path = f"{self.folder}/instruction.json"

    def start(self, stream: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        """Count the elements of ``stream`` from its first one on."""
        def note(batch: DataFrame, batch_id: int) -> None:
            rows = batch.select("message").collect()  # none, or the one of the limit
            if rows:
                write_text(self.spark, self.path, json.dumps({"how": self.how.value, "reason": rows[0][0], "done": False}))

        w = (thresholds_reached_stream(stream, [self.limit]).writeStream.foreachBatch(note)
             .option("checkpointLocation", f"{self.folder}/count").queryName("count"))
        return (w.trigger(**trigger) if trigger else w).start()

    @property
    def instruction(self) -> StopInstruction | None:
        """The instruction that is to be carried out, if any."""
        text = read_text(self.spark, self.path)
        said = json.loads(text) if text else {"done": True}
        return None if said["done"] else StopInstruction(HowToStop(said["how"]), said["reason"])

    def carried_out(self) -> None:
        text = read_text(self.spark, self.path)
        if text:
            write_text(self.spark, self.path, json.dumps(json.loads(text) | {"done": True}))


class StopAfter(StreamingQueryListener):
    """Counts the watched query's messages from progress events; fires once on crossing ``limit``.

    With ``counter`` (a metric observed as ``name`` on the query) that metric is counted instead of all input rows, so a
    query over two sources can count the first one only.
    """

    def __init__(self, limit: int, how: HowToStop = HowToStop.cancel, name: str | None = None, counter: str | None = None):
        self.limit, self.how, self.name, self.counter = limit, how, name, counter
        self.total = 0
        self.instruction: StopInstruction | None = None
        self.query_id: str | None = None

    def watch(self, query: StreamingQuery) -> None:
        self.query_id = str(query.id)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.query_id is not None and str(p.id) != self.query_id:
            return
        n = int(p.numInputRows)
        if self.counter is not None:
            seen = p.observedMetrics.get(self.name)
            n = int(seen[self.counter]) if seen is not None else 0
        if self.instruction is None and crossing(self.total, n, self.limit):
            self.instruction = StopInstruction(self.how, f"read at least {self.limit} messages")
        self.total += n

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def enforce(query: StreamingQuery, listener: StopAfter | CountedStop, drain_seconds: float = 600) -> bool:
    """Apply a pending stop instruction on the driver; True when the query was stopped."""
    instruction = listener.instruction
    if instruction is None or not query.isActive:
        return False
    if instruction.how is HowToStop.drain:
        drain(query, drain_seconds)
    query.stop()
    return True


def stop_all(queries: list[StreamingQuery], stop: CountedStop, drain_seconds: float = 600) -> bool:
    """Carry a pending instruction out on all queries, the first one (the reader of the sources) first."""
    instruction = stop.instruction
    if instruction is None:
        return False
    for q in queries:
        if q.isActive and instruction.how is HowToStop.drain:
            drain(q, drain_seconds)
        q.stop()
    stop.carried_out()
    return True


def drain(query: StreamingQuery, seconds: float) -> None:
    """Wait until the query has processed what is available, ``seconds`` at most."""
    waiter = threading.Thread(target=query.processAllAvailable, daemon=True)
    waiter.start()
    waiter.join(seconds)
