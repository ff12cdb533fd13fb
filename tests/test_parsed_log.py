"""The parsed log: whole slices, once over a repeated batch, trimmed behind the slowest reader."""

import os
import time

import pytest
from pyspark.sql import functions as F

from eventwatch.config import Options
from eventwatch.plans.pipeline import Inputs, start_monitor
from eventwatch.sources.messages import read_messages
from eventwatch.streaming.parsed_log import ParsedLog
from helpers import messages, payload

ROW = "n LONG, kind STRING"


def land(spark, folder, numbers):
    """One file a number, in order of time."""
    for n in numbers:
        part = os.path.join(folder, f"{n:04d}.json")
        with open(part, "w") as fh:
            fh.write(f'{{"n": {n}, "kind": "{"ab"[n % 2]}"}}\n')
        os.utime(part, (1_700_000_000 + n, 1_700_000_000 + n))


def start(spark, log, folder, name, out, keep=None):
    rows = log.read(spark.createDataFrame([], ROW).schema)
    rows = rows if keep is None else rows.filter(keep)
    return (rows.writeStream.format("parquet").option("path", f"{out}/{name}").option("checkpointLocation", f"{folder}/{name}")
            .trigger(processingTime="100 milliseconds").start())


def numbers(spark, path):
    return sorted(r.n for r in spark.read.schema(ROW).parquet(path).collect())


def wait(condition, seconds=90):
    end = time.time() + seconds
    while time.time() < end and not condition():
        time.sleep(0.2)
    assert condition()


class Reader:
    """Progress of a query, by the largest slice of each batch (None: no rows)."""

    def __init__(self, name, seen):
        self.id, self.recentProgress = name, [{"observedMetrics": {"parsed_log": {"slice": n}}} for n in seen]


def test_fifty_batches_leave_a_few_folders_and_a_stopped_reader_keeps_its_own(spark, scratch):
    source, base = os.path.join(scratch, "in"), os.path.join(scratch, "ck")
    os.makedirs(source)
    stream = spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).json(source)
    log = ParsedLog(spark, f"{base}/log", f"{base}/parse")
    fast = start(spark, log, base, "fast", scratch)
    slow = start(spark, log, base, "slow", scratch, F.col("kind") == "a")   # the filter must not hide slices from the mark
    log.follow([fast, slow])
    try:
        land(spark, source, range(50))
        log.write(stream, "parse", {"availableNow": True}).awaitTermination(120)
        for q in (fast, slow):
            q.processAllAvailable()
        wait(lambda: log.trim() or log.slices() == [49])
        assert numbers(spark, f"{scratch}/fast") == list(range(50)) and numbers(spark, f"{scratch}/slow") == list(range(0, 50, 2))

        slow.stop()
        land(spark, source, range(50, 60))
        log.write(stream, "parse", {"availableNow": True}).awaitTermination(120)
        fast.processAllAvailable()
        log.trim()
        assert log.slices() == list(range(49, 60))                 # all that the stopped reader has not left behind

        slow = start(spark, log, base, "slow", scratch, F.col("kind") == "a")
        log.follow([fast, slow])
        slow.processAllAvailable()
        wait(lambda: log.trim() or log.slices() == [59])
        assert numbers(spark, f"{scratch}/slow") == list(range(0, 60, 2)) and numbers(spark, f"{scratch}/fast") == list(range(60))
    finally:
        fast.stop()
        slow.stop()


def test_a_repeated_batch_keeps_its_slice_and_nothing_goes_without_marks(spark, scratch):
    log = ParsedLog(spark, f"{scratch}/log", f"{scratch}/parse")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], ROW)
    log.append(rows, 0)
    before = sorted(os.listdir(f"{scratch}/log/0"))
    log.append(rows, 0)
    log.append(rows.limit(0), 1)
    assert sorted(os.listdir(f"{scratch}/log/0")) == before and log.slices() == [0, 1]
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{scratch}/log").count() == 2
    assert log.trim() == []                                         # no readers are named
    log.follow([Reader("x", [0, None]), Reader("y", [])])
    assert log.trim() == [] and log.slices() == [0, 1]              # a reader without a mark keeps everything
    log.follow([Reader("x", [0, None]), Reader("y", [1])])
    assert log.trim() == [] and log.slices() == [0, 1]              # the slowest one may still want slice 0
    log.follow([Reader("x", [None, 1]), Reader("y", [])])
    assert log.trim() == [0] and log.slices() == [1]                # marks only grow: y was seen at 1
    with pytest.raises(RuntimeError):
        ParsedLog(spark, f"{scratch}/log", f"{scratch}/another")


def test_a_half_written_slice_is_never_read(spark, scratch):
    log = ParsedLog(spark, f"{scratch}/log", f"{scratch}/parse")
    rows = spark.createDataFrame([(1, "a")], ROW)
    rows.withColumn("log_slice", F.lit(0).cast("bigint")).write.parquet(f"{scratch}/log_new/0")   # a driver that died before the rename
    reader = start(spark, log, scratch, "reader", scratch)
    try:
        reader.processAllAvailable()
        assert not any(p["numInputRows"] for p in reader.recentProgress)
        log.append(spark.createDataFrame([(1, "a")], ROW), 0)
        reader.processAllAvailable()
        assert numbers(spark, f"{scratch}/reader") == [1]
    finally:
        reader.stop()


def test_the_running_monitor_trims_and_restarts(spark, scratch):
    """All queries of the monitor have marks; messages of all runs arrive once although their slices are gone."""
    path = os.path.join(scratch, "in")
    opts = Options(output_dir=os.path.join(scratch, "wh"), create_tables=True, checkpoint_dir=os.path.join(scratch, "ck"), clock="event",
                   findings_topic=os.path.join(scratch, "topic"), export_dir=os.path.join(scratch, "export"), max_messages=1000)
    sent = 0
    messages(spark, [(payload(), "m0", 0)]).limit(0).write.parquet(path)
    for run in range(2):
        queries = start_monitor(spark, Inputs(read_messages(spark, path, "parquet")), opts, {"processingTime": "100 milliseconds"})
        try:
            for k in range(4):
                messages(spark, [(payload(), f"m{sent}", sent * 1000)]).write.mode("append").parquet(path)
                sent += 1
                for q in queries[:1] + queries:
                    q.processAllAvailable()
            left = [n for n in os.listdir(f"{opts.checkpoint_dir}/parsed_log") if n.isdigit()]
            assert 1 <= len(left) <= 3, left
        finally:
            for q in queries:
                q.stop()
        assert spark.read.parquet(f"{opts.output_dir}/events").count() == sent
