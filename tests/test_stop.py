"""Counting to a threshold over restarts."""

import os

from eventwatch.config import Options
from eventwatch.operators.threshold import HowToStop
from eventwatch.plans.pipeline import Inputs, counted_stop, start_monitor
from eventwatch.sources.messages import read_messages
from eventwatch.streaming.stop import CountedStop, stop_all, thresholds_reached_stream
from helpers import messages, payload
from test_streaming import run_stream


def land(spark, path, n, first=0):
    messages(spark, [(payload(), str(first + i), 10 ** 9 + first + i) for i in range(n)]).repartition(3).write.mode("append").parquet(path)


def read(spark, path):
    return read_messages(spark, path, "parquet", streaming=True)


def test_each_threshold_once(spark, scratch):
    path = os.path.join(scratch, "in")
    land(spark, path, 25)
    reached = thresholds_reached_stream(read(spark, path), [23, 25, 26], "Reached {n}")
    run_stream(reached, scratch, "reached")
    assert sorted(r.message for r in spark.table("reached").collect()) == ["Reached 23", "Reached 25"]


def test_count_goes_on_after_restarts(spark, scratch):
    path, folder = os.path.join(scratch, "in"), os.path.join(scratch, "stop")
    said = []
    for k in range(5):
        land(spark, path, 10, 10 * k)
        stop = CountedStop(spark, folder, 25, HowToStop.drain)  # a new process with the old checkpoint
        stop.start(read(spark, path), {"availableNow": True}).awaitTermination(120)
        said.append(stop.instruction)
        if k == 3:
            stop.carried_out()
    assert [s is not None for s in said] == [False, False, True, True, False]  # stands until it is carried out, and comes once
    assert said[2].how is HowToStop.drain and said[2].reason == "read at least 25 messages"


def test_monitor_stops_at_its_limit_after_a_restart(spark, scratch):
    first, second = os.path.join(scratch, "in"), os.path.join(scratch, "in2")
    opts = Options(output_dir=os.path.join(scratch, "wh"), create_tables=True, clock="event", checkpoint_dir=os.path.join(scratch, "ck"),
                   max_messages=15, stop="drain")
    land(spark, second, 30)                       # the second source does not count
    for k, stopped in enumerate((False, True)):
        land(spark, first, 10, 10 * k)
        queries = start_monitor(spark, Inputs(read(spark, first), read(spark, second)), opts, {"availableNow": True})
        for q in queries:
            q.awaitTermination(120)
        assert stop_all(queries, counted_stop(spark, opts)) is stopped
