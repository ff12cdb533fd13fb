"""Ticks over restarts: none lost, none twice."""

import os
import time

import pytest

from eventwatch.sources.ticks import TickReader, ticks

HOUR_MS = 3_600_000
T0 = 1_700_000_000_000


@pytest.mark.parametrize("every", ["1 second", "5 seconds", "2 minutes", "5 minutes"])
def test_reader_covers_every_tick_once(every):
    from eventwatch.operators.sessions import interval_ms
    period, now = interval_ms(every), [T0 / 1000]
    at, got = TickReader(period, clock=lambda: now[0]).initialOffset(), []
    for pause in (0, 0.3, 7, 400, 0, 3600):
        now[0] += pause                               # a reader of its own each time: a restart
        reader = TickReader(period, clock=lambda: now[0])
        to = reader.latestOffset()
        got += [n for p in reader.partitions(at, to) for n, _ in reader.read(p)]
        at = to
    assert got == list(range(got[0], got[-1] + 1)) and got[0] == T0 // period and got[-1] == int(now[0] * 1000) // period


def run(spark, scratch, df, name):
    q = (df.writeStream.format("parquet").option("path", os.path.join(scratch, name))
         .option("checkpointLocation", os.path.join(scratch, "ck-" + name)).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return sorted(r.tick for r in spark.read.parquet(os.path.join(scratch, name)).collect())


def test_ticks_over_a_restart(spark, scratch):
    assert run(spark, scratch, ticks(spark, "2 minutes", T0, T0 + HOUR_MS), "two") == list(range(14166667, 14166697))
    assert run(spark, scratch, ticks(spark, "2 minutes", T0, T0 + 2 * HOUR_MS), "two") == list(range(14166667, 14166727))


def test_live_seconds_over_a_restart(spark, scratch):
    first = run(spark, scratch, ticks(spark, "1 second"), "live")
    time.sleep(2)                                     # ticks of the pause are made up
    both = run(spark, scratch, ticks(spark, "1 second"), "live")
    assert first and both[0] == first[0] and both == list(range(both[0], both[-1] + 1)) and len(both) >= len(first) + 2
