"""A rule table that changes while the stream runs."""

import os
import time

from pyspark.sql import functions as F

from eventwatch.config import Options, read_text
from eventwatch.functions.parse import parse_messages, valid_events
from eventwatch.plans.pipeline import Inputs, start_monitor
from eventwatch.sources.messages import read_messages
from eventwatch.streaming.live_rules import LiveRules
from eventwatch.streaming.user_state import user_findings_stream
from helpers import messages, payload

COLUMNS = "rule_id string, kind string, level string, pattern string, enabled boolean"
T0 = 10 ** 9


def table(spark, path, rows):
    spark.createDataFrame(rows, COLUMNS).coalesce(1).write.mode("overwrite").parquet(path)


def land(spark, path, rows):
    messages(spark, rows).coalesce(1).write.mode("append").parquet(path)


def seen(spark, name, n, seconds=90):
    """Rows of a memory table or parquet folder once there are ``n``."""
    end = time.time() + seconds
    while time.time() < end:
        try:
            rows = (spark.read.parquet(name) if os.sep in name else spark.table(name)).collect()
        except Exception:  # not there yet
            rows = []
        if len(rows) >= n:
            return rows
        time.sleep(0.5)
    raise AssertionError(f"{len(rows)} rows of {n}")


def test_change_between_two_batches_of_one_query(spark, scratch):
    rules, landing = os.path.join(scratch, "rules"), os.path.join(scratch, "in")
    table(spark, rules, [("a", "process_contains", "critical", "virus", True), ("off", "process_contains", "critical", "virus", False)])
    live = LiveRules(spark, rules, os.path.join(scratch, "live"))
    assert live.publish() and not live.publish()
    land(spark, landing, [(payload(process="virus1"), "1", T0), (payload(process="worm"), "2", T0 + 1)])
    ev = valid_events(parse_messages(read_messages(spark, landing, "parquet", streaming=True)))
    q = (user_findings_stream(ev, live_rules=live.column()).writeStream.format("memory").queryName("live_out").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(processingTime="500 milliseconds").start())
    try:
        assert {(r.rule_id, r.message_id) for r in seen(spark, "live_out", 1)} == {("a", "1")}
        table(spark, rules, [("b", "process_contains", "critical", "worm", True), ("new", "new_host", "critical", None, True)])
        assert live.publish()
        land(spark, landing, [(payload(process="virus1"), "3", T0 + 2), (payload(process="worm", dst="9.9.9.9"), "4", T0 + 3)])
        got = {(r.rule_id, r.message_id, r.description) for r in seen(spark, "live_out", 3)}
        assert got == {("a", "1", "Suspicious process: virus1"), ("b", "4", "Suspicious process: worm"), ("new", "4", "Newly accessed host: 9.9.9.9")}
        assert q.isActive and q.exception() is None
        table(spark, rules, [])                         # no rules: no findings, no failure
        live.publish()
        land(spark, landing, [(payload(process="worm"), "5", T0 + 4)])
        q.processAllAvailable()
        assert len(spark.table("live_out").collect()) == 3
    finally:
        q.stop()


def test_refresh_query_publishes_on_its_own(spark, scratch):
    rules = os.path.join(scratch, "rules")
    table(spark, rules, [("a", "new_host", "warning", None, True)])
    live = LiveRules(spark, rules, os.path.join(scratch, "live"))
    q = live.start_refresh("1 second", os.path.join(scratch, "ck"))
    try:
        for name in ("a", "b"):
            table(spark, rules, [(name, "new_host", "warning", None, True)])
            end = time.time() + 60
            while time.time() < end and f'"{name}"' not in (read_text(spark, live.path) or ""):
                time.sleep(0.3)
            assert f'"rule_id":"{name}"' in read_text(spark, live.path)
        assert q.isActive
    finally:
        q.stop()


def test_monitor_takes_the_rules_of_the_table(spark, scratch):
    rules, landing, out = (os.path.join(scratch, d) for d in ("rules", "in", "wh"))
    table(spark, rules, [("only", "process_contains", "critical", "worm", True)])
    land(spark, landing, [(payload(process="virus1"), "1", T0), (payload(process="worm"), "2", T0 + 1)])
    opts = Options(output_dir=out, rules_path=rules, create_tables=True, clock="event", checkpoint_dir=os.path.join(scratch, "ck"))
    for q in start_monitor(spark, Inputs(read_messages(spark, landing, "parquet", streaming=True)), opts, {"availableNow": True}):
        q.awaitTermination(120)
    got = spark.read.parquet(f"{out}/findings").select(F.col("description")).collect()
    assert [r[0] for r in got] == ["Suspicious process: worm"]
