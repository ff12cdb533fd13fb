from pyspark.sql import functions as F

from eventwatch.functions.parse import parse_messages, valid_events
from eventwatch.operators.rules import banned_process_rule
from eventwatch.operators.sessions import sessions, source_ip_findings
from eventwatch.plans.queries import _events
from helpers import messages, payload
from conftest import SF01


def events(spark, rows):
    return valid_events(parse_messages(messages(spark, rows)))


def test_session_boundaries_60s(spark):
    rows = [(payload(process="virus1"), "a", 0), (payload(process="p"), "b", 59_999),
            (payload(process="virus1"), "c", 119_999), (payload(process="virus1"), "d", 119_999 + 59_999)]
    s = sessions(events(spark, rows), "60 seconds").orderBy("session_start").collect()
    assert [r.event_count for r in s] == [2, 2]
    assert int(s[0].session_end.timestamp() * 1000) == 59_999 + 60_000


def test_banned_list_in_time_order_with_repeats(spark):
    rows = [(payload(process="virus2"), "3", 3000), (payload(process="virus1"), "1", 1000),
            (payload(process="ok"), "2", 2000), (payload(process="virus1"), "4", 4000)]
    f = source_ip_findings(events(spark, rows), ["virus1", "virus2"], "60 seconds").collect()
    assert [r.description for r in f] == ["Found banned processes: virus1, virus2, virus1"]
    assert int(f[0].request_ts.timestamp() * 1000) == 4000 + 60_000 - 1


def test_empty_banned_set_finds_nothing(spark):
    rows = [(payload(process="virus1"), "1", 0)]
    assert source_ip_findings(events(spark, rows), [], "60 seconds").count() == 0


def test_bucketed_sessions_equal_native_session_window(spark):
    """The skew-safe bucketed form equals Spark's session_window with gap − 1 ms on the sf0.01 data."""
    ev = _events(spark, SF01)
    mine = sessions(ev, "30 minutes").select(
        "src_ip", "session_start", (F.col("session_end") - F.expr("INTERVAL 1 MILLISECOND")).alias("end"),
        "event_count")
    native = (ev.groupBy("src_ip", F.session_window("publish_ts", "29 minutes 59 seconds 999 milliseconds").alias("w"))
              .agg(F.count(F.lit(1)).alias("event_count"))
              .select("src_ip", F.col("w.start").alias("session_start"), F.col("w.end").alias("end"),
                      "event_count"))
    assert mine.count() == native.count()
    assert mine.exceptAll(native).count() == 0 and native.exceptAll(mine).count() == 0
    assert banned_process_rule(["virus1"]).rule_id == "banned-process-detector"
