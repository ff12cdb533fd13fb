"""Session rules over some rows: the same findings in batch, in the default stream and with late panes."""

import os

import pytest
from pyspark.sql import functions as F

from eventwatch.config import Options
from eventwatch.functions.parse import parse_messages, valid_events
from eventwatch.operators.rules import (RuleNameClash, SessionRule, banned_process_rule, count_rows, greatest_of, least_of, rows_of,
                                        sum_of)
from eventwatch.operators.sessions import sessions, source_ip_findings
from eventwatch.plans.pipeline import Inputs, streaming_processing
from eventwatch.plans.queries import heavy_upload_rule
from eventwatch.sources.adapter import messages_from_events
from eventwatch.sources.messages import read_messages
from eventwatch.streaming.late_panes import merge_parts, pane_findings, session_panes_stream
from eventwatch.streaming.sessions import session_findings_stream
from conftest import SF001
from helpers import messages, payload
from test_streaming import landing, run_stream

T0, S = 10 ** 9, 1000


def all_kinds(predicate=lambda: F.col("x_rows") > 0):
    return SessionRule(
        "x-rows", "warning",
        {"x_rows": count_rows(), "x_sum": sum_of(lambda: F.col("bytes_sent")), "x_min": least_of(lambda: F.col("dst_ip")),
         "x_max": greatest_of(lambda: F.col("bytes_sent") / 2), "x_all": rows_of(lambda: F.col("dst_ip"))},
        predicate, lambda: F.concat_ws("|", "x_rows", "x_sum", "x_min", "x_max", F.array_join("x_all", ",")),
        rows=lambda: F.col("process_name") == "x")


def files(spark, scratch, batches):
    path = os.path.join(scratch, "in")
    for rows in batches:  # one file a micro-batch, in order
        messages(spark, rows).coalesce(1).write.mode("append").parquet(path)
    return valid_events(parse_messages(read_messages(spark, path, "parquet", streaming=True, options={"maxFilesPerTrigger": 1})))


def found(df):
    return sorted((r.source_ip, r.rule_id, r.description) for r in df.collect())


def test_three_forms_agree_on_driver_data(spark, scratch):
    path = landing(spark, scratch)
    rules = [banned_process_rule(["virus1"]), heavy_upload_rule()]
    batch = source_ip_findings(valid_events(parse_messages(messages_from_events(spark, SF001))), (), "30 minutes", rules)
    assert {r.rule_id for r in batch.collect()} == {"banned-process-detector", "heavy-uploads"}
    for late in (False, True):
        stream = read_messages(spark, path, "parquet", streaming=True, options={"maxFilesPerTrigger": 2})
        opts = Options(session_gap="30 minutes", allowed_lateness="1 hour", late_panes=late, clock="event")
        run_stream(streaming_processing(Inputs(stream, session_rules=rules), opts).source_ip_findings, scratch, f"rules_{late}")
        got = spark.sql(f"SELECT * FROM rules_{late}").filter("source_ip <> 's'")
        assert got.count() == batch.count() and got.exceptAll(batch.select(got.columns)).count() == 0


def test_every_kind_of_aggregate_and_sessions_without_wanted_rows(spark, scratch):
    rows = [(payload(src="A", process=p, sent=n, dst=d), f"{i}", T0 + i * S)
            for i, (p, n, d) in enumerate([("x", 10, "b"), ("y", 900, "0"), ("x", 5, "a"), (None, 70, "z")])]
    rows += [(payload(src="B", process="y"), "b", T0), (payload(src="C", process="x", sent=1, dst="c"), "c", T0)]
    end = [(payload(src="~", process="q"), "end", T0 + 10 ** 8)]
    want = [("A", "x-rows", "2|15|a|5.0|a,b"), ("C", "x-rows", "1|1|c|0.5|c")]
    rule = all_kinds()
    assert found(source_ip_findings(valid_events(parse_messages(messages(spark, rows))), (), "60 seconds", [rule])) == want
    ev = files(spark, scratch, [rows[:2], rows[2:], end])
    run_stream(session_findings_stream(ev, (), "60 seconds", "1 hour", [rule]), scratch, "kinds_default")
    assert found(spark.sql("SELECT * FROM kinds_default")) == want
    run_stream(session_panes_stream(ev, (), "60 seconds", "1 hour", [rule]), scratch, "kinds_panes")
    panes = spark.sql("SELECT * FROM kinds_panes")
    assert found(pane_findings(panes, [rule])) == want
    none = [(r.x_rows, r.x_sum, r.x_min, r.x_all) for r in panes.filter("source_ip = 'B'").collect()]
    assert none == [(0, None, None, [])]
    s = sessions(valid_events(parse_messages(messages(spark, rows))), "60 seconds", [rule]).filter("src_ip = 'B'").collect()
    assert [(r.x_rows, r.x_sum, r.x_min, r.x_all) for r in s] == none


def test_late_panes_merge_sessions_and_hold_only_new_elements(spark, scratch):
    """A late row joins a session that has fired with one that has not; a later row makes a pane of its own."""
    x = lambda src, sent, i, at: (payload(src=src, process="x", sent=sent, dst="d"), i, T0 + at * S)
    ev = files(spark, scratch, [[x("A", 1, "a", 0), x("A", 2, "b", 100)], [x("A", 4, "c", 50)], [x("~", 0, "e1", 400)],
                                [x("A", 8, "d", 60)], [x("~", 0, "e2", 10 ** 6)]])
    rule = all_kinds()
    run_stream(session_panes_stream(ev, (), "60 seconds", "1 hour", [rule]), scratch, "merged_panes")
    got = [(r.pane, r.n_elements, r.x_sum, r.session_start_ms - T0, r.session_end_ms - T0)
           for r in spark.sql("SELECT * FROM merged_panes WHERE source_ip = 'A'").collect()]
    assert sorted(got) == [("late", 1, 8, 0, 160 * S), ("late", 2, 6, 0, 160 * S), ("on_time", 1, 1, 0, 60 * S)]


def test_what_streams_cannot_do_is_refused(spark, scratch):
    ev = files(spark, scratch, [[(payload(), "1", T0)]])
    plain = {"n_all": F.count(F.lit(1))}
    some = SessionRule("r", "warning", plain, lambda: F.col("n_all") > 0, lambda: F.lit(""), rows=lambda: F.col("dst_port") > 1)
    with pytest.raises(ValueError, match="must be a Partial"):
        session_findings_stream(ev, (), rules=[some])
    with pytest.raises(ValueError, match="must be a Partial"):
        session_panes_stream(ev, (), rules=[SessionRule("r", "warning", plain, some.predicate, some.description)])
    stamp = SessionRule("r", "warning", {"at": greatest_of(lambda: F.col("publish_ts"))}, lambda: F.lit(True), lambda: F.lit(""))
    with pytest.raises(ValueError, match="cannot hold"):
        session_panes_stream(ev, (), rules=[stamp])
    with pytest.raises(RuleNameClash):
        session_findings_stream(ev, (), rules=[all_kinds(), all_kinds()])


def test_parts_merge_like_the_whole():
    kinds = {"n": ("count", None), "s": ("sum", None), "lo": ("min", None), "hi": ("max", None), "r": ("rows", None)}
    a, b = {"n": 2, "s": 5, "lo": "a", "hi": 3, "r": ["q"]}, {"n": 1, "lo": "b", "hi": 9, "r": ["p"]}
    assert merge_parts(kinds, a, b) == {"n": 3, "s": 5, "lo": "a", "hi": 9, "r": ["q", "p"]}
    assert merge_parts(kinds, {}, b) == b and merge_parts(kinds, a, {}) == a
