from pyspark.sql import functions as F

from eventwatch.functions.parse import parse_messages, valid_events
from eventwatch.operators.rules import (default_user_rules, new_destination_host_rule, process_name_rule,
                                        rules_from_table)
from eventwatch.operators.user_branch import held_findings, host_last_access, new_host_flags, user_findings
from eventwatch.plans.pipeline import Inputs, main_processing
from eventwatch.config import Options
from helpers import messages, payload

DAY = 86_400_000


def events(spark, rows):
    return valid_events(parse_messages(messages(spark, rows)))


def test_message_flow_end_to_end(spark):
    """1 junk + 2 valid messages of one user → 2 events, 1 dead letter, 2 new-host warnings from 1.1.1.1."""
    rows = [("junk", "j", 0),
            (payload("1.1.1.1", "2.2.2.2", 80, 20, 30, "process1", "user1", 0), "a", 1000),
            (payload("1.1.1.1", "2.2.2.3", 80, 20, 30, "virus1", "user1", 0), "b", 1000)]
    out = main_processing(Inputs(messages(spark, rows), rules=[new_destination_host_rule()]),
                          Options(banned_processes=("virus1",)))
    assert out.events.count() == 2
    d = out.dead_letters.collect()
    assert len(d) == 1 and d[0].failure_reason.startswith("Failed to parse: ")
    f = sorted((r.user_id, r.level, r.rule_id, r.description, r.source_ip, r.request_ts.timestamp())
               for r in out.user_findings.collect())
    assert f == [("user1", "warning", "new-destination-host", "Newly accessed host: 2.2.2.2", "1.1.1.1", 0.0),
                 ("user1", "warning", "new-destination-host", "Newly accessed host: 2.2.2.3", "1.1.1.1", 0.0)]
    s = out.source_ip_findings.collect()
    assert [(r.source_ip, r.level, r.description) for r in s] == [
        ("1.1.1.1", "severe", "Found banned processes: virus1")]
    # finding time is the session window's last instant: last element + 60 s − 1 ms
    assert int(s[0].request_ts.timestamp() * 1000) == 1000 + 60_000 - 1


def test_new_host_plain(spark):
    rows = [(payload(dst="h1", request_ms=10), "1", 10), (payload(dst="h1", request_ms=5), "2", 20),
            (payload(dst="h2", request_ms=30), "3", 30), (payload(dst="h1", user="user2", request_ms=40), "4", 40)]
    flags = {r.message_id: r.newly_accessed_host for r in new_host_flags(events(spark, rows)).collect()}
    assert flags == {"1": True, "2": False, "3": True, "4": True}


def test_new_host_expiry_boundaries(spark):
    """Retention 7 d, sweep at each UTC midnight D forgets hosts with last access <= D − 7 d."""
    rows = [
        # h_exact: last access exactly at the cutoff of the sweep at day 8 → forgotten → new again
        (payload(dst="h_exact", request_ms=DAY), "e1", DAY),
        (payload(dst="h_exact", request_ms=8 * DAY + 5), "e2", 8 * DAY + 5),
        # h_after: last access 1 ms after the cutoff → kept
        (payload(dst="h_after", request_ms=DAY + 1), "a1", DAY + 1),
        (payload(dst="h_after", request_ms=8 * DAY + 5), "a2", 8 * DAY + 5),
        # h_mid: event exactly at midnight; the sweep at that instant runs first
        (payload(dst="h_mid", request_ms=2 * DAY), "m1", 2 * DAY),
        (payload(dst="h_mid", request_ms=9 * DAY), "m2", 9 * DAY),
    ]
    flags = {r.message_id: r.newly_accessed_host for r in new_host_flags(events(spark, rows), "7 days").collect()}
    assert flags == {"e1": True, "e2": True, "a1": True, "a2": False, "m1": True, "m2": True}


def test_older_request_does_not_lower_last_access(spark):
    rows = [(payload(dst="h", request_ms=100), "1", 1), (payload(dst="h", request_ms=50), "2", 2)]
    r = host_last_access(events(spark, rows)).collect()[0]
    assert int(r.last_access_ts.timestamp() * 1000) == 100 and r.access_count == 2


def test_process_rule_ignores_null_process(spark):
    text = payload(process="x").replace('"process": "x",', "")
    rows = [(text, "n", 0), (payload(process="another-virus"), "v", 0)]
    f = user_findings(events(spark, rows), [process_name_rule()]).collect()
    assert [(r.message_id, r.description) for r in f] == [("v", "Suspicious process: another-virus")]


def test_hold_boundaries_and_critical_bypass(spark):
    hold = 120_000
    rows = [(payload(dst=f"h{i}", request_ms=t), f"m{i}", t) for i, t in
            enumerate([0, hold - 1, hold, hold + 5, 3 * hold])]
    rows.append((payload(dst="crit", process="another-virus", request_ms=10), "crit", 10))
    rules = default_user_rules() + [process_name_rule("another", "critical", "crit-rule")]
    f = held_findings(user_findings(events(spark, rows), rules), "120 seconds")
    got = {(r.message_id, r.rule_id): int(r.emit_ts.timestamp() * 1000) for r in f.collect()}
    assert got[("m0", "new-destination-host")] == hold          # bag opened at 0
    assert got[("m1", "new-destination-host")] == hold          # +119.999 s: same bag
    assert got[("m2", "new-destination-host")] == 2 * hold      # +120 s: the bag was emitted, new bag
    assert got[("m3", "new-destination-host")] == 2 * hold
    assert got[("m4", "new-destination-host")] == 4 * hold
    assert got[("crit", "crit-rule")] == 10                      # critical: at once
    assert got[("crit", "new-destination-host")] == 2 * hold - hold  # new host of the same event is held


def test_rules_from_table(spark):
    table = spark.createDataFrame([("new-destination-host", "new_host", "warning", None, True),
                                   ("process-name-rule", "process_contains", "severe", "virus", True),
                                   ("off", "process_contains", "critical", "process", False)],
                                  "rule_id STRING, kind STRING, level STRING, pattern STRING, enabled BOOLEAN")
    rules = rules_from_table(table.collect())
    assert [r.rule_id for r in rules] == ["new-destination-host", "process-name-rule"]


def test_user_branch_is_skew_safe_plan(spark):
    """No window sorts a whole (user, host) history: the only window runs on per-day summaries."""
    rows = [(payload(dst="h", request_ms=i), str(i), i) for i in range(5)]
    plan = new_host_flags(events(spark, rows), "7 days")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "Aggregate" in plan


def test_hold_bags_equal_a_plain_loop(spark):
    from eventwatch.plans.queries import _events
    from conftest import SF001
    f = user_findings(_events(spark, SF001), default_user_rules(), "7 days").cache()
    hold, rows = 6 * 3_600_000, {}
    for r in f.select("user_id", F.unix_millis("publish_ts").alias("t")).collect():
        rows.setdefault(r.user_id, set()).add(r.t)
    emit = {}
    for user, times in rows.items():
        opened = None
        for t in sorted(times):
            if opened is None or t >= opened + hold:
                opened = t
            emit[user, t] = opened + hold
    got = held_findings(f, "6 hours").select("user_id", F.unix_millis("publish_ts").alias("t"), F.unix_millis("emit_ts").alias("e")).collect()
    assert len(got) == f.count() > 0 and all(r.e == emit[r.user_id, r.t] for r in got)


def test_hold_boundaries_across_arrow_batches(spark):
    hold = 120_000
    rows = [(payload(dst=f"h{i}", request_ms=t), f"m{i}", t) for i, t in
            enumerate([0, hold - 1, hold, hold + 5, 3 * hold, 3 * hold + 1, 4 * hold])]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        f = held_findings(user_findings(events(spark, rows), default_user_rules()), "120 seconds")
        got = {r.message_id: int(r.emit_ts.timestamp() * 1000) for r in f.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {"m0": hold, "m1": hold, "m2": 2 * hold, "m3": 2 * hold, "m4": 4 * hold, "m5": 4 * hold,
                   "m6": 5 * hold}


def test_one_user_with_many_times_is_linear_and_lazy(spark):
    """60,000 distinct ms of one user within few holds: seconds, and no job while the plan is built."""
    import time
    f = spark.range(60_000).select(
        F.timestamp_millis(F.col("id") * 7).alias("publish_ts"), F.lit("u").alias("user_id"), F.lit("warning").alias("level"),
        F.lit("r").alias("rule_id"), F.col("id").cast("string").alias("message_id"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("hold", "hold")
    t = time.time()
    held = held_findings(f, "120 seconds")
    assert list(tracker.getJobIdsForGroup("hold")) == []
    got = held.groupBy("emit_ts").count().collect()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(got) == 4 and sum(r["count"] for r in got) == 60_000 and time.time() - t < 60


def test_repeated_messages_and_null_ids_have_one_new_host(spark):
    rows = [(payload(dst="h"), "same", 5), (payload(dst="h"), "same", 5), (payload(dst="a"), None, 1), (payload(dst="b"), None, 1),
            (payload(dst="h", request_ms=9), "late", 9)]
    flags = new_host_flags(events(spark, rows)).collect()
    assert len(flags) == 5 and sorted(r.dst_ip for r in flags if r.newly_accessed_host) == ["a", "b", "h"]
    found = user_findings(events(spark, rows), [new_destination_host_rule()]).collect()
    assert sorted(r.description for r in found) == [f"Newly accessed host: {h}" for h in "abh"]


def test_pandas_rule_escape_hatch(spark):
    """a rule Column expressions cannot state, run in Arrow batches; same findings as its Column twin."""
    from eventwatch.operators.rules import PandasUserRule

    def big_upload(pdf):
        hit = pdf["bytes_sent"] > 3 * pdf["bytes_received"]
        return hit, "Large upload: " + pdf["bytes_sent"].astype(str)

    rows = [(payload(sent=1000, received=10), "1", 0), (payload(sent=10, received=1000), "2", 1)]
    f = user_findings(events(spark, rows), [PandasUserRule("big-upload", "severe", big_upload)]).collect()
    assert [(r.message_id, r.rule_id, r.level, r.description, r.source_ip) for r in f] == [
        ("1", "big-upload", "severe", "Large upload: 1000", "1.1.1.1")]
