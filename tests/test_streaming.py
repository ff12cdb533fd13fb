"""Stream = batch: the same messages split over several files, run with availableNow."""

import os

from pyspark.sql import functions as F

from eventwatch.functions.parse import parse_messages, valid_events
from eventwatch.operators.rules import default_user_rules
from eventwatch.operators.user_branch import held_findings, user_findings
from eventwatch.schema import MESSAGE
from eventwatch.sources.adapter import messages_from_events
from eventwatch.sources.messages import read_messages
from eventwatch.streaming.refresh import Refreshing
from eventwatch.streaming.sessions import session_findings_stream
from eventwatch.streaming.stop import StopAfter
from eventwatch.operators.sessions import source_ip_findings
from eventwatch.operators.threshold import HowToStop
from eventwatch.streaming.user_state import user_findings_stream
from conftest import SF001

FAR = "2100-01-01 00:00:00"


def landing(spark, scratch, n_files=4):
    """sf0.001 messages in ``n_files`` publish-time slices, plus a far-future sentinel that moves the watermark."""
    m = messages_from_events(spark, SF001).drop("event_id")
    path = os.path.join(scratch, "landing")
    bounds = m.select(F.percentile_approx(F.unix_millis("publish_ts"), [i / n_files for i in range(1, n_files)]))
    cuts = [0] + list(bounds.first()[0]) + [2 ** 62]
    for i in range(n_files):
        part = m.filter((F.unix_millis("publish_ts") >= cuts[i]) & (F.unix_millis("publish_ts") < cuts[i + 1]))
        part.coalesce(1).write.mode("append").parquet(path)
    sentinel = spark.createDataFrame(
        [(bytearray(b'{"destination_ip": "s", "source_ip": "s", "bytes_sent": 1, "bytes_received": 1, '
                    b'"destination_port": 1, "request_timestamp": 4102444800000, "user": "~sentinel"}'),
          None, "~sentinel", None)], MESSAGE).withColumn("publish_ts", F.lit(FAR).cast("timestamp"))
    sentinel.write.mode("append").parquet(path)
    return path


def run_stream(df, scratch, name):
    q = (df.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ck-" + name)).trigger(availableNow=True).start())
    q.awaitTermination(300)
    return q


def test_user_stream_equals_batch(spark, scratch):
    path = landing(spark, scratch)
    stream = read_messages(spark, path, "parquet", streaming=True, options={"maxFilesPerTrigger": 1})
    ev = valid_events(parse_messages(stream))
    q = run_stream(user_findings_stream(ev, default_user_rules(), "6 hours", "7 days", clock="event"),
                   scratch, "uf_stream")
    got = spark.sql("SELECT * FROM uf_stream").filter(F.col("user_id") != "~sentinel")
    batch_ev = valid_events(parse_messages(messages_from_events(spark, SF001)))
    want = held_findings(user_findings(batch_ev, default_user_rules(), "7 days"), "6 hours")
    cols = ["user_id", "rule_id", "level", "description", "message_id", "emit_ts"]
    assert q.lastProgress is not None
    assert got.count() == want.count()
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0


def test_session_stream_equals_batch(spark, scratch):
    path = landing(spark, scratch)
    stream = read_messages(spark, path, "parquet", streaming=True, options={"maxFilesPerTrigger": 1})
    ev = valid_events(parse_messages(stream))
    run_stream(session_findings_stream(ev, ["virus1"], "30 minutes", "1 hour"), scratch, "sf_stream")
    got = spark.sql("SELECT * FROM sf_stream").filter(F.col("source_ip") != "s")
    want = source_ip_findings(valid_events(parse_messages(messages_from_events(spark, SF001))), ["virus1"],
                              "30 minutes")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(got.columns)).count() == 0


def test_refresh_reloads_after_ttl(spark):
    t = [0.0]
    r = Refreshing(lambda: spark.range(3), "2 minutes", clock=lambda: t[0])
    r.get(); r.get()
    t[0] = 119.0; r.get()
    t[0] = 120.0; r.get()
    assert r.loads == 2


def test_stop_after_counts_progress():
    class P:
        def __init__(self, n):
            self.progress = type("x", (), {"id": "q", "numInputRows": n})()
    s = StopAfter(25, HowToStop.drain)
    s.query_id = "q"
    for n in (10, 10):
        s.onQueryProgress(P(n))
    assert s.instruction is None
    s.onQueryProgress(P(10))
    assert s.instruction is not None and s.instruction.how is HowToStop.drain
    s.onQueryProgress(P(10))
    assert s.total == 40


def test_streaming_pipeline_persists_all_outputs(spark, scratch):
    """G1 + G2 on a stream: events / dead letters / user findings tables, both topics, raw export."""
    from eventwatch.config import Options
    from eventwatch.plans.pipeline import Inputs, start_monitor

    path = landing(spark, scratch, n_files=2)
    stream = read_messages(spark, path, "parquet", streaming=True, options={"maxFilesPerTrigger": 1})
    opts = Options(output_dir=os.path.join(scratch, "wh"), findings_topic=os.path.join(scratch, "topic"),
                   export_dir=os.path.join(scratch, "export"), banned_processes=("virus1",), session_gap="30 minutes",
                   retention="7 days", hold="6 hours", clock="event", checkpoint_dir=os.path.join(scratch, "ck"))
    opts.create_tables = True
    qs = start_monitor(spark, Inputs(stream), opts, trigger={"availableNow": True})
    for q in qs:
        q.awaitTermination(300)
        assert q.exception() is None
    total = messages_from_events(spark, SF001).count() + 1
    ev = spark.read.parquet(os.path.join(opts.output_dir, "events"))
    dead = spark.read.parquet(os.path.join(opts.output_dir, "invalid_messages"))
    assert ev.count() + dead.count() == total
    uf = spark.read.parquet(os.path.join(opts.output_dir, "findings")).filter("user_id <> '~sentinel'")
    want = held_findings(user_findings(valid_events(parse_messages(messages_from_events(spark, SF001))),
                                       default_user_rules(), "7 days"), "6 hours")
    assert uf.count() == want.count()
    from eventwatch.sinks.tables import ingest_findings
    topic_rows = ingest_findings(spark.read.text(os.path.join(opts.findings_topic, "source")).select("value"))
    want_src = source_ip_findings(valid_events(parse_messages(messages_from_events(spark, SF001))), ["virus1"],
                                  "30 minutes")
    assert topic_rows.count() == want_src.count() > 0
    assert spark.read.text(os.path.join(opts.export_dir, "data")).count() > 0
    seen = sum(p["observedMetrics"]["pipeline_counters"]["elements_seen"] for p in qs[0].recentProgress
               if p.get("observedMetrics", {}).get("pipeline_counters"))
    assert seen == total


def test_stop_after_n_messages_on_a_running_query(spark, scratch):
    """ST8: a listener counts input rows from progress events; the driver stops the query on crossing."""
    import time
    from eventwatch.streaming.stop import StopAfter, enforce
    path = landing(spark, scratch, n_files=3)
    stream = read_messages(spark, path, "parquet", streaming=True, options={"maxFilesPerTrigger": 1})
    listener = StopAfter(300, HowToStop.cancel)
    spark.streams.addListener(listener)
    try:
        q = (stream.writeStream.format("noop").option("checkpointLocation", os.path.join(scratch, "ck-stop"))
             .trigger(processingTime="200 milliseconds").start())
        listener.watch(q)
        deadline = time.time() + 120
        while time.time() < deadline and not enforce(q, listener):
            time.sleep(0.2)
        assert listener.instruction is not None and listener.instruction.reason == "read at least 300 messages"
        assert not q.isActive
    finally:
        spark.streams.removeListener(listener)


def test_side_input_stream_pairs_sums_with_latest(spark, scratch):
    import time
    from eventwatch.operators.side_input import pair_with_latest, side_input_stream
    main, side = side_input_stream(spark, "2 seconds", 5)
    sq = side.writeStream.format("memory").queryName("side_snap").start()
    got = []

    def sink(batch, batch_id):  # every micro-batch is consumed whole (stateful upstream)
        got.extend(r for r in pair_with_latest(batch, spark.sql("SELECT * FROM side_snap")).collect()
                   if r.key_a is not None)

    mq = main.writeStream.foreachBatch(sink).option("checkpointLocation", os.path.join(scratch, "ck-side")).start()
    deadline = time.time() + 60
    while time.time() < deadline and not got:
        time.sleep(0.5)
    mq.stop(); sq.stop()
    assert got and got[0].key == 1 and got[0].sum_value >= 0


def test_user_stream_processing_clock_emits_after_hold(spark, scratch):
    """clock='processing': wall-clock timers, as in the monitored system; polled, then stopped."""
    import time
    from helpers import messages as mk, payload as pl
    path = os.path.join(scratch, "live")
    rows = [(pl(dst="h1", process="virus1", request_ms=0), "1", 0), (pl(dst="h2", request_ms=1), "2", 1)]
    mk(spark, rows).write.parquet(path)
    stream = read_messages(spark, path, "parquet", streaming=True)
    out = user_findings_stream(valid_events(parse_messages(stream)), default_user_rules(), "2 seconds", "30 days",
                               clock="processing")
    q = (out.writeStream.format("memory").queryName("uf_live").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ck-live")).trigger(processingTime="500 milliseconds")
         .start())
    start = time.time()
    try:
        while time.time() - start < 90 and spark.sql("SELECT * FROM uf_live").count() < 3:
            time.sleep(0.5)
    finally:
        q.stop()
    got = spark.sql("SELECT * FROM uf_live").collect()
    assert sorted(r.rule_id for r in got) == ["new-destination-host", "new-destination-host", "process-name-rule"]
    # all three held in one bag, emitted together at open + 2 s (wall clock)
    assert len({r.emit_ts for r in got}) == 1


def test_late_panes_fire_again_with_only_new_elements(spark, scratch):
    """W2 exact: on-time pane at the watermark, then a late pane with only the late element."""
    from helpers import messages as mk, payload as pl
    from eventwatch.streaming.late_panes import pane_findings, session_panes_stream
    s, t0 = 1000, 10 ** 9                      # t0: away from the initial watermark (0)
    landing_dir = os.path.join(scratch, "late_landing")
    batches = [[(pl(src="A", process="virus1"), "a0", t0), (pl(src="A", process="p"), "a1", t0 + 10 * s),
                (pl(src="B", process="p"), "b0", t0 + 200 * s)],
               [(pl(src="A", process="virus1"), "a2", t0 + 20 * s)],
               [(pl(src="A", process="virus1"), "a3", t0 + 30 * s - 2 * 3600 * s)]]
    for rows in batches:                       # one file per micro-batch, in order
        mk(spark, rows).coalesce(1).write.mode("append").parquet(landing_dir)
    stream = read_messages(spark, landing_dir, "parquet", streaming=True, options={"maxFilesPerTrigger": 1})
    panes = session_panes_stream(valid_events(parse_messages(stream)), ["virus1"], "60 seconds", "1 hour")
    run_stream(panes, scratch, "panes")
    got = sorted((r.source_ip, r.pane, r.n_elements, r.banned, r.session_start_ms - t0, r.session_end_ms - t0)
                 for r in spark.sql("SELECT * FROM panes").collect())
    assert ("A", "on_time", 2, "virus1", 0, 70 * s) in got
    assert ("A", "late", 1, "virus1", 0, 80 * s) in got          # merged window grew to 20 s + 60 s
    assert not any(r[4] < 0 for r in got)                         # beyond the lateness: dropped
    f = pane_findings(spark.sql("SELECT * FROM panes")).filter("source_ip = 'A'").collect()
    assert sorted(r.description for r in f) == ["Found banned processes: virus1"] * 2


def test_lookup_refresh_inside_foreach_batch(spark, scratch):
    """J2: the dimension is re-read when stale, so a table changed between two batches is seen."""
    from helpers import messages as mk, payload as pl
    from eventwatch.operators.lookup import enrich_category, process_dimension
    dim_path = os.path.join(scratch, "process_info")
    spark.createDataFrame([("process1", "office")], "process_name STRING, category STRING").write.parquet(dim_path)
    landing_dir = os.path.join(scratch, "lk")
    mk(spark, [(pl(process="process1"), "1", 10 ** 9)]).write.mode("append").parquet(landing_dir)
    clock = [0.0]
    dim = Refreshing(lambda: process_dimension(spark.read.parquet(dim_path), None), "2 minutes",
                     clock=lambda: clock[0])
    seen = []

    def batch_fn(batch, batch_id):
        seen.extend(r.category for r in enrich_category(batch, dim.get()).collect())

    stream = read_messages(spark, landing_dir, "parquet", streaming=True, options={"maxFilesPerTrigger": 1})
    q1 = (valid_events(parse_messages(stream)).writeStream.foreachBatch(batch_fn)
          .option("checkpointLocation", os.path.join(scratch, "ck-lk")).trigger(availableNow=True).start())
    q1.awaitTermination(120)
    spark.createDataFrame([("process1", "browser")], "process_name STRING, category STRING") \
        .write.mode("overwrite").parquet(dim_path)
    clock[0] = 121.0
    mk(spark, [(pl(process="process1"), "2", 10 ** 9 + 1)]).write.mode("append").parquet(landing_dir)
    q2 = (valid_events(parse_messages(stream)).writeStream.foreachBatch(batch_fn)
          .option("checkpointLocation", os.path.join(scratch, "ck-lk")).trigger(availableNow=True).start())
    q2.awaitTermination(120)
    assert seen == ["office", "browser"] and dim.loads == 2


def test_findings_topic_ingest_stream(spark, scratch):
    """S9: findings JSON in a topic directory → table rows; only source-address findings by default."""
    from eventwatch.sinks.tables import ingest_findings
    topic = os.path.join(scratch, "topic_in")
    spark.createDataFrame([
        ('{"type":"source-ip-finding","request_ts":"2024-01-01T00:00:59.999Z","source_ip":"1.1.1.1",'
         '"level":"severe","description":"Found banned processes: virus1"}',),
        ('{"type":"user-event-finding","request_ts":"2024-01-01T00:00:00.000Z","user_id":"u","source_ip":"1.1.1.1",'
         '"level":"warning","description":"Newly accessed host: 2.2.2.2"}',)], "value STRING").write.text(topic)
    stream = spark.readStream.schema("value STRING").text(topic)
    run_stream(ingest_findings(stream), scratch, "ingested")
    rows = spark.sql("SELECT * FROM ingested").collect()
    assert [(r.type, r.source_ip, r.request_ts.isoformat()) for r in rows] == [
        ("source-ip-finding", "1.1.1.1", "2024-01-01T00:00:59.999000")]


def test_line_replay_feeds_a_landing_directory(spark, scratch):
    """S8: text lines → messages written to a landing directory → parsed by the stream reader."""
    from helpers import payload as pl
    from eventwatch.sources.messages import lines_to_messages
    lines_path = os.path.join(scratch, "lines.txt")
    with open(lines_path, "w") as fh:
        fh.write(pl() + "\n" + "junk\n")
    msgs = lines_to_messages(spark.read.text(lines_path))
    msgs.write.parquet(os.path.join(scratch, "replay"))
    back = read_messages(spark, os.path.join(scratch, "replay"), "parquet", streaming=False)
    p = parse_messages(back)
    assert p.count() == 2 and valid_events(p).count() == 1


def test_pandas_rule_stream_equals_batch(spark, scratch):
    from helpers import messages as mk, payload as pl
    from eventwatch.operators.rules import PandasUserRule

    def big_upload(pdf):
        return pdf["bytes_sent"] > 3 * pdf["bytes_received"], "Large upload: " + pdf["bytes_sent"].astype(str)

    rules = [PandasUserRule("big-upload", "severe", big_upload)]
    t0 = 10 ** 12
    rows = [(pl(sent=1000, received=10), "1", t0), (pl(sent=10, received=1000), "2", t0 + 1),
            (pl(sent=900, received=1, user="user2"), "3", t0 + 2),
            (pl(user="~sentinel", request_ms=0), "~s", 4102444800000)]
    path = os.path.join(scratch, "prule")
    mk(spark, rows).write.parquet(path)
    stream = read_messages(spark, path, "parquet", streaming=True)
    run_stream(user_findings_stream(valid_events(parse_messages(stream)), rules, "6 hours", "7 days"),
               scratch, "prule_out")
    got = spark.sql("SELECT message_id, description, emit_ts FROM prule_out").filter("message_id <> '~s'")
    want = held_findings(user_findings(valid_events(parse_messages(mk(spark, rows[:3]))), rules), "6 hours")
    assert got.count() == 2
    assert got.exceptAll(want.select("message_id", "description", "emit_ts")).count() == 0


def test_late_pane_option_equals_batch_without_late_data(spark, scratch):
    """late_panes=True through streaming_processing: in-order data gives one on-time pane per session."""
    from eventwatch.config import Options
    from eventwatch.plans.pipeline import Inputs, streaming_processing
    path = landing(spark, scratch)
    stream = read_messages(spark, path, "parquet", streaming=True, options={"maxFilesPerTrigger": 1})
    opts = Options(banned_processes=("virus1",), session_gap="30 minutes", allowed_lateness="1 hour",
                   late_panes=True, clock="event")
    run_stream(streaming_processing(Inputs(stream), opts).source_ip_findings, scratch, "sf_panes")
    got = spark.sql("SELECT * FROM sf_panes").filter(F.col("source_ip") != "s")
    want = source_ip_findings(valid_events(parse_messages(messages_from_events(spark, SF001))), ["virus1"],
                              "30 minutes")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(got.columns)).count() == 0
