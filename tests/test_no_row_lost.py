"""Rows that a table refuses, restarts, late events, sources at different speeds, absent tables, clean-up."""

import glob
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from eventwatch.config import Options, checkpoint_dir
from eventwatch.functions.parse import dead_letters, parse_messages, valid_events
from eventwatch.operators.rules import SessionRule, UserRule, default_user_rules, new_destination_host_rule
from eventwatch.operators.sessions import sessions
from eventwatch.operators.user_branch import held_findings, user_findings
from eventwatch.plans.pipeline import Inputs, start_ingest, start_monitor, streaming_processing
from eventwatch.sinks import tables
from eventwatch.sources.messages import file_counters, payload_messages, read_json_lines, read_messages
from eventwatch.streaming.user_state import user_findings_stream
from conftest import ROOT
from helpers import messages, payload
from test_streaming import run_stream

HOUR = 3_600_000
T0 = 10 ** 12
SENTINEL = (payload(user="~sentinel", src="s", request_ms=0), "~s", 4102444800000)


def stream_of(spark, path, batches):
    for rows in batches:
        messages(spark, rows).coalesce(1).write.mode("append").parquet(path)
    return read_messages(spark, path, "parquet", streaming=True, options={"maxFilesPerTrigger": 1})


def test_dead_letter_without_id_is_stored(spark, scratch):
    dead = dead_letters(parse_messages(messages(spark, [("junk", None, 0), ("junk", "b", 0)])))
    rejected = tables.write_dead_letters(dead, os.path.join(scratch, "invalid"))
    assert rejected.count() == 0 and spark.read.parquet(os.path.join(scratch, "invalid")).count() == 2


def test_rejected_rows_are_kept_and_reported(spark, scratch):
    ev = valid_events(parse_messages(messages(spark, [(payload(), "a", 0), (payload(), "b", 1)])))
    ev = ev.withColumn("dst_port", F.when(F.col("message_id") == "a", F.col("dst_port")))
    path = os.path.join(scratch, "events")
    for _ in range(2):
        tables.write_events(ev, path, "q-0")
    kept = spark.read.parquet(f"{path}_rejected")
    assert spark.read.parquet(path).count() == 1 and kept.count() == 1
    assert [r.failed_rows for r in tables.rejected_report(kept).collect()] == [1]


def test_absent_tables_are_refused(spark, scratch):
    ev = valid_events(parse_messages(messages(spark, [(payload(), "a", 0)])))
    with pytest.raises(tables.TableMissing):
        tables.write_events(ev, os.path.join(scratch, "nowhere"), must_exist=True)
    stream = stream_of(spark, os.path.join(scratch, "in"), [[(payload(), "a", 0)]])
    with pytest.raises(tables.TableMissing):
        start_monitor(spark, Inputs(stream), Options(output_dir=os.path.join(scratch, "wh"), checkpoint_dir=os.path.join(scratch, "ck")))


def test_restart_with_a_new_checkpoint_overwrites_nothing(spark, scratch):
    path = os.path.join(scratch, "in")
    opts = Options(output_dir=os.path.join(scratch, "wh"), create_tables=True, clock="event", export_dir=os.path.join(scratch, "export"))
    for run in range(2):
        stream = stream_of(spark, path, [[(payload(request_ms=T0), f"m{run}", T0 + run)]])
        opts.checkpoint_dir = os.path.join(scratch, f"ck{run}")
        for q in start_monitor(spark, Inputs(stream), opts, trigger={"availableNow": True}):
            q.awaitTermination(120)
    # the first run saw one message, the second (from scratch) both
    assert spark.read.parquet(f"{opts.output_dir}/events").count() == 3
    assert spark.read.text(f"{opts.export_dir}/data").count() == 3


def test_late_event_and_slower_source_are_not_dropped(spark, scratch):
    fast = stream_of(spark, os.path.join(scratch, "fast"), [[(payload(dst="h0"), "f0", T0)], [(payload(dst="h1"), "f1", T0 + 50 * HOUR)],
                                                          [(payload(dst="late"), "f2", T0 + 50 * HOUR - 5000)], [SENTINEL]])
    slow = stream_of(spark, os.path.join(scratch, "slow"), [[(payload(dst=f"s{i}"), f"s{i}", T0 + i * HOUR)] for i in range(4)])
    out = streaming_processing(Inputs(fast, slow), Options(clock="event"))
    run_stream(out.user_findings, scratch, "late_uf")
    got = {r.message_id for r in spark.sql("SELECT * FROM late_uf").collect()}
    assert got - {"~s"} == {"f0", "f1", "f2", "s0", "s1", "s2", "s3"}


def test_custom_rules_and_profiles_run_in_the_stream(spark, scratch):
    rules = [UserRule("big", "severe", lambda: F.col("bytes_sent") > 500, lambda: F.concat(F.lit("sent "), F.col("bytes_sent").cast("string"))),
             UserRule("watched", "warning", lambda: F.col("newly_accessed_host") & (F.col("profile_status") == "suspicious"), lambda: F.col("dst_ip"))]
    rows = [(payload(sent=900, dst="a"), "1", T0), (payload(sent=1, dst="a"), "2", T0 + 1), (payload(sent=1, dst="b", user="user2"), "3", T0 + 2)]
    profiles = spark.createDataFrame([("user1", "suspicious")], "user_id STRING, status STRING")
    stream = stream_of(spark, os.path.join(scratch, "in"), [rows, [SENTINEL]])
    got = user_findings_stream(valid_events(parse_messages(stream)), rules, "2 minutes", "30 days", profiles=profiles)
    run_stream(got, scratch, "custom_uf")
    cols = ["user_id", "rule_id", "level", "description", "message_id", "emit_ts"]
    want = held_findings(user_findings(valid_events(parse_messages(messages(spark, rows))), rules, "30 days", profiles), "2 minutes")
    assert sorted(spark.sql("SELECT * FROM custom_uf").select(cols).collect()) == sorted(want.select(cols).collect())
    assert want.count() == 2


def test_custom_session_rule_in_batch_and_stream(spark, scratch):
    rule = SessionRule("many", "warning", {"total": F.sum("bytes_sent")}, lambda: F.col("total") > 100, lambda: F.col("total").cast("string"))
    rows = [(payload(src="A", sent=60), "1", T0), (payload(src="A", sent=60), "2", T0 + 1000), (payload(src="B", sent=60), "3", T0)]
    s = sessions(valid_events(parse_messages(messages(spark, rows))), "60 seconds", [rule])
    assert {(r.src_ip, r.total, r.event_count) for r in s.collect()} == {("A", 120, 2), ("B", 60, 1)}
    stream = stream_of(spark, os.path.join(scratch, "in"), [rows, [SENTINEL]])
    out = streaming_processing(Inputs(stream, session_rules=[rule]), Options(clock="event"))
    run_stream(out.source_ip_findings, scratch, "many_sf")
    assert [(r.source_ip, r.description) for r in spark.sql("SELECT * FROM many_sf").collect()] == [("A", "120")]


def test_a_minute_of_a_million_rows_of_one_address(spark):
    ev = spark.range(1_000_000).select(F.lit("1.1.1.1").alias("src_ip"), F.timestamp_millis(F.col("id") % 60_000).alias("publish_ts"),
                                       F.col("id").cast("string").alias("message_id"), F.lit("p").alias("process_name"))
    r = sessions(ev, "60 seconds").collect()
    assert len(r) == 1 and r[0].event_count == 1_000_000


def test_file_list_stream_reads_every_path_and_counts_refused_files(spark, scratch):
    for d in ("a", "b"):
        os.makedirs(os.path.join(scratch, d))
        with open(os.path.join(scratch, d, "x.json"), "w") as fh:
            fh.write(payload() + "\n")
        with open(os.path.join(scratch, d, "x.txt"), "w") as fh:
            fh.write("refused")
    paths = [os.path.join(scratch, d) for d in ("a", "b")]
    run_stream(read_json_lines(spark, paths, streaming=True), scratch, "both_paths")
    assert spark.sql("SELECT * FROM both_paths").count() == 2
    assert tuple(file_counters(spark, paths).first()) == (2, 2)


def test_bare_payloads(spark):
    df = spark.createDataFrame([(payload(request_ms=5),), ("junk",)], "payload string")
    parsed = parse_messages(payload_messages(df)).collect()
    assert sorted(r.failure_reason is None for r in parsed) == [False, True]


def test_started_ingest_writes_rows(spark, scratch):
    topic = os.path.join(scratch, "topic")
    spark.createDataFrame([('{"type":"source-ip-finding","request_ts":"2024-01-01T00:00:59.999Z","source_ip":"1.1.1.1",'
                            '"level":"severe","description":"x"}',)], "value STRING").write.text(f"{topic}/source")
    opts = Options(output_dir=os.path.join(scratch, "wh"), checkpoint_dir=os.path.join(scratch, "ck"))
    start_ingest(spark, topic, opts, {"availableNow": True}).awaitTermination(120)
    assert [r.source_ip for r in spark.read.parquet(f"{opts.output_dir}/findings").collect()] == ["1.1.1.1"]


def test_changed_process_table_is_seen(spark, scratch):
    path, dim = os.path.join(scratch, "in"), os.path.join(scratch, "dim")
    opts = Options(output_dir=os.path.join(scratch, "wh"), create_tables=True, clock="event", process_info_path=dim, checkpoint_dir=os.path.join(scratch, "ck"))
    for i, category in enumerate(("office", "browser")):
        spark.createDataFrame([("process1", category)], "process_name STRING, category STRING").write.mode("overwrite").parquet(dim)
        stream = stream_of(spark, path, [[(payload(request_ms=i), f"m{i}", T0 + i)]])
        for q in start_monitor(spark, Inputs(stream, rules=[new_destination_host_rule()]), opts, trigger={"availableNow": True}):
            q.awaitTermination(120)
    got = spark.read.option("mergeSchema", "true").parquet(f"{opts.output_dir}/events").select("category").collect()
    assert sorted(r.category for r in got) == ["browser", "office"]


def run_python(code: str, **env) -> subprocess.CompletedProcess:
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=os.environ | env, capture_output=True, text=True, timeout=300)


def test_no_checkpoint_folder_on_a_cluster_is_an_error():
    from types import SimpleNamespace

    def session(master):
        conf = {"spark.master": master}
        context = SimpleNamespace(getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, default=None: conf.get(k, default)))

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://host"):
        with pytest.raises(RuntimeError):
            checkpoint_dir(session(master))
    assert os.path.isdir(checkpoint_dir(session("local[2]")))


def test_session_takes_the_clusters_settings():
    r = run_python("from eventwatch.config import get_spark\ns = get_spark()\nprint('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))",
                   PYSPARK_SUBMIT_ARGS="--master local[3] --conf spark.sql.shuffle.partitions=77 pyspark-shell")
    assert "GOT local[3] 77" in r.stdout


def test_no_table_is_left_behind(scratch):
    r = run_python("from eventwatch.config import get_spark\nimport glob, __spark_entry__ as E\n"
                   f"s = get_spark(cores=2, extra={{'spark.checkpoint.dir': 'file://{scratch}/ck'}})\n"
                   "E.queries()['all_findings'](s, '/root/testdata/sf0.001').count()\n"
                   f"print('TABLES', len(glob.glob('{scratch}/ck/**/eventwatch-tables/*', recursive=True)))\n")
    assert "TABLES 1" in r.stdout
    assert glob.glob(f"{scratch}/ck/**/eventwatch-tables/*", recursive=True) == []


def test_default_rules_do_not_join(spark):
    ev = valid_events(parse_messages(messages(spark, [(payload(), "a", 0)])))
    plan = user_findings(ev, default_user_rules(), "7 days")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
