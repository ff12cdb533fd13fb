"""What a running monitor reports: refused rows, refused files, suspicious activity; topics over a retry."""

import json
import os
import time

from pyspark.sql import functions as F

from eventwatch.config import Options
from eventwatch.plans.pipeline import Inputs, start_ingest, start_monitor
from eventwatch.sinks import tables
from eventwatch.sources.messages import read_json_lines, read_messages
from helpers import messages, payload


def observed(q, name):
    rows = [p["observedMetrics"][name] for p in q.recentProgress if (p.get("observedMetrics") or {}).get(name)]
    return {k: sum(r[k] for r in rows) for k in rows[0].asDict()} if rows else {}


def test_refused_rows_are_reported_while_running(spark, scratch):
    path = os.path.join(scratch, "in")
    bad = messages(spark, [("junk", "a", 0), ("junk too", "b", 0)])
    bad.withColumn("publish_ts", F.lit(None).cast("timestamp")).write.parquet(path)   # dead letters without their time
    opts = Options(output_dir=os.path.join(scratch, "wh"), create_tables=True, checkpoint_dir=os.path.join(scratch, "ck"),
                   report_window="2 seconds", report_delay="1 second")
    queries = start_monitor(spark, Inputs(read_messages(spark, path, "parquet")), opts)
    report = os.path.join(opts.output_dir, "failed_inserts")
    try:
        deadline, got = time.time() + 90, []
        while time.time() < deadline and not got:
            time.sleep(0.5)
            if os.path.exists(report) and any(n.startswith("slice=") for n in os.listdir(report)):
                rows = spark.read.schema("table STRING, failed_rows LONG").parquet(report).collect()
                got = [(r.table, r.failed_rows) for r in rows]
    finally:
        for q in queries:
            q.stop()
    assert got == [("invalid_messages", 2)]


def test_files_and_suspicious_activity_are_counted_on_streams(spark, scratch):
    folder = os.path.join(scratch, "files")
    os.makedirs(folder)
    for name, text in (("a.json", payload(process="virus1")), ("b.JSON", payload(src="9.9.9.9")), ("c.txt", "x"), ("d.json.gz", "x"), ("e.csv", "x")):
        with open(os.path.join(folder, name), "w") as fh:
            fh.write(text + "\n")
    opts = Options(output_dir=os.path.join(scratch, "wh"), create_tables=True, checkpoint_dir=os.path.join(scratch, "ck"), clock="event",
                   file_list=[folder], banned_processes=("virus1",), findings_topic=os.path.join(scratch, "topic"),
                   session_gap="1 second", allowed_lateness="0 seconds")
    for k in range(2):
        queries = {q.name: q for q in start_monitor(spark, Inputs(read_json_lines(spark, [folder], streaming=True)), opts, {"availableNow": True})}
        for q in queries.values():
            q.awaitTermination(120)
        if k == 0:
            assert observed(queries["files"], "file_counters") == {"accepted_files": 2, "rejected_files": 3}
            later = os.path.join(folder, "f.json")
            with open(later, "w") as fh:
                fh.write(payload(src="8.8.8.8") + "\n")
            os.utime(later, (time.time() + 3600, time.time() + 3600))    # moves the watermark past the session
    assert observed(queries["files"], "file_counters") == {"accepted_files": 1, "rejected_files": 0}
    assert observed(queries["source_findings"], "suspicious_activity")["suspicious_activity"] == 1


def finding(ip):
    return json.dumps({"type": "source-ip-finding", "request_ts": "2024-01-01T00:00:59.999Z", "source_ip": ip, "level": "severe", "description": "x"})


def test_repeated_slice_is_ingested_once(spark, scratch):
    topic = os.path.join(scratch, "topic")
    os.makedirs(f"{topic}/source")
    opts = Options(output_dir=os.path.join(scratch, "wh"), checkpoint_dir=os.path.join(scratch, "ck"))
    twice = spark.createDataFrame([(finding("1"),), (finding("1"),), (finding("2"),)], "value STRING")  # equal findings are two
    start_ingest(spark, topic, opts, {"availableNow": True}).awaitTermination(120)                      # the topic is empty yet
    for batch in (0, 0, 1):                                                                              # batch 0 is repeated
        tables.write_topic(twice, f"{topic}/source", slice_id=f"q-{batch}")
        start_ingest(spark, topic, opts, {"availableNow": True}).awaitTermination(120)
    got = sorted(r.source_ip for r in spark.read.parquet(f"{opts.output_dir}/findings").collect())
    assert got == ["1"] * 4 + ["2"] * 2


def test_keyed_records_of_a_repeated_slice_come_once(spark, scratch):
    path = os.path.join(scratch, "records")
    values = spark.createDataFrame([("a",), ("a",), ("b",)], "value STRING")
    for batch, df in ((0, values), (0, values.repartition(3).sort(F.desc("value"))), (1, values)):
        tables.keyed(df, f"q-{batch}").write.mode("append").parquet(path)
    spark.createDataFrame([(None, "n"), (None, "n")], "key STRING, value STRING").write.mode("append").parquet(path)
    stream = spark.readStream.schema("key STRING, value STRING").option("maxFilesPerTrigger", 2).parquet(path)
    q = (tables.each_key_once(stream).writeStream.format("memory").queryName("once").option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert sorted(r.value for r in spark.table("once").collect()) == ["a"] * 4 + ["b"] * 2 + ["n"] * 2
