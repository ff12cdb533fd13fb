import os

from pyspark.sql import functions as F

from eventwatch.functions.parse import dead_letters, parse_messages, valid_events
from eventwatch.sinks import tables
from eventwatch.sources.messages import accepted_files, csv_first_column, read_json_lines
from eventwatch.plans.pipeline import Inputs, canonical_events
from eventwatch.config import Options
from helpers import messages, payload


def test_events_table_is_day_partitioned_and_batch_idempotent(spark, scratch):
    ev = valid_events(parse_messages(messages(spark, [(payload(request_ms=0), "a", 0),
                                                      (payload(request_ms=86_400_000), "b", 1)])))
    path = os.path.join(scratch, "events")
    for _ in range(2):  # the same micro-batch retried: no duplicates
        rejected = tables.write_events(ev, path, slice_id="q-7")
    assert rejected.count() == 0
    back = spark.read.parquet(path)
    assert back.count() == 2 and {r.request_date.isoformat() for r in back.collect()} == {"1970-01-01", "1970-01-02"}


def test_rejected_rows_are_reported(spark, scratch):
    ev = valid_events(parse_messages(messages(spark, [(payload(), "a", 0)]))).withColumn("dst_port", F.lit(None).cast("int"))
    rejected = tables.write_events(ev, os.path.join(scratch, "ev2"))
    assert rejected.count() == 1
    assert tables.rejected_report(rejected, "request_ts").first().failed_rows == 1


def test_dead_letters_table_and_topic(spark, scratch):
    dead = dead_letters(parse_messages(messages(spark, [(b"\x7b\xff", "bad", 0, {"k": "v"})])))
    tables.write_dead_letters(dead, os.path.join(scratch, "invalid"))
    row = spark.read.parquet(os.path.join(scratch, "invalid")).first()
    assert row.payload_string == "{�" and row.attributes[0].name == "k"


def test_file_list_source_filters_extensions(spark, scratch):
    d = os.path.join(scratch, "files")
    os.makedirs(d)
    for name in ("a.json", "b.JSON", "c.Json", "d.json.gz"):
        with open(os.path.join(d, name), "w") as fh:
            fh.write(payload() + "\n" + "junk\n")
    msgs = read_json_lines(spark, [d])
    assert msgs.count() == 4
    verdict = {os.path.basename(r.path): r.accepted for r in accepted_files(spark, [d]).collect()}
    assert verdict == {"a.json": True, "b.JSON": True, "c.Json": False, "d.json.gz": False}
    assert valid_events(parse_messages(msgs)).count() == 2


def test_csv_first_column(spark, scratch):
    p = os.path.join(scratch, "x.csv")
    with open(p, "w") as fh:
        fh.write('"{""a"": 1}",x\n"line\ntwo",y\n')
    assert [r.value for r in csv_first_column(spark, p).collect()] == ['{"a": 1}', "line\ntwo"]


def test_union_keeps_identical_messages(spark):
    a = messages(spark, [(payload(), "same", 0)])
    b = messages(spark, [(payload(), "same", 0), ("junk", "j", 0)])
    ev, dead = canonical_events(Inputs(a, b), Options())
    assert ev.count() == 2 and dead.count() == 0
    ev, dead = canonical_events(Inputs(a, b), Options(keep_all_dead_letters=True))
    assert dead.count() == 1


def test_cli_options():
    from eventwatch.__main__ import parse_args
    opts, a = parse_args(["--source", "in", "--output-dir", "out", "--banned", "virus1,virus2", "--max-messages",
                          "25", "--stop", "drain", "--late-panes"])
    assert opts.banned_processes == ("virus1", "virus2") and opts.max_messages == 25 and opts.late_panes
    assert a.stop == "drain" and opts.session_gap == "60 seconds" and opts.hold == "120 seconds"
