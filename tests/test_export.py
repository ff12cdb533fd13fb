"""Raw export of a stream: one file a minute, whole and once."""

import glob
import os

import pytest

from eventwatch.sources.messages import read_messages
from eventwatch.streaming.export import MinuteExport
from helpers import messages


def land(spark, path, rows):
    messages(spark, rows).coalesce(1).write.mode("append").parquet(path)


def doc(i):
    return '{ "n" : %d}' % i


def exported(root):
    found = {}
    for f in sorted(glob.glob(os.path.join(root, "data/*/*/*/*"))):
        parts = f.split(os.sep)[-4:]
        assert f.endswith(".json")
        with open(f) as fh:
            found.setdefault("/".join(parts[:3]), []).append(sorted(fh.read().splitlines()))
    return found


def minute(m):
    return f"eventDate=1970-01-01/eventHour={m // 60:02d}/eventMinute={m % 60:02d}"


def run(spark, export, path):
    stream = read_messages(spark, path, "parquet", streaming=True, options={"maxFilesPerTrigger": 1})
    export.start(stream, {"availableNow": True}).awaitTermination(120)


def test_one_file_a_minute_over_a_restart(spark, scratch):
    path, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    land(spark, path, [(doc(i), str(i), i * 20_000) for i in range(5)])            # minutes 0 and half of 1
    run(spark, MinuteExport(out, os.path.join(scratch, "ex")), path)
    assert exported(out) == {minute(0): [['{"n":0}', '{"n":1}', '{"n":2}']]}       # minute 1 is open
    land(spark, path, [(doc(5), "5", 100_000), ("junk", "j", 100_000), (doc(6), "6", 3_700_000)])
    run(spark, MinuteExport(out, os.path.join(scratch, "ex")), path)
    assert exported(out)[minute(1)] == [['{"n":3}', '{"n":4}', '{"n":5}']]
    land(spark, path, [(doc(7), "7", 1000), (doc(8), "8", 3_760_000)])             # 7 is late: a further file, not lost
    run(spark, MinuteExport(out, os.path.join(scratch, "ex")), path)
    got = exported(out)
    assert sorted(got[minute(0)]) == [['{"n":0}', '{"n":1}', '{"n":2}'], ['{"n":7}']]
    assert got[minute(61)] == [['{"n":6}']] and minute(62) not in got
    assert not os.listdir(os.path.join(out, "temp"))


@pytest.mark.parametrize("stage", ["_publish", "mark"])
def test_a_repeated_batch_writes_the_same_files(spark, scratch, monkeypatch, stage):
    path, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    land(spark, path, [(doc(i), str(i), i * 30_000) for i in range(6)])
    export = MinuteExport(out, os.path.join(scratch, "ex"))
    publish = export._publish

    def publish_and_fail(*args):
        publish(*args)
        raise RuntimeError("executor lost")

    if stage == "_publish":
        monkeypatch.setattr(export, "_publish", publish_and_fail)
    else:
        write = export.write

        def write_and_fail(batch, batch_id):
            write(batch, batch_id)
            raise RuntimeError("driver lost")
        monkeypatch.setattr(export, "write", write_and_fail)
    with pytest.raises(Exception):
        run(spark, export, path)
    first = {f for f in glob.glob(os.path.join(out, "data/*/*/*/*.json"))}
    assert len(first) == 2
    land(spark, path, [(doc(9), "9", 600_000)])
    run(spark, MinuteExport(out, os.path.join(scratch, "ex")), path)
    got = exported(out)
    assert first < set(glob.glob(os.path.join(out, "data/*/*/*/*.json")))
    assert [got[minute(m)] for m in range(3)] == [[['{"n":%d}' % (2 * m), '{"n":%d}' % (2 * m + 1)]] for m in range(3)]


def test_shards_and_messages_without_a_time(spark, scratch):
    path, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    rows = [(doc(i), str(i), 0) for i in range(40)] + [(doc(99), "x", 60_000)]
    m = messages(spark, rows)
    from pyspark.sql import functions as F
    m.withColumn("publish_ts", F.when(F.col("message_id") != "0", F.col("publish_ts"))).coalesce(1).write.parquet(path)
    run(spark, MinuteExport(out, os.path.join(scratch, "ex"), shards=3), path)
    got = exported(out)
    assert len(got[minute(0)]) == 3 and sum(map(len, got[minute(0)])) == 39
    assert [v for k, v in got.items() if "HIVE" in k] == [[['{"n":0}']]]
