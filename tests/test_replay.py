"""Line replay over a restart in mid-file, at a rate."""

import os
import time

import pytest

from eventwatch.streaming import replay as R


def test_restart_in_mid_file_publishes_every_line_once(spark, scratch, monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 10)
    os.makedirs(os.path.join(scratch, "in"))
    lines = [f"line {i % 7}" for i in range(45)]                     # equal lines stay messages of their own
    for k, part in enumerate((lines[:30], lines[30:])):
        with open(os.path.join(scratch, "in", f"{k}.txt"), "w") as fh:
            fh.write("\n".join(part) + "\n")
    target = os.path.join(scratch, "landing")

    def replay():
        return R.LineReplay(spark, [os.path.join(scratch, "in")], target, os.path.join(scratch, "place"), rate=5)

    first, write, calls = replay(), R._write_once, []

    def write_and_fail(*args):
        write(*args)
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("driver lost")                        # after the slice, before the batch is committed
    monkeypatch.setattr(R, "_write_once", write_and_fail)
    with pytest.raises(Exception):
        first.run()
    monkeypatch.setattr(R, "_write_once", write)
    second = replay()
    began, left = time.time(), 45 - spark.read.parquet(target).count()
    assert 0 < left < 45
    assert second.run() == 45
    assert time.time() - began >= left / 5 - 2                       # not faster than the rate
    got = {int(r.message_id.split("-")[1]): bytes(r.payload).decode() for r in spark.read.parquet(target).collect()}
    assert spark.read.parquet(target).count() == 45 and len(got) == 45
    assert sorted(got.values()) == sorted(lines)
