"""Periodic ticks as a streaming source whose offsets are tick numbers (S6).

Tick ``n`` of a period is the instant ``n * period`` after the epoch, so the checkpoint's offset says which ticks came:
none is lost or comes twice over a restart, and ticks of a pause are made up by the first batch after it. A new
checkpoint begins with the newest tick, or with the first one at or after ``from`` (epoch ms); with ``until`` (epoch ms,
exclusive) the source has an end.
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from eventwatch.operators.sessions import interval_ms

cloudpickle.register_pickle_by_value(sys.modules[__name__])

EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


class TickRange(InputPartition):
    def __init__(self, first: int, end: int):
        self.first, self.end = first, end


class TickReader(DataSourceStreamReader):
    def __init__(self, period_ms: int, start_ms: int | None = None, until_ms: int | None = None, clock=time.time):
        self.period_ms, self.start_ms, self.until_ms, self.clock = period_ms, start_ms, until_ms, clock

    def _due(self) -> int:
        """Number of the first tick that is not due yet."""
        due = int(self.clock() * 1000) // self.period_ms + 1
        return due if self.until_ms is None else min(due, -(-self.until_ms // self.period_ms))

    def initialOffset(self) -> dict:
        return {"tick": self._due() - 1 if self.start_ms is None else -(-self.start_ms // self.period_ms)}

    def latestOffset(self) -> dict:
        return {"tick": self._due()}

    def partitions(self, start: dict, end: dict) -> list[TickRange]:
        return [TickRange(start["tick"], end["tick"])] if end["tick"] > start["tick"] else []

    def read(self, partition: TickRange) -> Iterator[tuple]:
        for n in range(partition.first, partition.end):
            yield n, EPOCH + dt.timedelta(milliseconds=n * self.period_ms)


class TickSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ticks"

    def schema(self) -> str:
        return "tick LONG, timestamp TIMESTAMP"

    def streamReader(self, schema) -> TickReader:
        at = {k: int(self.options[k]) for k in ("from", "until") if k in self.options}
        return TickReader(int(self.options["period_ms"]), at.get("from"), at.get("until"))


def ticks(spark: SparkSession, every: str, start_ms: int | None = None, until_ms: int | None = None) -> DataFrame:
    """Stream of (tick, timestamp), one row every ``every`` ('2 minutes', '5 seconds', ...)."""
    spark.dataSource.register(TickSource)
    r = spark.readStream.format("ticks").option("period_ms", interval_ms(every))
    for name, value in (("from", start_ms), ("until", until_ms)):
        if value is not None:
            r = r.option(name, value)
    return r.load()
