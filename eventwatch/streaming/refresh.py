"""Slowly changing lookups for streams: a dimension re-read when older than its TTL.

Used inside ``foreachBatch``: each micro-batch asks for the dimension; it is re-read from the table
(and re-cached) when stale, else the cached copy is joined.  A plain stream-static join could keep the
file list of its first read; this re-reads by design.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from eventwatch.operators.sessions import interval_ms


class Refreshing:
    def __init__(self, load: Callable[[], DataFrame], ttl: str, clock: Callable[[], float] = time.monotonic):
        self.load, self.ttl_s, self.clock = load, interval_ms(ttl) / 1000.0, clock
        self._df: DataFrame | None = None
        self._at = float("-inf")
        self.loads = 0

    def get(self) -> DataFrame:
        now = self.clock()
        if self._df is None or now - self._at >= self.ttl_s:
            if self._df is not None:
                self._df.unpersist()
            self._df = self.load().cache()
            self._at = now
            self.loads += 1
        return self._df
