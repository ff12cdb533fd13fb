"""Element-count threshold (fires once, exactly when the count reaches n) and stop instructions."""

from __future__ import annotations

from dataclasses import dataclass
from enum import Enum

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class HowToStop(Enum):
    cancel = "cancel"
    drain = "drain"


@dataclass(frozen=True)
class StopInstruction:
    how: HowToStop
    reason: str


def threshold_reached(df: DataFrame, thresholds: list[int], message: str = "read at least {n} messages") -> DataFrame:
    """One row per threshold the input reaches (count >= n); none for thresholds above the count.

    A global count is a partial + final aggregate: every task counts its split, one tiny merge.
    """
    total = df.agg(F.count(F.lit(1)).alias("__count"))
    return (total.select("__count", F.explode(F.array(*[F.lit(int(n)).cast("bigint") for n in thresholds]))
                         .alias("threshold"))
            .filter(F.col("__count") >= F.col("threshold"))
            .select("threshold", F.format_string(message.replace("{n}", "%d"), F.col("threshold")).alias("message")))


def crossing(previous_total: int, batch_count: int, threshold: int) -> bool:
    """True when a micro-batch takes the running total from below ``threshold`` to at least it."""
    return previous_total < threshold <= previous_total + batch_count
