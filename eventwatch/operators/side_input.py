"""1-second global sums and the latest side value (A4, A5, J6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventwatch.sources.ticks import ticks


def window_sum(df: DataFrame, ts: str, value: str, duration: str = "1 second") -> DataFrame:
    """Global sum per fixed window; windows without elements give no row."""
    return (df.groupBy(F.window(ts, duration).alias("w"))
            .agg(F.sum(value).alias("sum_value"), F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "sum_value", "n"))


def latest_value(side: DataFrame, value: Column, ts: str) -> Column:
    """Newest side value by element time, as a scalar subquery (one value, computed once, inlined)."""
    return side.select(F.max_by(value, F.col(ts))).scalar()


def with_latest(main: DataFrame, side: DataFrame, value: Column, ts: str, name: str = "side_value") -> DataFrame:
    """Pair every row with the latest side value (the side is reduced to one value first)."""
    return main.withColumn(name, latest_value(side, value, ts))


def side_input_stream(spark, side_rate: str = "5 seconds", main_rows_per_second: int = 1):
    """Streaming form of the latest-side-input pattern.

    Main: ticks (numbered) summed per 1 s window (windows without ticks give no row).  Side: ticks every
    ``side_rate`` producing a map {Key_A: HH:mm:ss of the tick}; each micro-batch pairs its sums with
    the newest side value (a TTL-free re-read of a small side frame inside ``foreachBatch``).
    Returns (main streaming frame, side streaming frame); wire them with ``pair_with_latest``.
    """
    main = (ticks(spark, f"{1000 / main_rows_per_second} milliseconds").withWatermark("timestamp", "0 seconds")
            .groupBy(F.window("timestamp", "1 second").alias("w")).agg(F.sum("tick").alias("sum_value"))
            .select(F.col("w.start").alias("window_start"), "sum_value"))
    side = ticks(spark, side_rate).select(
        "timestamp", F.create_map(F.lit("Key_A"), F.date_format("timestamp", "HH:mm:ss")).alias("side"))
    return main, side


def pair_with_latest(batch: DataFrame, side_snapshot: DataFrame) -> DataFrame:
    """One micro-batch of sums paired with the newest side map, re-stamped with the wall clock."""
    latest = side_snapshot.select(F.max_by("side", "timestamp")).scalar()
    return batch.select(F.lit(1).alias("key"), "sum_value", latest.getItem("Key_A").alias("key_a"),
                        F.current_timestamp().alias("out_ts"))
