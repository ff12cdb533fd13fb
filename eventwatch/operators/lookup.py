"""Lookups: process category (J1), last-wins dimension (A7), user profiles (J7).

Joins carry no broadcast hint: adaptive execution broadcasts a side whose bytes, measured as it is computed, are
under the session's threshold, and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventwatch.config import UNKNOWN_CATEGORY


def process_dimension(process_info: DataFrame, order_col: str | None = "loaded_seq") -> DataFrame:
    """name → category, one row per name; a later row with the same name replaces an earlier one."""
    rows = process_info.filter(F.col("process_name").isNotNull())
    if order_col is None or order_col not in rows.columns:
        return rows.groupBy("process_name").agg(F.max("category").alias("category"))
    # max_by over the load order: partial aggregation, no per-name sort.
    return rows.groupBy("process_name").agg(F.max_by("category", order_col).alias("category"))


def enrich_category(events: DataFrame, dimension: DataFrame) -> DataFrame:
    """Left lookup by process name; a miss or a null name gives 'UNKNOWN'."""
    dim = dimension.select("process_name", F.col("category").alias("__category"))
    return (events.join(dim, on="process_name", how="left")
            .withColumn("category", F.coalesce("__category", F.lit(UNKNOWN_CATEGORY))).drop("__category"))


def derive_process_info(events: DataFrame) -> DataFrame:
    """A process_info table derived from the data: one row per (process, event kind) seen.

    category = the event kind, loaded in event-id order, so names repeat and the last one wins.
    """
    return (events.filter(F.col("process_name").isNotNull())
            .groupBy("process_name", F.col("event_type").alias("category"))
            .agg(F.max("event_id").alias("loaded_seq"), F.min("user_id").alias("user_id"),
                 F.count(F.lit(1)).alias("__n"))
            .select("user_id", "process_name", "category",
                    F.concat(F.lit("seen "), F.col("__n").cast("string"), F.lit(" times")).alias("description"),
                    "loaded_seq"))


def derive_user_profiles(events: DataFrame, min_banned: int = 20) -> DataFrame:
    """Profiles derived from the data: users with at least ``min_banned`` virus events are suspicious.

    Other users are absent and read as 'regular'.
    """
    return (events.filter(F.col("user_id").isNotNull())
            .groupBy("user_id")
            .agg(F.count(F.when(F.col("process_name").contains("virus"), 1)).alias("__n"))
            .filter(F.col("__n") >= min_banned)
            .select("user_id", F.lit("suspicious").alias("status")))
