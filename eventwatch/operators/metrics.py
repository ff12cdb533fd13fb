"""Counters: total, rejected and suspicious counts as one aggregate, or observed on a running query."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def message_counters(parsed: DataFrame) -> list:
    return [F.count(F.lit(1)).alias("elements_seen"),
            F.count(F.when(F.col("failure_reason").isNull(), 1)).alias("total_events"),
            F.count(F.when(F.col("failure_reason").isNotNull(), 1)).alias("rejected_events")]


def observe_messages(parsed: DataFrame, name: str = "pipeline_counters") -> tuple[DataFrame, Observation | str]:
    """Attach counters to a frame; batch → Observation, stream → StreamingQueryProgress.observedMetrics."""
    if parsed.isStreaming:
        more = [F.count(F.when(F.col("source") == 1, 1)).alias("first_source")] if "source" in parsed.columns else []
        return parsed.observe(name, *message_counters(parsed), *more), name
    obs = Observation(name)
    return parsed.observe(obs, *message_counters(parsed)), obs


def observe_files(files: DataFrame, name: str = "file_counters") -> DataFrame:
    """Accepted and rejected files, observed on a stream of ``accepted_files``."""
    ok = F.col("accepted")
    return files.observe(name, F.count(F.when(ok, 1)).alias("accepted_files"), F.count(F.when(~ok, 1)).alias("rejected_files"))


def observe_suspicious(findings: DataFrame, name: str = "suspicious_activity") -> DataFrame:
    """Findings on source addresses, observed on their stream."""
    return findings.observe(name, F.count(F.lit(1)).alias("suspicious_activity"))
