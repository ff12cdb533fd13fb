"""Output formats: table rows, JSON messages, ISO time text, export partition columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventwatch.config import ISO_MILLIS, SOURCE_FINDING_TYPE, USER_FINDING_TYPE
from eventwatch.functions.parse import bind, only_document, payload_text, wrapped


def iso_millis(ts: Column) -> Column:
    """Instant → 'yyyy-MM-ddTHH:mm:ss.SSSZ' (UTC session time zone)."""
    return F.date_format(ts, ISO_MILLIS)


def event_rows(events: DataFrame, *more: str) -> DataFrame:
    """Event → ``events`` table row, with the columns ``more``; ``dst_hostname`` is not resolved (null)."""
    return events.select(
        "request_ts", "dst_ip", "dst_port", "src_ip", "bytes_sent", "bytes_received", "user_id", "process_name",
        F.lit(None).cast("string").alias("dst_hostname"), *more)


def user_finding_rows(findings: DataFrame) -> DataFrame:
    """User finding → ``findings`` table row; the rule id is not written."""
    return findings.select("request_ts", F.lit(USER_FINDING_TYPE).alias("type"), "level", "source_ip",
                           "description", "user_id")


def source_finding_rows(findings: DataFrame) -> DataFrame:
    return findings.select("request_ts", F.lit(SOURCE_FINDING_TYPE).alias("type"), "level", "source_ip",
                           "description", F.lit(None).cast("string").alias("user_id"))


def dead_letter_rows(dead: DataFrame) -> DataFrame:
    """Dead letter → ``invalid_messages`` row; bad UTF-8 bytes become U+FFFD in ``payload_string``."""
    return dead.select(
        F.col("publish_ts").alias("published_ts"), "message_id", F.col("payload").alias("payload_bytes"),
        F.make_valid_utf8(F.col("payload").cast("string")).alias("payload_string"), "failure_reason",
        F.transform(F.map_entries("attributes"),
                    lambda e: F.struct(e["key"].alias("name"), e["value"].alias("value"))).alias("attributes"))


def user_finding_json(findings: DataFrame) -> DataFrame:
    return findings.select(F.to_json(F.struct(
        F.lit(USER_FINDING_TYPE).alias("type"), iso_millis(F.col("request_ts")).alias("request_ts"),
        "user_id", "source_ip", "level", "description")).alias("value"))


def source_finding_json(findings: DataFrame) -> DataFrame:
    return findings.select(F.to_json(F.struct(
        F.lit(SOURCE_FINDING_TYPE).alias("type"), iso_millis(F.col("request_ts")).alias("request_ts"),
        "source_ip", "level", "description")).alias("value"))


def normalised_json(messages: DataFrame) -> DataFrame:
    """Parse and re-serialise each payload; unparseable ones are skipped (they are dead letters by the same check)."""
    text = payload_text(F.col("payload"))
    return (bind(messages.select("publish_ts", text.alias("__t")), wrapped(F.col("__t")).alias("__a"))
            .select("publish_ts", only_document(F.col("__a"), F.col("__t")).alias("__v"))
            .filter(F.col("__v").isNotNull())
            .select("publish_ts", F.to_json("__v").alias("value")))


def export_partitions(ts: Column) -> list[Column]:
    """eventDate / eventHour / eventMinute of the 1-minute window start (UTC)."""
    start = F.date_trunc("MINUTE", ts)
    return [F.date_format(start, "yyyy-MM-dd").alias("eventDate"), F.date_format(start, "HH").alias("eventHour"),
            F.date_format(start, "mm").alias("eventMinute")]
