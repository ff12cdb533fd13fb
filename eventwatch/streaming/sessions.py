"""Source-address sessions on a stream: ``session_window`` on publish time with a watermark.

Append mode emits each session once, when the watermark passes its end (late data within the
allowed lateness is merged first).  The gap is shortened by 1 ms so that events exactly one gap apart
stay apart and the window end equals the last instant of the monitored system's session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventwatch.config import ALLOWED_LATENESS, SESSION_GAP
from eventwatch.operators.rules import SessionRule, banned_process_rule, check_names, session_finding_array
from eventwatch.operators.sessions import interval_ms


def session_findings_stream(events: DataFrame, banned: list[str] | tuple[str, ...], gap: str = SESSION_GAP,
                            lateness: str = ALLOWED_LATENESS, rules: list[SessionRule] | None = None) -> DataFrame:
    rules = rules if rules is not None else [banned_process_rule(banned)]
    check_names(rules)
    gap_ms = interval_ms(gap) - 1
    aggs = [F.count(F.lit(1)).alias("event_count")]
    for r in rules:  # each aggregate over the rows that its rule wants; the session is over all rows
        aggs += r.columns(filtered=False)
    s = (events.withWatermark("publish_ts", lateness)
         .groupBy("src_ip", F.session_window("publish_ts", f"{gap_ms} milliseconds").alias("session"))
         .agg(*aggs))
    return (s.select(F.col("src_ip").alias("source_ip"), F.col("session.end").alias("request_ts"),
                     F.explode(session_finding_array(rules)).alias("f"))
            .select("request_ts", "source_ip", "f.level", "f.rule_id", "f.description"))
