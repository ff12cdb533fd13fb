"""Source-address sessions: gap sessions, the banned-process rule and session findings.

Batch form: time is cut into buckets no longer than the gap, so all of a key's events in one bucket belong to one
session whatever lies between them. Events are reduced to one row per key and bucket by a plain aggregate
(combined before the shuffle: a burst from one address is one row a task), and a window over those rows puts
buckets together. No event is ever sorted, and no (key, bucket) is a window partition. Stream form:
``session_window`` with a watermark (``streaming.sessions``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventwatch.config import SESSION_GAP
from eventwatch.operators.rules import Partial, SessionRule, banned_process_rule, check_names, session_finding_array

def interval_ms(spec: str) -> int:
    """'30 minutes' → 1800000.  Accepts the units used by the options."""
    n, unit = spec.split()
    unit = unit.rstrip("s").lower()
    mult = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}[unit]
    return int(float(n) * mult)


def bucket_of(ms, length_ms: int):
    """Start of the bucket that a time is in, in whole numbers."""
    return ms - F.pmod(ms, F.lit(length_ms))


def session_buckets(df: DataFrame, keys: list[str], ts: str, gap_ms: int, out: str = "session_start_ms") -> DataFrame:
    """One row per (keys, bucket of one gap): ``__n`` events, ``__last`` ms, and ``out``, the ms at which its session starts.

    Two neighbouring buckets of a key share a session iff the later one's first event comes less than a gap
    after the earlier one's last. One shuffle of pre-aggregated rows; the window sees one row per key and bucket.
    """
    t = F.unix_millis(F.col(ts))
    rows = (df.select(*keys, t.alias("__t")).withColumn("__b", bucket_of(F.col("__t"), gap_ms))
            .groupBy(*keys, "__b").agg(F.min("__t").alias("__first"), F.max("__t").alias("__last"), F.count(F.lit(1)).alias("__n")))
    by_key = Window.partitionBy(*keys).orderBy("__b")
    before = F.lag("__last").over(by_key)
    starts = rows.withColumn("__start", F.when(before.isNull() | (F.col("__first") - before >= gap_ms), F.col("__first")))
    start = F.max("__start").over(by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return starts.withColumn(out, start).select(*keys, "__b", "__last", "__n", out)


def assign_sessions(df: DataFrame, keys: list[str], ts: str, gap_ms: int, out: str = "session_start_ms") -> DataFrame:
    """Add ``out``, the epoch ms at which each row's gap session starts (new session iff gap >= ``gap_ms``), and ``__t``."""
    buckets = session_buckets(df, keys, ts, gap_ms, out).drop("__last", "__n")
    staged = df.withColumn("__t", F.unix_millis(F.col(ts))).withColumn("__b", bucket_of(F.col("__t"), gap_ms))
    return staged.join(buckets, on=[*keys, "__b"], how="inner").drop("__b")


def sessions(events: DataFrame, gap: str = SESSION_GAP, rules: list[SessionRule] | None = None) -> DataFrame:
    """One row per (src_ip, session): start, exclusive end (last + gap), event count, rule aggregates.

    Start, end and count come from the bucket rows. Only the rows that a rule asks for (``SessionRule.rows``) are
    joined to their sessions; a session without such rows has a rule's aggregates over none.
    """
    gap_ms = interval_ms(gap)
    check_names(rules or [])
    buckets = session_buckets(events, ["src_ip"], "publish_ts", gap_ms)
    found = buckets.groupBy("src_ip", "session_start_ms").agg(F.sum("__n").alias("event_count"), F.max("__last").alias("__last"))
    for r in rules or []:
        wanted = events if r.rows is None else events.filter(r.wanted())
        wanted = wanted.withColumn("__b", bucket_of(F.unix_millis("publish_ts"), gap_ms))
        part = (wanted.join(buckets.select("src_ip", "__b", "session_start_ms"), ["src_ip", "__b"])
                .groupBy("src_ip", "session_start_ms").agg(*r.columns(filtered=True)))
        found = found.join(part, ["src_ip", "session_start_ms"], "left")
        found = found.withColumns({n: a.filled(F.col(n)) for n, a in r.aggregates.items() if isinstance(a, Partial)})
    return (found
            .withColumn("session_start", F.timestamp_millis("session_start_ms"))
            .withColumn("session_end", F.timestamp_millis(F.col("__last") + F.lit(gap_ms)))
            .drop("session_start_ms", "__last"))


def source_ip_findings(events: DataFrame, banned: tuple[str, ...] | list[str], gap: str = SESSION_GAP,
                       rules: list[SessionRule] | None = None) -> DataFrame:
    """Findings of the session rules: request_ts = last instant of the session window (end − 1 ms)."""
    rules = rules if rules is not None else [banned_process_rule(banned)]
    s = sessions(events, gap, rules)
    return session_findings(s, rules)


def session_findings(s: DataFrame, rules: list[SessionRule]) -> DataFrame:
    return (s.select(F.col("src_ip").alias("source_ip"),
                     (F.col("session_end") - F.expr("INTERVAL 1 MILLISECOND")).alias("request_ts"),
                     F.explode(session_finding_array(rules)).alias("f"))
            .select("request_ts", "source_ip", "f.level", "f.rule_id", "f.description"))
