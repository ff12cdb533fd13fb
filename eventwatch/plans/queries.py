"""Registered queries: one per operator of the blueprint, each over the whole driver tables.

Every query reads ``events`` (through the message adapter) or data Spark derives from it.
Timestamps leave as TIMESTAMP_NTZ (UTC wall time) so that they compare with the SQL oracle.
Replay parameters for the 30-day data: session gap 30 min, retention 7 d, hold 6 h, banned {virus1}.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventwatch.config import (REPLAY_BANNED, REPLAY_HOLD, REPLAY_RETENTION, REPLAY_SESSION_GAP, SOURCE_FINDING_TYPE,
                               USER_FINDING_TYPE, Options, ensure_utc, materialize)
from eventwatch.functions import formats
from eventwatch.functions.parse import CONVERTERS, dead_letters, parse_messages, payload_text, payload_type, valid_events
from eventwatch.operators import lookup, metrics, side_input, threshold
from eventwatch.operators.rules import (SessionRule, banned_process_rule, count_rows, default_user_rules, greatest_of,
                                        new_destination_host_rule, process_name_rule, rows_of, sum_of)
from eventwatch.operators.sessions import session_findings, sessions, source_ip_findings
from eventwatch.streaming.live_rules import apply_rule_data, rule_rows
from eventwatch.operators.user_branch import (held_findings, host_last_access, new_host_flags, user_events,
                                              user_findings, with_profile)
from eventwatch.plans.pipeline import Inputs, main_processing
from eventwatch.schema import EVENTS_REQUIRED
from eventwatch.sinks.tables import ingest_findings, rejected_report, split_required
from eventwatch.sources.adapter import event_fields, load_table, messages_from_events, split_sources
from eventwatch.sources.messages import read_messages

THRESHOLDS = [1_000, 10_000, 100_000, 1_000_000]
CRITICAL_PATTERN = "another"


def ntz(c: str | Column, name: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("timestamp_ntz").alias(name or (c if isinstance(c, str) else "ts"))


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return parse_messages(messages_from_events(spark, sf))


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return valid_events(_parsed(spark, sf))


def _events_once(spark: SparkSession, sf: str) -> DataFrame:
    """Parsed valid events, written once: for plans where the events feed more than one branch."""
    return materialize(_events(spark, sf))


def _finding_cols(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    return df.select(ntz("request_ts"), "user_id", "source_ip", "level", "rule_id", "description",
                     "message_id", *extra)


# --- sources -------------------------------------------------------------------------------------

def q_src_messages(spark, sf):
    """Messages landed as files and read back by the message reader."""
    landed = materialize(messages_from_events(spark, sf).drop("event_id"))
    m = read_messages(spark, landed.inputFiles()[0].rsplit("/", 1)[0], "parquet", streaming=False)
    return m.select("message_id", ntz("publish_ts"), payload_text(F.col("payload")).alias("payload_text"),
                    F.col("attributes").getItem("payloadType").alias("payload_type"))


def q_process_dim(spark, sf):
    return lookup.process_dimension(lookup.derive_process_info(_process_source(spark, sf)))


def _process_source(spark, sf):
    """Adapted events with their event kind (one scan; the adapter is a projection)."""
    return event_fields(load_table(spark, sf, "events"), carry=("event_type",))


# --- parsing -------------------------------------------------------------------------------------

def q_parse_reasons(spark, sf):
    return _parsed(spark, sf).select("message_id", "failure_reason")


def q_payload_dispatch(spark, sf):
    m = messages_from_events(spark, sf)
    t = payload_type(F.col("attributes"))
    return m.select("message_id", t.alias("payload_type"),
                    F.when(t.isin(list(CONVERTERS)), t).otherwise("proxy-request").alias("converter"))


def q_parse_edges(spark, sf):
    """Payloads with text behind the object, repeated nested keys, numbers beyond 64 bits and 38 digits, microsecond stamps."""
    eid, text = F.col("event_id"), payload_text(F.col("payload"))
    # 39 to 60 digits: a whole number and one with a fraction, made from the event's number.
    digits = F.concat(F.lit("7"), F.repeat(F.lpad(eid.cast("string"), 19, "3"), F.lit(2)), F.repeat(F.lit("9"), (eid % 22).cast("int")))
    fraction = F.when(eid % 2 == 0, F.lit(".75")).otherwise(F.lit(""))
    edited = (F.when(eid % 31 == 0, F.concat(text, F.lit(" x")))
              .when(eid % 37 == 0, F.concat(F.substring(text, F.lit(1), F.length(text) - 1), F.lit(', "extra": {"a": 1, "a": 2}}')))
              .when(eid % 41 == 0, F.regexp_replace(text, r'"bytes_sent": [0-9.]+', '"bytes_sent": 1e40'))
              .when(eid % 47 == 0, F.regexp_replace(text, F.lit(r'"bytes_received": "?[0-9.]+"?'), F.concat(F.lit('"bytes_received": -'), digits, fraction)))
              .when(eid % 43 == 0, F.regexp_replace(text, r'("request_timestamp": [0-9]+)', "$1000"))
              .otherwise(text))
    m = messages_from_events(spark, sf).withColumn("payload", F.encode(edited, "UTF-8"))
    return parse_messages(m).select("message_id", "failure_reason", "bytes_sent", "bytes_received", F.unix_millis("request_ts").alias("request_ms"))


def q_rejected_report(spark, sf):
    """Event rows that lack a required column, per two-minute window of their publish time."""
    ev = _events(spark, sf).withColumn("dst_port", F.when(F.col("event_id") % 41 != 0, F.col("dst_port")))
    _, rejected = split_required(formats.event_rows(ev, "publish_ts"), EVENTS_REQUIRED)
    r = rejected_report(rejected, "publish_ts")
    return r.select(ntz("window_start"), ntz("window_end"), "failed_rows")


def q_canonical_events(spark, sf):
    return _events(spark, sf).select(ntz("request_ts"), "src_ip", "dst_ip", "dst_port", "process_name", "user_id",
                                     "bytes_sent", "bytes_received", ntz("publish_ts"), "message_id")


def q_lenient_int(spark, sf):
    return _events(spark, sf).select("message_id", "bytes_sent", "bytes_received", "dst_port")


def q_valid_events(spark, sf):
    p = _parsed(spark, sf)
    return (p.groupBy(F.to_date("publish_ts").alias("publish_date"))
            .agg(F.count(F.when(F.col("failure_reason").isNull(), 1)).alias("n_valid"),
                 F.count(F.when(F.col("failure_reason").isNotNull(), 1)).alias("n_invalid")))


def q_dead_letters(spark, sf):
    d = dead_letters(_parsed(spark, sf))
    return d.select("failure_reason", "message_id", ntz("publish_ts"),
                    payload_text(F.col("payload")).alias("payload_text"),
                    F.col("attributes").getItem("payloadType").alias("payload_type"))


def q_dead_letter_rows(spark, sf):
    rows = formats.dead_letter_rows(dead_letters(_parsed(spark, sf)))
    return rows.select(ntz("published_ts"), "message_id", "payload_string", "failure_reason",
                       F.size(F.coalesce("attributes", F.array())).alias("attribute_count"),
                       F.to_date("published_ts").alias("published_date"))


def q_user_events(spark, sf):
    return user_events(_events(spark, sf)).select("message_id", "user_id", "dst_ip", ntz("request_ts"))


def q_union_sources(spark, sf):
    first, second = split_sources(messages_from_events(spark, sf))
    a = valid_events(parse_messages(first)).withColumn("source", F.lit("first"))
    b = valid_events(parse_messages(second)).withColumn("source", F.lit("second"))
    return a.unionByName(b).select("message_id", "source", "user_id", "src_ip", "dst_ip", ntz("publish_ts"))


# --- per-user branch -----------------------------------------------------------------------------

FLAG_COLUMNS = ("message_id", "user_id", "dst_ip", "publish_ts", "request_ts")


def q_new_host_flags(spark, sf):
    return new_host_flags(_events(spark, sf).select(*FLAG_COLUMNS)).select("message_id", "user_id", "dst_ip", "newly_accessed_host")


def q_new_host_expiry(spark, sf):
    return new_host_flags(_events(spark, sf).select(*FLAG_COLUMNS), REPLAY_RETENTION).select(
        "message_id", "user_id", "dst_ip", "newly_accessed_host")


def q_new_host_repeats(spark, sf):
    """New hosts where every 50th message comes twice and every 60th has no id."""
    eid = F.col("event_id")
    m = messages_from_events(spark, sf).withColumn("message_id", F.when(eid % 60 != 0, F.col("message_id")))
    m = m.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(eid % 50 == 0, 2).otherwise(1))))
    flags = new_host_flags(valid_events(parse_messages(m)).select(*FLAG_COLUMNS), REPLAY_RETENTION)
    return flags.select("message_id", ntz("publish_ts"), "user_id", "dst_ip", "newly_accessed_host")


def q_host_last_access(spark, sf):
    return host_last_access(_events(spark, sf)).select("user_id", "dst_ip", ntz("last_access_ts"), "access_count")


def q_rule_process_name(spark, sf):
    return _finding_cols(user_findings(_events(spark, sf), [process_name_rule()]))


def q_rule_new_host(spark, sf):
    return _finding_cols(user_findings(_events(spark, sf), [new_destination_host_rule()], REPLAY_RETENTION))


def q_user_findings(spark, sf):
    return _finding_cols(user_findings(_events_once(spark, sf), default_user_rules(), REPLAY_RETENTION))


def q_rules_as_data(spark, sf):
    """Rules as rows paired with events: the two default ones, and one per program that the events name with a number 1."""
    ev = _events_once(spark, sf)
    more = ev.filter(F.col("process_name").endswith("1")).select(F.col("process_name").alias("pattern")).distinct()
    table = (more.select(F.concat(F.lit("watch-"), "pattern").alias("rule_id"), F.lit("process_contains").alias("kind"),
                         F.lit("critical").alias("level"), "pattern", F.lit(True).alias("enabled"))
             .unionByName(spark.range(2).select(F.when(F.col("id") == 0, "new-destination-host").otherwise("process-name-rule").alias("rule_id"),
                                                F.when(F.col("id") == 0, "new_host").otherwise("process_contains").alias("kind"),
                                                F.when(F.col("id") == 0, "warning").otherwise("severe").alias("level"),
                                                F.lit(None).cast("string").alias("pattern"), F.lit(True).alias("enabled"))))
    rules = rule_rows(table).scalar()
    return _finding_cols(apply_rule_data(new_host_flags(ev, REPLAY_RETENTION), rules))


def q_user_profile(spark, sf):
    ev = materialize(_events(spark, sf).select("user_id", "process_name"))
    profiles = lookup.derive_user_profiles(ev)
    return (with_profile(user_events(ev), profiles).groupBy("user_id")
            .agg(F.max("profile_status").alias("profile_status"), F.count(F.lit(1)).alias("n_events")))


def q_held_findings(spark, sf):
    f = user_findings(_events_once(spark, sf), default_user_rules(), REPLAY_RETENTION)
    h = held_findings(f, REPLAY_HOLD)
    return h.select(ntz("request_ts"), "user_id", "source_ip", "level", "rule_id", "description", "message_id",
                    ntz("emit_ts"))


def critical_rules():
    return default_user_rules() + [process_name_rule(CRITICAL_PATTERN, "critical", "critical-process-rule")]


def q_critical_route(spark, sf):
    f = user_findings(_events_once(spark, sf), critical_rules(), REPLAY_RETENTION)
    h = held_findings(f, REPLAY_HOLD)
    return h.select(ntz("request_ts"), "user_id", "level", "rule_id", "message_id", ntz("emit_ts"),
                    F.when(F.col("level") == "critical", "immediate").otherwise("held").alias("route"))


def _user_findings_replay(spark, sf, events=None):
    ev = events if events is not None else _events_once(spark, sf)
    return user_findings(ev, default_user_rules(), REPLAY_RETENTION)


def q_user_finding_json(spark, sf):
    return formats.user_finding_json(_user_findings_replay(spark, sf))


def q_user_finding_rows(spark, sf):
    rows = formats.user_finding_rows(_user_findings_replay(spark, sf))
    return rows.select(ntz("request_ts"), "type", "level", "source_ip", "description", "user_id")


# --- per-source-address branch -------------------------------------------------------------------

SESSION_COLUMNS = ("src_ip", "publish_ts", "message_id", "process_name")


def _sessions(spark, sf, events=None):
    # Read twice: for the bucket rows, and for the few rows that the rule needs.
    ev = events if events is not None else materialize(_events(spark, sf).select(*SESSION_COLUMNS))
    return sessions(ev, REPLAY_SESSION_GAP, [banned_process_rule(REPLAY_BANNED)])


def q_sessions(spark, sf):
    return sessions(_events(spark, sf), REPLAY_SESSION_GAP).select("src_ip", ntz("session_start"), ntz("session_end"), "event_count")


def q_session_banned(spark, sf):
    s = _sessions(spark, sf).filter(F.size("banned_hits") > 0)
    return s.select("src_ip", ntz("session_start"), ntz("session_end"),
                    F.size("banned_hits").alias("banned_count"),
                    F.array_join(F.transform("banned_hits", lambda x: x["process_name"]), ", ").alias("banned_list"))


def _source_findings(spark, sf, events=None):
    return session_findings(_sessions(spark, sf, events), [banned_process_rule(REPLAY_BANNED)])


def q_source_ip_findings(spark, sf):
    return _source_findings(spark, sf).select(ntz("request_ts"), "source_ip", "level", "rule_id", "description")


def heavy_upload_rule() -> SessionRule:
    """Sessions with two or more uploads of over 600 bytes: how many, their bytes, and the programs in order."""
    return SessionRule(
        "heavy-uploads", "warning",
        {"uploads": count_rows(), "upload_bytes": sum_of(lambda: F.col("bytes_sent")), "last_host": greatest_of(lambda: F.col("dst_ip")),
         "programs": rows_of(lambda: F.struct(F.unix_micros("publish_ts").alias("t"), "message_id", "process_name"))},
        predicate=lambda: F.col("uploads") >= 2,
        description=lambda: F.concat_ws(" ", F.col("uploads").cast("string"), F.col("upload_bytes").cast("string"), "last_host",
                                        F.array_join(F.transform("programs", lambda p: F.coalesce(p["process_name"], F.lit("?"))), ",")),
        rows=lambda: F.col("bytes_sent") > 600)


def q_session_rule_rows(spark, sf):
    """A rule over some rows of a session beside the built-in one, which sees others of the same session."""
    rules = [banned_process_rule(REPLAY_BANNED), heavy_upload_rule()]
    # Read once for the bucket rows and once a rule: parsed once, the columns that these read.
    ev = materialize(_events(spark, sf).select(*SESSION_COLUMNS, "dst_ip", "bytes_sent"))
    found = source_ip_findings(ev, REPLAY_BANNED, REPLAY_SESSION_GAP, rules)
    return found.select(ntz("request_ts"), "source_ip", "level", "rule_id", "description")


def q_source_finding_json(spark, sf):
    return formats.source_finding_json(_source_findings(spark, sf))


# --- whole pipeline ------------------------------------------------------------------------------

REPLAY_OPTIONS = Options(banned_processes=REPLAY_BANNED, session_gap=REPLAY_SESSION_GAP, retention=REPLAY_RETENTION)


def q_all_findings(spark, sf):
    """The main processing on two sources: findings of both branches."""
    first, second = split_sources(messages_from_events(spark, sf))
    out = main_processing(Inputs(first, second), REPLAY_OPTIONS)
    u = formats.user_finding_rows(out.user_findings)
    s = formats.source_finding_rows(out.source_ip_findings)
    return u.unionByName(s).select(ntz("request_ts"), "type", "source_ip", "user_id", "level", "description")


def q_findings_ingest(spark, sf):
    """Findings topic → table: JSON messages of both kinds parsed back into table rows."""
    ev = _events_once(spark, sf)
    topic = (formats.user_finding_json(_user_findings_replay(spark, sf, ev))
             .unionByName(formats.source_finding_json(_source_findings(spark, sf, ev))))
    rows = ingest_findings(topic, (USER_FINDING_TYPE, SOURCE_FINDING_TYPE))
    return rows.select(ntz("request_ts"), "type", "source_ip", "user_id", "level", "description")


def q_event_rows(spark, sf):
    rows = formats.event_rows(_events(spark, sf))
    return rows.select(ntz("request_ts"), "dst_ip", "dst_port", "src_ip", "bytes_sent", "bytes_received", "user_id",
                       "process_name", "dst_hostname", F.to_date("request_ts").alias("request_date"))


def q_export_partitions(spark, sf):
    first, _ = split_sources(messages_from_events(spark, sf))
    n = formats.normalised_json(first)
    return (n.groupBy(*formats.export_partitions(F.col("publish_ts")))
            .agg(F.count(F.lit(1)).alias("n_records"), F.sum(F.length("value")).alias("n_chars")))


# --- lookups, thresholds, side inputs, counters ---------------------------------------------------

def q_enrich_category(spark, sf):
    dim = lookup.process_dimension(lookup.derive_process_info(_process_source(spark, sf)))
    return lookup.enrich_category(_events(spark, sf), dim).select("message_id", "process_name", "category")


def q_count_threshold(spark, sf):
    return threshold.threshold_reached(messages_from_events(spark, sf), THRESHOLDS)


def q_window_sum(spark, sf):
    w = side_input.window_sum(_events(spark, sf), "publish_ts", "bytes_sent")
    return w.select(ntz("window_start"), ntz("window_end"), F.col("sum_value").alias("sum_bytes"), "n")


def q_latest_side_input(spark, sf):
    ev = _events_once(spark, sf)
    sums = side_input.window_sum(ev, "publish_ts", "bytes_sent")
    side = ev.filter(F.col("process_name") == "another-virus")
    latest = side_input.with_latest(sums, side, F.date_format("publish_ts", "HH:mm:ss"), "publish_ts", "key_a")
    return latest.select(ntz("window_start"), F.col("sum_value").alias("sum_bytes"), "key_a")


def q_pipeline_counters(spark, sf):
    p = materialize(_parsed(spark, sf).select("failure_reason", "payload", "attributes", *SESSION_COLUMNS))
    counts = p.agg(*metrics.message_counters(p))
    suspicious = _source_findings(spark, sf, valid_events(p)).agg(F.count(F.lit(1)).alias("suspicious_activity"))
    return counts.select("*", suspicious.select("suspicious_activity").scalar().alias("suspicious_activity"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "src_messages": q_src_messages,
    "process_dim": q_process_dim,
    "parse_reasons": q_parse_reasons,
    "payload_dispatch": q_payload_dispatch,
    "parse_edges": q_parse_edges,
    "rejected_report": q_rejected_report,
    "new_host_repeats": q_new_host_repeats,
    "canonical_events": q_canonical_events,
    "lenient_int": q_lenient_int,
    "valid_events": q_valid_events,
    "dead_letters": q_dead_letters,
    "dead_letter_rows": q_dead_letter_rows,
    "user_events": q_user_events,
    "union_sources": q_union_sources,
    "new_host_flags": q_new_host_flags,
    "new_host_expiry": q_new_host_expiry,
    "host_last_access": q_host_last_access,
    "rule_process_name": q_rule_process_name,
    "rule_new_host": q_rule_new_host,
    "user_findings": q_user_findings,
    "rules_as_data": q_rules_as_data,
    "user_profile": q_user_profile,
    "held_findings": q_held_findings,
    "critical_route": q_critical_route,
    "user_finding_json": q_user_finding_json,
    "user_finding_rows": q_user_finding_rows,
    "sessions": q_sessions,
    "session_banned": q_session_banned,
    "source_ip_findings": q_source_ip_findings,
    "session_rule_rows": q_session_rule_rows,
    "source_finding_json": q_source_finding_json,
    "all_findings": q_all_findings,
    "findings_ingest": q_findings_ingest,
    "event_rows": q_event_rows,
    "export_partitions": q_export_partitions,
    "enrich_category": q_enrich_category,
    "count_threshold": q_count_threshold,
    "window_sum": q_window_sum,
    "latest_side_input": q_latest_side_input,
    "pipeline_counters": q_pipeline_counters,
}


def wrap(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        return fn(spark, sf_dir.rstrip("/"))
    run.__name__ = fn.__name__
    return run
