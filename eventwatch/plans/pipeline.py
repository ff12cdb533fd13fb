"""Main processing (G1): messages → events, dead letters, user findings, source-address findings.

``main_processing`` is a pure DataFrame function: the same code runs on a static replay and on
streaming frames (the stream form of the per-user branch is ``streaming.user_state``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventwatch.config import PROCESS_REFRESH, Options, checkpoint_dir, materialize
from eventwatch.functions import formats
from eventwatch.functions.parse import dead_letters, parse_messages, valid_events
from eventwatch.operators.lookup import enrich_category, process_dimension
from eventwatch.operators.metrics import observe_files, observe_messages, observe_suspicious
from eventwatch.operators.rules import SessionRule, UserRule, banned_process_rule
from eventwatch.operators.sessions import source_ip_findings
from eventwatch.operators.threshold import HowToStop
from eventwatch.operators.user_branch import user_findings
from eventwatch.schema import FINDINGS_REQUIRED
from eventwatch.sinks import tables
from eventwatch.sources.messages import accepted_files
from eventwatch.streaming.export import MinuteExport
from eventwatch.streaming.live_rules import LiveRules
from eventwatch.streaming.parsed_log import ParsedLog
from eventwatch.streaming.refresh import Refreshing
from eventwatch.streaming.reject_report import start_report
from eventwatch.streaming.stop import CountedStop


@dataclass
class Inputs:
    messages: DataFrame
    second_messages: DataFrame | None = None
    rules: list[UserRule] | None = None
    profiles: DataFrame | None = None
    session_rules: list[SessionRule] | None = None


@dataclass
class Outputs:
    raw_messages: DataFrame
    events: DataFrame
    dead_letters: DataFrame
    user_findings: DataFrame
    source_ip_findings: DataFrame
    parsed: DataFrame | None = None      # all parsed messages, tagged ``source`` 1/2 (stream sink input)


def parsed_sources(inputs: Inputs) -> DataFrame:
    """Parsed messages of both sources in one frame, tagged by source number: put together first, so that one parser runs."""
    messages = inputs.messages.withColumn("source", F.lit(1))
    if inputs.second_messages is not None:
        messages = messages.unionByName(inputs.second_messages.withColumn("source", F.lit(2)), allowMissingColumns=True)
    return parse_messages(messages)


def canonical_events(inputs: Inputs, options: Options) -> tuple[DataFrame, DataFrame]:
    """(valid events of all sources, dead letters).  Second-source dead letters are dropped unless asked."""
    parsed = parsed_sources(inputs)
    refused = parsed if options.keep_all_dead_letters else parsed.filter(F.col("source") == 1)
    return valid_events(parsed).drop("source"), dead_letters(refused)


def main_processing(inputs: Inputs, options: Options) -> Outputs:
    """Batch: every message is parsed once, into a table that all branches read (columns and filters pushed down)."""
    parsed = materialize(parsed_sources(inputs))
    events = valid_events(parsed).drop("source")
    refused = parsed if options.keep_all_dead_letters else parsed.filter(F.col("source") == 1)
    uf = user_findings(events, inputs.rules, options.retention, inputs.profiles)
    sf = source_ip_findings(events, options.banned_processes, options.session_gap,
                            inputs.session_rules or [banned_process_rule(options.banned_processes)])
    return Outputs(inputs.messages, events, dead_letters(refused), uf, sf, parsed)


def streaming_processing(inputs: Inputs, options: Options, parsed: DataFrame | None = None, live_rules: Column | None = None) -> Outputs:
    """Stream form of ``main_processing``; ``parsed`` is the stream of parsed messages if they were written already,
    ``live_rules`` the column of rules that may change while the stream runs."""
    from eventwatch.streaming.sessions import session_findings_stream
    from eventwatch.streaming.user_state import user_findings_stream

    parsed = parsed_sources(inputs) if parsed is None else parsed
    events = valid_events(parsed).drop("source")
    refused = parsed if options.keep_all_dead_letters else parsed.filter(F.col("source") == 1)
    uf = user_findings_stream(events, inputs.rules, options.hold, options.retention, options.clock, profiles=inputs.profiles,
                              live_rules=live_rules)
    if options.late_panes:  # exact: on-time pane, then one pane per late element (new elements only)
        from eventwatch.streaming.late_panes import pane_findings, session_panes_stream
        rules = inputs.session_rules or [banned_process_rule(options.banned_processes)]
        sf = pane_findings(session_panes_stream(events, (), options.session_gap, options.allowed_lateness, rules), rules).drop("pane")
    else:                   # default: one complete finding per session when the watermark passes it
        sf = session_findings_stream(events, options.banned_processes, options.session_gap,
                                     options.allowed_lateness, inputs.session_rules)
    return Outputs(inputs.messages, events, dead_letters(refused), uf, sf, parsed)


def _start(writer, trigger: dict | None):
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_monitor(spark: SparkSession, inputs: Inputs, options: Options, trigger: dict | None = None) -> list:
    """Start the whole monitor on streaming inputs; returns its queries, the first one is the parser.

    The parser is the only query that reads the sources: it writes every parsed message once into a log (and observes the
    counters), from which the other queries read columns, and trims the log behind the slowest of them. With an
    ``availableNow`` trigger the others start when the parser is done.
    """
    base = options.checkpoint_dir or checkpoint_dir(spark)
    if not options.create_tables:
        for name in (options.events_table, options.findings_table, options.invalid_messages_table):
            tables.require_table(spark, f"{options.output_dir}/{name}")
    else:
        tables.create_tables(spark, options.output_dir, options.events_table, options.findings_table, options.invalid_messages_table)
    parsed = parsed_sources(inputs)
    log = ParsedLog(spark, f"{base}/parsed_log", f"{base}/parse")
    observed, _ = observe_messages(parsed)
    queries = [log.write(observed, "parse", trigger)]
    if trigger and trigger.get("availableNow"):
        queries[0].awaitTermination()
    stream = log.read(parsed.schema)
    live, more = None, []
    if options.rules_path:
        live = LiveRules(spark, options.rules_path, f"{base}/rules")
        live.publish()
        if not (trigger and trigger.get("availableNow")):
            more.append(live.start_refresh(checkpoint=f"{base}/rules_refresh"))
    outputs = streaming_processing(inputs, options, stream, live.column() if live else None)
    if options.file_list:
        files = observe_files(accepted_files(spark, options.file_list, streaming=True))
        more.append(_start(files.writeStream.format("noop").option("checkpointLocation", f"{base}/files").queryName("files"), trigger))
    if not (trigger and trigger.get("availableNow")):   # a finite run has its rejects in the tables
        out = options.output_dir
        watched = {t: f"{out}/{t}" for t in (options.events_table, options.findings_table, options.invalid_messages_table)}
        more.append(start_report(spark, watched, f"{out}/{options.report_table}", f"{base}/reject_report", options.report_window,
                                 options.report_delay, trigger))
    readers = start_queries(outputs, options, trigger=trigger)
    if options.max_messages:
        readers.append(counted_stop(spark, options).start(stream.filter(F.col("source") == 1), trigger))
    log.follow(readers)
    return queries + readers + more


def counted_stop(spark: SparkSession, options: Options) -> CountedStop:
    """The stop after ``max_messages`` messages of the first source, counted over restarts from one checkpoint folder."""
    base = options.checkpoint_dir or checkpoint_dir(spark)
    return CountedStop(spark, f"{base}/stop", options.max_messages, HowToStop(options.stop))


def start_queries(outputs: Outputs, options: Options, trigger: dict | None = None) -> list:
    """Persist all outputs of a streaming ``main_processing`` (G2), one query per branch.

    Events and dead letters share one ``foreachBatch`` over the parsed messages; user findings go to the findings table
    and topic; source-address findings go to the topic; the raw export has a query of its own, which closes minutes.
    Rows that a table refuses go to its rejects. Every micro-batch writes a slice named by its query's id and number.
    """
    spark = outputs.parsed.sparkSession
    base = options.checkpoint_dir or checkpoint_dir(spark)
    out = options.output_dir
    must = not options.create_tables
    dimension = None
    if options.process_info_path:
        dimension = Refreshing(lambda: process_dimension(spark.read.parquet(options.process_info_path)), PROCESS_REFRESH)

    def in_slices(name: str, fn):
        def run(batch: DataFrame, batch_id: int) -> None:
            batch.persist()
            try:
                fn(batch, tables.slice_of(batch.sparkSession, f"{base}/{name}", batch_id))
            finally:
                batch.unpersist()
        return run

    def topic(values: DataFrame, kind: str, slice_id: str) -> None:
        if options.findings_topic and options.topic_format == "kafka":
            tables.write_topic(values, options.findings_topic, "kafka", slice_id, options.topic_options)
        elif options.findings_topic:
            tables.write_topic(values, f"{options.findings_topic}/{kind}", slice_id=slice_id)

    def write_messages(batch: DataFrame, slice_id: str) -> None:
        events = valid_events(batch).drop("source")
        if dimension is not None:
            events = enrich_category(events, dimension.get())
        tables.write_events(events, f"{out}/{options.events_table}", slice_id, must)
        dead = batch if options.keep_all_dead_letters else batch.filter(F.col("source") == 1)
        tables.write_dead_letters(dead_letters(dead), f"{out}/{options.invalid_messages_table}", slice_id, must)

    def write_user(batch: DataFrame, slice_id: str) -> None:
        tables.write_user_findings(batch, f"{out}/{options.findings_table}", slice_id, must)
        topic(formats.user_finding_json(batch), "user", slice_id)

    def write_source(batch: DataFrame, slice_id: str) -> None:
        topic(formats.source_finding_json(batch), "source", slice_id)

    branches = [("messages", outputs.parsed, write_messages), ("user_findings", outputs.user_findings, write_user)]
    if options.findings_topic:  # the only place that source-address findings go to
        branches.append(("source_findings", observe_suspicious(outputs.source_ip_findings), write_source))
    queries = []
    for name, df, fn in branches:
        w = df.writeStream.foreachBatch(in_slices(name, fn)).option("checkpointLocation", f"{base}/{name}").queryName(name)
        queries.append(_start(w, trigger))
    if options.export_dir:
        finite = bool(trigger and trigger.get("availableNow"))
        export = MinuteExport(options.export_dir, f"{base}/export", options.export_lateness, options.export_shards, close_all=finite)
        queries.append(export.start(outputs.parsed.filter(F.col("source") == 1), trigger))
    return queries


def start_ingest(spark: SparkSession, topic: str, options: Options, trigger: dict | None = None):
    """Findings topic -> findings table (S9): source-address findings, written as they come."""
    base = options.checkpoint_dir or checkpoint_dir(spark)

    def write(batch: DataFrame, batch_id: int) -> None:
        tables.append_partitioned(tables.ingest_findings(batch), f"{options.output_dir}/{options.findings_table}", "request_date",
                                  "request_ts", FINDINGS_REQUIRED, tables.slice_of(batch.sparkSession, f"{base}/ingest", batch_id))

    if options.topic_format == "kafka":
        records = spark.readStream.format("kafka").options(subscribe=topic, **options.topic_options).load()
        values = tables.each_key_once(records.select(F.col("key").cast("string"), F.col("value").cast("string")))
    else:  # a slice's files come once; its folder, that may not be there yet, is no column
        values = spark.readStream.schema("value STRING").option("recursiveFileLookup", "true").text(f"{topic}/source")
    return _start(values.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/ingest").queryName("ingest"), trigger)
