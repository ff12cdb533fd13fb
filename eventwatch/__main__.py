"""Start the monitor: ``python -m eventwatch --source DIR [--second-source DIR] --output-dir DIR ...``.

Reads message landing directories (or Kafka topics with ``--format kafka``), runs the stream form of
the main processing and persists every output; stops after ``--max-messages`` if given.
"""

from __future__ import annotations

import argparse
import time

from eventwatch.config import Options, checkpoint_dir, get_spark
from eventwatch.plans.pipeline import Inputs, counted_stop, start_ingest, start_monitor
from eventwatch.sources.messages import read_json_lines, read_messages
from eventwatch.streaming.replay import LineReplay
from eventwatch.streaming.stop import stop_all


def parse_args(argv=None) -> tuple[Options, argparse.Namespace]:
    ap = argparse.ArgumentParser(prog="eventwatch")
    ap.add_argument("--source", help="landing directory or topic of the first source")
    ap.add_argument("--files", nargs="+", help="raw JSON files (paths or globs) as the first source")
    ap.add_argument("--second-source")
    ap.add_argument("--format", default="parquet", choices=["parquet", "json", "kafka"])
    ap.add_argument("--output-dir", required=True)
    ap.add_argument("--create-tables", action="store_true", help="make absent tables instead of refusing to start")
    ap.add_argument("--process-info", help="process table (parquet), read again every two minutes")
    ap.add_argument("--rules", help="rule table (parquet), read again every five minutes")
    ap.add_argument("--profiles", help="user profile table (parquet)")
    ap.add_argument("--ingest", action="store_true", help="only move source-address findings from the topic to the table")
    ap.add_argument("--replay", nargs="+", help="only publish the lines of these text files to the landing directory --source")
    ap.add_argument("--rate", type=int, default=100, help="lines a second of --replay")
    ap.add_argument("--findings-topic")
    ap.add_argument("--topic-format", default="json", choices=["json", "kafka"])
    ap.add_argument("--kafka-servers")
    ap.add_argument("--export-dir")
    ap.add_argument("--checkpoint-dir")
    ap.add_argument("--banned", default="", help="comma-separated banned process names")
    ap.add_argument("--max-messages", type=int)
    ap.add_argument("--stop", default="cancel", choices=["cancel", "drain"])
    ap.add_argument("--clock", default="processing", choices=["processing", "event"])
    ap.add_argument("--late-panes", action="store_true")
    ap.add_argument("--keep-all-dead-letters", action="store_true")
    a = ap.parse_args(argv)
    if not (a.source or a.files or a.ingest):
        ap.error("--source or --files is needed")
    opts = Options(source_path=a.source, second_source_path=a.second_source, source_format=a.format,
                   output_dir=a.output_dir, findings_topic=a.findings_topic, export_dir=a.export_dir,
                   checkpoint_dir=a.checkpoint_dir, max_messages=a.max_messages, stop=a.stop,
                   banned_processes=tuple(x for x in a.banned.split(",") if x), clock=a.clock,
                   late_panes=a.late_panes, keep_all_dead_letters=a.keep_all_dead_letters, file_list=a.files,
                   create_tables=a.create_tables, process_info_path=a.process_info, rules_path=a.rules, profiles_path=a.profiles,
                   topic_format=a.topic_format, topic_options={"kafka.bootstrap.servers": a.kafka_servers} if a.kafka_servers else {})
    return opts, a


def inputs_of(spark, opts: Options) -> Inputs:
    """The streaming inputs that the options name."""
    first = (read_json_lines(spark, opts.file_list, streaming=True) if opts.file_list
             else read_messages(spark, opts.source_path, opts.source_format, streaming=True, options=opts.topic_options))
    second = (read_messages(spark, opts.second_source_path, opts.source_format, streaming=True, options=opts.topic_options)
              if opts.second_source_path else None)
    profiles = spark.read.parquet(opts.profiles_path) if opts.profiles_path else None
    return Inputs(first, second, None, profiles)  # a rule table is read by the monitor, again and again


def main(argv=None) -> None:
    opts, a = parse_args(argv)
    spark = get_spark("eventwatch")
    if a.replay:
        folder = f"{opts.checkpoint_dir or checkpoint_dir(spark)}/replay"
        print(f"published {LineReplay(spark, a.replay, opts.source_path, folder, a.rate).run()} lines")
        return
    if a.ingest:
        start_ingest(spark, opts.findings_topic, opts).awaitTermination()
        return
    queries = start_monitor(spark, inputs_of(spark, opts), opts)
    stop = counted_stop(spark, opts) if opts.max_messages else None
    while any(q.isActive for q in queries):
        if stop is not None and stop_all(queries, stop):
            break
        time.sleep(1)


if __name__ == "__main__":
    main()
