"""Table, topic and export writers, idempotent per micro-batch.

Each writer takes a static DataFrame (a micro-batch inside ``foreachBatch``, or a batch replay). With a slice (see
``slice_of``) a write replaces only that slice, so a retried micro-batch is not there twice, while a new query, with
its new checkpoint, adds slices of its own and never overwrites. Rows that miss a required column go to the table's
rejects (``<table>_rejected``) and are counted per fixed window like the monitored system's failed-insert report.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventwatch.config import FAILED_INSERT_WINDOW, path_exists
from eventwatch.functions import formats
from eventwatch.schema import EVENTS_REQUIRED, EVENTS_TABLE, FINDINGS_REQUIRED, FINDINGS_TABLE, INVALID_MESSAGES_TABLE, INVALID_REQUIRED


class TableMissing(RuntimeError):
    pass


def create_tables(spark: SparkSession, output_dir: str, events: str = "events", findings: str = "findings",
                  invalid: str = "invalid_messages") -> None:
    """Make the (empty) tables that the monitor appends to; tables that are there stay."""
    for name, schema in ((events, EVENTS_TABLE), (findings, FINDINGS_TABLE), (invalid, INVALID_MESSAGES_TABLE)):
        if not path_exists(spark, f"{output_dir}/{name}"):
            spark.createDataFrame([], schema).write.parquet(f"{output_dir}/{name}")


def require_table(spark: SparkSession, path: str) -> None:
    if not path_exists(spark, path):
        raise TableMissing(path)


def slice_of(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """Name of a micro-batch: the streaming query's id, kept in its checkpoint, and the batch's number."""
    meta = spark.read.text(f"{checkpoint}/metadata").first()
    return f"{json.loads(meta[0])['id']}-{batch_id}"


def split_required(rows: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that have every required column, the others)."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return rows.filter(ok), rows.filter(~ok)


def _write(df: DataFrame, path: str, columns: list[str], slice_id: str | None, fmt: str) -> None:
    if slice_id is None:
        w = df.write.mode("append")
    else:
        df = df.withColumn("slice", F.lit(slice_id))
        w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        columns = [*columns, "slice"]
    (w.partitionBy(*columns) if columns else w).format(fmt).save(path)


def _write_once(df: DataFrame, path: str, slice_id: str | None, fmt: str) -> None:
    """Like ``_write``, for readers that follow the folder: a slice comes into its place as a whole and a retry leaves it
    there, so a reader never meets its rows a second time in new files."""
    if slice_id is None or not path_exists(df.sparkSession, f"{path}/slice={slice_id}"):
        _write(df, path, [], slice_id, fmt)


def append_partitioned(df: DataFrame, path: str, date_col: str, ts_col: str, required: list[str],
                       slice_id: str | None = None, must_exist: bool = False) -> DataFrame:
    """Append rows to a parquet table partitioned by day of ``ts_col``; the others go to its rejects and are returned."""
    if must_exist:
        require_table(df.sparkSession, path)
    good, rejected = split_required(df, required)
    _write(good.withColumn(date_col, F.to_date(ts_col)), path, [date_col], slice_id, "parquet")
    _write_once(rejected.withColumn("rejected_ts", F.current_timestamp()), f"{path}_rejected", slice_id, "parquet")
    return rejected


def rejected_report(rejected: DataFrame, ts_col: str = "rejected_ts", window: str = FAILED_INSERT_WINDOW) -> DataFrame:
    """Rejected rows per window."""
    return (rejected.groupBy(F.window(ts_col, window).alias("w")).agg(F.count(F.lit(1)).alias("failed_rows"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "failed_rows"))


def write_events(events: DataFrame, path: str, slice_id: str | None = None, must_exist: bool = False) -> DataFrame:
    rows = formats.event_rows(events)
    if "category" in events.columns:
        rows = formats.event_rows(events, "category")
    return append_partitioned(rows, path, "request_date", "request_ts", EVENTS_REQUIRED, slice_id, must_exist)


def write_dead_letters(dead: DataFrame, path: str, slice_id: str | None = None, must_exist: bool = False) -> DataFrame:
    return append_partitioned(formats.dead_letter_rows(dead), path, "published_date", "published_ts",
                              INVALID_REQUIRED, slice_id, must_exist)


def write_user_findings(findings: DataFrame, path: str, slice_id: str | None = None, must_exist: bool = False) -> DataFrame:
    return append_partitioned(formats.user_finding_rows(findings), path, "request_date", "request_ts",
                              FINDINGS_REQUIRED, slice_id, must_exist)


def write_topic(json_values: DataFrame, target: str, fmt: str = "json", slice_id: str | None = None,
                options: dict | None = None) -> None:
    """Publish JSON strings (column ``value``): a directory of JSON-lines files, where a repeated slice is written once, or a
    Kafka topic, whose records carry keys that are the same in a repeated slice (see ``keyed``, ``each_key_once``)."""
    if fmt == "kafka":
        records = keyed(json_values, slice_id) if slice_id else json_values.select("value")
        records.write.format("kafka").options(**(options or {})).option("topic", target).save()
        return
    _write_once(json_values.select("value"), target, slice_id, "text")


def keyed(json_values: DataFrame, slice_id: str) -> DataFrame:
    """(key, value): the slice, the text's hash and the number of the text among equal ones. Whatever order and tasks a
    repeated slice has, its keys are the same."""
    texts = json_values.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return (texts.select("value", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("k"))
            .select(F.concat_ws("#", F.lit(slice_id), F.sha2("value", 256), F.col("k").cast("string")).alias("key"), "value"))


def each_key_once(records: DataFrame, within: str = "1 day") -> DataFrame:
    """Stream of (key, value) without the records of a repeated slice that come within ``within`` of the first ones.

    The time is the arrival here, which never is late; records without a key are all kept.
    """
    own = F.coalesce(F.col("key").cast("string"), F.uuid())
    arrived = records.withColumns({"key": own, "arrived": F.current_timestamp()}).withWatermark("arrived", within)
    return arrived.dropDuplicatesWithinWatermark(["key"]).select("value")


def export_raw(messages: DataFrame, path: str, one_file_per_window: bool = False, slice_id: str | None = None) -> None:
    """Raw JSON export (first source only) under eventDate=/eventHour=/eventMinute=/.

    Default: range-partitioned on publish time, so a minute normally lands in one file and a very busy
    minute is split over several tasks.  ``one_file_per_window`` hashes each minute to a single task
    (the monitored system's one shard per window), which a hot minute would serialise.
    """
    n = formats.normalised_json(messages)
    parts = formats.export_partitions(F.col("publish_ts"))
    staged = n.select(*parts, "value", "publish_ts")
    staged = (staged.repartition("eventDate", "eventHour", "eventMinute") if one_file_per_window
              else staged.repartitionByRange("publish_ts"))
    _write(staged.drop("publish_ts"), path, ["eventDate", "eventHour", "eventMinute"], slice_id, "text")


def ingest_findings(topic_values: DataFrame, types: tuple[str, ...] = ("source-ip-finding",)) -> DataFrame:
    """Findings topic → ``findings`` table rows (static or streaming).

    User findings are also written directly to the table, so by default only source-address findings are
    ingested from the topic (both ways would duplicate them).
    """
    from eventwatch.schema import FINDING_JSON
    from eventwatch.config import ISO_MILLIS
    r = F.from_json("value", FINDING_JSON)
    rows = topic_values.select(r.alias("r")).select("r.*").filter(F.col("type").isin(list(types)))
    return rows.select(F.to_timestamp("request_ts", ISO_MILLIS).alias("request_ts"), "type", "source_ip", "user_id",
                       "level", "description")
