"""Message sources: landing directories (parquet/json lines), Kafka, file lists, CSV payload columns.

All produce the message envelope (payload, attributes, message_id, publish_ts), static or streaming.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventwatch.config import ACCEPTED_FILE_PATTERN
from eventwatch.schema import MESSAGE

FILE = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"   # as Spark lists files
JSON_GLOB = "*.{json,JSON}"


def read_messages(spark: SparkSession, path: str, fmt: str = "parquet", streaming: bool = True,
                  options: dict | None = None) -> DataFrame:
    """Envelope rows from a landing directory (``parquet``) or a Kafka topic (``kafka``; needs its package)."""
    opts = dict(options or {})
    if fmt == "kafka":
        reader = spark.readStream if streaming else spark.read
        raw = reader.format("kafka").options(subscribe=path, **opts).load()
        return raw.select(
            F.col("value").alias("payload"),
            F.map_from_entries(F.transform(F.coalesce("headers", F.array()),
                                           lambda h: F.struct(h["key"], h["value"].cast("string")))).alias("attributes"),
            F.concat_ws("-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string")).alias("message_id"),
            F.col("timestamp").alias("publish_ts"))
    if fmt == "json":
        return read_json_lines(spark, [path], streaming)
    reader = spark.readStream if streaming else spark.read
    return reader.schema(MESSAGE).options(**opts).format(fmt).load(path)


def read_json_lines(spark: SparkSession, paths: list[str], streaming: bool = False) -> DataFrame:
    """File-list source: every line of every ``.json``/``.JSON`` file of every path or glob is one message.

    Other extensions are refused by the glob filter.  The message id is the file path plus a hash of the
    line; the publish time is the file's modification time.  A stream reads each path as a source of its own.
    """
    reader = spark.readStream if streaming else spark.read
    read = reader.option("pathGlobFilter", JSON_GLOB)
    columns = ["value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_modification_time").alias("file_time")]
    raw = (reduce(DataFrame.union, [read.text(p).select(*columns) for p in paths]) if streaming else read.text(paths).select(*columns))
    return raw.select(
        F.encode("value", "UTF-8").alias("payload"),
        F.lit(None).cast("map<string,string>").alias("attributes"),
        F.concat_ws("#", "file_path", F.sha2("value", 256)).alias("message_id"),
        F.col("file_time").alias("publish_ts"))


def file_counters(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Counters of the extension filter: accepted_files, rejected_files."""
    ok = F.col("accepted")
    return accepted_files(spark, paths).agg(F.count(F.when(ok, 1)).alias("accepted_files"), F.count(F.when(~ok, 1)).alias("rejected_files"))


def payload_messages(payloads: DataFrame, column: str = "payload", publish_col: str | None = None) -> DataFrame:
    """A collection of raw JSON payloads (text or bytes) as messages: no attributes, no id; published now unless a
    column says when."""
    c = F.col(column)
    body = c if dict(payloads.dtypes)[column] == "binary" else F.encode(c, "UTF-8")
    return payloads.select(body.alias("payload"), F.lit(None).cast("map<string,string>").alias("attributes"),
                           F.lit(None).cast("string").alias("message_id"),
                           (F.col(publish_col) if publish_col else F.current_timestamp()).alias("publish_ts"))


def accepted_files(spark: SparkSession, paths: list[str], streaming: bool = False) -> DataFrame:
    """Listed files with their verdict (counters: accepted / rejected) — the extension filter as data. Only names are
    read. A stream gives every new file of every path once."""
    def listing(reader, at):
        return reader.schema(FILE).format("binaryFile").option("recursiveFileLookup", "false").load(at).select(F.col("path"))
    files = (reduce(DataFrame.union, [listing(spark.readStream, p) for p in paths]) if streaming else listing(spark.read, paths))
    return files.withColumn("accepted", F.col("path").rlike(ACCEPTED_FILE_PATTERN))


def csv_first_column(spark: SparkSession, path: str) -> DataFrame:
    """CSV → first column of every row (quoted, possibly multi-line fields), one payload per row."""
    df = (spark.read.option("quote", '"').option("escape", '"').option("multiLine", True).csv(path))
    return df.select(F.col(df.columns[0]).alias("value"))


def lines_to_messages(lines: DataFrame, publish_col: str | None = None) -> DataFrame:
    """Replay text lines as messages (line → payload), e.g. to feed a landing directory or topic.

    Ids are numbered by partition and line, so equal lines stay two messages.
    """
    pub = F.col(publish_col) if publish_col else F.current_timestamp()
    return lines.select(F.encode("value", "UTF-8").alias("payload"),
                        F.lit(None).cast("map<string,string>").alias("attributes"),
                        F.concat_ws("#", F.monotonically_increasing_id().cast("string"), F.sha2("value", 256)).alias("message_id"),
                        pub.alias("publish_ts"))
