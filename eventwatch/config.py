"""Options, fixed values and session helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------------------------------------
# These must equal the monitored system's behaviour for results to agree.
# ---------------------------------------------------------------------------------------------
SESSION_GAP = "60 seconds"          # per source address, on publish time
ALLOWED_LATENESS = "1 hour"         # late panes for source-address sessions
FINDING_HOLD = "120 seconds"        # non-critical user findings are held this long
HOST_RETENTION = "30 days"          # hosts unseen this long are forgotten at the daily sweep
PROCESS_REFRESH = "2 minutes"       # lookup table refresh period
RULE_REFRESH = "5 minutes"          # rule table refresh period
FAILED_INSERT_WINDOW = "2 minutes"  # rejected-row report window
DEFAULT_PAYLOAD_TYPE = "Other"
UNKNOWN_CATEGORY = "UNKNOWN"
ACCEPTED_FILE_PATTERN = r"(^.*\.(json|JSON)$)"
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
USER_FINDING_TYPE = "user-event-finding"
SOURCE_FINDING_TYPE = "source-ip-finding"
# ---------------------------------------------------------------------------------------------

# Parameters widened for the 30-day driver data set (see README, "Data adapter").
REPLAY_SESSION_GAP = "30 minutes"
REPLAY_RETENTION = "7 days"
REPLAY_HOLD = "6 hours"
REPLAY_BANNED = ("virus1",)


@dataclass
class Options:
    """Pipeline options; unused threat options of the monitored system are left out."""

    source_path: str | None = None            # landing directory or topic of the first source
    second_source_path: str | None = None     # optional second source
    file_list: list[str] | None = None        # paths or globs of raw JSON files instead of a first source
    source_format: str = "parquet"            # parquet | json | kafka
    output_dir: str = "warehouse"
    events_table: str = "events"
    findings_table: str = "findings"
    invalid_messages_table: str = "invalid_messages"
    report_table: str = "failed_inserts"      # rows that tables refused, per window
    report_window: str = FAILED_INSERT_WINDOW
    report_delay: str = "30 seconds"
    create_tables: bool = False               # else absent tables are refused
    process_info_path: str | None = None      # process table, read again every two minutes: events get a category
    rules_path: str | None = None             # rule table, read again every five minutes
    profiles_path: str | None = None          # user profile table
    findings_topic: str | None = None         # directory or Kafka topic
    topic_format: str = "json"                # json | kafka
    topic_options: dict = field(default_factory=dict)
    export_dir: str | None = None             # raw JSON export, first source only: a file a minute
    export_lateness: str = "0 seconds"        # how long a minute stays open after its end (publish time)
    export_shards: int = 1                    # files a minute
    max_messages: int | None = None           # stop after this many messages of the first source
    stop: str = "cancel"                      # how: cancel | drain
    banned_processes: tuple[str, ...] = ()
    session_gap: str = SESSION_GAP
    allowed_lateness: str = ALLOWED_LATENESS
    hold: str = FINDING_HOLD
    retention: str = HOST_RETENTION
    keep_all_dead_letters: bool = False
    late_panes: bool = False
    clock: str = "processing"                 # processing | event
    checkpoint_dir: str | None = None


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Day alignment, partition paths and ISO strings are UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, local mode (tests) takes a scratch folder; any other master is refused, as executors
    would write to their own disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not spark.conf.get("spark.master", "local").split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="eventwatch-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    sc.setCheckpointDir(path)
    return path


_TABLES: list[str] = []


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, asked of the file system that Spark writes to."""
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in its place as a whole: readers see the old content or the new."""
    fs, to = _file_system(spark, path)
    jvm = spark._jvm
    to = fs.makeQualified(to)
    new = jvm.org.apache.hadoop.fs.Path(to.getParent(), f"_{uuid.uuid4().hex}")
    out = fs.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), spark._jsc.hadoopConfiguration()).rename(new, to, overwrite)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file; None where there is none."""
    return spark.read.text(path, wholetext=True).first()[0] if path_exists(spark, path) else None


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a parquet table in the shared checkpoint folder and continue from it.

    Used where one input feeds several branches: it is computed once, lineage is cut, a lost executor re-reads
    the written files, and each branch reads only the columns it needs (filters push down into the scan).
    Select what the branches read before. The tables go with ``release_tables``, at the latest when the
    process ends.
    """
    base = checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/eventwatch-tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _TABLES:
        atexit.register(_release_at_exit)
    _TABLES.append(path)
    return df.sparkSession.read.parquet(path)


def release_tables(spark: SparkSession, keep: int = 0) -> int:
    """Delete the materialised tables of this process but the first ``keep``; call it once their results are written."""
    gone = 0
    while len(_TABLES) > keep:
        fs, p = _file_system(spark, _TABLES.pop())
        gone += bool(fs.delete(p, True))
    return gone


def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        release_tables(spark)


def get_spark(app: str = "eventwatch", cores: str | int | None = None, shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Session with the settings this engine relies on (UTC, AQE, skew join, no UI).

    Master, memory and shuffle partitions are the cluster's (spark-submit or its defaults); only ``cores``, for
    tests and the bench, asks for local mode, and only ``shuffle_partitions`` sets their number.
    """
    b = (SparkSession.builder.appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.sql.streaming.stateStore.providerClass",
                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"))
    if cores is not None:
        b = b.master(f"local[{cores}]").config("spark.driver.memory", os.environ.get("EVENTWATCH_DRIVER_MEMORY", "8g"))
        shuffle_partitions = shuffle_partitions or int(os.environ.get("EVENTWATCH_SHUFFLE_PARTITIONS", "8"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_utc(spark)
