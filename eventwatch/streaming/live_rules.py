"""User rules of a running stream as data: a changed rule table takes effect without a restart.

A rule table (rule_id, kind, level, pattern, enabled) is configuration of a few rows. ``publish`` writes its current rows
as one JSON file in the checkpoint folder, by writing a new file and renaming it; a query of its own does so every five
minutes (``start_refresh``). The streams read that file as the single value of a scalar subquery, which Spark evaluates
again for every micro-batch with the file's content of that moment, and pair every event with the rules of the value: an
array that is transformed to findings. So the rules are an input of the plan, not expressions in it.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventwatch.config import RULE_REFRESH, path_exists, read_text, write_text
from eventwatch.operators.rules import NEW_HOST_DESCRIPTION, PROCESS_DESCRIPTION, PROCESS_RULE_PATTERN, RULE_KINDS

RULES = "array<struct<rule_id:string,kind:string,level:string,pattern:string>>"


def rule_rows(table: DataFrame) -> DataFrame:
    """The enabled rules of known kinds, as one row with an array in order of their ids."""
    good = table.filter(F.col("enabled") & F.col("kind").isin(list(RULE_KINDS)))
    return good.agg(F.array_sort(F.collect_list(F.struct("rule_id", "kind", "level", F.col("pattern").cast("string").alias("pattern")))).alias("rules"))


def data_finding_array(rules: Column) -> Column:
    """Findings (level, rule_id, description) that rules given as data raise on an event with ``newly_accessed_host``.

    ``rules`` is a column of the frame (a subquery must be bound to one before)."""
    def one(r: Column) -> Column:
        pattern = F.coalesce(r["pattern"], F.lit(PROCESS_RULE_PATTERN))
        text = (F.when((r["kind"] == "new_host") & F.col("newly_accessed_host"), F.concat(F.lit(NEW_HOST_DESCRIPTION), F.col("dst_ip")))
                .when((r["kind"] == "process_contains") & F.contains(F.col("process_name"), pattern),
                      F.concat(F.lit(PROCESS_DESCRIPTION), F.col("process_name"))))
        return F.when(text.isNotNull(), F.struct(r["level"].alias("level"), r["rule_id"].alias("rule_id"), text.alias("description")))
    return F.filter(F.transform(rules, one), lambda x: x.isNotNull())


def apply_rule_data(context: DataFrame, rules: Column) -> DataFrame:
    """One row per event and finding, like ``rules.apply_user_rules``, for rules given as a column."""
    return (context.withColumn("__rules", rules)
            .select("request_ts", "user_id", F.col("src_ip").alias("source_ip"), "publish_ts", "message_id",
                    F.explode(data_finding_array(F.col("__rules"))).alias("f"))
            .select("request_ts", "user_id", "source_ip", "f.level", "f.rule_id", "f.description", "publish_ts", "message_id"))


class LiveRules:
    def __init__(self, spark: SparkSession, table: str, folder: str):
        self.spark, self.table, self.folder = spark, table, folder.rstrip("/")
        self.path = f"{self.folder}/current.json"

    def publish(self) -> bool:
        """Write the table's rules if they have changed; whether they have. An unreadable table leaves the old rules in force."""
        rows = rule_rows(self.spark.read.parquet(self.table)).select(F.to_json("rules").alias("r")).first()[0]
        if read_text(self.spark, self.path) == rows:
            return False
        write_text(self.spark, self.path, rows)
        return True

    def column(self) -> Column:
        """The rules in force, for use in a (streaming) plan."""
        if not path_exists(self.spark, self.path):
            self.publish()
        file = self.spark.read.format("binaryFile").load(self.path)   # its content is read anew by every execution
        return F.from_json(file.select(F.max(F.decode("content", "utf-8"))).scalar(), RULES)

    def start_refresh(self, every: str = RULE_REFRESH, checkpoint: str | None = None) -> StreamingQuery:
        """A query that looks at the table at once and every five minutes."""
        def look(batch: DataFrame, batch_id: int) -> None:
            try:
                self.publish()
            except Exception as e:  # the table may be half written; the next tick looks again
                print(f"rules not refreshed: {json.dumps(str(e)[:200])}")

        ticks = self.spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()
        w = ticks.writeStream.foreachBatch(look).trigger(processingTime=every).queryName("rules")
        return (w.option("checkpointLocation", checkpoint) if checkpoint else w).start()
