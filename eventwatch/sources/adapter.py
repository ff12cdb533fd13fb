"""Turns the driver's ``events`` table into proxy-request messages (README, "Data adapter").

The projection is fixed so that the DuckDB oracle (``plans.oracle``) can rebuild the same
messages.  Fault injection by ``event_id`` residue puts malformed payloads into the stream;
every row is still emitted, none is filtered out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventwatch.config import ensure_utc

# Fixed fault-injection residues, first match wins: junk text, no destination_ip,
# no bytes_sent, port "abc", payloadType "type A".
FAULT_JUNK, FAULT_NO_DST, FAULT_NO_SENT, FAULT_BAD_PORT, FAULT_TYPE_A = 97, 89, 83, 79, 73
# Valid encodings exercised on the side: bytes_received as digit string, bytes_sent with a fraction,
# payloadType "proxy" (an unknown type, so the default converter).
STRING_RECEIVED, FRACTION_SENT, PROXY_TYPE = 7, 13, 5
NO_USER = 11


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. ``eventwatch.adapter.partitions``, unset by default, deals a one-split test file out to so many
    tasks (the bench sets it); a large table comes in many splits and needs no shuffle."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    n = spark.conf.get("eventwatch.adapter.partitions", None)
    return df.repartition(int(n)) if n else df


def _q(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def event_fields(events: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Typed proxy fields of each driver event (before JSON encoding), plus ``carry`` columns."""
    k = F.get_json_object("props", "$.k").cast("int")
    publish = F.date_trunc("MILLISECOND", F.col("ts").cast("timestamp"))
    return events.select(
        F.col("event_id"),
        F.col("event_id").cast("string").alias("message_id"),
        publish.alias("publish_ts"),
        F.timestamp_millis(F.unix_millis(publish) - (F.col("event_id") % 5) * 1000).alias("request_ts"),
        F.concat(F.lit("192.6.6."), (F.col("user_id") % 10 + 1).cast("string")).alias("src_ip"),
        F.concat(F.lit("10.2.1."), k.cast("string")).alias("dst_ip"),
        F.when(k % 3 == 0, 80).when(k % 3 == 1, 443).otherwise(8080).alias("dst_port"),
        F.when(F.col("event_type") == "error", F.lit("virus1"))
         .when(F.col("event_type") == "signup", F.lit("another-virus"))
         .when(F.col("event_type") == "click", F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("process"), (k % 3 + 1).cast("string"))).alias("process_name"),
        F.when(F.col("event_id") % NO_USER == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("user"), F.col("user_id").cast("string"))).alias("user_id"),
        (F.lit(300) + F.floor(F.col("value") * 10).cast("int")).alias("bytes_sent"),
        (F.lit(200) + F.floor(F.col("value") * 20).cast("int")).alias("bytes_received"),
        *carry,
    )


def encode_messages(fields: DataFrame) -> DataFrame:
    """JSON-encode typed fields into the message envelope, injecting faults by id."""
    eid = F.col("event_id")
    fault = (F.when(eid % FAULT_JUNK == 0, "junk").when(eid % FAULT_NO_DST == 0, "no_dst")
             .when(eid % FAULT_NO_SENT == 0, "no_sent").when(eid % FAULT_BAD_PORT == 0, "bad_port")
             .when(eid % FAULT_TYPE_A == 0, "type_a"))
    sent = F.when(eid % FRACTION_SENT == 0, F.concat(F.col("bytes_sent").cast("string"), F.lit(".5"))) \
        .otherwise(F.col("bytes_sent").cast("string"))
    received = F.when(eid % STRING_RECEIVED == 0, _q(F.col("bytes_received").cast("string"))) \
        .otherwise(F.col("bytes_received").cast("string"))
    port = F.when(fault == "bad_port", F.lit('"abc"')).otherwise(F.col("dst_port").cast("string"))
    epoch_ms = F.unix_millis(F.col("request_ts"))
    body = F.concat(
        F.lit("{"),
        F.when(fault == "no_sent", F.lit("")).otherwise(F.concat(F.lit('"bytes_sent": '), sent, F.lit(", "))),
        F.when(fault == "no_dst", F.lit("")).otherwise(F.concat(F.lit('"destination_ip": '), _q(F.col("dst_ip")), F.lit(", "))),
        F.lit('"destination_port": '), port, F.lit(", "),
        F.when(F.col("process_name").isNull(), F.lit(""))
         .otherwise(F.concat(F.lit('"process": '), _q(F.col("process_name")), F.lit(", "))),
        F.lit('"request_timestamp": '), epoch_ms.cast("string"), F.lit(", "),
        F.lit('"bytes_received": '), received, F.lit(", "),
        F.lit('"source_ip": '), _q(F.col("src_ip")),
        F.when(F.col("user_id").isNull(), F.lit("")).otherwise(F.concat(F.lit(', "user": '), _q(F.col("user_id")))),
        F.lit("}"))
    text = F.when(fault == "junk", F.lit("junk")).otherwise(body)
    attributes = (F.when(fault == "type_a", F.create_map(F.lit("payloadType"), F.lit("type A")))
                  .when(eid % PROXY_TYPE == 1, F.create_map(F.lit("payloadType"), F.lit("proxy"))))
    return fields.select(
        F.encode(text, "UTF-8").alias("payload"),
        attributes.alias("attributes"),
        F.col("message_id"),
        F.col("publish_ts"),
        F.col("event_id"),
    )


def messages_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message envelope (payload, attributes, message_id, publish_ts) plus the source ``event_id``."""
    ensure_utc(spark)
    return encode_messages(event_fields(load_table(spark, sf_dir, "events")))


def split_sources(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First source: even ids; second source: odd ids.  Together they are all messages."""
    return (messages.filter(F.col("event_id") % 2 == 0), messages.filter(F.col("event_id") % 2 == 1))
