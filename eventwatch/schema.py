"""Record schemas (Spark DDL / StructType)."""

from pyspark.sql import types as T

MESSAGE = T.StructType([
    T.StructField("payload", T.BinaryType(), True),
    T.StructField("attributes", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("message_id", T.StringType(), True),
    T.StructField("publish_ts", T.TimestampType(), True),
])

FINDING_JSON = T.StructType([
    T.StructField("type", T.StringType(), True),
    T.StructField("request_ts", T.StringType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("source_ip", T.StringType(), True),
    T.StructField("level", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
])

# Stored tables: columns of the day-partitioned outputs.
EVENTS_TABLE = T.StructType([
    T.StructField("request_ts", T.TimestampType(), False),
    T.StructField("bytes_sent", T.IntegerType(), False),
    T.StructField("bytes_received", T.IntegerType(), False),
    T.StructField("dst_hostname", T.StringType(), True),
    T.StructField("dst_ip", T.StringType(), False),
    T.StructField("dst_port", T.IntegerType(), False),
    T.StructField("src_ip", T.StringType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("process_name", T.StringType(), True),
])
EVENTS_REQUIRED = ["request_ts", "bytes_sent", "bytes_received", "dst_ip", "dst_port"]

FINDINGS_TABLE = T.StructType([
    T.StructField("request_ts", T.TimestampType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("source_ip", T.StringType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("level", T.StringType(), False),
    T.StructField("description", T.StringType(), False),
])
FINDINGS_REQUIRED = ["request_ts", "type", "level", "description"]

INVALID_MESSAGES_TABLE = T.StructType([
    T.StructField("published_ts", T.TimestampType(), False),
    T.StructField("failure_reason", T.StringType(), False),
    T.StructField("message_id", T.StringType(), True),
    T.StructField("payload_string", T.StringType(), True),
    T.StructField("payload_bytes", T.BinaryType(), True),
    T.StructField("attributes", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType(), False),
        T.StructField("value", T.StringType(), False)])), True),
])
INVALID_REQUIRED = ["published_ts", "failure_reason"]   # a message may come without an id
