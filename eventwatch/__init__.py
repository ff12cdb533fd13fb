"""eventwatch: Spark-native security monitoring of network-proxy events.

Messages become typed events or dead letters (``functions.parse``), are analysed per user
(``operators.user_branch``) and per source address (``operators.sessions``), and are written
by ``sinks``.  The same DataFrame functions serve batch replay and Structured Streaming.
"""

from eventwatch.config import Options, get_spark, ensure_utc

__all__ = ["Options", "get_spark", "ensure_utc"]
