"""Sinks: day-partitioned tables, JSON topics (directory or Kafka), minute-partitioned raw export."""
