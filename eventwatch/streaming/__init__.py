"""Structured Streaming forms: message streams, the stateful per-user processor, stream sessions,
refreshable lookups, stop-on-count, and sink wiring."""
