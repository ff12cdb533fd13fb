"""Operators: rules, the per-user branch, source-address sessions, lookups, thresholds, side inputs."""
