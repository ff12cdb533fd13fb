"""Plan shape of every registered query: what must never appear at 100 TB scale."""

import pytest

from eventwatch import config
from eventwatch.operators import user_branch
from eventwatch.plans import pipeline, queries

import __spark_entry__ as E
from conftest import SF001
from eventwatch.plans.queries import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_or_row_python(spark, name, monkeypatch):
    """The plan of the result and of every table that the query writes on its way."""
    plans = []
    write = config.materialize

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    for module in (config, queries, pipeline, user_branch):
        monkeypatch.setattr(module, "materialize", watched)
    plans.append(E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString())
    assert not [f for p in plans for f in FORBIDDEN if f in p]


def test_events_are_read_and_parsed_once(spark):
    """All findings come from one scan of the source: every branch reads the parsed table."""
    files = E.queries()["all_findings"](spark, SF001).inputFiles()
    assert files and all("eventwatch-tables" in f for f in files)


def test_session_rules_read_events_parsed_once(spark):
    """The bucket rows and every rule read one parsed table, whatever the number of rules."""
    files = E.queries()["session_rule_rows"](spark, SF001).inputFiles()
    assert files and all("eventwatch-tables" in f for f in files)


def test_sessions_shuffle_reduced_rows(spark):
    """Counts and bounds of sessions: one exchange of pre-aggregated (address, bucket) rows, no sort of events."""
    plan = E.queries()["sessions"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "partial_min" in plan


def test_projection_prunes_scan_columns(spark):
    plan = E.queries()["payload_dispatch"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint>" in plan


def test_both_sources_share_one_parser(spark):
    """The sources are put together before they are parsed."""
    from eventwatch.sources.adapter import messages_from_events, split_sources
    first, second = split_sources(messages_from_events(spark, SF001))
    plan = pipeline.parsed_sources(pipeline.Inputs(first, second))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[failure_reason#") == 1 and plan.count("Union") == 1
