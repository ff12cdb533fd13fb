"""Rule surface: user-event rules and session rules as Column expressions.

A user rule sees one event row enriched with ``newly_accessed_host`` and ``profile_status``; a
session rule contributes aggregate columns to the session ``groupBy`` and a predicate and
description over them.  Rules run inside the same projection or aggregate as the data: no UDF.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed rule identifiers, levels and description texts.
NEW_HOST_RULE_ID = "new-destination-host"
NEW_HOST_DESCRIPTION = "Newly accessed host: "
PROCESS_RULE_ID = "process-name-rule"
PROCESS_RULE_PATTERN = "virus"
PROCESS_DESCRIPTION = "Suspicious process: "
BANNED_RULE_ID = "banned-process-detector"
BANNED_DESCRIPTION = "Found banned processes: "
BANNED_SEPARATOR = ", "


@dataclass(frozen=True)
class UserRule:
    rule_id: str
    level: str
    predicate: Callable[[], Column]
    description: Callable[[], Column]
    kind: str | None = None       # 'new_host' | 'process_contains': lets the stream processor run the rule
    pattern: str | None = None


def new_destination_host_rule(level: str = "warning") -> UserRule:
    return UserRule(NEW_HOST_RULE_ID, level, lambda: F.col("newly_accessed_host"),
                    lambda: F.concat(F.lit(NEW_HOST_DESCRIPTION), F.col("dst_ip")), "new_host")


def process_name_rule(pattern: str = PROCESS_RULE_PATTERN, level: str = "severe",
                      rule_id: str = PROCESS_RULE_ID) -> UserRule:
    # A null process name gives no finding.
    return UserRule(rule_id, level, lambda: F.coalesce(F.col("process_name").contains(pattern), F.lit(False)),
                    lambda: F.concat(F.lit(PROCESS_DESCRIPTION), F.col("process_name")), "process_contains", pattern)


@dataclass(frozen=True)
class PandasUserRule:
    """Escape hatch for rules Column expressions cannot state: ``fn(batch) -> (hit, description)``.

    ``batch`` is a pandas DataFrame of enriched events (request_ts, user_id, src_ip, dst_ip, dst_port,
    process_name, bytes_sent, bytes_received, newly_accessed_host, publish_ts, message_id); ``hit`` is a
    boolean Series and ``description`` a string Series of the same length.  Runs in Arrow batches
    (``mapInPandas``) in batch mode and inside the per-user processor in stream mode.
    """
    rule_id: str
    level: str
    fn: Callable
    kind: str = "pandas"
    pattern: str | None = None


def default_user_rules() -> list[UserRule]:
    return [new_destination_host_rule(), process_name_rule()]


RULE_KINDS: dict[str, Callable[[str, str, str | None], UserRule]] = {
    "new_host": lambda rid, level, pattern: UserRule(
        rid, level, lambda: F.col("newly_accessed_host"),
        lambda: F.concat(F.lit(NEW_HOST_DESCRIPTION), F.col("dst_ip")), "new_host"),
    "process_contains": lambda rid, level, pattern: process_name_rule(pattern or PROCESS_RULE_PATTERN, level, rid),
}


def rules_from_table(rule_rows: Iterable) -> list[UserRule]:
    """Build rules from rows of the rule table (rule_id, kind, level, pattern, enabled).

    The rule table is configuration (a handful of rows), read on the driver like the monitored
    system's singleton rule side input.
    """
    out = []
    for r in rule_rows:
        if r["enabled"] and r["kind"] in RULE_KINDS:
            out.append(RULE_KINDS[r["kind"]](r["rule_id"], r["level"], r["pattern"]))
    return out


def finding_array(rules: list[UserRule]) -> Column:
    """Array of finding structs (level, rule_id, description) that the rules raise on this row."""
    if not rules:
        return F.array().cast("array<struct<level:string,rule_id:string,description:string>>")
    items = [F.when(r.predicate(), F.struct(F.lit(r.level).alias("level"), F.lit(r.rule_id).alias("rule_id"),
                                            r.description().alias("description")))
             for r in rules]
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def apply_user_rules(context: DataFrame, rules: list[UserRule]) -> DataFrame:
    """One output row per (event, finding): request_ts, user_id, source_ip, level, rule_id, description."""
    passthrough = [c for c in ("publish_ts", "message_id") if c in context.columns]
    return (context
            .select("request_ts", "user_id", F.col("src_ip").alias("source_ip"), *passthrough,
                    F.explode(finding_array(rules)).alias("f"))
            .select("request_ts", "user_id", "source_ip", "f.level", "f.rule_id", "f.description", *passthrough))


@dataclass(frozen=True)
class Partial:
    """An aggregate that can be taken in parts and merged: a session that grows, or a pane of it, needs no events again.

    ``kind``: ``count`` (of rows, or of non-null values), ``sum``, ``min``, ``max`` or ``rows`` (the values in order). Values are
    whole numbers, floating-point numbers, strings, or (for ``rows``) structs of these; nulls are left out.
    """
    kind: str
    value: Callable[[], Column] | None = None

    def per_row(self) -> Column:
        return F.lit(1).cast("bigint") if self.value is None else self.value()

    def over(self, wanted: Column | None = None) -> Column:
        """The aggregate over the rows that are wanted (all if None)."""
        v = self.per_row() if wanted is None else F.when(wanted, self.per_row())
        return {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max, "rows": lambda c: F.array_sort(F.collect_list(c))}[self.kind](v)

    def filled(self, column: Column) -> Column:
        """What a session without wanted rows has, however it was computed."""
        return F.coalesce(column, F.lit(0)) if self.kind == "count" else F.coalesce(column, F.array()) if self.kind == "rows" else column


def count_rows() -> Partial:
    return Partial("count")


def sum_of(value: Callable[[], Column]) -> Partial:
    return Partial("sum", value)


def least_of(value: Callable[[], Column]) -> Partial:
    return Partial("min", value)


def greatest_of(value: Callable[[], Column]) -> Partial:
    return Partial("max", value)


def rows_of(value: Callable[[], Column]) -> Partial:
    return Partial("rows", value)


@dataclass(frozen=True)
class SessionRule:
    """Aggregates over the events of a session that the rule wants, a predicate on them and a description.

    Aggregates that are a ``Partial`` work everywhere: batch, stream, late panes. Plain aggregate Columns work in batch, and
    in the default stream where the rule wants all rows; elsewhere they are refused.
    """
    rule_id: str
    level: str
    aggregates: dict[str, Column | Partial]
    predicate: Callable[[], Column]
    description: Callable[[], Column]
    rows: Callable[[], Column] | None = None   # the events that the aggregates need; all if None

    def wanted(self) -> Column | None:
        """Null counts as unwanted."""
        return None if self.rows is None else F.coalesce(self.rows(), F.lit(False))

    def columns(self, filtered: bool) -> list[Column]:
        """The aggregates, over events that are filtered already or else over all events of the session."""
        out = []
        for name, a in self.aggregates.items():
            if isinstance(a, Partial):
                a = a.over(None if filtered else self.wanted())
            elif not filtered and self.rows is not None:
                raise ValueError(f"session rule {self.rule_id}: {name} must be a Partial to be taken over some rows of a stream")
            out.append(a.alias(name))
        return out


class RuleNameClash(ValueError):
    pass


def check_names(rules: Iterable[SessionRule]) -> None:
    """Aggregates of all rules share one row: names must differ."""
    names = [n for r in rules for n in r.aggregates]
    if len(set(names)) < len(names):
        raise RuleNameClash(f"session rules share names of aggregates: {sorted(n for n in set(names) if names.count(n) > 1)}")


def banned_process_rule(banned: Iterable[str], level: str = "severe") -> SessionRule:
    """Severe finding listing every banned process of the session in time order, repeats kept."""
    names = sorted(set(banned))
    hit = F.col("process_name").isin(names) if names else F.lit(False)
    return SessionRule(
        BANNED_RULE_ID, level,
        aggregates={"banned_hits": rows_of(lambda: F.struct(F.unix_micros("publish_ts").alias("t"), "message_id", "process_name"))},
        predicate=lambda: F.coalesce(F.size("banned_hits"), F.lit(0)) > 0,
        description=lambda: F.concat(F.lit(BANNED_DESCRIPTION), F.array_join(
            F.transform("banned_hits", lambda x: x["process_name"]), BANNED_SEPARATOR)),
        rows=lambda: hit,
    )


def session_finding_array(rules: list[SessionRule]) -> Column:
    items = [F.when(r.predicate(), F.struct(F.lit(r.level).alias("level"), F.lit(r.rule_id).alias("rule_id"),
                                            r.description().alias("description")))
             for r in rules]
    return F.filter(F.array(*items), lambda x: x.isNotNull())
