"""Per-user branch, batch form: seen-before hosts with expiry, rule findings, held findings.

Replay order is (publish_ts, message_id, then the other columns); the replay clock is publish time. No form sorts
one user's (or one user-host pair's) whole history in one task: state is reduced per (user, host, day) with partial
aggregation, and what a rule needs of a host's first event rides along in that aggregate.
"""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventwatch.config import FINDING_HOLD, materialize
from eventwatch.operators.rules import PandasUserRule, UserRule, apply_user_rules, default_user_rules
from eventwatch.operators.sessions import assign_sessions, bucket_of, interval_ms

# Executors get the Arrow-batch functions of this module by value: no package install needed on workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def user_events(events: DataFrame) -> DataFrame:
    """Events that have a user; filtered before any shuffle by user."""
    return events.filter(F.col("user_id").isNotNull())


def _first_of_day(ev: DataFrame, retention: str | None, carry: list[str]) -> DataFrame:
    """The first event of every (user, host, day) as struct ``__first`` (publish_ts, message_id, then ``carry``), with
    ``__new``: whether the host was not remembered.

    Only that event can be new: it is iff the latest request time over the earlier days is missing or, with a
    retention, <= its day - retention (the sweep at each UTC midnight forgets such hosts).
    """
    day = F.date_trunc("DAY", F.col("publish_ts"))
    first = F.struct("publish_ts", "message_id", *[c for c in carry if c not in ("publish_ts", "message_id")])
    daily = (ev.groupBy("user_id", "dst_ip", day.alias("__day"))
             .agg(F.min(first).alias("__first"), F.max("request_ts").alias("__day_max")))
    prev = F.max("__day_max").over(Window.partitionBy("user_id", "dst_ip").orderBy("__day")
                                   .rowsBetween(Window.unboundedPreceding, -1))
    daily = daily.withColumn("__prev", prev)
    is_new = F.col("__prev").isNull()
    if retention is not None:
        cutoff = F.timestamp_millis(F.unix_millis("__day") - F.lit(interval_ms(retention)))
        is_new = is_new | (F.col("__prev") <= cutoff)
    return daily.select("user_id", "dst_ip", "__first", is_new.alias("__new"))


def new_host_events(events: DataFrame, retention: str | None = None) -> DataFrame:
    """The events whose (user, host) pair is not in the user's remembered hosts, with ``newly_accessed_host`` true.

    One aggregate and no join. Repeated messages and null ids count as what they are: of equal first events one is new.
    """
    ev = user_events(events)
    carry = [c for c in ev.columns if c not in ("user_id", "dst_ip")]
    firsts = _first_of_day(ev, retention, carry).filter("__new").select("user_id", "dst_ip", "__first.*")
    return firsts.select(*ev.columns).withColumn("newly_accessed_host", F.lit(True))


def new_host_flags(events: DataFrame, retention: str | None = None) -> DataFrame:
    """Add ``newly_accessed_host`` to every user event: the (user, host) pair is not in the user's remembered hosts.

    Without ``retention`` a host is new only on its first event. Rows are told apart by a number written with them,
    so repeated messages and null ids do not matter: of equal events exactly one can be new.
    """
    ev = materialize(user_events(events).withColumn("__row", F.monotonically_increasing_id()))
    new = _first_of_day(ev, retention, ["__row"]).filter("__new").select(F.col("__first.__row").alias("__row"), "__new")
    return (ev.join(new, on="__row", how="left")
            .withColumn("newly_accessed_host", F.coalesce(F.col("__new"), F.lit(False))).drop("__new", "__row"))


def host_last_access(events: DataFrame) -> DataFrame:
    """Latest request time per (user, host); an older request never lowers it."""
    return (user_events(events).groupBy("user_id", "dst_ip")
            .agg(F.max("request_ts").alias("last_access_ts"), F.count(F.lit(1)).alias("access_count")))


def with_profile(events: DataFrame, profiles: DataFrame | None) -> DataFrame:
    """Attach ``profile_status``; users missing from the profile table are 'regular'."""
    if profiles is None:
        return events.withColumn("profile_status", F.lit("regular"))
    p = profiles.select("user_id", F.col("status").alias("__status"))
    return (events.join(p, on="user_id", how="left")
            .withColumn("profile_status", F.coalesce("__status", F.lit("regular"))).drop("__status"))


def user_findings(events: DataFrame, rules: list[UserRule] | None = None, retention: str | None = None,
                  profiles: DataFrame | None = None) -> DataFrame:
    """Every finding the rules raise on every user event (before holding)."""
    rules = default_user_rules() if rules is None else rules
    groups = {"new_host": [], "process_contains": [], "other": [], "pandas": []}
    for r in rules:
        groups[r.kind if r.kind in groups else "other"].append(r)
    enriched = lambda df: df if profiles is None else with_profile(df, profiles)
    parts = []
    if groups["process_contains"] or not rules:  # needs no state
        plain = user_events(events).withColumn("newly_accessed_host", F.lit(False))
        parts.append(apply_user_rules(enriched(plain), groups["process_contains"]))
    if groups["new_host"]:                       # needs the new hosts' events only
        parts.append(apply_user_rules(enriched(new_host_events(events, retention)), groups["new_host"]))
    if groups["other"] or groups["pandas"]:      # may read the flag of any event
        context = enriched(new_host_flags(events, retention))
        if groups["other"]:
            parts.append(apply_user_rules(context, groups["other"]))
        parts += [apply_pandas_rule(context, r) for r in groups["pandas"]]
    return reduce(DataFrame.unionByName, parts)


FINDING_SCHEMA = T.StructType([
    T.StructField("request_ts", T.TimestampType()), T.StructField("user_id", T.StringType()),
    T.StructField("source_ip", T.StringType()), T.StructField("level", T.StringType()),
    T.StructField("rule_id", T.StringType()), T.StructField("description", T.StringType()),
    T.StructField("publish_ts", T.TimestampType()), T.StructField("message_id", T.StringType())])


def _pandas_rule_runner(rule_id: str, level: str, fn):
    def run(batches):
        for pdf in batches:
            hit, text = fn(pdf)
            hit = hit.fillna(False).astype(bool).to_numpy()
            sel = pdf[hit]
            yield pd.DataFrame({"request_ts": sel["request_ts"], "user_id": sel["user_id"],
                                "source_ip": sel["src_ip"], "level": level, "rule_id": rule_id,
                                "description": pd.Series(text)[hit].astype(str).to_numpy(),
                                "publish_ts": sel["publish_ts"], "message_id": sel["message_id"]})
    return run


def apply_pandas_rule(context: DataFrame, rule: PandasUserRule) -> DataFrame:
    """Findings of a pandas rule: no shuffle, one Python call per Arrow batch."""
    cols = ["request_ts", "user_id", "src_ip", "dst_ip", "dst_port", "process_name", "bytes_sent", "bytes_received",
            "newly_accessed_host", "publish_ts", "message_id"]
    return context.select(*cols).mapInPandas(_pandas_rule_runner(rule.rule_id, rule.level, rule.fn), FINDING_SCHEMA)


def critical_route(findings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(critical findings, emitted at once; the rest, held)."""
    critical = F.col("level") == "critical"
    return findings.filter(critical), findings.filter(~critical)


def _bag_starts(hold_ms: int):
    """mapInArrow body: batches of (user_id, island, t), sorted by them -> (user_id, t) of every bag's first finding.

    What is carried from batch to batch is the open bag's user, island and time: no rows, whatever an island's length.
    """
    def run(batches):
        last = None  # user, island, opening time of the bag at hand
        for batch in batches:
            if not batch.num_rows:
                continue
            users = batch.column("user_id").dictionary_encode()
            u = users.indices.to_numpy(zero_copy_only=False)
            isl, t = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("island", "t"))
            new = np.r_[True, (u[1:] != u[:-1]) | (isl[1:] != isl[:-1])]
            begin = np.flatnonzero(new)
            end = np.r_[begin[1:], len(t)]
            goes_on = last is not None and users.dictionary[u[0]].as_py() == last[0] and int(isl[0]) == last[1]
            opens = t[begin].copy()
            starts = [begin[1:] if goes_on else begin]
            if goes_on:
                opens[0] = last[2]
            for g in np.flatnonzero(t[end - 1] >= opens + hold_ms):  # groups of more than one bag
                seg, a = t[begin[g]:end[g]], int(opens[g])
                more = []
                while (i := int(np.searchsorted(seg, a + hold_ms))) < len(seg):
                    a = int(seg[i])
                    more.append(begin[g] + i)
                starts.append(np.array(more, np.int64))
                opens[g] = a
            last = (users.dictionary[u[-1]].as_py(), int(isl[-1]), int(opens[-1]))
            at = np.sort(np.concatenate(starts))
            yield pa.RecordBatch.from_arrays([batch.column("user_id").take(pa.array(at)), pa.array(t[at])], ["user_id", "t"])
    return run


def bag_starts(findings: DataFrame, hold_ms: int) -> DataFrame:
    """(user_id, t): the opening time of every hold bag, in one pass over the distinct finding times.

    Findings at least one hold apart never share a bag, so times are cut into islands at such gaps, which spreads a busy
    user. Only distinct (user, ms) pairs are shuffled; islands are sorted within partitions and streamed.
    """
    times = findings.select("user_id", "publish_ts").distinct()
    islands = assign_sessions(times, ["user_id"], "publish_ts", hold_ms, out="island").select("user_id", "island", F.col("__t").alias("t"))
    return (islands.repartition("user_id", "island").sortWithinPartitions("user_id", "island", "t")
            .mapInArrow(_bag_starts(hold_ms), "user_id string, t bigint"))


def assign_bags(rest: DataFrame, starts: DataFrame, hold_ms: int) -> DataFrame:
    """Add ``__open``, the opening time of each finding's bag: the last start <= its time.  Starts are >= one hold
    apart, so each (user, bucket of one hold) holds at most one: two equi-joins on (user, bucket) suffice."""
    t = F.unix_millis("publish_ts")
    s = starts.select("user_id", bucket_of(F.col("t"), hold_ms).alias("__b"), F.col("t").alias("__s"))
    both = (s.select("user_id", "__b", F.col("__s").alias("__s0"), F.lit(None).cast("bigint").alias("__s1"))
            .unionByName(s.select("user_id", (F.col("__b") + hold_ms).alias("__b"), F.lit(None).cast("bigint").alias("__s0"), F.col("__s").alias("__s1")))
            .groupBy("user_id", "__b").agg(F.max("__s0").alias("__s0"), F.max("__s1").alias("__s1")))
    staged = rest.withColumn("__b", bucket_of(t, hold_ms)).join(both, ["user_id", "__b"], "left")
    return staged.withColumn("__open", F.when(F.col("__s0") <= t, F.col("__s0")).otherwise(F.col("__s1"))).drop("__b", "__s0", "__s1")


def held_findings(findings: DataFrame, hold: str = FINDING_HOLD) -> DataFrame:
    """Add ``emit_ts``: when the finding leaves the user's hold bag (critical ones leave at once).

    A bag opens at the first held finding (publish time) and is emitted ``hold`` later with all findings that arrived
    before then; the next finding opens a new bag.  One lazy plan for any number of findings.
    """
    hold_ms = interval_ms(hold)
    critical, rest = critical_route(findings)
    bagged = assign_bags(rest, bag_starts(rest, hold_ms), hold_ms)
    bagged = bagged.withColumn("emit_ts", F.timestamp_millis(F.col("__open") + F.lit(hold_ms))).drop("__open")
    return bagged.unionByName(critical.withColumn("emit_ts", F.col("publish_ts")))
