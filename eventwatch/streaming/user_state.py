"""Per-user stream branch with ``transformWithStateInPandas``.

State per user: remembered hosts host -> last request ms (map), held findings (list), bag open time and next daily
sweep (values). Rows of a micro-batch are handled in (publish_ts, message_id) order. Rules that are Column
expressions are evaluated before the processor, once as for a new host and once as for a known one, so any such rule
works and the processor only chooses. Per user and batch the processor reads the hosts it needs once, works on local
values, calls each pandas rule once, and writes what changed once.

``clock='event'`` replays on publish time with watermark timers, and closes an overdue bag / runs an overdue sweep
before each row, so any split of the input into batches gives the batch result; ``clock='processing'`` uses
wall-clock timers like the monitored system. Late events are never dropped: the watermark only drives timers, and the
processor's input carries no event-time column to filter by. A late event joins the bag that is open when it comes.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventwatch.config import FINDING_HOLD, HOST_RETENTION
from eventwatch.operators.rules import PandasUserRule, default_user_rules, finding_array
from eventwatch.operators.sessions import interval_ms
from eventwatch.operators.user_branch import with_profile
from eventwatch.streaming.live_rules import data_finding_array

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAY_MS = 86_400_000
OUTPUT = ("request_ms LONG, user_id STRING, source_ip STRING, level STRING, rule_id STRING, description STRING, "
          "message_id STRING, publish_ms LONG, emit_ms LONG")
HELD = ("request_ms LONG, source_ip STRING, level STRING, rule_id STRING, description STRING, message_id STRING, "
        "publish_ms LONG")
COLUMNS = ["request_ms", "user_id", "source_ip", "level", "rule_id", "description", "message_id", "publish_ms",
           "emit_ms"]


def _findings_json(rules: list, live_rules: Column | None) -> Column:
    """Findings of the Column rules and of those given as data, as JSON; null where there are none."""
    found = finding_array(rules)
    if live_rules is not None:
        found = F.concat(found, F.coalesce(data_finding_array(live_rules), F.array())) if rules else data_finding_array(live_rules)
    return F.when(F.size(found) > 0, F.to_json(found))


class UserEventProcessor(StatefulProcessor):
    def __init__(self, pandas_rules: list[tuple], hold_ms: int, retention_ms: int, clock: str = "event"):
        self.rules, self.hold_ms, self.retention_ms, self.clock = pandas_rules, hold_ms, retention_ms, clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.hosts = handle.getMapState("hosts", "host STRING", "last_ms LONG")
        self.held = handle.getListState("held", HELD)
        self.open = handle.getValueState("open", "open_ms LONG")
        self.sweep_at = handle.getValueState("sweep", "sweep_ms LONG")

    def _begin(self) -> None:
        self.cache, self.dirty = {}, set()
        self.opened = self.was_open = self.open.get()[0] if self.open.exists() else None
        self.sweep = self.was_sweep = self.sweep_at.get()[0] if self.sweep_at.exists() else None
        self.new_held, self.emptied = [], False

    def _last(self, host: str):
        if host not in self.cache:
            self.cache[host] = self.hosts.getValue((host,))[0] if self.hosts.containsKey((host,)) else None
        return self.cache[host]

    def _close_bag(self, user: str, at_ms: int) -> list[tuple]:
        """The held findings leave."""
        before = [] if self.emptied else [tuple(r) for r in self.held.get()]
        out = [(r[0], user, *r[1:], at_ms) for r in [*before, *self.new_held]]
        self.new_held, self.emptied, self.opened = [], True, None
        return out

    def _run_sweep(self, now_ms: int) -> None:
        """Forget hosts that were last seen a retention before this day or earlier."""
        day = now_ms - now_ms % DAY_MS
        for (host,), (last,) in self.hosts.iterator():
            self.cache.setdefault(host, last)
        for host, last in self.cache.items():
            if last is not None and last <= day - self.retention_ms:
                self.cache[host] = None
                self.dirty.add(host)
        self.sweep = day + DAY_MS

    def _end(self) -> None:
        """Write what changed."""
        for host in self.dirty:
            if self.cache[host] is not None:
                self.hosts.updateValue((host,), (self.cache[host],))
            elif self.hosts.containsKey((host,)):
                self.hosts.removeKey((host,))
        if self.emptied:
            self.held.clear()
        if self.new_held:
            self.held.appendList(self.new_held)
        for now, was, state, plus in ((self.opened, self.was_open, self.open, self.hold_ms), (self.sweep, self.was_sweep, self.sweep_at, 0)):
            if now != was:
                if was is not None:
                    self.handle.deleteTimer(was + plus)
                if now is None:
                    state.clear()
                else:
                    state.update((now,))
                    self.handle.registerTimer(now + plus)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        user = key[0]
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["publish_ms", "message_id"], kind="mergesort", ignore_index=True)
        self._begin()
        event = self.clock == "event"
        wall = None if event else timerValues.getCurrentProcessingTimeInMs()
        published, requested = pdf["publish_ms"].tolist(), pdf["request_ms"].tolist()
        new = []
        for host, now, req in zip(pdf["dst_ip"].tolist(), published, requested):  # remembered hosts
            now = now if event else wall
            if event and self.sweep is not None and now >= self.sweep:
                self._run_sweep(now)
            last = self._last(host)
            new.append(last is None)
            if last is None or last < req:
                self.cache[host] = req
                self.dirty.add(host)
                if self.sweep is None:
                    self.sweep = now - now % DAY_MS + DAY_MS
        found = [json.loads(a if n else b) if isinstance(a if n else b, str) else []
                 for n, a, b in zip(new, pdf["if_new"].tolist(), pdf["if_known"].tolist())]
        if self.rules:
            frame = pdf.assign(newly_accessed_host=new, user_id=user, request_ts=pd.to_datetime(pdf["request_ms"], unit="ms"),
                               publish_ts=pd.to_datetime(pdf["publish_ms"], unit="ms"))
            for rule_id, level, fn in self.rules:
                hit, text = fn(frame)
                hit = hit.fillna(False).astype(bool).to_numpy()
                text = pd.Series(text).reset_index(drop=True) if not isinstance(text, str) else pd.Series([text] * len(pdf))
                for i in np.flatnonzero(hit):
                    found[i].append({"level": level, "rule_id": rule_id, "description": str(text.iloc[i])})
        out: list[tuple] = []
        for i, (now, req, src, mid) in enumerate(zip(published, requested, pdf["src_ip"].tolist(), pdf["message_id"].tolist())):  # bags
            pub, now = now, now if event else wall
            if event and self.opened is not None and now >= self.opened + self.hold_ms:
                out += self._close_bag(user, self.opened + self.hold_ms)
            for f in found[i]:
                row = (req, src, f["level"], f["rule_id"], f.get("description"), mid, pub)
                if f["level"] == "critical":
                    out.append((req, user, *row[1:], now))
                    continue
                if self.opened is None:
                    self.opened = now
                self.new_held.append(row)
        self._end()
        if out:
            yield pd.DataFrame(out, columns=COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        self._begin()
        out: list[tuple] = []
        if self.opened is not None and self.opened + self.hold_ms <= due:
            out += self._close_bag(key[0], self.opened + self.hold_ms)
        if self.sweep is not None and self.sweep <= due:
            self._run_sweep(due)
        self._end()
        if out:
            yield pd.DataFrame(out, columns=COLUMNS)

    def close(self) -> None:
        pass


def user_findings_stream(events: DataFrame, rules: list | None = None, hold: str = FINDING_HOLD,
                         retention: str = HOST_RETENTION, clock: str = "event", watermark: str = "0 seconds",
                         profiles: DataFrame | None = None, live_rules: Column | None = None) -> DataFrame:
    """Held and critical user findings of a (streaming) event frame; ``emit_ts`` is when each leaves.

    ``live_rules`` is a column of rules given as data (``live_rules.LiveRules.column``), besides ``rules`` (by default none then).
    ``profiles`` (user_id, status) gives rules the column ``profile_status``, 'regular' for users it lacks.
    """
    if rules is None:
        rules = default_user_rules() if live_rules is None else []
    columns = [r for r in rules if not isinstance(r, PandasUserRule)]
    processor = UserEventProcessor([(r.rule_id, r.level, r.fn) for r in rules if isinstance(r, PandasUserRule)],
                                   interval_ms(hold), interval_ms(retention), clock)
    ev = events.filter(F.col("user_id").isNotNull())
    if clock == "event":
        ev = ev.withWatermark("publish_ts", watermark)
    ev = with_profile(ev, profiles)
    if live_rules is not None:
        ev = ev.withColumn("__rules", live_rules)
    data = None if live_rules is None else F.col("__rules")
    for name, flag in (("if_new", True), ("if_known", False)):
        ev = ev.withColumn("newly_accessed_host", F.lit(flag)).withColumn(name, _findings_json(columns, data))
    inp = ev.select("user_id", "src_ip", "dst_ip", "dst_port", "process_name", "bytes_sent", "bytes_received", "profile_status",
                    "message_id", F.unix_millis("publish_ts").alias("publish_ms"), F.unix_millis("request_ts").alias("request_ms"),
                    "if_new", "if_known")
    out = inp.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=OUTPUT, outputMode="Append",
        timeMode="EventTime" if clock == "event" else "ProcessingTime")
    return out.select(F.timestamp_millis("request_ms").alias("request_ts"), "user_id", "source_ip", "level",
                      "rule_id", "description", "message_id", F.timestamp_millis("publish_ms").alias("publish_ts"),
                      F.timestamp_millis("emit_ms").alias("emit_ts"))
