"""Exact late panes for source-address sessions (``late_panes=True``), with ``transformWithStateInPandas``.

Sessions per source address merge when their windows [t, t + gap) overlap.  A session fires once when
the watermark passes its end (on-time pane) and then again for every late element that arrives within
the allowed lateness, with only the new elements (discarding panes); after end + lateness it is dropped.
Spark's watermark is set ``lateness`` behind the newest publish time, so the processor works with
``W = watermark + lateness`` (the newest time seen), which is what the windows are compared against.
Due firings run before each batch's rows, so a late row never joins a pane that should have fired.

Any session rules whose aggregates are ``Partial`` work here. What an event gives to each rule is computed by Spark, as
JSON, before the processor; the state holds every rule's aggregates of the elements not fired yet per session, which are
merged when sessions merge; a pane carries them out, and Spark evaluates the rules' predicates on them. State is one
map entry per open session, and only entries that change are written.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventwatch.config import ALLOWED_LATENESS, SESSION_GAP
from eventwatch.operators.rules import BANNED_SEPARATOR, Partial, SessionRule, banned_process_rule, check_names, session_finding_array
from eventwatch.operators.sessions import interval_ms

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PANES = "source_ip STRING, session_start_ms LONG, session_end_ms LONG, pane STRING, n_elements LONG, parts STRING"
_PANE_COLUMNS = ["source_ip", "session_start_ms", "session_end_ms", "pane", "n_elements", "parts"]
_PLAIN = (T.StringType, T.IntegralType, T.FloatType, T.DoubleType)


def _in_order(fields: list[str] | None):
    """Sort key of ``rows`` values: nulls first, structs field by field."""
    one = lambda v: (v is not None, v)
    return one if fields is None else lambda v: tuple((f in v, v.get(f)) for f in fields)


def merge_parts(kinds: dict[str, tuple[str, list[str] | None]], a: dict, b: dict) -> dict:
    """Aggregates of two sets of events as those of both (names without a value are left out)."""
    out = dict(a)
    for name, v in b.items():
        if name not in out:
            out[name] = v
            continue
        kind = kinds[name][0]
        out[name] = out[name] + v if kind in ("count", "sum", "rows") else min(out[name], v) if kind == "min" else max(out[name], v)
    return out


class SessionPaneProcessor(StatefulProcessor):
    """Per source address: sessions start -> (end, fired, elements not fired yet, their aggregates as JSON)."""

    def __init__(self, gap_ms: int, lateness_ms: int, kinds: dict[str, tuple[str, list[str] | None]]):
        self.gap, self.late, self.kinds = gap_ms, lateness_ms, kinds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sessions = handle.getMapState("sessions", "start LONG", "end LONG, fired BOOLEAN, n LONG, parts STRING")

    def _merged(self, sessions: list[tuple]) -> list[tuple]:
        """Overlapping sessions become one; a single sweep in order of start."""
        out: list[list] = []
        for start, end, fired, n, parts in sorted(sessions, key=lambda s: s[:2]):
            if out and start < out[-1][1]:
                out[-1][1:] = [max(out[-1][1], end), out[-1][2] or fired, out[-1][3] + n, merge_parts(self.kinds, out[-1][4], parts)]
            else:
                out.append([start, end, fired, n, parts])
        return [tuple(s) for s in out]

    def _fire(self, key: str, sessions: list[tuple], now: int) -> tuple[list[tuple], list[tuple]]:
        """Panes of sessions whose end the newest time has passed, and what stays; sessions are in order."""
        out, keep = [], []
        for start, end, fired, n, parts in sessions:
            if now >= end and n:
                for name, (kind, fields) in self.kinds.items():
                    if kind == "rows" and name in parts:
                        parts[name] = sorted(parts[name], key=_in_order(fields))
                out.append((key, start, end, "late" if fired else "on_time", n, json.dumps(parts)))
                fired, n, parts = True, 0, {}
            if now < end + self.late:             # still within the allowed lateness: keep the window
                keep.append((start, end, fired, n, parts))
                if not fired:
                    self.handle.registerTimer(end - self.late)
                self.handle.registerTimer(end)    # garbage collection at end + lateness
        return out, keep

    def _loaded(self) -> list[tuple]:
        self.before = {start: tuple(v) for (start,), v in self.sessions.iterator()}
        return [(start, end, fired, n, json.loads(parts)) for start, (end, fired, n, parts) in sorted(self.before.items())]

    def _store(self, sessions: list[tuple]) -> None:
        now = {start: (end, fired, n, json.dumps(parts)) for start, end, fired, n, parts in sessions}
        for start in self.before.keys() - now.keys():
            self.sessions.removeKey((start,))
        for start, v in now.items():
            if self.before.get(start) != v:
                self.sessions.updateValue((start,), v)

    def _elements(self, pdf: pd.DataFrame) -> list[tuple]:
        """One session a publish time, with the aggregates of its elements."""
        found: dict[int, dict] = {}
        some = pdf[pdf["given"].notna()]
        for t, given in zip(some["t"].tolist(), some["given"].tolist()):
            one = {k: [v] if self.kinds[k][0] == "rows" else v for k, v in json.loads(given).items()}
            found[t] = merge_parts(self.kinds, found[t], one) if t in found else one
        return [(int(t), int(t) + self.gap, False, int(c), found.get(t, {})) for t, c in pdf["t"].value_counts().items()]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() + self.late
        out, sessions = self._fire(key[0], self._loaded(), now)
        for pdf in rows:
            pdf = pdf[pdf["t"] + self.gap + self.late > now]   # else the window is past the allowed lateness
            sessions = self._merged(sessions + self._elements(pdf))
        more, sessions = self._fire(key[0], sessions, now)
        self._store(sessions)
        if out + more:
            yield pd.DataFrame(out + more, columns=_PANE_COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out, sessions = self._fire(key[0], self._loaded(), timerValues.getCurrentWatermarkInMs() + self.late)
        self._store(sessions)
        if out:
            yield pd.DataFrame(out, columns=_PANE_COLUMNS)

    def close(self) -> None:
        pass


def _aggregates(events: DataFrame, rules: list[SessionRule]) -> tuple[dict[str, tuple[str, list[str] | None]], T.StructType, Column]:
    """Kinds of all aggregates, their types in a pane, and what an event gives to them as JSON (null: nothing)."""
    kinds, given, schema = {}, [], T.StructType()
    for r in rules:
        for name, a in r.aggregates.items():
            if not isinstance(a, Partial):
                raise ValueError(f"session rule {r.rule_id}: {name} must be a Partial for late panes")
            v = a.per_row() if a.kind != "count" else F.when(a.per_row().isNotNull(), F.lit(1).cast("bigint"))
            v = v if r.rows is None else F.when(r.wanted(), v)
            kind = events.select(v.alias("v")).schema["v"].dataType
            inner = [f.dataType for f in kind.fields] if isinstance(kind, T.StructType) and a.kind == "rows" else [kind]
            if not all(isinstance(t, _PLAIN) for t in inner):
                raise ValueError(f"session rule {r.rule_id}: {name} has values of a type that panes cannot hold ({kind.simpleString()})")
            wide = T.LongType() if a.kind == "sum" and isinstance(kind, T.IntegralType) else T.DoubleType() if a.kind == "sum" else kind
            schema.add(name, T.ArrayType(kind) if a.kind == "rows" else wide)
            kinds[name] = a.kind, kind.names if isinstance(kind, T.StructType) else None
            given.append(v.alias(name))
    if not given:
        return kinds, schema, F.lit(None).cast("string")
    text = F.to_json(F.struct(*given))
    return kinds, schema, F.when(text != "{}", text)


def session_panes_stream(events: DataFrame, banned: list[str] | tuple[str, ...] = (), gap: str = SESSION_GAP,
                         lateness: str = ALLOWED_LATENESS, rules: list[SessionRule] | None = None) -> DataFrame:
    """Panes (on_time / late) per source-address session with the rules' aggregates over the pane's elements.

    Without ``rules``, those of the banned-process rule, and ``banned``, the pane's banned processes.
    """
    own = rules is None
    rules = [banned_process_rule(banned)] if own else rules
    check_names(rules)
    kinds, schema, given = _aggregates(events, rules)
    proc = SessionPaneProcessor(interval_ms(gap), interval_ms(lateness), kinds)
    inp = (events.withWatermark("publish_ts", lateness)
           .select("src_ip", "publish_ts", F.unix_millis("publish_ts").alias("t"), given.alias("given")))
    panes = inp.groupBy("src_ip").transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=PANES, outputMode="Append", timeMode="EventTime")
    parts = F.from_json("parts", schema)
    filled = [a.filled(parts[n]).alias(n) for r in rules for n, a in r.aggregates.items()]
    out = panes.select(*_PANE_COLUMNS[:-1], *filled)
    if own:
        names = F.transform("banned_hits", lambda x: x["process_name"])
        out = out.withColumn("banned", F.when(F.size("banned_hits") > 0, F.array_join(names, BANNED_SEPARATOR)))
    return out


def pane_findings(panes: DataFrame, rules: list[SessionRule] | None = None) -> DataFrame:
    """Source-address findings of the panes, at the window's last instant: of every pane that a rule's predicate holds for."""
    rules = [banned_process_rule([])] if rules is None else rules
    return (panes.select(F.timestamp_millis(F.col("session_end_ms") - 1).alias("request_ts"), "source_ip",
                         F.explode(session_finding_array(rules)).alias("f"), "pane")
            .select("request_ts", "source_ip", "f.level", "f.rule_id", "f.description", "pane"))
