"""Benchmark decontamination with a generalised suffix automaton over the words of the test items.

The items of one shard (at most ``SHARD_WORDS`` words) become one automaton: its states are the distinct
substrings (of words) of the items up to equal end positions. Tasks build the automata, in a table. The texts stream
through a group of shards at a time (``GROUP_WORDS`` words: the bound of what is broadcast and of what a worker holds, some
60 MB a shard). A larger benchmark takes more passes over the texts; findings are put together, so nothing is cut. The
automaton keeps the longest suffix that occurs in any item; once that length reaches a window, its words are hit.

A window is ``window`` consecutive item words; an item of fewer words, but not none, is one window as a whole.

Defined cases: null texts have no words and no hits; items without words have no windows; items with equal text
all count; equal documents get equal results; repeated rows keep their rows; empty tables give empty results.
Very long texts stream in pieces, the automaton's state carried over; items longer than a shard are cut into pieces that overlap
by a window less a word. A column that has the name of ``out`` stays, the new one takes the next free name (``free_name``).
"""

import hashlib
import pickle
from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventwatch.config import materialize
from eventwatch.llm.common import WORD_BYTES, free_name, give_back, quoted, text_batches, utf8, words

WINDOW = 10
SHARD_WORDS = 100_000
GROUP_WORDS = 400_000
PIECE = 1 << 20
MAX_COVERAGE = 0.5


class Automaton:
    """Suffix automaton of several word sequences, with the windows that end in each state."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for item, ws in items:
            if ws:
                ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws]
                coded.append((item, ids))
                self._add(ids)
        self._mark(coded)

    def _state(self, length: int, link: int, arcs: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(arcs)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of state q for the strings that end here through p."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _add(self, ids: list[int]) -> None:
        last = 0
        for c in ids:
            q = self.next[last].get(c)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
                continue
            cur, p = self._state(self.length[last] + 1, 0, {}), last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = cur
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
            last = cur

    def _mark(self, coded: list[tuple[int, list[int]]]) -> None:
        """Which items have a window that ends in a state, by the window's own length."""
        here: dict[int, dict[int, set[int]]] = {}
        self.shortest = self.window
        for item, ids in coded:
            n = min(self.window, len(ids))
            self.shortest = min(self.shortest, n)
            v = size = 0
            for c in ids:
                v, size = self.next[v][c], size + 1
                while self.length[self.link[v]] >= n:  # forget all but the last n words
                    v = self.link[v]
                size = min(size, n)
                if size == n:
                    here.setdefault(v, {}).setdefault(n, set()).add(item)
        # windows of a state's suffix links end there as well
        self.windows: list[tuple[tuple[int, frozenset[int]], ...]] = [()] * len(self.length)
        for v in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            own = tuple((n, frozenset(i)) for n, i in sorted(here.get(v, {}).items()))
            self.windows[v] = self.windows[self.link[v]] + own

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[int]]:
        """Number of words, hit runs of words (start, end), items that have a window in the text."""
        total, runs, found = 0, [], set()
        v = size = 0
        for ws in pieces(text):
            ids = list(map(self.vocabulary.get, ws))
            for a, b in self._stretches(ids, size > 0):
                if a:
                    v = size = 0
                for i in range(a, b):
                    c = ids[i]
                    arcs = self.next[v]
                    while c not in arcs:
                        if not v:
                            size = -1
                            break
                        v = self.link[v]
                        size = self.length[v]
                        arcs = self.next[v]
                    else:
                        v = arcs[c]
                    size += 1
                    if self.windows[v]:
                        most = 0
                        for n, items in self.windows[v]:
                            if n <= size:
                                most = max(most, n)
                                found |= items
                        if most:
                            end = total + i + 1
                            if runs and runs[-1][1] >= end - most:
                                runs[-1] = (min(runs[-1][0], end - most), end)
                                while len(runs) > 1 and runs[-2][1] >= runs[-1][0]:
                                    start, _ = runs.pop()
                                    runs[-1] = (min(runs[-1][0], start), end)
                            else:
                                runs.append((end - most, end))
            if ids and ids[-1] is None:
                v = size = 0
            total += len(ids)
        return total, runs, found

    def _stretches(self, ids: list, carried: bool) -> list[tuple[int, int]]:
        """Stretches of known words that could hold a window: others cannot, as a window has no unknown word."""
        known = np.fromiter((c is not None for c in ids), bool, len(ids))
        edge = np.flatnonzero(np.diff(np.r_[False, known, False]))
        starts, ends = edge[::2], edge[1::2]
        use = (ends - starts >= self.shortest) | (ends == len(ids))  # the last one may go on in the next piece
        if carried:
            use |= starts == 0
        return list(zip(starts[use].tolist(), ends[use].tolist()))


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in pieces that never cut a word."""
    if len(text) <= PIECE:
        yield words(text)
        return
    plain, at = text.translate(WORD_BYTES), 0
    while at < len(plain):
        end = plain.rfind(b" ", at, at + PIECE) + 1 if at + PIECE < len(plain) else len(plain)
        if end <= at:
            end = plain.find(b" ", at) + 1 or len(plain)
        yield plain[at:end].split()
        at = end


class Shard:
    """A pickled automaton, unpickled by the worker that scans with it."""

    def __init__(self, data: bytes):
        self.data, self._automaton = data, None

    def __getstate__(self):
        return {"data": self.data, "_automaton": None}

    @property
    def value(self) -> Automaton:
        if self._automaton is None:
            self._automaton, self.data = pickle.loads(self.data), b""
        return self._automaton


def _item_pieces(ws: list[bytes], window: int, most: int) -> Iterator[list[bytes]]:
    """An item's words in pieces of at most ``most`` that have all its windows."""
    if len(ws) <= most:
        yield ws
        return
    for at in range(0, len(ws) - window + 1, most - window + 1):
        yield ws[at:at + most]


def _automata(items: DataFrame, id_col: str, text: str, window: int, shard_words: int) -> DataFrame:
    """(shard, n_words, data): pickled automata over the items, at most ``shard_words`` words each, built by tasks. A repeated
    row adds nothing."""
    rows = text_batches(items).select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text)).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length(F.col(quoted(text))))).first()[0] or 0
    most = max(shard_words, 2 * window)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = [], 0

        def out():
            data = pickle.dumps(Automaton(part, window), pickle.HIGHEST_PROTOCOL)
            return pa.RecordBatch.from_arrays([pa.array([held], pa.int64()), pa.array([data], pa.binary())], ["n_words", "data"])

        for batch in batches:
            for item, t in zip(batch.column("id").to_pylist(), utf8(batch.column("text"))):
                for ws in _item_pieces(words(t), window, most):
                    if part and held + len(ws) > most:
                        yield out()
                        part, held = [], 0
                    part.append((item, ws))
                    held += len(ws)
        if held:
            yield out()
        give_back()

    tasks = 1 + size // (8 * most)   # a task makes about one automaton; it starts another where that is full
    return materialize(rows.coalesce(tasks).mapInArrow(build, "n_words bigint, data binary").withColumn("shard", F.monotonically_increasing_id()))


def _groups(items: DataFrame, id_col: str, text: str, window: int, shard_words: int, group_words: int) -> list[Callable[[], list[Shard]]]:
    """Groups of shards, at least one; each is read when it is called for."""
    made = _automata(items, id_col, text, window, shard_words)
    groups: list[list[int]] = []
    held = 0
    for shard, n in made.select("shard", "n_words").orderBy("shard").collect():  # one row a shard
        if not groups or held + n > group_words:
            groups.append([])
            held = 0
        groups[-1].append(shard)
        held += n

    def read(ids: list[int]) -> list[Shard]:
        return [Shard(bytes(r[0])) for r in made.where(F.col("shard").isin(ids)).select("data").collect()]
    if not groups:
        return [lambda: [Shard(pickle.dumps(Automaton([], window)))]]
    return [partial(read, ids) for ids in groups]


_FOUND = "struct<n_words:bigint,runs:array<struct<start:bigint,end:bigint>>,items:array<bigint>>"


def _joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs in order, those that touch as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _scan_all(shards: list[Shard], text: bytes) -> tuple[int, list[tuple[int, int]], list[int]]:
    """Number of words, hit runs and items over all shards."""
    n, runs, items = 0, [], set()
    for shard in shards:
        n, more, found = shard.value.scan(text)
        runs += more
        items |= found
    return n, _joined(runs) if len(shards) > 1 else runs, sorted(i for i in items if i is not None)


def with_hits(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
              out: str = "hits", window: int = WINDOW, shard_words: int = SHARD_WORDS, group_words: int = GROUP_WORDS) -> DataFrame:
    """``docs`` plus a struct: number of words, merged hit runs (in words, end exclusive), sorted distinct items."""
    return _with_hits(docs, _groups(items, item_id, item_text, window, shard_words, group_words), text, free_name(docs, out))


def _with_hits(docs: DataFrame, groups: list[Callable[[], list[Shard]]], text: str, out: str) -> DataFrame:
    """Every group is a pass over the texts; between passes stands a table, so that no worker holds two groups."""
    got = docs
    for k, group in enumerate(groups):
        if k:
            got = materialize(got)
            before = free_name(got, "before")
            got = got.withColumnRenamed(out, before)
            got = got.withColumn(out, _scan(got, group(), True)(F.col(quoted(text)), F.col(quoted(before)))).drop(before)
        else:
            got = got.withColumn(out, _scan(got, group(), False)(F.col(quoted(text))))
    return got


def _scan(docs: DataFrame, group: list[Shard], more: bool):
    """The column function for one group: of the text, and (``more``) of what the groups before found."""
    shards = text_batches(docs).sparkSession.sparkContext.broadcast(group)
    run = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def found(got: list[tuple[int, list, list]]) -> pa.Array:
        runs = [[{"start": a, "end": b} for a, b in r] for _, r, _ in got]
        return pa.StructArray.from_arrays([pa.array([n for n, _, _ in got], pa.int64()), pa.array(runs, run),
                                           pa.array([i for _, _, i in got], pa.list_(pa.int64()))], ["n_words", "runs", "items"])

    def put_together(now, was):
        n, runs, items = now
        return n, _joined([*runs, *((r["start"], r["end"]) for r in was["runs"])]), sorted({*items, *was["items"]})

    @F.arrow_udf(_FOUND)
    def scan(cols: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in cols:
            yield found([_scan_all(shards.value, t) for t in utf8(col)])
        give_back()

    @F.arrow_udf(_FOUND)
    def scan_on(cols: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for col, before in cols:
            yield found([put_together(_scan_all(shards.value, t), was) for t, was in zip(utf8(col), before.to_pylist())])
        give_back()
    return scan_on if more else scan


def n_hit(hits: str = "hits"):
    """Number of hit words."""
    return F.aggregate(F.col(hits)["runs"], F.lit(0).cast("bigint"), lambda s, r: s + r["end"] - r["start"])


def cut(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    """The text without the bytes from the first to the last word of each run; a line break stands in."""
    plain, out, at, word, pos = text.translate(WORD_BYTES), [], 0, 0, 0
    for start, end in runs:
        while word < start:
            pos = _skip(plain, pos)
            word += 1
        while pos < len(plain) and plain[pos] == 32:
            pos += 1
        out.append(text[at:pos])
        while word < end:
            pos = _skip(plain, pos)
            word += 1
        at = pos
    return b"\n".join(x for x in [*out, text[at:]] if x.strip())


def _skip(plain: bytes, pos: int) -> int:
    """The end of the next word."""
    while plain[pos] == 32:
        pos += 1
    end = plain.find(b" ", pos)
    return len(plain) if end < 0 else end


def remove_hits(docs: DataFrame, items: DataFrame, text: str = "text", n_chars: str | None = "n_chars",
                max_coverage: float = MAX_COVERAGE, window: int = WINDOW, shard_words: int = SHARD_WORDS,
                group_words: int = GROUP_WORDS) -> DataFrame:
    """Documents without the passages that occur in the items, in the columns of ``docs``.

    Spans are cut until none is left (a cut may bring two remains together). Documents of which more than
    ``max_coverage`` of the words are hit are dropped whole. ``n_chars`` is counted anew where it is a column.
    """
    groups = _groups(items, "item_id", "text", window, shard_words, group_words)
    if len(groups) > 1:
        return _remove_in_passes(docs, groups, text, n_chars, max_coverage)
    name = free_name(docs, "cleaned")
    shards = text_batches(docs).sparkSession.sparkContext.broadcast(groups[0]())

    @F.arrow_udf("struct<keep:boolean,text:string>")
    def cleaned(cols: Iterator[pa.Array]) -> Iterator[pa.Array]:
        """Whether a document stays, and its new text (null: as it was)."""
        for col in cols:
            keep, new = [], []
            for t in utf8(col):
                n, runs, _ = _scan_all(shards.value, t)
                keep.append(sum(b - a for a, b in runs) <= max_coverage * n)
                dirty = bool(runs) and keep[-1]
                while runs and keep[-1]:
                    t = cut(t, runs)
                    runs = _scan_all(shards.value, t)[1]
                new.append(t.decode() if dirty else None)
            yield pa.StructArray.from_arrays([pa.array(keep, pa.bool_()), pa.array(new, pa.string())], ["keep", "text"])
        give_back()

    # declared nondeterministic so that the filter on it does not compute it a second time
    got = docs.withColumn(name, cleaned.asNondeterministic()(F.col(quoted(text)))).where(F.col(name)["keep"])
    return _renewed(got, docs.columns, F.col(name)["text"], text, n_chars)


def _renewed(got: DataFrame, columns: list[str], clean, text: str, n_chars: str | None) -> DataFrame:
    """``columns`` of ``got`` with the new text where there is one."""
    new = {text: F.coalesce(clean, F.col(quoted(text)))}
    if n_chars and n_chars in columns:
        new[n_chars] = F.when(clean.isNotNull(), F.length(clean).cast(got.schema[n_chars].dataType)).otherwise(F.col(quoted(n_chars)))
    return got.select(*[new[c].alias(c) if c in new else F.col(quoted(c)) for c in columns])


def _remove_in_passes(docs: DataFrame, groups: list, text: str, n_chars: str | None, max_coverage: float) -> DataFrame:
    """``remove_hits`` for a benchmark of several groups: documents that were cut are scanned again, by all groups, until
    none has a hit."""
    hits, name = free_name(docs, "hits"), free_name(docs, "cleaned")

    @F.arrow_udf("string")
    def without(cols: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for col, found in cols:
            yield pa.array([cut(t, [(r["start"], r["end"]) for r in x["runs"]]).decode() for t, x in zip(utf8(col), found.to_pylist())], pa.string())
        give_back()

    found = materialize(_with_hits(docs, groups, text, hits))
    found = found.where(n_hit(hits) <= F.lit(max_coverage) * F.col(hits)["n_words"])
    done = []
    while True:
        done.append(found.where(F.size(F.col(hits)["runs"]) == 0).select(*map(quoted, docs.columns)))
        dirty = found.where(F.size(F.col(hits)["runs"]) > 0)
        if dirty.isEmpty():
            return reduce(DataFrame.unionByName, done)
        cleaned = dirty.withColumn(name, without(F.col(quoted(text)), F.col(hits)))
        found = materialize(_with_hits(materialize(_renewed(cleaned, docs.columns, F.col(name), text, n_chars)), groups, text, hits))


def digest(items: str):
    """sha256 of the item ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.array_sort(F.transform(F.col(items), lambda i: i.cast("string"))), ",").cast("binary"), 256)


def brute_force(text: str | None, items: list[tuple[int, str | None]], window: int = WINDOW) -> tuple[int, int, list[int]]:
    """The same by comparing every window with every place; for tests."""
    ws, hit, found = words((text or "").encode()), set(), set()
    for item, t in items:
        it = words((t or "").encode())
        n = min(window, len(it))
        for j in range(len(it) - n + 1) if n else ():
            for i in range(len(ws) - n + 1):
                if ws[i:i + n] == it[j:j + n]:
                    hit.update(range(i, i + n))
                    found.add(item)
    return len(ws), len(hit), sorted(found)


def items_sha256(items: list[int]) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


_SQL_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

#: The result of query op6 in DuckDB.
ORACLE = f"""
WITH i AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[j:j + least(len(w), {WINDOW}) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS j FROM i WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS} AS w FROM documents),
g AS (SELECT r, n, j, array_to_string(w[j:j + n - 1], ' ') AS g
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS j FROM d JOIN (SELECT DISTINCT n FROM win) ON len(w) >= n)),
hit AS (SELECT r, j, n, item_id FROM g JOIN win USING (n, g)),
places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(j, j + n)) AS p FROM (SELECT DISTINCT r, j, n FROM hit)) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
          FROM (SELECT DISTINCT r, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r)
"""
