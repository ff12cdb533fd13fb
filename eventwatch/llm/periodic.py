"""Periodic runs of words: maximal repetitions by Lyndon roots, and texts with the repetitions collapsed.

A run is a stretch of at least ``min_words`` words and two periods that no neighbouring word extends at its smallest period.

1. Words become numbers (a dictionary a portion of texts). Every word of a run of 12 or more stands in some six words that
   the text holds twice, one period apart. So only maximal stretches of words inside repeated six-word stretches go on; a run
   lies in one of them, and what would extend it does too.
2. Grouping: phase one of Baier's suffix sorting. Places stand in groups by their first word; groups are taken from
   the highest down, and the last lower place before every member has its Lyndon word extended by the group's, once a
   member that points at it. When a group's turn comes, its word is the longest Lyndon word of its places: the Lyndon array
   comes out of the grouping directly, without a suffix array. Done under the order of the words and under its reverse.
3. Every run has a Lyndon root at some place under one of the two orders. Each Lyndon word is extended to both sides by the
   longest common extensions of its place and the place one period on. These are exact: words of 1, 2, 4, ... places are numbered
   (equal number, equal words), and an extension is put together from the longest ones.

It is a map over documents in portions of bounded words: no shuffle, and any lost task can run again.

Defined cases: null, empty and word-less texts have no run; ties do not matter, as a run has one start and period; repeated
rows give equal results; very long texts are a portion of their own, with some 8 bytes a word and level (as many as the longest
repetition needs). Empty tables give empty results; a column called like ``out`` makes the new one's name end in ``_``.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventwatch.llm.common import free_name, give_back, quoted, text_batches, utf8

MIN_WORDS = 12
PORTION = 1 << 20   # bytes of text handled together
_MIX = np.uint64(0x9E3779B97F4A7C15)


def lyndon_array(s: list[int]) -> list[int]:
    """Length of the longest Lyndon word at every place of ``s`` (numbers), by Baier's grouping."""
    n = len(s)
    names = sorted(set(s))
    number = {x: g for g, x in enumerate(names)}
    group = [number[x] for x in s]                 # of every place
    members: list[list[int]] = [[] for _ in names]
    for i, g in enumerate(group):
        members[g].append(i)
    count = list(map(len, members))                # of the groups' places; those that moved up stay in the old list
    length = [1] * len(names)                      # of the groups' words
    below = list(range(-1, len(names) - 1))        # the next lower group
    above = list(range(1, len(names))) + [-1]
    done, before, out = bytearray(n), [-1] * n, [0] * n
    g = len(names) - 1
    while g >= 0:
        size, hits = length[g], {}
        if count[g]:
            for i in members[g]:
                if group[i] != g:
                    continue
                j = i - 1
                while j >= 0 and done[j]:
                    j = before[j]
                before[i] = j
                done[i] = 1
                out[i] = size
                if j >= 0:
                    hits[j] = hits.get(j, 0) + 1
        moved: dict[tuple[int, int], int] = {}
        for p, t in sorted(hits.items(), key=lambda hit: -hit[1]) if len(hits) > 1 else hits.items():
            old = group[p]                         # the more often extended, the higher
            new = moved.get((old, t))
            if new is None and count[old] == 1:    # alone: its group's word grows
                length[old] += t * size
                continue
            if new is None:
                new = moved[old, t] = len(length)
                up = above[old]
                length.append(length[old] + t * size)
                members.append([])
                count.append(0)
                below.append(old)
                above.append(up)
                above[old] = new
                if up >= 0:
                    below[up] = new
            members[new].append(p)
            count[new] += 1
            count[old] -= 1
            group[p] = new
        g = below[g]
    return out


class Extensions:
    """Longest common extensions of places of a sequence, from the numbers of its words of 1, 2, 4, ... places."""

    def __init__(self, s: np.ndarray):
        self.n = len(s)
        self.level = [np.unique(s, return_inverse=True)[1].astype(np.int64)]
        while True:
            last, step = self.level[-1], 1 << (len(self.level) - 1)
            if len(last) <= step or int(last.max(initial=-1)) + 1 == len(last):  # all differ: longer words do too
                break
            pair = last[:-step] * (int(last.max()) + 1) + last[step:]
            self.level.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))

    def _equal(self, k: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ok = (np.minimum(a, b) >= 0) & (np.maximum(a, b) < len(self.level[k]))
        top = max(len(self.level[k]) - 1, 0)
        return ok & (self.level[k][np.clip(a, 0, top)] == self.level[k][np.clip(b, 0, top)])

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many places are equal from ``a`` and ``b`` on."""
        got = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.level))):  # no extension is longer than all levels together
            got += self._equal(k, a + got, b + got).astype(np.int64) << k
        return got

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many places are equal from ``a`` and ``b`` to the left, both included."""
        got = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.level))):
            width = (1 << k) - 1
            got += self._equal(k, a - got - width, b - got - width).astype(np.int64) << k
        return got


def runs_of(s: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of a sequence of numbers, by start and period."""
    up = s.tolist()
    period = np.r_[lyndon_array(up), lyndon_array([-x for x in up])].astype(np.int64)
    place = np.r_[np.arange(len(s)), np.arange(len(s))]
    ext = Extensions(s)
    on = place + period
    # a root that neither its next nor the place before it continues is no run
    goes = (on < len(s)) & (s[np.minimum(on, len(s) - 1)] == s[place]) | (place > 0) & (s[place - 1] == s[np.minimum(on, len(s)) - 1])
    place, period, on = place[goes], period[goes], on[goes]
    back, ahead = ext.left(place - 1, on - 1), ext.right(place, on)
    ok = (back + ahead >= period) & (back + ahead + period >= min_words)
    found = np.unique(np.stack([place - back, period, back + ahead + period], axis=1)[ok], axis=0)
    return [(a, n, q) for a, q, n in found.tolist()]


def _repeated(seqs: list[np.ndarray], stretch: int) -> list[list[tuple[int, int]]]:
    """For every sequence, the maximal stretches (start, end) of places inside some ``stretch`` numbers that it holds twice
    (equal 64-bit hashes; a chance hit does no harm, as runs are looked for inside)."""
    out: list[list[tuple[int, int]]] = [[] for _ in seqs]
    s = np.concatenate(seqs).astype(np.uint64) if seqs else np.zeros(0, np.uint64)
    m = len(s) - stretch + 1
    if m <= 0:
        return out
    first = np.cumsum([0, *map(len, seqs)])
    doc = np.repeat(np.arange(len(seqs)), np.diff(first))
    h = np.zeros(m, np.uint64)
    for k in range(stretch):
        h = (h + s[k:k + m] + np.uint64(1)) * _MIX
        h ^= h >> np.uint64(29)
    inside = np.flatnonzero(doc[:m] == doc[stretch - 1:])
    h = (h[inside] ^ (doc[inside].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))) * _MIX
    order = np.argsort(h)
    same = np.flatnonzero((h[order[1:]] == h[order[:-1]]) & (doc[inside[order[1:]]] == doc[inside[order[:-1]]]))
    at = np.unique(inside[np.r_[order[same], order[same + 1]]])
    if len(at):
        cut = np.r_[True, (at[1:] > at[:-1] + stretch) | (doc[at[1:]] != doc[at[:-1]])]
        start = at[cut]
        end = np.r_[at[np.flatnonzero(cut)[1:] - 1], at[-1]] + stretch
        for a, b in zip(start.tolist(), end.tolist()):
            d = int(doc[a])
            out[d].append((a - int(first[d]), b - int(first[d])))
    return out


def _portions(texts: list[bytes]) -> Iterator[list[bytes]]:
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= PORTION):
            size += len(texts[end])
            end += 1
        yield texts[at:end]
        at = end


def _dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stand in some run behind its first period."""
    turn = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        turn[start + period] += 1
        turn[start + length] -= 1
    return np.cumsum(turn[:n]) > 0


def analyse(texts: list[bytes], min_words: int = MIN_WORDS) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """Number of words, runs, and the collapsed text, of every text."""
    for some in _portions(texts):
        number: dict[bytes, int] = {}
        split = [t.split() for t in some]  # bytes: white space is 0x09-0x0D and 0x20
        seqs = [np.array([number.setdefault(w, len(number)) for w in ws], np.int64) for ws in split]
        for ws, s, parts in zip(split, seqs, _repeated(seqs, (min_words + 1) // 2)):
            runs = [(a + start, n, q) for a, b in parts for start, n, q in runs_of(s[a:b], min_words)]
            kept = [ws[i] for i in np.flatnonzero(~_dropped(len(ws), runs))] if runs else ws
            yield len(ws), runs, b" ".join(kept)


def with_runs(df: DataFrame, text: str = "text", out: str = "runs", min_words: int = MIN_WORDS) -> DataFrame:
    """``df`` plus a struct: n_words, runs (array of start, length, period, by start and period) and collapsed, the
    words that stand in no run behind its first period, joined by one space."""
    @F.arrow_udf("struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>")
    def find(cols: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in cols:
            n, runs, left = [], [], []
            for a, b, c in analyse(utf8(col), min_words):
                n.append(a)
                runs.append(b)
                left.append(c)
            ends = np.cumsum([0, *map(len, runs)])
            flat = np.array([r for rs in runs for r in rs], np.int64).reshape(-1, 3)
            rows = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows),
                                              pa.array(left, pa.binary()).cast(pa.string())], ["n_words", "runs", "collapsed"])
        give_back()
    return text_batches(df).withColumn(free_name(df, out), find(F.col(quoted(text)).cast("string")))


def longest(runs: Column) -> Column:
    """The longest run (ties: smallest start, then period); null where there is none."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return F.when(best.isNotNull(), F.struct((-best["s"]).alias("start"), best["length"].alias("length"), (-best["p"]).alias("period")))


def digest(runs: Column) -> Column:
    """SHA-256 of the lines ``start,length,period``."""
    line = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return F.sha2(F.array_join(line, "").cast("binary"), 256)


def with_probe(df: DataFrame, id_col: str = "doc_id", text: str = "text", out: str = "probe") -> DataFrame:
    """``df`` plus texts of which some end in a planted repetition: with h = crc32(decimal id) divisible by 10, g = h / 10
    and n > 0 words, each word from a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) / (3 + g % 8).
    Other texts, and those of null ids, stay as they are."""
    t, h = F.col(quoted(text)).cast("string"), F.crc32(F.col(quoted(id_col)).cast("string").cast("binary"))
    words = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    w, g, n, a, p = (free_name(df, x) for x in ("__words", "__g", "__n", "__a", "__p"))
    got = df.withColumn(w, F.when(h % 10 == 0, words)).withColumn(g, F.floor(h / 10)).withColumn(n, F.size(w).cast("bigint"))
    got = got.withColumn(a, F.when(F.col(n) > 0, F.col(g) % F.col(n)))
    got = got.withColumn(p, F.lit(1) + F.floor((F.col(n) - F.col(a)) / (F.lit(3) + F.col(g) % 8)))
    tail = F.transform(F.sequence(F.col(a), F.col(n) - 1), lambda i: F.col(w)[(F.col(a) + (i - F.col(a)) % F.col(p)).cast("int")])
    text_ = F.array_join(F.concat(F.slice(F.col(w), F.lit(1), F.col(a).cast("int")), tail), " ")
    return got.withColumn(free_name(df, out), F.when(F.col(n) > 0, text_).otherwise(t)).drop(w, g, n, a, p)


def brute_force(ws: list, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """Runs by trying every period; for tests."""
    n, out = len(ws), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if ws[i] != ws[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and ws[j] == ws[j + q]:
                j += 1
            if j + q - i >= max(min_words, 2 * q):
                out.setdefault((i, j + q - i), q)   # the smallest period of a stretch comes first
            i = j
    return sorted((a, length, q) for (a, length), q in out.items())
