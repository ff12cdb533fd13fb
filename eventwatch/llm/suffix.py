"""Exact substring dedup: every byte goes that is covered by a ``WINDOW``-byte string that also starts earlier.

A suffix array of the whole table cannot be cut into independent shards by place, as copies are anywhere, and merging
every shard with every other is quadratic. So strings are dealt to shards by content:

1. Anchors. Every window is assigned to the smallest (by a rolling hash) of its ``GRAM``-byte strings, which depends on
   the window's bytes only: equal windows have equal anchors. Neighbouring windows with the same anchor
   form a section of at most 69 windows; on average there are 35 bytes a section. One row a section: anchor, hash of
   the section's bytes, document, place.
2. Of equal sections in one batch of documents all but the first are copies; they are dealt out evenly, so a passage
   in a third of all documents is one row a batch. One shuffle by anchor, sorted, finds the other copies as they
   stream by. Sections whose anchor no other text shares are unique. What is left, sections that share an anchor but differ somewhere, is where copies begin
   and end.
3. Those sections' bytes go to shards by anchor. Every shard builds a suffix array by Larsson-Sadakane refinement
   (8, 16, 32, 64 bytes, then 64 + 36; only groups that are not single yet are sorted again) in numpy. Neighbours in it
   share a prefix of ``WINDOW`` bytes where the ranks of their first and last 64 bytes agree; the smallest place of
   such a group stays. (The ranks give what Kasai's loop over all bytes would, without a step a byte in Python.)
4. An anchor with more sections than a shard holds is spread over several shards; their sorted lists of distinct
   windows, as hashes, are merged by a sorted aggregation over Spark's partitions rather than by searches in every
   other shard, so such an anchor never meets in one task's memory.
5. The copies' spans go back to their documents.

Sections and windows are compared by 64-bit hashes together with the 64-bit hash of their anchor.

Defined cases: null and empty texts have no bytes; texts under ``WINDOW`` bytes are never cut; a string that overlaps itself
(a run of one byte) is cut from its second place on; rows that share an id (or a null one) but not a text are documents of
their own, in order of a hash of their texts; equal rows are one document (neither is earlier); null ids come first; an
empty table gives an empty result.
"""

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventwatch.config import materialize
from eventwatch.llm.common import free_name, give_back, quoted, text_batches, text_of, utf8
from eventwatch.llm.merkle import placed

WINDOW = 100
GRAM = 32
SHARD_BYTES = 2 << 20
_CHUNK = 1 << 16                       # gram places of one pass: they fit 16 bits
_WIDTH = WINDOW - GRAM + 1             # grams of a window
_BASE = 0x9E3779B97F4A7C15
_NULL_ID = -(1 << 63)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of bytes, powers of the base, and of its inverse modulo 2^64."""
    value = _mix((np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)) ^ np.uint64(0x94D049BB133111EB))
    n = SHARD_BYTES + _CHUNK + 1024
    up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return value, np.cumprod(up), np.cumprod(down)


def _prefix(b: np.ndarray) -> np.ndarray:
    value, up, _ = _powers()
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(value[b] * up[:len(b)], dtype=np.uint64)])


def sections(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Sections of all texts: anchor, hash, number of the text, place of the first window, number of windows."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    stop = np.cumsum(size)
    start = stop - size
    buf = np.frombuffer(b"".join(texts), np.uint8)
    _, _, down = _powers()
    per = _CHUNK - _WIDTH + 1
    for c in range(0, len(buf) - WINDOW + 1, per):
        seg = buf[c:c + per + WINDOW - 1]
        m, ng = len(seg) - WINDOW + 1, len(seg) - GRAM + 1
        s = _prefix(seg)
        h = _mix((s[GRAM:GRAM + ng] - s[:ng]) * down[:ng])
        v = (h & ~np.uint64(0xFFFF)) | np.arange(ng, dtype=np.uint64)
        step = 1
        while step * 2 <= _WIDTH:  # least value of 2, 4, ... 64 grams
            v = np.minimum(v[:-step], v[step:])
            step *= 2
        if _WIDTH > step:
            v = np.minimum(v[:step - _WIDTH], v[_WIDTH - step:])
        least = (v & np.uint64(0xFFFF)).astype(np.int64)
        valid = np.ones(m, bool)
        for e in stop[np.searchsorted(stop, c):np.searchsorted(stop, c + m + WINDOW)].tolist():
            valid[max(0, e - WINDOW + 1 - c):max(0, e - c)] = False
        first = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])])
        last = np.r_[first[1:], m]
        ok = valid[first]
        first, last = first[ok], last[ok]
        doc = np.searchsorted(start, c + first, "right") - 1
        yield h[least[first]], _mix((s[last + WINDOW - 1] - s[first]) * down[first]), doc, c + first - start[doc], last - first


def _section_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
        texts = utf8(batch.column("text"))
        at = 0
        while at < len(texts):  # bounded portions of a batch
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= 8 << 20):
                size += len(texts[end])
                end += 1
            got = list(sections(texts[at:end]))
            if got:
                key, h, doc, x, n = map(np.concatenate, zip(*got))
                i = ids[at + doc]
                if (i[1:] < i[:-1]).any():
                    order = np.lexsort((x, i))
                    key, h, i, x, n = key[order], h[order], i[order], x[order], n[order]
                _, first, group = np.unique(key ^ _mix(h), return_index=True, return_inverse=True)
                first = first[group]
                copy = (i != i[first]) | (x != x[first])
                use = copy | (np.arange(len(x)) == first)  # of equal places of equal rows one is enough
                key = np.where(copy, _mix(np.arange(len(x), dtype=np.uint64) ^ h), key)
                yield pa.RecordBatch.from_arrays([pa.array(c[use]) for c in (key.view(np.int64), h.view(np.int64), i, x, n.astype(np.int16), copy)],
                                                 ["key", "h", "id", "x", "n", "copy"])
            at = end
    give_back()


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sections sorted by anchor, hash, id, place -> copies (those known before pass through), and the first of equal ones where the anchor has others.
    Rows pass through; only the first row of the group at hand is held."""
    held = None  # key, h, id, x, n, whether its anchor had another section before

    def out(key, i, x, n, edge):
        return pa.RecordBatch.from_arrays([pa.array(np.where(edge, key, 0)), pa.array(i), pa.array(x), pa.array(n), pa.array(edge)],
                                          ["key", "id", "x", "n", "edge"])

    def edge_row(row):
        return out(*(np.array([v]) for v in (row[0], row[2], row[3], np.int16(row[4]))), np.array([True]))

    for batch in batches:
        if not batch.num_rows:
            continue
        key, h, i, x, n, known = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "h", "id", "x", "n", "copy"))
        if known.any():
            yield out(key[known], i[known], x[known], n[known], np.zeros(int(known.sum()), bool))
            key, h, i, x, n = (c[~known] for c in (key, h, i, x, n))
            if not len(key):
                continue
        new = np.r_[held is None or (key[0], h[0]) != held[:2], (key[1:] != key[:-1]) | (h[1:] != h[:-1])]
        start = np.flatnonzero(new)
        group = np.cumsum(new) - 1  # -1: goes on from the batch before
        fi, fx = (np.r_[v[start], held[j] if held else 0][group] for v, j in ((i, 2), (x, 3)))
        copy = ~new & ((i != fi) | (x != fx))
        if copy.any():
            yield out(key[copy], i[copy], x[copy], n[copy], np.zeros(int(copy.sum()), bool))
        if not len(start):
            continue
        k = key[start]
        shares = np.r_[held is not None and k[0] == held[0], k[1:] == k[:-1]]  # with the group before
        if held is not None and (held[5] or shares[0]):
            yield edge_row(held)
        edge = (shares | np.r_[shares[1:], False])[:-1]
        f = start[:-1][edge]
        if len(f):
            yield out(key[f], i[f], x[f], n[f], np.ones(len(f), bool))
        j = start[-1]
        held = (key[j], h[j], i[j], x[j], n[j], bool(shares[-1]))
    if held is not None and held[5]:
        yield edge_row(held)


def suffix_ranks(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of all places by their first 64 and (where they have so many) ``WINDOW`` bytes, by Larsson-Sadakane refinement."""
    n = len(buf)
    pad = np.concatenate([buf, np.zeros(8, np.uint8)])
    k = np.zeros(n, np.uint64)
    for j in range(8):
        k = (k << np.uint64(8)) | pad[j:j + n]
    sa = np.argsort(k, kind="stable")
    head = np.r_[True, k[sa[1:]] != k[sa[:-1]]]
    rank = np.empty(n + WINDOW, np.int64)
    rank[n:] = -1

    def number(sa, head):
        first = np.flatnonzero(head)
        rank[sa] = np.repeat(first, np.diff(np.r_[first, n]))

    number(sa, head)
    half = None
    for step in (8, 16, 32, WINDOW - 64):
        if step == WINDOW - 64:
            half = rank[:n].copy()
        single = head & np.r_[head[1:], True]
        act = np.flatnonzero(~single)  # groups of several, side by side
        if len(act):
            at = sa[act]
            one, two = rank[at], rank[at + step]
            order = np.lexsort((two, one))
            sa[act], two, one = at[order], two[order], one[order]
            head[act[1:]] |= (one[1:] != one[:-1]) | (two[1:] != two[:-1])
            number(sa, head)
    return half, rank[:n].copy()


def _shard(rows: list[tuple], shared: set[int]) -> Iterator[tuple]:
    """Rows (key, id, x, bytes) of one shard -> (key, hash, id, start, end): spans of copies (hash null), and the places
    of distinct windows of anchors in ``shared``, whose other sections are in other shards (end null)."""
    buf = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
    size = np.array([len(r[3]) for r in rows])
    count = size - WINDOW + 1
    base = np.cumsum(size) - size
    row = np.repeat(np.arange(len(rows)), count)
    off = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    ids, xs = np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
    _, rank = suffix_ranks(buf)
    r, i, x = rank[base[row] + off], ids[row], xs[row] + off
    order = np.lexsort((x, i, r))
    ro, io, xo = r[order], i[order], x[order]
    new = np.r_[True, ro[1:] != ro[:-1]]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    copy = np.zeros(len(row), bool)
    copy[order] = (io != io[first]) | (xo != xo[first])
    edge = np.flatnonzero(np.diff(np.r_[False, copy, False]) != 0)
    cuts = np.union1d(edge, np.flatnonzero(np.r_[False, (row[1:] != row[:-1])]))
    for a, b in zip(cuts, np.r_[cuts[1:], len(row)]):
        if a < len(row) and copy[a]:
            yield None, None, int(i[a]), int(x[a]), int(x[b - 1]) + WINDOW
    if shared:
        keys = np.array([k[0] for k in rows], np.int64)
        pick = order[new]
        pick = pick[np.isin(keys[row[pick]], np.fromiter(shared, np.int64))]
        s, (_, _, down) = _prefix(buf), _powers()
        p = base[row[pick]] + off[pick]
        h = _mix((s[p + WINDOW] - s[p]) * down[p]).view(np.int64)
        yield from zip(keys[row[pick]].tolist(), h.tolist(), i[pick].tolist(), x[pick].tolist(), [None] * len(pick))


def _shards(shard_bytes: int):
    """Rows (key, id, x, u) in order of key -> what ``_shard`` gives, shard by shard."""
    def out(rows, shared):
        got = list(_shard(rows, shared))
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in (zip(*got) if got else [[]] * 5)], ["key", "h", "id", "start", "end"])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, shared = [], 0, set()
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "x", "u"))):
                if size >= shard_bytes:
                    more = rows[-1][0] == r[0]  # this anchor goes on in the next shard
                    yield out(rows, shared | ({r[0]} if more else set()))
                    rows, size, shared = [], 0, {r[0]} if more else set()
                rows.append(r)
                size += len(r[3])
        if rows:
            yield out(rows, shared)
        give_back()
    return shards


def copied_spans(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(id, text) -> (id, start, end): byte spans that are copies of earlier ones. They may overlap."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = text_batches(docs).mapInArrow(_section_rows, "key bigint, h bigint, id bigint, x bigint, n smallint, copy boolean")
    found = materialize(rows.repartition(n, "key").sortWithinPartitions("key", "h", "id", "x")
                        .mapInArrow(_copies, "key bigint, id bigint, x bigint, n smallint, edge boolean"))
    whole = found.where(~F.col("edge")).select("id", F.col("x").alias("start"), (F.col("x") + F.col("n") + (WINDOW - 1)).alias("end"))
    edges = found.where("edge").groupBy("id").agg(F.collect_list(F.struct("key", "x", "n")).alias("parts"))
    bits = (docs.where(F.col("text") != "").join(edges, "id").select("id", F.col("text").cast("binary").alias("b"), F.explode("parts").alias("p"))
            .select("p.key", "id", "p.x", F.substring("b", (F.col("p.x") + 1).cast("int"), F.col("p.n") + F.lit(WINDOW - 1)).alias("u")))
    merged = materialize(bits.repartition(n, "key").sortWithinPartitions("key")
                         .mapInArrow(_shards(shard_bytes), "key bigint, h bigint, id bigint, start bigint, end bigint"))
    part = merged.where("end is not null").select("id", "start", "end")
    open_ = merged.where("end is null").select("key", "h", F.struct("id", "start").alias("at"))
    least = open_.groupBy("key", "h").agg(F.min("at").alias("least"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    late = open_.join(least, ["key", "h"]).where("at > least").select("at.id", "at.start", (F.col("at.start") + WINDOW).alias("end"))
    return whole.union(part).union(late)


def _keyed(docs: DataFrame, id_col: str, text: str, key: str) -> DataFrame:
    """``docs`` plus a number that tells documents apart and keeps their order: the id, or, where ids repeat or more than one is
    null, the rank of (id, hash of the text). Only then are narrow rows of all documents numbered, and joined back."""
    ids = docs.select(F.col(quoted(id_col)).cast("bigint").alias("id"))
    if ids.groupBy("id").count().where("count > 1").isEmpty():
        return docs.withColumn(key, F.coalesce(F.col(quoted(id_col)).cast("bigint"), F.lit(_NULL_ID)))
    # the hash of the text tells rows of one id apart; equal rows are one document
    mark = lambda: F.xxhash64(text_of(text), F.length(text_of(text)))
    rows, blocks = placed(docs.select(F.col(quoted(id_col)).cast("bigint").alias("id"), mark().alias("h")).distinct(), [], ["id", "h"])
    ranks = (rows.withColumn("part", F.shiftright("seq", 33)).join(blocks.select("part", "first", "before"), "part")
             .select(F.col("id").alias("i"), "h", (F.col("before") + F.col("seq") - F.col("first")).alias("r")))
    i, h, r = (free_name(docs, f"repeat_{c}") for c in "ihr")
    ranks = materialize(ranks).toDF(i, h, r)
    same = F.col(quoted(id_col)).cast("bigint").eqNullSafe(ranks[i]) & (mark() == ranks[h])
    return docs.join(ranks, same).withColumn(key, F.col(r)).drop(i, h, r)


def with_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", out: str = "repeats", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` plus the byte spans (start, end) of its repeats: array of struct, null where there is none. Spans may overlap."""
    key = free_name(docs, "repeat_id")
    docs = _keyed(docs, id_col, text, key)
    spans = copied_spans(docs.select(F.col(key).alias("id"), text_of(text).alias("text")), shard_bytes)
    lists = spans.groupBy(F.col("id").alias(key)).agg(F.collect_list(F.struct("start", "end")).alias(out))
    return docs.join(lists, key, "left").drop(key)


def merge_spans(spans: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return [(a, min(b, size)) for a, b in out if a < size]


def keep_rest(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at:a])
        at = b
    return b"".join([*parts, text[at:]])


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", out: str = "rest", kept: bool = True,
                    shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` plus a struct: n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the bytes that stay (they
    may cut a character in two)."""
    name = free_name(docs, "repeats")
    kinds = "n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string" + ",kept:binary" * kept

    @F.arrow_udf(f"struct<{kinds}>")
    def rest(texts: pa.Array, spans: pa.Array) -> pa.Array:
        a, b, c, d, e = [], [], [], [], []
        at = spans.offsets.to_numpy()
        flat = spans.values
        start, end = flat.field("start").to_numpy(zero_copy_only=False), flat.field("end").to_numpy(zero_copy_only=False)
        for j, t in enumerate(utf8(texts)):
            runs = merge_spans(list(zip(start[at[j]:at[j + 1]].tolist(), end[at[j]:at[j + 1]].tolist())), len(t))
            left = keep_rest(t, runs)
            a.append(len(t))
            b.append(len(t) - len(left))
            c.append(len(runs))
            d.append(sha256(left).hexdigest())
            e.append(left)
        columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64()), pa.array(d, pa.string()), pa.array(e, pa.binary())]
        return pa.StructArray.from_arrays(columns[:4 + kept], ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][:4 + kept])

    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return with_repeats(text_batches(docs), id_col, text, name, shard_bytes).withColumn(out, rest(text_of(text), F.coalesce(F.col(name), none))).drop(name)


def brute_force(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, int, str]]:
    """The same by a table of all windows; for tests with unique ids."""
    seen, out = set(), {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        b = (t or "").encode()
        spans = []
        for x in range(len(b) - WINDOW + 1):
            w = b[x:x + WINDOW]
            if w in seen:
                spans.append((x, x + WINDOW))
            seen.add(w)
        runs = merge_spans(spans, len(b))
        left = keep_rest(b, runs)
        out[i] = (len(b), len(b) - len(left), len(runs), sha256(left).hexdigest())
    return out
