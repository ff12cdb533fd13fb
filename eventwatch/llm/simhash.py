"""SimHash near-duplicates by pivot distance tables.

Fingerprints of 64 bits link when at most ``max_bits`` bits differ; components are the transitive closure.

1. Every text becomes a fingerprint (Arrow UDF, whole texts). Rows with equal fingerprints collapse to one
   node by a partial aggregate, so copies never meet pair by pair.
2. Candidates: the 64 bits are cut into ``max_bits + 3`` blocks. Two fingerprints within ``max_bits`` bits
   agree on at least 3 whole blocks, so they meet under at least one key (three block numbers, their bits):
   an exact cover with about 32 equal bits a key. Nothing is sampled or capped.
3. Inside one key, a pivot table holds the Hamming distances to 16 reference fingerprints. By the triangle
   inequality |d(x,p) - d(y,p)| <= d(x,y), so pairs whose largest coordinate difference exceeds
   ``max_bits`` are discarded; survivors are verified on the fingerprints. A search from node to node that
   never revisits a linked node emits a spanning forest, at most one link a node and key, instead of all
   pairs of a group. Rows of one key agree on 32 bits and are distinct, so a dense group of near copies is
   bounded by the number of fingerprints in a small Hamming ball, whatever the number of documents.
4. Components by rounds of large-star / small-star over the links, each round a table in the checkpoint folder.

Defined cases: null or word-less texts have fingerprint zero and link like any other; fewer than
``shingle`` words make one shingle; a majority must be strict; repeated rows and null ids keep their rows;
a component's id is the smallest non-null id in it (null if all are null). Empty tables give empty results.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventwatch.config import materialize
from eventwatch.llm.common import free_name, give_back, narrow_batches, quoted, text_batches, utf8

SHINGLE = 3
MAX_BITS = 3
SEED = 42
PIVOTS = 16

#: Reference fingerprints: fixed odd multiples of the 64-bit golden ratio.
_REFERENCE = (np.arange(1, PIVOTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of one UTF-8 text, as an unsigned 64-bit number."""
    ws = text.lower().split()  # bytes: A-Z only, and white space 0x09-0x0D and 0x20
    if not ws:
        return 0
    h = xxhash.xxh64_intdigest
    if len(ws) <= shingle:
        return h(b" ".join(ws), SEED)
    line = b" ".join(ws)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1)
    starts = [0, *ends[:-1].tolist()]
    stops = (ends[shingle - 1:] - 1).tolist()
    hashes = np.fromiter((h(line[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, len(stops))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):  # bounded working set for very long texts
        bits = np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << int(b) for b in np.flatnonzero(2 * ones > len(hashes)))


def with_fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """``df`` plus its SimHash as a bigint (the 64 bits, signed)."""
    @F.arrow_udf("bigint")
    def simhash(cols: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in cols:
            got = np.fromiter((fingerprint(t, shingle) for t in utf8(col)), np.uint64, len(col))
            yield pa.array(got.view(np.int64))
        give_back()
    # declared nondeterministic so that a filter on it does not compute it a second time
    return text_batches(df).withColumn(out, simhash.asNondeterministic()(F.col(quoted(text))))


def _blocks(max_bits: int) -> list[int]:
    """Masks of the unions of 3 out of ``max_bits + 3`` blocks of the 64 bits."""
    n = max_bits + 3
    cuts = [64 * i // n for i in range(n + 1)]
    one = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(n)]
    return [a | b | c for a, b, c in combinations(one, 3)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(fps: np.ndarray, max_bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links that span the same components as all links among the distinct fingerprints of one key."""
    table = np.bitwise_count(fps[:, None] ^ _REFERENCE[None, :]).astype(np.int16)
    order = np.lexsort((fps, table[:, 0]))
    fps, table = fps[order], table[order]
    left, right = [], []
    todo = np.arange(len(fps))
    while len(todo) > 1:
        front, todo = todo[:1], todo[1:]
        while len(front) and len(todo):
            grown = []
            for i in front:
                first = table[todo, 0]
                lo, hi = np.searchsorted(first, [table[i, 0] - max_bits, table[i, 0] + max_bits + 1])
                near = todo[lo:hi]
                for p in range(1, PIVOTS):  # coordinate by coordinate: most are gone after a few
                    if not len(near):
                        break
                    near = near[np.abs(table[near, p] - table[i, p]) <= max_bits]
                near = near[np.bitwise_count(fps[near] ^ fps[i]) <= max_bits]
                if len(near):
                    left.append(np.full(len(near), fps[i]))
                    right.append(fps[near])
                    todo = np.setdiff1d(todo, near, assume_unique=True)
                    grown.append(near)
                    if not len(todo):
                        break
            front = np.concatenate(grown) if grown else todo[:0]
    return left, right


def _linked(max_bits: int):
    """Batches of (table, key, fp), sorted by them -> links. A key's rows may cross batches."""
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = []

        def work(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            t, k, f = rows
            new = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (k[1:] != k[:-1]), True])
            size = np.diff(new)
            left, right = [], []
            two = new[:-1][size == 2]
            a, b = f[two].view(np.uint64), f[two + 1].view(np.uint64)
            far = np.abs(np.bitwise_count(a[:, None] ^ _REFERENCE).astype(np.int16)
                         - np.bitwise_count(b[:, None] ^ _REFERENCE)).max(axis=1, initial=0) > max_bits
            a, b = a[~far], b[~far]
            ok = np.bitwise_count(a ^ b) <= max_bits
            left.append(a[ok])
            right.append(b[ok])
            for s, n in zip(new[:-1][size > 2], size[size > 2]):
                x, y = _forest(np.unique(f[s:s + n].view(np.uint64)), max_bits)
                left += x
                right += y
            return np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64)

        def out(pair):
            return pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)])
            last = (rows[0] != rows[0, -1]) | (rows[1] != rows[1, -1])
            cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
            if cut:
                yield out(work(np.concatenate([*rest, rows[:, :cut]], axis=1)))
                rest = []
            rest.append(rows[:, cut:])
        if rest:
            yield out(work(np.concatenate(rest, axis=1)))
        give_back()
    return links


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct fingerprints (column fp) -> links (a, b) that span every component."""
    masks = F.array(*[F.lit(_signed(m)) for m in _blocks(max_bits)])
    keyed = (fps.select("fp", F.posexplode(masks).alias("t", "mask"))
             .select("t", F.col("fp").bitwiseAND(F.col("mask")).alias("k"), "fp"))
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.repartition(n, "t", "k").sortWithinPartitions("t", "k", "fp")
    return dealt.mapInArrow(_linked(max_bits), "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """Links (a, b) -> (node, root): the smallest node of each component, by large-star and small-star rounds.

    Rounds go on until no link changes. Each round's links are a table in the checkpoint folder.
    """
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def state(e: DataFrame) -> tuple[int, int]:
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    was, seen = None, state(now)
    while seen[0] and seen != was:
        all_ = both(now)
        least = all_.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (all_.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        large = materialize(large)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.*").where("a <> b").distinct())
        now = materialize(small)
        was, seen = seen, state(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, fingerprint_col: str = "fingerprint", component_col: str = "component_id",
                    root_col: str = "root", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) of ``df`` plus its fingerprint (bigint), its component's id and the
    component's smallest fingerprint (which tells components apart even where all ids are null)."""
    keep = df.columns if keep is None else keep
    fp, cid, root = (free_name(df, c) for c in (fingerprint_col, component_col, root_col))
    narrow = materialize(with_fingerprint(df.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text)).alias("t")), "t", "fp", shingle)
                         .select("id", "fp"))
    nodes = materialize(narrow.groupBy("fp").agg(F.min("id").alias("first")))
    with narrow_batches(df.sparkSession):
        tree = components(links(nodes.select("fp"), max_bits))
    named = (nodes.join(tree.select(F.col("node").alias("fp"), "root"), "fp", "left")
             .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    named = materialize(named)
    least = named.groupBy("root").agg(F.min("first").alias("cid"))
    found = named.join(least, "root").select(F.col("fp").alias(fp), F.col("cid").alias(cid), F.col("root").alias(root))
    if set(keep) <= {id_col}:  # the narrow table has all that is asked for
        return narrow.select(*[F.col("id").alias(c) for c in keep], F.col("fp").alias(fp)).join(found, fp)
    return with_fingerprint(df, text, fp, shingle).select(*map(quoted, keep), fp).join(found, fp)


def hex_fingerprint(col: str):
    """16 lowercase hex digits of a bigint fingerprint."""
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                max_bits: int = MAX_BITS) -> DataFrame:
    """``df`` with one row of each group of near-duplicates: one with the smallest id."""
    cid, root = free_name(df, "component_id"), free_name(df, "root")
    got = near_duplicates(df, id_col, text, shingle, max_bits, component_col=cid, root_col=root)
    first = got.where(F.col(quoted(id_col)).eqNullSafe(F.col(cid)))
    return first.dropDuplicates([root]).select(*map(quoted, df.columns))
