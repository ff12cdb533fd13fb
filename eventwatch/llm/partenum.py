"""Exact set-similarity join on word shingles by PartEnum signatures.

Two texts link when the Jaccard similarity of their shingle sets is at least ``num / den``; components are the transitive closure.

1. Sets. Every text becomes the set of 64-bit hashes of its shingles. Equal sets are one node, known by a hash.
2. Size bands. Sizes are cut into bands from l to floor(l * den / num), so similar sets are of one band or of neighbours. A set
   takes part in two instances: its own band's and the next one's. In an instance of largest size r, similar sets differ in at
   most k = floor(2 r (den - num) / (den + num)) elements.
3. Signatures. An instance's domain (all hashes) is cut into n1 parts of n2 cells. A part is good if at most k2 elements differ in
   it; at most floor(k / (k2 + 1)) parts are not. In a good part, some n2 - k2 cells agree: every choice of so many cells of
   a part, with the elements in them, is a signature, and similar sets share one. A choice of empty cells says nothing and
   would be shared by masses, so n1 has ``spare`` parts more: a set with up to so many parts with an empty choice still shares a
   signature with elements. The few sets with more of them also give signatures under a second hash, and so on.
4. Candidates. Signatures are sorted into groups of equal ones as they stream by (one row is held). First every member is
   verified against the group's smallest node only, which joins a group of near copies by a few links a member. Groups whose
   members are then of several components go on: a pair between components is a candidate if their sizes and their parity
   bitmaps allow it. (A bitmap holds the parity of the elements that fall on each of ``BITS`` places; two sets differ in at least
   as many elements as their bitmaps in bits.) So sets that share one common passage are told apart by a few machine words
   a pair in the task, and emit nothing. A group gives ``FIRST`` candidates between two components, which joins most that belong
   together; where there were more, a second round gives all candidates between what is still apart. Groups of more than ``BLOCK`` members are dealt out as pairs of blocks; nothing is
   capped or sampled.
5. Verification counts common hashes of the two sets, and components are found by ``simhash.components``.

Links are exact but for equal 64-bit hashes of different shingles within a pair (about size^2 / 2^64) or of different sets.

Defined cases: fewer words than a shingle make one shingle; texts without words (and null ones) have the empty set, which links
with nothing; repeated rows and null ids keep their rows; a component's id is its smallest non-null id, null if it has none; very
long texts are one set of 8 bytes a shingle in one task; empty tables give empty results. Extra columns are not carried but by
``keep``; names that clash with the new ones make these end in ``_``.
"""

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import ceil, comb, exp, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventwatch.config import materialize
from eventwatch.llm.common import free_name, give_back, quoted, text_batches, utf8
from eventwatch.llm.simhash import components

SHINGLE = 4
SIMILAR = (85, 100)
BITS = 512          # of a parity bitmap
BLOCK = 8192        # members of a group that one task compares at a time
FIRST = 8           # candidates between two components that a group gives at first; all others follow if these were not similar
PORTION = 1 << 20   # bytes of text handled together
KNOWN = 100_000     # words whose hashes a portion remembers
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B
    x = (x ^ (x >> np.uint64(29))) * _C
    return x ^ (x >> np.uint64(32))


class _Words(dict):
    def __missing__(self, w: bytes) -> int:
        if len(self) > KNOWN:
            self.clear()
        h = self[w] = xxhash.xxh64_intdigest(w, 11)
        return h


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, one text after the other, and their numbers."""
    known, parts, size, short = _Words(), [], [], {}
    for i, t in enumerate(texts):
        ws = t.lower().split()  # bytes: A-Z only, and white space 0x09-0x0D and 0x20
        if 0 < len(ws) < shingle:  # one shingle
            short[i] = xxhash.xxh64_intdigest(b" ".join(ws), 12 + len(ws))
            ws = []
        parts.append(np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws)))
        size.append(len(ws))
    words, size = np.concatenate([*parts, np.zeros(shingle, np.uint64)]), np.array(size, np.int64)
    m = len(words) - shingle
    h = words[:m] * _A
    for k in range(1, shingle):
        h ^= words[k:k + m]
        h *= _B
        h ^= h >> np.uint64(31)
    count = np.maximum(size - shingle + 1, 0)
    end = np.cumsum(size)
    sets = [np.sort(h[e - n:e - n + c]) if c else np.array([short[i]] if i in short else [], np.uint64)
            for i, (e, n, c) in enumerate(zip(end.tolist(), size.tolist(), count.tolist()))]
    count = np.fromiter(map(len, sets), np.int64, len(sets))
    h = np.concatenate([*sets, np.zeros(0, np.uint64)])
    new = np.r_[True, h[1:] != h[:-1]][:len(h)]
    first = (np.cumsum(count) - count)[count > 0]
    new[first] = True
    d = np.repeat(np.arange(len(texts)), count)
    return _mix(h[new]), np.bincount(d[new], minlength=len(texts))


def node_of(hashes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """One hash for every set."""
    total = np.zeros(len(size), np.uint64)
    np.add.at(total, np.repeat(np.arange(len(size)), size), _mix(hashes ^ _A))
    return _mix(total ^ (size.astype(np.uint64) * _B)).view(np.int64)


@lru_cache(None)
def _bands(num: int, den: int) -> np.ndarray:
    """Smallest sizes of the bands."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(out[-1] * den // num + 1)
    return np.array(out, np.int64)


@lru_cache(None)
def _plan(band: int, num: int, den: int) -> tuple[int, int, int, int] | None:
    """(n1, n2, k2, spare) of a band's instance; none where only equal sets are similar."""
    first = _bands(num, den)
    largest, smallest = int(first[band + 1]) - 1, int(first[max(band - 1, 0)])
    k = 2 * largest * (den - num) // (den + num)
    if not k:
        return None
    if k <= 3:
        return 1, k + 2, k, 0
    n2, k2 = (3, 1) if k <= 24 else (2, 1)
    need = k // (k2 + 1) + 1
    mean = need * comb(n2, k2) * exp(-(n2 - k2) / n2 * smallest / need)  # parts with an empty choice
    spare = ceil(mean + 4 * sqrt(mean))
    return need + spare, n2, k2, spare


def _instance(band: int, hashes: np.ndarray, size: np.ndarray, seed: int, num: int, den: int, depth: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(number of the set, signature) of sets in one instance."""
    plan = _plan(band, num, den)
    if plan is None or not len(size):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    n1, n2, k2, spare = plan
    m, cells = len(size), n1 * n2
    x = _mix(hashes ^ np.uint64((seed * 0x2545F4914F6CDD1D + 1) % (1 << 64)))
    cell = np.repeat(np.arange(m), size) * cells + ((x >> np.uint64(33)) % np.uint64(cells)).astype(np.int64)
    total = np.zeros(m * cells, np.uint64)
    np.add.at(total, cell, _mix(x ^ _C))
    total, count = total.reshape(m, n1, n2), np.bincount(cell, minlength=m * cells).reshape(m, n1, n2)
    empty = np.zeros((m, n1), bool)
    who, sig = [], []
    for j, choice in enumerate(combinations(range(n2), n2 - k2)):
        s, c = total[:, :, choice[0]].copy(), count[:, :, choice[0]].copy()
        for o in choice[1:]:
            s += total[:, :, o]
            c += count[:, :, o]
        empty |= c == 0
        last = depth == 0
        at, part = np.nonzero((c > 0) | last)
        tag = ((np.uint64(band) * np.uint64(64) + np.uint64(seed % 64)) << np.uint64(40)) + part.astype(np.uint64) * np.uint64(64) + np.uint64(j)
        who.append(at)
        sig.append(_mix(s[at, part] ^ _mix(tag * _A)))
    more = np.flatnonzero(empty.sum(axis=1) > spare)
    if len(more) and depth:
        ends = np.cumsum(size)
        some = np.concatenate([hashes[ends[i] - size[i]:ends[i]] for i in more])
        a, b = _instance(band, some, size[more], seed + 1, num, den, depth - 1)
        who.append(more[a])
        sig.append(b)
    return np.concatenate(who), np.concatenate(sig)


def signatures(hashes: np.ndarray, size: np.ndarray, seed: int = 0, similar: tuple[int, int] = SIMILAR) -> tuple[np.ndarray, np.ndarray]:
    """(number of the set, signature) of all sets: two that are similar but not equal share a signature."""
    band = np.searchsorted(_bands(*similar), size, "right") - 1
    ends = np.cumsum(size)
    who, sig = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for b in np.unique(band[size > 0]).tolist():
        mine = np.flatnonzero((band == b) & (size > 0))
        some = np.concatenate([hashes[ends[i] - size[i]:ends[i]] for i in mine])
        for instance in (b, b + 1):
            at, s = _instance(instance, some, size[mine], seed, *similar)
            who.append(mine[at])
            sig.append(s)
    return np.concatenate(who), np.concatenate(sig)


def _portions(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= PORTION):
            size += len(texts[end])
            end += 1
        yield at, texts[at:end]
        at = end


def _nodes(shingle: int):
    """Arrow column of texts -> struct of node and n."""
    def nodes(cols: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in cols:
            node, n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, some in _portions(utf8(col)):
                hashes, size = shingle_sets(some, shingle)
                node.append(node_of(hashes, size))
                n.append(size)
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(node)), pa.array(np.concatenate(n))], ["node", "n"])
        give_back()
    return F.arrow_udf(nodes, "struct<node:bigint,n:bigint>").asNondeterministic()


def _set(shingle: int):
    """Arrow column of texts -> struct of hashes and parity bitmap."""
    def sets(cols: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in cols:
            got, sizes, bits = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], []
            for _, some in _portions(utf8(col)):
                hashes, size = shingle_sets(some, shingle)
                got.append(hashes)
                sizes.append(size)
                bits += bitmaps(hashes, size)
            words = pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(sizes)), pa.int32()), pa.array(np.concatenate(got).view(np.int64)))
            yield pa.StructArray.from_arrays([words, pa.array(bits, pa.binary())], ["words", "bits"])
        give_back()
    return F.arrow_udf(sets, "struct<words:array<bigint>,bits:binary>").asNondeterministic()


def bitmaps(hashes: np.ndarray, size: np.ndarray) -> list[bytes]:
    place = np.repeat(np.arange(len(size)), size) * BITS + (_mix(hashes ^ _C) % np.uint64(BITS)).astype(np.int64)
    odd = (np.bincount(place, minlength=len(size) * BITS) & 1).astype(np.uint8)
    return [row.tobytes() for row in np.packbits(odd.reshape(len(size), BITS), axis=1)]


def _signed_texts(shingle: int, similar: tuple[int, int]):
    """Batches of texts -> (sig, node); equal sets of a portion give their signatures once."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, some in _portions(utf8(batch.column(0))):
                hashes, size = shingle_sets(some, shingle)
                node = node_of(hashes, size)
                first = np.zeros(len(size), bool)
                first[np.unique(node, return_index=True)[1]] = True
                ends, mine = np.cumsum(size), np.flatnonzero(first)
                use = np.repeat(first, size)
                who, sig = signatures(hashes[use], size[mine], 0, similar)
                for a in range(0, len(who), 1 << 17):
                    yield pa.RecordBatch.from_arrays([pa.array(sig[a:a + (1 << 17)].view(np.int64)), pa.array(node[mine[who[a:a + (1 << 17)]]])], ["sig", "node"])
        give_back()
    return rows


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (sig, node) in order -> members of groups of several nodes: (sig, node, least of the group)."""
    held = None  # of the last row: sig, node, the least of its group, whether the group has several
    for batch in batches:
        s, x = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        again = np.r_[False, (s[1:] == s[:-1]) & (x[1:] == x[:-1])][:len(s)]
        if held and len(s):
            again[0] = (s[0], x[0]) == held[:2]
        s, x = s[~again], x[~again]
        if not len(s):
            continue
        new = np.r_[not held or s[0] != held[0], s[1:] != s[:-1]]
        start = np.flatnonzero(new)
        low = np.r_[held[2] if held else 0, x[start]][np.cumsum(new)]
        second = ~new & np.r_[bool(held) and not held[3], new[:-1]]  # now the group's first member is out as well
        out = np.flatnonzero(~new)
        both = np.r_[out, np.flatnonzero(second)]
        if len(both):
            node = np.r_[x[out], low[second]]
            yield pa.RecordBatch.from_arrays([pa.array(s[both]), pa.array(node), pa.array(low[both])], ["sig", "node", "least"])
        held = (s[-1], x[-1], low[-1], not new[-1])
    give_back()


def _members(rows: DataFrame) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(rows.repartition(n, "sig").sortWithinPartitions("sig", "node").mapInArrow(_groups, "sig bigint, node bigint, least bigint"))


def _verified(pairs: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of nodes that are similar."""
    num, den = similar
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("words").alias("wa"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("words").alias("wb"))
    both = pairs.join(one, "a").join(two, "b").where(F.least("na", "nb") * den >= F.greatest("na", "nb") * num)
    common = F.size(F.array_intersect("wa", "wb"))
    return materialize(both.where(common * den >= (F.col("na") + F.col("nb") - common) * num).select("a", "b"))


def _close(rows: dict[str, np.ndarray], num: int, den: int, first: int | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of one cell's rows that may be similar: of different components, and of different blocks where the cell has two.
    Of two components the ``first`` ones (None: all), with whether there are more."""
    node, root, n, block, bits = (rows[c] for c in ("node", "root", "n", "block", "bits"))
    apart = (block != block[0]).any()
    used: dict[tuple[int, int], int] = {}
    cut = None  # a pair that is left for later
    for i in range(len(node) - 1):
        rest = slice(i + 1, None)
        ok = (root[rest] != root[i]) & (np.minimum(n[rest], n[i]) * den >= np.maximum(n[rest], n[i]) * num)
        if apart:
            ok &= block[rest] != block[i]
        at = np.flatnonzero(ok) + i + 1
        if len(at):
            differ = np.bitwise_count(bits[at] ^ bits[i]).sum(axis=1, dtype=np.int64)
            at = at[differ * (den + num) <= (n[at] + n[i]) * (den - num)]
        if not len(at):
            continue
        if first is not None:
            order = np.argsort(root[at], kind="stable")
            at = at[order]
            new = np.flatnonzero(np.r_[True, root[at[1:]] != root[at[:-1]]])
            take = []
            for a, b in zip(new.tolist(), [*new[1:].tolist(), len(at)]):
                key = tuple(sorted((int(root[i]), int(root[at[a]]))))
                left = max(0, first - used.get(key, 0))
                used[key] = used.get(key, 0) + min(left, b - a)
                take.append(np.arange(a, min(a + left, b)))
                if b - a > left:
                    cut = i, int(at[b - 1])
            at = at[np.concatenate(take)]
        yield np.minimum(node[at], node[i]), np.maximum(node[at], node[i]), np.zeros(len(at), bool)
    if cut:
        a, b = sorted(int(node[i]) for i in cut)
        yield np.array([a]), np.array([b]), np.array([True])


def _candidates(similar: tuple[int, int], first: int | None):
    """Rows (sig, cell, block, node, root, n, bits) in order of (sig, cell) -> pairs (a, b, more). At most two blocks are held."""
    def work(parts: list[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        rows = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
        got = list(_close(rows, *similar, first))
        if got:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*got)], ["a", "b", "more"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            all_ = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("sig", "cell", "block", "node", "root", "n")}
            all_["bits"] = np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint64).reshape(batch.num_rows, -1)
            key = all_["sig"], all_["cell"]
            cut = np.flatnonzero((key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
                part = {c: v[a:b] for c, v in all_.items()}
                if held and (held[0]["sig"][0], held[0]["cell"][0]) != (part["sig"][0], part["cell"][0]):
                    yield from work(held)
                    held = []
                held.append(part)
        if held:
            yield from work(held)
        give_back()
    return pairs


def _links(docs: DataFrame, text: str, shingle: int, similar: tuple[int, int]) -> DataFrame:
    """(node, root) of the nodes that have links."""
    texts = docs.select(F.col(quoted(text)).cast("string").alias("t"))
    members = _members(text_batches(texts).mapInArrow(_signed_texts(shingle, similar), "sig bigint, node bigint"))
    named = text_batches(texts).withColumn("x", _nodes(shingle)("t")).select("t", "x.node", "x.n")
    wanted = named.join(members.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
    sets = materialize(wanted.withColumn("x", _set(shingle)("t")).select("node", "n", "x.words", "x.bits"))
    edges = _verified(members.where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct(), sets, similar)
    for first in (FIRST, None):
        tree = components(edges)
        pairs = materialize(_apart(members, tree, sets).mapInArrow(_candidates(similar, first), "a bigint, b bigint, more boolean"))
        more = _verified(pairs.select("a", "b").distinct(), sets, similar)
        if more.isEmpty() and pairs.where("more").isEmpty():
            return tree
        edges = edges.union(more)
        if pairs.where("more").isEmpty():
            break
    return components(edges)


def _apart(members: DataFrame, tree: DataFrame, sets: DataFrame) -> DataFrame:
    """Members of groups of several components, dealt out by group and pair of blocks. The least nodes are through."""
    rooted = members.join(tree.select("node", "root"), "node", "left").select("sig", "node", "least", F.coalesce("root", "node").alias("root"))
    open_ = (rooted.groupBy("sig").agg((F.min("root") != F.max("root")).alias("open"), F.count(F.lit(1)).alias("g"))
             .where("open and g > 2").drop("open"))
    left = rooted.where("node <> least").join(open_, "sig").join(sets.select("node", "n", "bits"), "node")
    blocks = F.ceil(F.col("g") / BLOCK)
    left = left.withColumn("block", F.pmod(F.xxhash64("node"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
    cell = F.least("block", "other") * blocks + F.greatest("block", "other")
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (left.select("sig", cell.alias("cell"), "block", "node", "root", "n", "bits")
            .repartition(n, "sig", "cell").sortWithinPartitions("sig", "cell", "node"))


def similar_texts(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, similar: tuple[int, int] = SIMILAR,
                  size_col: str = "n_shingles", component_col: str = "component_id", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: the id) of ``df`` plus the size of its shingle set and the id of its component."""
    keep = [id_col] if keep is None else keep
    size, cid = (free_name(df.select(*map(quoted, keep)), c) for c in (size_col, component_col))
    ids = df.select(F.col(quoted(id_col)).alias("id"), *[F.col(quoted(c)).alias(f"k{i}") for i, c in enumerate(keep)],
                    F.col(quoted(text)).cast("string").alias("t"))
    narrow = materialize(text_batches(ids).withColumn("x", _nodes(shingle)("t")).drop("t").select("*", "x.node", "x.n").drop("x"))
    tree = _links(df, text, shingle, similar)
    nodes = narrow.where("n > 0").groupBy("node").agg(F.min("id").alias("first"))
    named = materialize(nodes.join(tree, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root")))
    least = named.groupBy("root").agg(F.min("first").alias("cid"))
    found = named.join(least, "root").select("node", "cid")
    return (narrow.join(found, "node", "left")
            .select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], F.col("n").alias(size),
                    F.when(F.col("n") > 0, F.col("cid")).otherwise(F.col("id")).alias(cid)))


def brute_force(texts: dict[int, str | None], shingle: int = SHINGLE, similar: tuple[int, int] = SIMILAR) -> dict[int, tuple[int, int]]:
    """id -> (set size, component id); for tests."""
    sets = {}
    for i, t in texts.items():
        ws = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(ws[j:j + shingle]) for j in range(max(1, len(ws) - shingle + 1))) if ws else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets, key=lambda i: len(sets[i]))
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            if len(sets[i]) * similar[1] < len(sets[j]) * similar[0]:
                break
            both = len(sets[i] & sets[j])
            if both and both * similar[1] >= (len(sets[i]) + len(sets[j]) - both) * similar[0]:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}
