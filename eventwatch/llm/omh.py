"""Document fingerprints by Order MinHash, in DataFrame functions only.

A text's k-mers are its runs of ``k`` words (white-space separated, as written). Repeats of a k-mer are numbered, and a
number and k-mer together are hashed. The hash's top bits deal the numbered k-mers out to ``bins`` bins; each bin
selects its ``width`` smallest hashes, puts the selected k-mers back into text order, and hashes that tuple. A
fingerprint is the tuple hashes of all bins, 4 hex digits each (0000: an empty bin). Two texts' likeness is the share
of bins, among those that either fills, with equal hashes. As the tuples keep text order, moving a passage lowers it:
it follows edit distance rather than the set of words.

All of this happens within a row: k-mer hashes and their places are packed into longs, which sort without objects,
and repeats are numbered along the sorted runs. So a very long text is one sort, and no text's k-mers are shuffled.

``with_neighbours`` gives every row its next row's text with one shuffle of the texts: ids are cut into blocks of about
``BLOCK`` rows, the first text of each block is also sent to the block before, and a window looks ahead in a block.

Defined cases: null texts are empty; a text of fewer than ``k`` words, but not none, is one k-mer; texts without a word have the
empty fingerprint; two empty fingerprints are alike (1.0); the next of the last row is the first; rows with equal ids are in
order of text; a single row is its own next; null ids come first. Repeated rows keep their rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventwatch.config import materialize
from eventwatch.llm.common import quoted, text_of

K = 2
WIDTH = 2
BINS = 64
BLOCK = 64


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once a row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def fingerprint(text: Column, k: int = K, width: int = WIDTH, bins: int = BINS) -> Column:
    """The Order MinHash fingerprint of a text column: ``bins`` * 4 hex digits."""
    if bins & (bins - 1) or not 1 < bins <= 1024:
        raise ValueError("bins must be a power of two from 2 to 1024")
    bin_shift = 64 - bins.bit_length() + 1
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    index = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def kmers(ws: Column) -> Column:
        several = F.transform(index(F.size(ws) - (k - 1)), lambda i: F.xxhash64(*[F.get(ws, i + j) for j in range(k)]))
        return F.when(F.size(ws) == 0, F.array().cast("array<bigint>")).when(F.size(ws) < k, F.array(F.xxhash64(ws))).otherwise(several)

    def from_kmers(hs: Column) -> Column:
        return let(F.size(hs), lambda n: let(F.length(F.bin(n)).cast("int"), lambda bits: from_bits(hs, bits)))

    def from_bits(hs: Column, bits: Column) -> Column:
        """``bits`` hold any place in the text; the rest of a long holds the hash."""
        mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1
        packed = F.sort_array(F.transform(hs, lambda h, i: F.call_function("shiftleft", h, bits).bitwiseOR(i.cast("bigint"))))
        return let(packed, lambda ps: let(mask, lambda m: from_places(hs, F.transform(ps, lambda p: p.bitwiseAND(m).cast("int")), m)))

    def from_places(hs: Column, places: Column, mask: Column) -> Column:
        """``places``: all places, equal k-mers together and in text order."""
        def numbered(at: Column) -> Column:
            first = F.filter(index(F.size(at)), lambda i: (i == 0) | (F.get(hs, F.get(at, i)) != F.get(hs, F.get(at, i - 1))))
            runs = let(first, lambda fs: F.transform(fs, lambda s, j: F.slice(at, s + 1, F.coalesce(F.get(fs, j + 1), F.size(at)) - s)))
            keyed = F.flatten(F.transform(runs, lambda run: F.transform(run, lambda p, nth: F.xxhash64(F.get(hs, p), nth)
                                                                        .bitwiseAND(F.bitwise_not(mask)).bitwiseOR(p.cast("bigint")))))
            return let(F.sort_array(keyed), lambda ks: signature(ks, mask))
        return let(places, numbered)

    def signature(ks: Column, mask: Column) -> Column:
        """``ks``: hash (high bits) and place (low bits), smallest first."""
        of = lambda x: F.call_function("shiftrightunsigned", x, F.lit(bin_shift))
        first = F.filter(index(F.size(ks)), lambda i: (i == 0) | (of(F.get(ks, i)) != of(F.get(ks, i - 1))))

        def tuple_hash(s: Column) -> Column:
            chosen = F.filter(F.slice(ks, s + 1, width), lambda x: of(x) == of(F.get(ks, s)))
            in_order = F.transform(F.array_sort(F.transform(chosen, lambda x: F.struct(x.bitwiseAND(mask).alias("p"), x.bitwiseAND(F.bitwise_not(mask)).alias("h")))),
                                   lambda x: x["h"])
            return F.lpad(F.lower(F.hex(F.pmod(F.xxhash64(in_order), F.lit(65535)) + 1)), 4, "0")
        filled = F.map_from_entries(F.transform(first, lambda s: F.struct(of(F.get(ks, s)).cast("int").alias("bin"), tuple_hash(s).alias("hash"))))
        return let(filled, lambda m: F.array_join(F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.coalesce(F.try_element_at(m, b), F.lit("0000"))), ""))

    return let(words, lambda ws: let(kmers(ws), from_kmers))


def likeness(a: Column, b: Column, bins: int = BINS) -> Column:
    """Share of equal bins among those that either fingerprint fills."""
    place = F.sequence(F.lit(0), F.lit(bins - 1))
    at = lambda x, i: F.substring(x, i * 4 + 1, F.lit(4))
    equal = F.size(F.filter(place, lambda i: (at(a, i) == at(b, i)) & (at(a, i) != "0000")))
    filled = F.size(F.filter(place, lambda i: (at(a, i) != "0000") | (at(b, i) != "0000")))
    return F.when(a == b, 1.0).when(filled == 0, 1.0).otherwise(equal / filled).cast("double")


def edited(text: Column, following: Column) -> Column:
    """The last floor(n/2) code points replaced by the first as many of the following text."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.left(text, n - half), F.left(following, half))


def next_keys(keys: DataFrame) -> DataFrame:
    """Distinct (key) -> (key, next): the next larger key, null for the largest. Range partitions look ahead on
    their own; one row a partition carries the first key of the next one."""
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(keys.repartitionByRange(n, "key").withColumn("part", F.spark_partition_id()))
    first = dealt.groupBy("part").agg(F.min("key").alias("first"))
    after = first.select("part", F.lead("first").over(Window.orderBy("part")).alias("after"))  # one row a partition
    ahead = dealt.withColumn("next", F.lead("key").over(Window.partitionBy("part").orderBy("key")))
    return ahead.join(F.broadcast(after), "part").select("key", F.coalesce("next", "after").alias("next"))


def with_neighbours(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = K, width: int = WIDTH, bins: int = BINS) -> DataFrame:
    """Of every row: id, text, edited (its last half replaced from the next row's text), fingerprint,
    edited_fingerprint, next_fingerprint. Ids are whole numbers; rows are in order of id, then text."""
    rows = docs.select(F.col(quoted(id_col)).cast("bigint").alias("id"), text_of(text).alias("text"))
    low, high, n = rows.agg(F.min("id"), F.max("id"), F.count(F.lit(1))).first()
    span = max(1, (high - low + 1) * BLOCK // max(n, 1)) if low is not None else 1
    block = F.coalesce(F.floor((F.col("id").cast("decimal(20,0)") - F.lit(low or 0)) / F.lit(span)).cast("bigint"), F.lit(-1).cast("bigint"))
    rows = rows.select(block.alias("block"), F.lit(0).alias("edge"), "id", "text")
    heads = materialize(rows.groupBy("block").agg(F.min(F.struct("id", "text")).alias("head")).select("block", F.col("head.text").alias("text")))
    order = next_keys(heads.select(F.col("block").alias("key")))
    first = heads.agg(F.min("block")).first()[0]
    order = order.select(F.col("key").alias("block"), F.coalesce("next", F.lit(first).cast("bigint")).alias("then"))
    edges = (heads.withColumnRenamed("block", "then").join(order, "then")
             .select("block", F.lit(1).alias("edge"), F.lit(None).cast("bigint").alias("id"), "text"))
    ahead = Window.partitionBy("block").orderBy("edge", F.asc_nulls_first("id"), "text")
    fp = lambda c: fingerprint(F.col(c), k, width, bins)
    return (rows.unionByName(edges)
            .withColumn("following", F.lead("text").over(ahead))
            .withColumn("fingerprint", fp("text"))
            .withColumn("next_fingerprint", F.lead("fingerprint").over(ahead))
            .where("edge = 0").withColumn("edited", edited(F.col("text"), F.col("following")))
            .select("id", "text", "edited", "fingerprint", fp("edited").alias("edited_fingerprint"), "next_fingerprint"))


def brute_force(text: str | None, hash_words, k: int = K, width: int = WIDTH, bins: int = BINS) -> str:
    """The fingerprint of one text in plain Python; ``hash_words`` hashes lists as the functions above do. For tests."""
    import re
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    hs = [hash_words("kmer", ws[i:i + k]) for i in range(len(ws) - k + 1)] if len(ws) >= k else [hash_words("short", ws)] if ws else []
    bits, seen, keyed = len(f"{len(hs):b}"), {}, []
    mask = (1 << bits) - 1
    packed = {}
    for i, h in enumerate(hs):
        packed.setdefault(h, []).append(i)
    for h, places in packed.items():
        for nth, p in enumerate(places):
            keyed.append(((hash_words("nth", [h, nth]) & ~mask & (2**64 - 1)) | p))
    signed = lambda x: x - 2**64 if x >> 63 else x
    keyed.sort(key=signed)
    shift, out = 64 - bins.bit_length() + 1, ["0000"] * bins
    for b in {x >> shift for x in keyed}:
        chosen = sorted([x for x in keyed if x >> shift == b][:width], key=lambda x: x & mask)
        out[b] = f"{hash_words('tuple', [signed(x & ~mask) for x in chosen]) % 65535 + 1:04x}"
    return "".join(out)
