from hashlib import sha256

from pyspark.sql import functions as F

from eventwatch.llm import omh, queries
from fixtures import empty, frame, rows


def expected(data):
    docs = sorted(((r[0], r[1] or "") for r in data), key=lambda d: (d[0] is not None, d[0] or 0, d[1]))
    out = []
    for j, (i, t) in enumerate(docs):
        after, half = docs[(j + 1) % len(docs)][1], len(t) // 2
        out.append((i, t, t[:len(t) - half] + after[:half]))
    return out


def test_edited_text_and_equal_fingerprints(spark):
    got = omh.with_neighbours(frame(spark)).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted(((r.id, r.text, r.edited) for r in got), key=key) == sorted(expected(rows()), key=key)
    by_text = {}
    for r in got:
        by_text.setdefault(r.text, set()).add(r.fingerprint)
        by_text.setdefault(r.edited, set()).add(r.edited_fingerprint)
        assert len(r.fingerprint) == 4 * omh.BINS
    assert all(len(f) == 1 for f in by_text.values())
    assert by_text[""] == by_text[" \n\t "] == {"0000" * omh.BINS}


def test_next_rows_across_blocks_and_sparse_ids(spark):
    ids = [-(2**62), -5, 0, 1, 2, 2**40, 2**40 + 1, 2**61, 2**62, 2**63 - 1] + list(range(1000, 1300))
    data = [(i, f"text number {i} of many words here", "en", "s", 1, None, None) for i in ids]
    got = {r.id: r.edited for r in omh.with_neighbours(frame(spark, data)).collect()}
    assert got == {i: e for i, _, e in expected(data)}


def test_one_row_and_empty_table(spark):
    r = omh.with_neighbours(frame(spark, [(5, "abcd", "en", "s", 4, None, None)])).first()
    assert (r.id, r.edited) == (5, "abab") and r.next_fingerprint == r.fingerprint
    assert omh.with_neighbours(empty(spark)).count() == 0


def test_fingerprint_equals_plain_python(spark):
    texts = ["a b c d e f", "a a a a b a a", "one", "x y", "", "w " * 300, " ".join(str(i % 37) for i in range(500))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")

    def hashed(kind, x):  # the hashes come from Spark; order, numbering and bins are what is tested
        if kind in ("kmer",):
            e = F.xxhash64(*[F.lit(w) for w in x])
        elif kind == "short":
            e = F.xxhash64(F.array(*[F.lit(w) for w in x]))
        elif kind == "nth":
            e = F.xxhash64(F.lit(x[0]).cast("bigint"), F.lit(x[1]).cast("int"))
        else:
            e = F.xxhash64(F.array(*[F.lit(v).cast("bigint") for v in x]))
        return e

    def hash_words(kind, x):
        key = (kind, tuple(x))
        if key not in cache:
            cache[key] = spark.range(1).select(hashed(kind, x)).first()[0]
        v = cache[key]
        return v if kind != "nth" else v & (2**64 - 1)
    cache: dict = {}
    got = [r[1] for r in df.select("t", omh.fingerprint(F.col("t"), bins=4)).collect()]
    assert got[:5] == [omh.brute_force(t, hash_words, bins=4) for t in texts[:5]]


def test_order_counts_and_likeness_bounds(spark):
    words = [f"w{i}" for i in range(400)]
    a, moved, other = " ".join(words), " ".join(words[200:] + words[:200]), " ".join(f"v{i}" for i in range(400))
    df = spark.createDataFrame([(a, a, moved, other)], "a string, b string, m string, o string")
    f = {c: omh.fingerprint(F.col(c)) for c in df.columns}
    r = df.select(*(f[c].alias(c) for c in f)).select(*(omh.likeness(F.col("a"), F.col(c)).alias(c) for c in "bmo")).first()
    assert r.b == 1.0 and 0.2 < r.m < 0.95 and r.o < 0.1


def test_query(spark):
    got = queries.op3_order_minhash(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 200 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert sum(r.near_edited for r in got) > 5 * sum(r.near_next for r in got)
    assert all(len(r.edited_sha256) == len(sha256(b"").hexdigest()) for r in got)


def test_native_plan(spark):
    plan = queries.op3_order_minhash(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
