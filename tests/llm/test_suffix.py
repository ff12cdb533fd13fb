import random

import numpy as np
from pyspark.sql import functions as F

from eventwatch.llm import queries, suffix
from fixtures import empty, frame, rows


def texts(seed=3, n=160):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abc é") for _ in range(400)) for _ in range(5)]
    out = [None, "", "a" * 500, "a" * 99, "ab" * 300, "a" * 100, base[0], base[0]]
    for _ in range(n):
        t = ""
        for _ in range(rnd.randint(0, 5)):
            s, a = rnd.choice(base), rnd.randint(0, 380)
            t += s[a:a + rnd.randint(1, 250)] + "".join(rnd.choice("xyz") for _ in range(rnd.choice([0, 0, 0, 30])))
        out.append(t)
    return list(enumerate(out))


def found(df, **more):
    got = suffix.without_repeats(df, kept=True, **more).select("doc_id", "rest.*").collect()
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got}


def test_equals_brute_force_in_one_and_in_many_shards(spark):
    data = texts()
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    want = suffix.brute_force(data)
    assert sum(w[1] for w in want.values()) > 10_000
    assert found(df) == want
    assert found(df, shard_bytes=3000) == want


def test_hot_passage(spark):
    passage = " ".join(f"passage word {i}" for i in range(15))
    rnd = random.Random(1)
    data = [(i, f"{rnd.random()} {rnd.random()} {passage} {rnd.random()} {rnd.random()}") for i in range(300)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert found(df, shard_bytes=2000) == suffix.brute_force(data)


def test_suffix_ranks():
    rng = np.random.default_rng(1)
    buf = np.frombuffer(bytes(rng.choice(list(b"ab"), 3000).tolist()) * 2, np.uint8)
    half, full = suffix.suffix_ranks(buf)
    b = buf.tobytes()
    places = range(len(b) - suffix.WINDOW)
    for ranks, size in ((half, 64), (full, suffix.WINDOW)):
        by = sorted(places, key=lambda p: b[p:p + size])
        assert all((ranks[p] == ranks[q]) == (b[p:p + size] == b[q:q + size]) and ranks[p] <= ranks[q] for p, q in zip(by, by[1:]))


def test_sections_cover_windows_whatever_the_chunks(monkeypatch):
    data = [(t or "").encode() for _, t in texts(n=20)] + [bytes(range(256)) * 300]
    want = sum(max(0, len(t) - suffix.WINDOW + 1) for t in data)
    for chunk in (1 << 16, 200):
        monkeypatch.setattr(suffix, "_CHUNK", chunk)
        seen = set()
        for _, _, doc, x, n in suffix.sections(data):
            for d, a, c in zip(doc.tolist(), x.tolist(), n.tolist()):
                seen.update((d, a + j) for j in range(c))
        assert len(seen) == want


def test_odd_rows(spark):
    got = suffix.without_repeats(frame(spark))
    assert got.count() == len(rows()) and set(got.columns) == {*frame(spark).columns, "rest"}
    assert got.where("text is null").select(F.max("rest.n_bytes")).first()[0] == 0
    twin = [r for r in got.collect() if r.doc_id == 10]
    assert len(twin) == 2 and twin[0].rest == twin[1].rest
    assert suffix.without_repeats(empty(spark)).count() == 0


def test_shared_and_null_ids(spark):
    """Rows of one id are documents of their own: nothing unique goes, and of every repeated passage one place stays."""
    rnd = random.Random(4)
    letters = lambda n: "".join(rnd.choice("abcdefghijklmnop") for _ in range(n))
    passage, other = letters(150), letters(200)
    data = [(1, passage), (5, letters(40) + passage + letters(60)), (5, letters(300)), (5, letters(300)), (7, other), (7, other),
            (None, letters(250)), (None, letters(30) + other), (None, letters(120)), (9, other + letters(10)), (None, None), (5, "")]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("repeat_i", F.lit(1))
    got = suffix.without_repeats(df).select("doc_id", "text", "rest.n_removed", "rest.n_bytes").collect()
    assert len(got) == len(data)
    cut = {(r.doc_id, r.text): r.n_removed for r in got}
    assert cut == {(i, t): 150 if i == 5 and passage in (t or "") else 200 if other in (t or "") and i is not None else 0 for i, t in data}
    # order: null ids, then ids; of one id, any order that is the same everywhere
    plain = suffix.brute_force([(k, t) for k, (_, t) in enumerate(sorted(set(data), key=lambda r: (r[0] is not None, r[0] or 0)))])
    assert sum(r[1] for r in plain.values()) == sum({(r.doc_id, r.text): r.n_removed for r in got}.values())


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in queries.op7_suffix_array(spark, sf).collect()}
    assert got == suffix.brute_force(docs)
