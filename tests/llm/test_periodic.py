import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from eventwatch.llm import periodic, queries
from fixtures import empty, frame, rows


def lyndon(s):
    """Longest Lyndon words by definition: smaller than all their suffixes."""
    return [max(j - i for j in range(i + 1, len(s) + 1) if all(s[i:j] < s[k:j] for k in range(i + 1, j))) for i in range(len(s))]


def sequences(seed, n):
    rnd = random.Random(seed)
    for _ in range(n):
        s = [rnd.randrange(rnd.choice([2, 3, 8])) for _ in range(rnd.randrange(1, 100))]
        for _ in range(rnd.randrange(4)):
            at, i = rnd.randrange(len(s)), rnd.randrange(len(s))
            s = s[:at] + s[i:i + rnd.randrange(1, 12)] * rnd.randrange(1, 8) + s[at:]
        yield s


def test_lyndon_arrays():
    for s in sequences(1, 60):
        assert periodic.lyndon_array(s[:40]) == lyndon(s[:40])


def test_runs_equal_brute_force():
    for s in sequences(2, 400):
        for least in (2, 5, 12):
            assert periodic.runs_of(np.array(s), least) == periodic.brute_force(s, least)


def test_repeated_stretches_lose_no_run():
    for s in sequences(3, 400):
        (n, runs, _), = periodic.analyse([" ".join(map(str, s)).encode()])
        assert n == len(s) and runs == periodic.brute_force(s)


def test_words_known_for_many_runs():
    fib = [0], [0, 1]
    while len(fib[1]) < 700:
        fib = fib[1], fib[1] + fib[0]
    thue = [bin(i).count("1") & 1 for i in range(4096)]
    for s in (fib[1], thue[:700], [0] * 500, [0, 1] * 300, list(range(300)) * 3):
        assert periodic.runs_of(np.array(s)) == periodic.brute_force(s)
    assert all(n == 2 * q for _, n, q in periodic.runs_of(np.array(thue)))  # that word holds no three copies, nor more than two


def digests(text):
    ws = (text or "").split()
    runs = periodic.brute_force(ws)
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    left = " ".join(w for i, w in enumerate(ws) if i not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return (len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def probe(i, text):
    ws = [w for w in "".join(c if c not in "\t\n\v\f\r" else " " for c in text or "").split(" ") if w]
    h = zlib.crc32(str(i).encode())
    g, n = h // 10, len(ws)
    if h % 10 or not n or i is None:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(ws[:a] + [ws[a + (k - a) % p] for k in range(a, n)])


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: tuple(r[1:]) for r in queries.op13_periodic(spark, sf).collect()}
    small = [(i, t) for i, t in texts if len((t or "").split()) < 700]
    assert len(small) > 150 and sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in small) > 10
    for i, t in small:
        assert got[i] == digests(probe(i, t)), i
    assert len(got) == len(texts)


def test_odd_rows(spark):
    df = frame(spark).withColumn("runs", F.lit(1)).withColumn("__n", F.lit(2)).withColumn("PROBE", F.lit(3))
    got = periodic.with_runs(df)
    assert got.columns == [*df.columns, "runs_"] and got.count() == len(rows())
    by = {r.doc_id: r for r in got.where("doc_id in (0, 1, 2, 6)").collect()}
    assert by[0]["runs_"].n_words == 0 and by[0]["runs_"].collapsed == "" and by[2]["runs_"].runs == []
    assert [tuple(r) for r in by[6]["runs_"].runs] == [(0, 2000, 1)] and by[6]["runs_"].collapsed == "ab"
    assert periodic.with_runs(empty(spark)).count() == 0
    planted = periodic.with_probe(df)
    assert planted.columns == [*df.columns, "probe_"]
    for r in planted.select("doc_id", "text", "probe_").collect():
        assert r["probe_"] == probe(r["doc_id"], r["text"])
