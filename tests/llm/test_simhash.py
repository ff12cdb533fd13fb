import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventwatch.llm import queries, simhash
from fixtures import empty, frame, rows


def components(fps, bits=3):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    fps = list(root)
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= bits:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def clustered(seed=1, centres=25, each=14, bits=5):
    rnd, out = random.Random(seed), []
    for _ in range(centres):
        c = rnd.getrandbits(64)
        for _ in range(each):
            f = c
            for b in rnd.sample(range(64), rnd.randint(0, bits)):
                f ^= 1 << b
            out.append(f)
    return sorted({f - (1 << 64) if f >> 63 else f for f in out + [0, 1, 2**63, 2**64 - 1]})


def test_fingerprint_by_spark_hashes(spark):
    texts = [r[1] for r in rows() if r[1]][:25]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    low = F.translate("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    ws = F.filter(F.split(low, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rowsets = df.select("i", ws.alias("ws")).collect()
    grams = [(r.i, " ".join(r.ws[j:j + 3])) for r in rowsets for j in range(max(1, len(r.ws) - 2)) if r.ws]
    hashes = {}
    for i, h in spark.createDataFrame(grams, "i long, g string").select("i", F.xxhash64("g")).collect():
        hashes.setdefault(i, []).append(h & (2**64 - 1))
    for i, t in enumerate(texts):
        hs = hashes.get(i, [])
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0
        assert simhash.fingerprint(t.encode()) == want


@pytest.mark.parametrize("bits", [1, 3])
def test_components_equal_brute_force(spark, bits):
    fps = clustered()
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    tree = simhash.components(simhash.links(df, bits))
    got = {f: f for f in fps} | {r.node: r.root for r in tree.collect()}
    want, groups = components(fps, bits), {}
    for f in fps:
        groups.setdefault(want[f], set()).add(got[f])
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(600)] + [(5, 5), (1000, 1001), (1001, 1000)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert all(got[i] == 0 for i in range(1, 601)) and got[1001] == 1000


def test_dense_key_gives_a_forest():
    rng = np.random.default_rng(3)
    fps = np.unique(np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 30, 4000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 30, 4000).astype(np.uint64)))
    left, right = simhash._forest(fps, 3)
    assert sum(map(len, left)) == len(fps) - 1 and len(right)


def test_one_of_each_and_odd_rows(spark):
    got = simhash.near_duplicates(frame(spark))
    assert got.count() == len(rows())
    assert set(got.columns) == {*frame(spark).columns, "fingerprint_", "component_id", "root"}
    null_like = got.where("trim(coalesce(text, '')) = ''").select("fingerprint_").distinct().collect()
    assert [r[0] for r in null_like if r[0] == 0] == [0]
    one = simhash.one_of_each(frame(spark))
    assert one.columns == frame(spark).columns
    kept = [r.doc_id for r in one.collect()]
    assert len(kept) == len(set(kept)) == got.select("root").distinct().count() and 10 in kept and None not in kept
    assert simhash.one_of_each(empty(spark)).count() == 0
    nulls = frame(spark, [(None, "alpha beta gamma delta", None, None, 1, None, None), (None, "quite another text", None, None, 1, None, None)] * 2)
    assert simhash.one_of_each(nulls).count() == 2


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = dict(map(tuple, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()))
    fps = {i: simhash.fingerprint((t or "").encode()) for i, t in texts.items()}
    root = components(list(fps.values()))
    least = {}
    for i in sorted(fps):
        least.setdefault(root[fps[i]], i)
    got = queries.op9_simhash(spark, sf).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{f:016x}", least[root[f]]) for i, f in fps.items()}
