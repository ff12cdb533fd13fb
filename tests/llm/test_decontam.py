import random

import pytest
from pyspark.sql import functions as F

from eventwatch.llm import decontam, queries
from conftest_sql import oracle_rows
from fixtures import empty, frame, rows

ITEMS = "item_id long, text string"


def cases():
    rnd = random.Random(2)
    items = [(i, " ".join(rnd.choice("abcd") for _ in range(n))) for i, n in enumerate([0, 1, 3, 9, 10, 11, 30, 12, 15, 40])]
    items += [(20, None), (21, "  ... "), (22, items[6][1]), (23, items[6][1].upper()), (11, "Q-R s")]
    docs = ["", None, "zzz"] + [" ".join(rnd.choice("abcdz") for _ in range(rnd.randint(1, 200))) for _ in range(60)]
    docs += [items[6][1], f"z {items[9][1]}! z {items[8][1]}", "é-" + items[5][1].replace(" ", "-é "), " ".join([items[9][1]] * 30), "q r, S"]
    return items, docs


def test_scan_equals_brute_force():
    items, docs = cases()
    for window in (10, 4):
        auto = decontam.Automaton([(i, decontam.words((t or "").encode())) for i, t in items], window)
        for d in docs:
            n, runs, found = auto.scan((d or "").encode())
            assert (n, sum(b - a for a, b in runs), sorted(found)) == decontam.brute_force(d, items, window), d
            assert all(b < c for (_, b), (c, _) in zip(runs, runs[1:]))


def test_pieces_carry_the_state(monkeypatch):
    items, docs = cases()
    auto = decontam.Automaton([(i, decontam.words((t or "").encode())) for i, t in items if len((t or "").split()) != 1], 10)
    want = [auto.scan((d or "").encode()) for d in docs]
    monkeypatch.setattr(decontam, "PIECE", 17)
    assert [auto.scan((d or "").encode()) for d in docs] == want


@pytest.mark.parametrize("group_words", [10**6, 60])   # one pass; many
def test_shards_and_passes_give_the_same(spark, group_words):
    items, docs = cases()
    df = spark.createDataFrame([(i, d, "x") for i, d in enumerate(docs)], "doc_id long, text string, `Hits` string")
    bench = spark.createDataFrame([*items, *items[5:8]], ITEMS)          # some rows twice
    made = decontam._automata(bench, "item_id", "text", 10, 25)
    assert made.count() > 4 and made.agg(F.max("n_words")).first()[0] <= 25      # items of 30 and 40 words stand in pieces
    many = decontam.with_hits(df, bench, shard_words=25, group_words=group_words)
    assert many.columns == ["doc_id", "text", "Hits", "hits_"]
    got = {r.doc_id: r["hits_"] for r in many.collect()}
    assert len(got) == len(docs)
    for i, d in enumerate(docs):
        n, hit, found = decontam.brute_force(d, items)
        runs = [(r.start, r.end) for r in got[i]["runs"]]
        assert (got[i]["n_words"], sum(b - a for a, b in runs), got[i]["items"]) == (n, hit, found), d
        assert all(b < c for (_, b), (c, _) in zip(runs, runs[1:]))


def test_removal_in_passes_gives_the_same(spark):
    """Also where a cut brings remains together that another group's item matches."""
    rnd = random.Random(4)
    items = [(i, " ".join(f"w{rnd.randint(0, 400)}" for _ in range(30))) for i in range(12)]
    docs = []
    for i in range(40):
        own = [f"own{rnd.randint(0, 999)}" for _ in range(120)]
        inner, outer = (items[rnd.randrange(12)][1].split() for _ in range(2))
        at = rnd.randint(0, 100)
        docs.append((i, " ".join(own if i % 4 == 0 else [*own[:at], *outer[:7], *inner, *outer[7:14], *own[at:]]), "en", "s", 1, "x", "y"))
    docs += [(50, items[0][1], "en", "s", 1, "x", "y"), (51, None, "en", "s", None, "x", "y"), (52, "", "en", "s", 0, "x", "y")]
    df, bench = frame(spark, docs), spark.createDataFrame(items, ITEMS)
    one = sorted(map(str, decontam.remove_hits(df, bench).collect()))
    many = sorted(map(str, decontam.remove_hits(df, bench, shard_words=70, group_words=140).collect()))
    assert one == many and len(one) == 42 and not any("doc_id=50" in r for r in one)


def test_removal_leaves_nothing_and_keeps_clean_documents(spark):
    passage = " ".join(f"bench{i}" for i in range(25))
    data = [(1, f"Before it. {passage}, after it comes a long text of other words that goes on and on and on for at least as many words again as before", "en", "s", 1, None, None),
            (2, "clean text", "en", "s", 10, None, None), (3, passage, "en", "s", 1, None, None),
            (4, " ".join(passage.split()[:5] + [passage] + passage.split()[5:]) + " own" * 60, "en", "s", 1, None, None)]
    bench = spark.createDataFrame([(1, passage)], ITEMS)
    got = {r.doc_id: r for r in decontam.remove_hits(frame(spark, data), bench).collect()}
    assert set(got) == {1, 2, 4} and got[2].text == "clean text" and got[2].n_chars == 10
    assert "bench" not in got[1].text and got[1].text.startswith("Before it.") and got[1].n_chars == len(got[1].text)
    left = decontam.with_hits(spark.createDataFrame([(r.text,) for r in got.values()], "text string"), bench)
    assert left.where(F.size("hits.runs") > 0).count() == 0


def test_odd_rows(spark):
    bench = spark.createDataFrame(cases()[0][6:8], ITEMS)
    got = decontam.remove_hits(frame(spark), bench)
    assert got.columns == frame(spark).columns and got.count() == len(rows())
    assert decontam.remove_hits(empty(spark), bench).count() == 0
    assert decontam.remove_hits(frame(spark), bench.where("false")).count() == len(rows())


def test_query_equals_sql(spark):
    got, want = oracle_rows(spark, "op6_decontamination")
    assert got == want and len(got) == 200
    assert queries.ORACLES["op6_decontamination"]
