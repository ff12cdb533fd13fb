import random

import numpy as np
from pyspark.sql import functions as F

from eventwatch.llm import queries, toxicity
from fixtures import empty, frame, prose, rows


def corpus(spark):
    rnd = random.Random(5)
    docs, labels = [], []
    for i in range(900):
        bad = i % 8 == 0
        words = prose(rnd, rnd.randint(5, 60)).split()
        if bad:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(["idiot", "scum", f"zorgu{rnd.choice(['ra', 'mi', 'lo'])}", f"zorgu{rnd.choice(['ta', 'vi'])}"]))
        docs.append((i, " ".join(words), "en", "s", 1, None, None))
        if i % 2 == 0:
            labels.append((i, 1, int(bad)))
    return frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {d[0]: d[0] % 8 == 0 for d in docs}


def test_learns_cues_and_finds_toxic_texts(spark):
    docs, labels, truth = corpus(spark)
    model = toxicity.fit(docs.where(~toxicity.held_out()), labels)
    assert any(c.startswith(" zorg") for c, _ in model.cues)
    got = toxicity.with_score(docs, model).select("doc_id", toxicity.held_out().alias("out"), "toxicity").collect()
    out = [(truth[r.doc_id], r.toxicity >= toxicity.THRESHOLD) for r in got if r.out]
    assert sum(a and b for a, b in out) >= 0.9 * sum(a for a, _ in out) and not any(b and not a for a, b in out)


def test_held_out_labels_do_not_matter(spark):
    docs, labels, _ = corpus(spark)
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit(docs.where(~toxicity.held_out()), x) for x in (labels, flipped))
    assert a.cues == b.cues and np.allclose(a.weight, b.weight)


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(0)
    n, prior, rates = 40_000, 0.2, [(0.9, 0.02), (0.8, 0.05), (0.7, 0.01), (0.6, 0.1)]
    y = rng.random(n) < prior
    v = np.array([np.where(y, rng.random(n) < a, rng.random(n) < b) for a, b in rates] + [[]] * 0).T
    v = np.c_[v, v[:, 3]].astype(float)  # the last two voters are one
    m = toxicity.Model([], [], [str(i) for i in range(5)], prior)
    toxicity.fit_label_model(m, n, v.sum(0), v.T @ v)
    assert np.allclose(m.accuracy[:3], [a - b for a, b in rates[:3]], atol=0.08)
    assert m.correlation[3, 4] > 0.8 and abs(m.correlation[0, 1]) < 0.2
    assert ((m.posterior(v) > 0.5) == y).mean() > 0.97


def test_label_model_sees_all_training_rows(spark, monkeypatch):
    data = [(i, f"a text of its own {i}" + " nobody likes you" * (i % 500 == 1), "en", "s", 1, None, None) for i in range(4000)]
    docs = frame(spark, data).where(~toxicity.held_out())
    labels = spark.createDataFrame([(i, 1, int(i % 500 == 1)) for i in range(4000)], "doc_id long, quality int, toxic int")
    seen, real = [], toxicity.fit_label_model
    monkeypatch.setattr(toxicity, "SAMPLE", 40)
    monkeypatch.setattr(toxicity, "fit_label_model", lambda model, n, one, both: (seen.append((n, one)), real(model, n, one, both)))
    model = toxicity.fit(docs, labels)
    rare = model.names.index("nobody")
    (n, one), = seen
    assert n == docs.count() > 2000 and one[rare] == docs.where("text like '%nobody%'").count() > 0
    assert model.accuracy[rare] > 0 and model.vote_weight[rare] > 0


def test_odd_rows_and_no_labels(spark):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(frame(spark), none)
    got = toxicity.with_score(frame(spark), model, out="Score").collect()
    assert len(got) == len(rows()) and all(0 <= r.Score <= 1 for r in got)
    assert len({r.Score for r in got if not (r.text or "").strip()}) == 1
    bare = toxicity.fit(empty(spark), none)
    assert toxicity.with_score(empty(spark), bare).count() == 0
    assert bare.score("you idiot, shut up you pathetic scum") > bare.score("a fine day")


def test_query(spark):
    got = queries.op5_toxicity(spark, "/root/testdata/sf0.001")
    assert got.count() == 200 and dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
