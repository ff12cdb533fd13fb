import re

import numpy as np
from pyspark.sql import functions as F

from eventwatch.llm import langid, queries
from fixtures import empty, frame, rows

TEXTS = {"en": "the quick brown fox jumps over the lazy dog and then the fox runs away from the house",
         "de": "der schnelle braune fuchs springt über den faulen hund und dann läuft der fuchs weg vom haus",
         "fr": "le renard brun rapide saute par dessus le chien paresseux et puis le renard s'enfuit de la maison"}


def labelled(spark, extra=()):
    data = [(i * 3 + j, " ".join(t.split()[i % 5:]), k, "s", 1, None, None) for i in range(60) for j, (k, t) in enumerate(TEXTS.items())]
    return frame(spark, data + list(extra))


def test_filter_returns_all_languages_of_a_gram():
    g = np.arange(1, 4000, dtype=np.uint64) * np.uint64(7919)
    names = [f"l{i:02d}" for i in range(20)]  # more than one byte of bits
    f = langid.Filter.build({n: g[i * 100:(i + 4) * 100] for i, n in enumerate(names)}, "l00")
    one, two = langid._slots(g)
    mask = np.unpackbits(f.slots[one] & f.slots[two], axis=1, bitorder="little")[:, :20]
    for i in range(20):
        assert mask[i * 100:(i + 4) * 100, i].all()
        assert mask[:, i].mean() - 400 / len(g) < 0.01
    assert (f.false_positive < 0.01).all()


def test_learns_and_corrects(spark):
    docs = labelled(spark)
    model = langid.fit_on_training_rows(docs)
    got = langid.with_language(docs, model).select("lang", "language.*").collect()
    assert model.languages == ["de", "en", "fr"] and all(r[0] == r[1] and 0 < r.score <= 1 and r.evidence > 0.5 for r in got)


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    docs = labelled(spark)
    wrong = docs.withColumn("lang", F.when(langid.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    a, b = langid.fit_on_training_rows(docs), langid.fit_on_training_rows(wrong)
    assert a.languages == b.languages and (a.slots == b.slots).all()


def test_und_ties_and_odd_rows(spark):
    model = langid.fit_on_training_rows(labelled(spark))
    for text in (None, "", "123 !? 4", "\n", "²", "½ ¼", "①", "Ⅷ", "٣ _ ๓"):
        assert model.predict(text) == ("und", 0.0, 0.0)
    assert model.predict("漢字")[0] in model.languages and model.predict("漢字")[1:] == (0.0, 0.0)
    long = TEXTS["de"] * 30_000
    assert model.predict(long)[0] == "de"
    got = langid.with_language(frame(spark), model, out="Language")
    assert got.count() == len(rows()) and got.where(langid.speaks("Language")).count() <= len(rows())
    assert langid.with_language(empty(spark), langid.fit(empty(spark))).count() == 0
    assert langid.fit(empty(spark)).predict("text") == ("und", 0.0, 0.0)
    unlabelled = frame(spark, [(1, "text", None, None, 1, None, None)])
    assert langid.with_language(unlabelled, langid.fit(unlabelled)).first().language.lang == "und"


def test_texts_without_an_ngram_are_kept_if_they_have_a_letter(spark):
    model = langid.fit_on_training_rows(labelled(spark))
    texts = ["Re.", "A.", "De.", "é", "-- x 1 --", "1 2", "", None, " \n", "xqz zqxq qzzx", "the quick brown fox"]
    data = [(i, t, None, "s", 1, None, None) for i, t in enumerate(texts)]
    got = langid.with_language(frame(spark, data), model).where(langid.speaks())
    assert {r.doc_id for r in got.collect()} == {0, 1, 2, 3, 4, 10}
    short = frame(spark, data).select("doc_id", langid.unjudged().alias("u")).where("u").collect()
    assert {r.doc_id for r in short} == {i for i, t in enumerate(texts) if t is not None and len(langid._RUNS.sub(
        b" ", b" " + t.lower().encode().translate(langid._PLAIN) + b" ")) < langid.GRAM}


def test_a_clashing_column_stays(spark):
    df = labelled(spark).withColumnRenamed("Text_", "Language")
    got = langid.with_language(df, langid.fit_on_training_rows(df))
    assert got.columns == [*df.columns, "language_"] and got.where("language_.lang = lang").count() == got.count()


def test_scores_equal_a_plain_count_of_ngrams(spark):
    """Share of n-grams that each language holds, looked up one at a time in the given filter; the hashes in plain Python."""
    model = langid.fit_on_training_rows(labelled(spark))
    shift = 64 - langid.SLOTS.bit_length() + 1
    for text in [*TEXTS.values(), "the fuchs saute über the house", "Été", "x", "a" * 30, "½ the", "dog 123 HUND"]:
        line = re.sub(rb"[^a-z\x80-\xff]+", b" ", f" {text.lower()} ".encode()).ljust(langid.GRAM)
        grams = [int.from_bytes(line[i:i + langid.GRAM], "big") for i in range(len(line) - langid.GRAM + 1)]
        slots = [[(g * int(m) & (2**64 - 1)) >> shift for m in langid._MULTIPLIERS] for g in grams]
        share = []
        for i, fp in enumerate(model.false_positive):
            held = sum(all(model.slots[s, i // 8] >> i % 8 & 1 for s in both) for both in slots)
            share.append(min(1.0, max(0.0, (held / len(grams) - fp) / (1 - fp))))
        best = share.index(max(share))
        want = (model.languages[best], share[best] / sum(share), share[best]) if share[best] else (model.fallback, 0.0, 0.0)
        got = model.predict(text)
        assert got[0] == want[0] and np.allclose(got[1:], want[1:], rtol=1e-12)


def test_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op10_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in got if r.held_out]
    assert len(got) == 1000 and len(out) > 100
    assert sum(r.lang == r.lang_pred for r in out) >= 0.98 * len(out) and all(0 <= r.score <= 1 for r in got)
