"""Small documents with the cases that every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `Text_` string, `fingerprint` string"
WORDS = "the of and lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore".split()


def prose(rnd: random.Random, n: int) -> str:
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "", "s", "ing"]) for _ in range(n))


def rows(n: int = 40, seed: int = 7) -> list[tuple]:
    rnd = random.Random(seed)
    texts: list[str | None] = [None, "", " \n\t ", "Été! 漢字 😀 naïve", "one", "a" * 3000, "ab " * 2000, prose(rnd, 20_000)]
    texts += [prose(rnd, rnd.randint(1, 150)) for _ in range(n)]
    texts += [texts[10], texts[10], texts[11] + " end", texts[12].upper()]
    out = [(i, t, "en", f"s{i % 3}", None if t is None else len(t), "x", "y") for i, t in enumerate(texts)]
    return out + [out[10], (None, texts[9], None, None, 1, "x", "y"), (None, None, None, None, None, None, None)]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
