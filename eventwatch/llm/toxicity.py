"""Toxicity by weak supervision.

1. Cues: words and word beginnings that occur once, twice or three times in a text far more often if it is toxic,
   counted by Spark over a bounded sample of labelled training rows (``SAMPLE``), next to hand-written word lists and
   patterns.
2. Voters: every hand-written list and pattern votes, and the mined cues are dealt out by a hash to ``LEXICONS``
   lexicons that vote each; a vote is 1 where the voter finds something.
3. Label model: from the votes' second moments over all training documents (one small matrix a task) it estimates,
   without using the labels again, each voter's accuracy by triplets of voters (the covariance of two voters that are
   independent given the label is the product of their accuracies) and the voters' correlations given the label (what
   is left of the covariance). The posterior is the linear discriminant with those means and that covariance.
4. A linear classifier (ridge logistic regression) learns the posteriors of a bounded sample of training documents from
   the cues' counts. Where a sampled row has a label, that is one more, very accurate vote in its posterior; rows
   without one weigh less. Its probability is the score.

Defined cases: null and empty texts score as texts without any cue; missing, null or contradictory labels (the larger
counts) are fine; without labelled rows the hand-written lists decide alone, without any rows with fixed weights; repeated rows keep their rows.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventwatch.llm.common import give_back, quoted, text_batches, words

SAMPLE = 8_000       # labelled rows to learn cues from, and documents to fit the classifier on, about
CUES = 300           # mined cues that are kept
CANDIDATES = 20_000  # cues of toxic texts that are counted in other texts
LEXICONS = 12        # lexicons that the mined cues are dealt out to
STEMS = range(3, 9)  # lengths of word beginnings, in characters
TIMES = (1, 2, 3)    # a cue is a word or word beginning that occurs at least so often in a text
LIFT = 20.0          # least ratio of a cue's rate in toxic texts to its rate in others
THRESHOLD = 0.3
LABEL_ACCURACY = 0.99
UNLABELLED_WEIGHT = 0.1

# Hand-written lists (whole words) and patterns over the lower-cased words of a text.
LISTS = {
    "insult": "idiot idiots moron morons imbecile imbeciles fool fools dumbass loser losers clown clowns jerk creep".split(),
    "contempt": "pathetic worthless disgusting stupid useless despicable vile repulsive ridiculous laughable".split(),
    "dehumanising": "scum trash vermin filth garbage parasite parasites subhuman savages animals cockroaches".split(),
    "profanity": "fuck fucking shit shitty bitch bastard asshole crap damn dick piss cunt whore slut".split(),
    "threat": "kill murder strangle stab lynch hang exterminate annihilate".split(),
    "german": "idiot dummkopf arschloch scheisse scheiße abschaum trottel schwachkopf hurensohn".split(),
    "french": "idiot imbécile connard connasse salaud merde ordure crétin abruti pute".split(),
    "spanish": "idiota imbécil estúpido estúpida basura mierda puta cabrón pendejo gilipollas".split(),
}
PATTERNS = {
    "you are": r" (?:you|u|they|he|she) (?:are|is|re|r) (?:all |such |just |nothing but )?(?:a |an )?(?:\S+ )?(?:idiot|moron|loser|clown|scum|trash|disgrace|joke)",
    "shut up": r" (?:shut (?:the \S+ )?up|get lost|go to hell|drop dead|screw you)",
    "harm": r" (?:kill yourself|kys|hope you die|deserve to die|should be shot)",
    "nobody": r" (?:nobody|no one) (?:likes|wants|cares about) you",
}


def normal(text: str | None) -> str:
    """Lower-cased words, one space apart and around."""
    return f" {b' '.join(words((text or '').lower().encode())).decode()} "


def cues_of(text: str, known: set[str] | None = None) -> list[str]:
    """Candidates: whole words (a space behind) and word beginnings, a space before each; behind them, how often."""
    n: Counter = Counter()
    for w, c in Counter(normal(text).split()).items():
        n[f" {w} "] += c
        for k in STEMS:
            if len(w) >= k:
                n[f" {w[:k]}"] += c
    return [f"{s}\t{t}" for s, c in n.items() for t in TIMES if c >= t and (known is None or f"{s}\t{t}" in known)]


@dataclass
class Model:
    """Cue strings, their voters, the label model and the classifier's weights."""

    cues: list[tuple[str, int]]  # what, and how often at least
    voter: list[int]
    names: list[str]
    prior: float
    accuracy: np.ndarray | None = None
    correlation: np.ndarray | None = None
    vote_weight: np.ndarray | None = None
    vote_bias: float = 0.0
    weight: np.ndarray | None = None
    bias: float = 0.0
    _find: object = field(default=None, repr=False, compare=False)
    _patterns: list = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return self.__dict__ | {"_find": None, "_patterns": None}

    def counts(self, text: str | None) -> dict[int, int]:
        """The cues that a text has, by number, with how often (patterns follow the cues in number)."""
        if self._find is None:
            self._patterns = [re.compile(p) for p in PATTERNS.values()]
            self._find = ahocorasick.Automaton()
            for c in dict(self.cues):
                self._find.add_word(c, [(i, t) for i, (d, t) in enumerate(self.cues) if d == c])
            self._find.make_automaton()
        line, seen = normal(text), {}
        if self.cues:
            for _, cues in self._find.iter(line):
                for i, t in cues:
                    seen[i, t] = seen.get((i, t), 0) + 1
        got = {i: n for (i, t), n in seen.items() if n >= t}
        for j, p in enumerate(self._patterns):
            if n := sum(1 for _ in p.finditer(line)):
                got[len(self.cues) + j] = n
        return got

    def votes(self, got: dict[int, int]) -> np.ndarray:
        out = np.zeros(len(self.names))
        for i in got:
            out[self.voter[i]] = 1.0
        return out

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(votes @ self.vote_weight + self.vote_bias, -30, 30)))

    def row(self, got: dict[int, int]) -> np.ndarray:
        out = np.zeros(len(self.voter))
        for i, n in got.items():
            out[i] = np.log1p(n)
        return out

    def score(self, text: str | None) -> float:
        z = self.bias + sum(self.weight[i] * np.log1p(n) for i, n in self.counts(text).items())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that training never sees: crc32 of the id's text, modulo 4, is 2. A null id is never learned either."""
    return F.coalesce(F.crc32(F.col(quoted(id_col)).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def _drawn(df: DataFrame, key: str, most: int, count: int) -> DataFrame:
    """About ``most`` of ``count`` rows, chosen by a hash of their id."""
    return df.where(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 20)) < int(min(1.0, most / max(count, 1)) * (1 << 20)) + 1)


def _counted(sample: DataFrame, known: set[str] | None) -> DataFrame:
    """(cue, n): the number of texts that have it."""
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column("text").to_pylist():
                seen.update(cues_of(text or "", known))
                if len(seen) > 500_000:
                    yield out(seen)
                    seen = Counter()
            yield out(seen)

    def out(seen):
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["cue", "n"])
    return sample.select("text").mapInArrow(counts, "cue string, n bigint").groupBy("cue").agg(F.sum("n").alias("n"))


def mine_cues(sample: DataFrame, toxic: int, others: int) -> list[tuple[str, int]]:
    """Cues of a labelled sample (text, toxic) that are much commoner in toxic texts: the most frequent ``CUES``."""
    if not toxic:
        return []
    bad = _counted(sample.where("toxic = 1"), None).where(F.col("n") >= max(3, toxic // 100))
    bad = {r[0]: r[1] for r in bad.orderBy(F.desc("n"), F.length("cue"), "cue").limit(CANDIDATES).collect()}
    good = {r[0]: r[1] for r in _counted(sample.where("toxic = 0"), set(bad)).collect()} if others else {}
    rate = lambda c: ((bad[c] + 0.5) / (toxic + 1)) / ((good.get(c, 0) + 0.5) / (others + 1))
    kept: dict[tuple, str] = {}
    for c in sorted(bad, key=lambda c: (-bad[c], good.get(c, 0), len(c), c)):
        if rate(c) >= LIFT:  # longer beginnings of the same words in the same texts add nothing
            kept.setdefault((bad[c], good.get(c, 0), c[:3]), c)
    return [(c.split("\t")[0], int(c.split("\t")[1])) for c in list(kept.values())[:CUES]]


def _moments(docs: DataFrame, model: Model) -> tuple[float, np.ndarray, np.ndarray]:
    """Number of documents, sums of votes, sums of products of votes; one row a task goes to the driver's sum."""
    shared, m = docs.sparkSession.sparkContext.broadcast(model), len(model.names)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros((m, m))
        for batch in batches:
            v = np.array([shared.value.votes(shared.value.counts(t)) for t in batch.column(0).to_pylist()]).reshape(-1, m)
            n += len(v)
            total += v.T @ v
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[i, -1]), pa.array(np.r_[j, -1]), pa.array(np.r_[total[i, j], n])], ["i", "j", "x"])

    got = docs.select("text").mapInArrow(sums, "i bigint, j bigint, x double").groupBy("i", "j").agg(F.sum("x")).collect()
    both, n = np.zeros((m, m)), 0.0
    for i, j, x in got:
        if i < 0:
            n = x
        else:
            both[i, j] = x
    return n, np.diag(both).copy(), both


def fit_label_model(model: Model, n: float, one: np.ndarray, both: np.ndarray) -> None:
    """Accuracies by triplets, correlations from the rest of the covariance, and the discriminant that they give."""
    mean = one / max(n, 1)
    cov = both / max(n, 1) - np.outer(mean, mean)
    m, spread = len(mean), model.prior * (1 - model.prior)
    live = np.flatnonzero(np.diag(cov) > 1e-9)
    scaled = np.zeros(m)  # accuracy times the label's deviation
    for i in live:
        found = [cov[i, j] * cov[i, k] / cov[j, k] for j in live for k in live
                 if j < k and i not in (j, k) and cov[j, k] > 1e-7 and cov[i, j] > 0 and cov[i, k] > 0]
        if found:
            scaled[i] = np.sqrt(np.median(found))
        else:  # too few voters agree with anything: trust the vote by itself
            scaled[i] = np.sqrt(spread) * 0.5 * min(1.0, mean[i] / model.prior)
    gap = np.minimum(scaled / np.sqrt(spread), np.minimum(1.0, mean / model.prior))  # P(vote | toxic) - P(vote | clean)
    rest = cov - spread * np.outer(gap, gap)
    rest[np.diag_indices(m)] = np.maximum(np.diag(rest), 0) + 0.01
    value, vector = np.linalg.eigh((rest + rest.T) / 2)
    rest = (vector * np.maximum(value, 0.01)) @ vector.T
    dev = np.sqrt(np.diag(rest))
    model.accuracy, model.correlation = gap, rest / np.outer(dev, dev)
    model.vote_weight = np.linalg.solve(rest, gap)
    middle = mean + (0.5 - model.prior) * gap
    model.vote_bias = float(-model.vote_weight @ middle + np.log(model.prior / (1 - model.prior)))


def fit_classifier(model: Model, rows: list[dict[int, int]], known: list[int | None], weights: list[float], ridge: float = 0.5) -> None:
    """Ridge logistic regression on the rows' posteriors, by damped Newton steps. A labelled row's own label is one
    more vote, of accuracy ``LABEL_ACCURACY``, and settles its posterior."""
    x = np.array([np.r_[model.row(g), 1.0] for g in rows]).reshape(-1, len(model.voter) + 1)
    y = model.posterior(np.array([model.votes(g) for g in rows]).reshape(-1, len(model.names)))
    say = np.array([0.0 if k is None else (2 * k - 1) * np.log(LABEL_ACCURACY / (1 - LABEL_ACCURACY)) for k in known])
    odds = np.clip(np.log(np.maximum(y, 1e-9) / np.maximum(1 - y, 1e-9)), -3, 3)
    y = np.where(say != 0, 1 / (1 + np.exp(-say - odds)), y)
    scale = np.array(weights)
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-4
    w = np.zeros(x.shape[1])
    w[-1] = np.log(model.prior / (1 - model.prior))
    def loss(v):
        z = x @ v
        return float(scale @ (np.logaddexp(0, z) - y * z) + 0.5 * (penalty * v * v).sum())

    now = loss(w)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (scale * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), x.T @ (scale * (p - y)) + penalty * w)
        while (then := loss(w - step)) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        w, was, now = w - step, now, then
        if was - now < 1e-7 * max(1.0, abs(now)):
            break
    model.weight, model.bias = w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Train on the rows of ``docs`` (all are training rows) and their labels."""
    rows = text_batches(docs).select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text)).alias("text"))
    known = (labels.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(label)).cast("int").alias("toxic"))
             .where("id is not null and toxic in (0, 1)").where(~held_out("id")).groupBy("id").agg(F.max("toxic").alias("toxic")))
    n = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    few = known.where("false")
    for y in n:  # a bounded sample of labels, so it may be broadcast
        few = few.union(_drawn(known.where(F.col("toxic") == y), "id", SAMPLE // 2, n[y]))
    sample = rows.join(F.broadcast(few), "id").select("text", "toxic").dropDuplicates(["text"])
    drawn = {y: min(c, SAMPLE // 2) for y, c in n.items()}
    cues = mine_cues(sample, drawn.get(1, 0), drawn.get(0, 0))
    names = [*LISTS, *PATTERNS, *(f"lexicon {i}" for i in range(LEXICONS))]
    place = {v: i for i, v in enumerate(names)}
    hand = {(f" {w} ", 1): place[k] for k, ws in LISTS.items() for w in ws}
    deal = {c: place[f"lexicon {i % LEXICONS}"] for i, c in enumerate(sorted(set(cues) - set(hand), key=lambda c: (crc32(str(c).encode()), c)))}
    every = {**deal, **hand}
    prior = float(np.clip(n.get(1, 0) / max(sum(n.values()), 1) if n else 0.1, 0.005, 0.5))
    model = Model(list(every), [*every.values(), *(place[p] for p in PATTERNS)], names, prior)
    size = rows.count()
    if not size:  # nothing to learn from
        model.weight = np.array([3.0 * (names[v] in LISTS or names[v] in PATTERNS) for v in model.voter])
        model.bias = float(np.log(prior / (1 - prior)))
        return model
    fit_label_model(model, *_moments(rows, model))
    some = _drawn(rows, "id", SAMPLE, size)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shared.value.counts(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([list(g.keys()) for g in got], pa.list_(pa.int32())),
                                              pa.array([list(g.values()) for g in got], pa.list_(pa.int32())), batch.column(1)], ["k", "v", "y"])
    fit_rows = (sample.select("text", "toxic").union(some.join(F.broadcast(few), "id", "left_anti").select("text", F.lit(None).cast("int")))
                .mapInArrow(found, "k array<int>, v array<int>, y int").collect())  # a few hits of each of 2 * SAMPLE rows
    of = {y: n[y] / max(1, sum(r[2] == y for r in fit_rows)) / max(1, sum(n.values())) for y in n}
    labelled = sum(r[2] is not None for r in fit_rows)
    weights = [UNLABELLED_WEIGHT if r[2] is None else of[r[2]] * labelled for r in fit_rows]
    fit_classifier(model, [dict(zip(r[0], r[1])) for r in fit_rows], [r[2] for r in fit_rows], weights)
    return model


def with_score(df: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``df`` plus the probability that the text is toxic."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # a few hundred cues

    @F.arrow_udf("double")
    def score(cols: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in cols:
            yield pa.array([shared.value.score(t) for t in col.to_pylist()], pa.float64())
        give_back()
    return text_batches(df).withColumn(out, score(F.col(quoted(text))))
