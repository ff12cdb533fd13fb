"""Language identification with language-bitmask n-gram filters.

Training counts the byte n-grams of a bounded sample of labelled texts (about ``SAMPLE_TEXTS`` a language, chosen
by a hash of the row's id; a documented bound of the training sample only). Every language keeps its most frequent
n-grams among those that it uses at a fair rate against the other languages. They go into one bit-sliced Bloom filter: slot j of
the filter holds a bitmask of languages, so a lookup (the AND of two slots) returns all languages that contain an
n-gram at once. A text's n-grams are looked up together; the popcount of each language's bit, corrected for the
language's false-positive rate, decides.

Defined cases: a null text, or one without a letter (a character of Unicode category L; digits, number forms and
fractions are none), is ``und`` with score 0 and evidence 0; a text with a letter but
without any known n-gram gets the language with most training texts, score 0; ties go to the first language in
alphabetical order; texts shorter than an n-gram are padded with spaces; null labels are not learned; with no
labelled text at all every text is ``und``. Repeated rows keep their rows; very long texts are looked up in pieces; an empty
table gives an empty result; a column that has the name of ``out`` stays, the new one takes the next free name (``free_name``).
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventwatch.config import materialize
from eventwatch.llm.common import free_name, give_back, quoted, text_batches

UND = "und"
GRAM = 5                 # bytes of an n-gram
SAMPLE_TEXTS = 3000      # labelled texts of each language to learn from, about
GRAMS = 30_000           # n-grams that a language keeps
RATE = 0.5               # an n-gram belongs to every language that uses it at this rate of its heaviest user
SLOTS = 1 << 19          # slots of the filter
REJECT_EVIDENCE = 0.05   # see ``speaks``

_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
#: ASCII bytes that are not letters become a space; the text is lower-cased before.
_PLAIN = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_RUNS = re.compile(rb"  +")


def grams(text: str) -> np.ndarray:
    """The n-grams of a text as numbers: lower case, words set apart by one space."""
    b = _RUNS.sub(b" ", b" " + text.lower().encode().translate(_PLAIN) + b" ").ljust(GRAM)
    a = np.frombuffer(b, np.uint8)
    out = a[:len(a) - GRAM + 1].astype(np.uint64)
    for i in range(1, GRAM):
        out = (out << np.uint64(8)) | a[i:len(a) - GRAM + 1 + i]
    return out


def _slots(g: np.ndarray) -> list[np.ndarray]:
    shift = np.uint64(64 - int(SLOTS).bit_length() + 1)
    return [((g * m) >> shift).astype(np.int64) for m in _MULTIPLIERS]


@dataclass
class Filter:
    """Bit-sliced Bloom filter: ``slots[j, w]`` holds the bits of languages 8w to 8w+7."""

    languages: list[str]
    slots: np.ndarray
    false_positive: np.ndarray
    fallback: str

    @classmethod
    def build(cls, kept: dict[str, np.ndarray], fallback: str) -> "Filter":
        languages = sorted(kept)
        slots = np.zeros((SLOTS, (len(languages) + 7) // 8 or 1), np.uint8)
        fp = np.zeros(len(languages))
        for i, name in enumerate(languages):
            at = np.unique(np.concatenate(_slots(kept[name].astype(np.uint64))))
            slots[at, i // 8] |= np.uint8(1 << i % 8)
            fp[i] = (len(at) / SLOTS) ** len(_MULTIPLIERS)
        return cls(languages, slots, fp, fallback)

    def share(self, text: str) -> np.ndarray:
        """For every language, the share of the text's n-grams that it contains, corrected for false positives."""
        total, ones = 0, np.zeros(self.slots.shape[1] * 8, np.int64)
        for part in _parts(text):
            g = grams(part)
            one, two = _slots(g)
            mask = self.slots[one] & self.slots[two]
            total += len(g)
            for w in range(mask.shape[1]):
                by_value = np.bincount(mask[:, w], minlength=256)
                ones[8 * w:8 * w + 8] += by_value @ _BITS
        return np.clip((ones[:len(self.languages)] / max(total, 1) - self.false_positive) / (1 - self.false_positive), 0, 1)

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score (share of the winner's evidence), evidence (the winner's corrected share of n-grams)."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UND, 0.0, 0.0
        x = self.share(text)
        best = int(np.argmax(x))
        if x[best] <= 0:
            return self.fallback, 0.0, 0.0
        return self.languages[best], float(x[best] / x.sum()), float(x[best])


#: _BITS[v, i]: bit i of byte v.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _parts(text: str, size: int = 1 << 20) -> Iterator[str]:
    """Bounded pieces of a very long text."""
    for i in range(0, len(text), size):
        yield text[i:i + size]


def _by_language(batch: pa.RecordBatch, most: int = 1 << 21) -> Iterator[tuple[str, list[np.ndarray]]]:
    """Each language's n-grams, in portions of about ``most``."""
    held: dict[str, list[np.ndarray]] = {}
    size: dict[str, int] = {}
    for name, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
        for part in _parts(text):
            held.setdefault(name, []).append(grams(part))
            size[name] = size.get(name, 0) + len(held[name][-1])
            if size[name] >= most:
                yield name, held.pop(name)
                size[name] = 0
    yield from held.items()


def fit(df: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id") -> Filter:
    """Learn from the labelled rows of ``df``: one scan counts them and one reads the sample, for any number of languages. Only one row a language, and the kept n-grams, reach the driver."""
    rows = text_batches(df).where(F.col(quoted(lang)).isNotNull() & F.col(quoted(text)).isNotNull()).select(
        F.col(quoted(lang)).cast("string").alias("lang"), F.col(quoted(text)).alias("text"),
        F.pmod(F.xxhash64(F.col(quoted(id_col)).cast("string")), F.lit(1 << 20)).alias("draw"))
    count = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not count:
        return Filter.build({}, UND)
    cut = F.create_map(*[F.lit(x) for k, n in count.items() for x in (k, int(min(1, SAMPLE_TEXTS / n) * (1 << 20)) + 1)])
    sample = rows.where(F.col("draw") < cut[F.col("lang")]).select("lang", "text")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, parts in _by_language(batch):
                g, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(g)), pa.array(g.view(np.int64)), pa.array(n)], ["lang", "g", "n"])
        give_back()

    found = materialize(sample.mapInArrow(counts, "lang string, g bigint, n bigint").groupBy("lang", "g").agg(F.sum("n").alias("n")).where("n >= 3"))
    total = {r[0]: r[1] for r in found.groupBy("lang").agg(F.sum("n")).collect()}
    if not total:
        return Filter.build({}, UND)
    rate = F.create_map(*[F.lit(x) for k, n in total.items() for x in (k, 1.0 / n)])
    by_gram = (found.withColumn("rate", F.col("n") * rate[F.col("lang")])
               .groupBy("g").agg(F.max("rate").alias("most"), F.collect_list(F.struct("lang", "n", "rate")).alias("uses")))
    fair = materialize(by_gram.select("g", "most", F.explode("uses").alias("u")).where(F.col("u.rate") >= RATE * F.col("most"))
                       .select("g", F.col("u.lang").alias("lang"), F.col("u.n").alias("n")))
    kept = {}
    for name in sorted(total):  # a few languages: each a distributed top-k
        top = fair.where(F.col("lang") == name).orderBy(F.desc("n"), "g").limit(GRAMS).select("g").toArrow()
        kept[name] = top.column("g").to_numpy().view(np.uint64)
    return Filter.build(kept, min(count, key=lambda k: (-count[k], k)))


def with_language(df: DataFrame, model: Filter, text: str = "text", out: str = "language") -> DataFrame:
    """``df`` plus a struct: lang, score, evidence."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # SLOTS bytes for each 8 languages

    @F.arrow_udf("struct<lang:string,score:double,evidence:double>")
    def identify(cols: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in cols:
            got = [shared.value.predict(t) for t in col.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                                              pa.array([g[2] for g in got], pa.float64())], ["lang", "score", "evidence"])
        give_back()
    return text_batches(df).withColumn(free_name(df, out), identify(F.col(quoted(text))))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that training never sees: crc32 of the id's text, modulo 5, is 0. A null id is never learned either."""
    return F.coalesce(F.crc32(F.col(quoted(id_col)).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit_on_training_rows(df: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id") -> Filter:
    return fit(df.where(~held_out(id_col)), text, lang, id_col)


def unjudged(text: str = "text") -> Column:
    """Texts that are shorter than an n-gram once words are set apart: there is nothing to look up."""
    apart = F.regexp_replace(F.concat(F.lit(" "), F.lower(F.col(quoted(text))), F.lit(" ")), r"[\x00-\x60\x7B-\x7F]+", " ")
    return F.octet_length(apart) < GRAM


def speaks(language: str = "language", text: str = "text") -> Column:
    """Texts that are in some language: not ``und``, and with evidence for the predicted one where they have an n-gram."""
    c = F.col(language)
    return (c["lang"] != UND) & ((c["evidence"] >= REJECT_EVIDENCE) | unjudged(text))
