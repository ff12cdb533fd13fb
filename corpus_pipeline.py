"""A training corpus from raw documents: five stages, each one of the operators of ``eventwatch.llm``.

Every stage reads the documents that the one before kept, as a Parquet table, and its decisions take effect:
documents that speak no language go; lines that many sites carry are cut; one document of each near-duplicate group
stays; passages of the benchmark are cut, and documents that are mostly benchmark go; what is left is encoded.
All stages but the last return the columns of ``documents``. Null and empty texts are rejected by the first stage;
clashing or extra columns are carried through.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventwatch.config import ensure_utc, materialize
from eventwatch.llm import bpe, decontam, langid, lines, simhash
from eventwatch.llm.common import free_name, quoted


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language (10)."""
    name = free_name(docs, "language")
    model = langid.fit_on_training_rows(docs)
    return langid.with_language(docs, model, out=name).where(langid.speaks(name)).select(*map(quoted, docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cross-site boilerplate lines are cut (4)."""
    return lines.remove_boilerplate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (9)."""
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut (6)."""
    return decontam.remove_hits(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the digests of their tokens (1)."""
    name = free_name(docs, "bpe")
    got = bpe.with_token_digest(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, out=name)
    new = [F.col(name)[c].alias(free_name(docs, c)) for c in ("n_tokens", "ids_sha256", "decoded_sha256")]
    return got.select(*map(quoted, docs.columns), *new)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language), ("line dedup", line_dedup), ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate), ("byte-level BPE", encode)]

#: A trained language model decides in the first stage: SQL cannot express it (tests/llm holds a plain version).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each result written as a table and read again."""
    ensure_utc(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
