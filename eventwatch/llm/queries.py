"""The registered queries of the operators: thin projections of their results."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventwatch.config import ensure_utc
from eventwatch.llm import bpe, chat, decontam, langid, licenses, lines, merkle, omh, partenum, periodic, simhash, suffix, toxicity


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def op7_suffix_array(spark: SparkSession, sf: str) -> DataFrame:
    """Exact substring dedup: what goes and what stays of every document."""
    got = suffix.without_repeats(table(spark, sf, "documents").select("doc_id", "text"), kept=False)
    return got.select("doc_id", *(F.col("rest")[c].alias(c) for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")))


def op8_licenses(spark: SparkSession, sf: str) -> DataFrame:
    """License detections of every document; places of the base phrases."""
    got = licenses.with_licenses(table(spark, sf, "documents").select("doc_id", "text"))
    c = F.col("licenses")
    base = c["base"]["label"]
    return got.select("doc_id", c["n_words"].alias("n_words"), F.size(c["base"]).cast("bigint").alias("n_base"),
                      F.array_min(c["base"]["start"]).alias("first_word"), F.array_max(c["base"]["start"]).alias("last_word"),
                      licenses.joined(base).alias("base_labels"),
                      licenses.joined(F.concat(base, c["detections"]["label"])).alias("labels"),
                      F.coalesce(F.array_max(c["detections"]["score"]), F.lit(0.0)).alias("score"))


def op9_simhash(spark: SparkSession, sf: str) -> DataFrame:
    """SimHash near-duplicates: fingerprint and component of every document."""
    got = simhash.near_duplicates(table(spark, sf, "documents"), keep=["doc_id"])
    return got.select("doc_id", simhash.hex_fingerprint("fingerprint").alias("fingerprint"), "component_id")


def op1_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Byte-level BPE of every document, and the round trip back to bytes."""
    got = bpe.with_token_digest(table(spark, sf, "documents").select("doc_id", "text"),
                                public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return got.select("doc_id", "bpe.n_tokens", "bpe.ids_sha256", "bpe.decoded_sha256")


def op2_chat(spark: SparkSession, sf: str) -> DataFrame:
    """Chat formatting of every conversation and of one with control strings in its texts; all read back."""
    turn = F.col("id")
    more = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), turn.alias("turn"),
                                 F.when(turn == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    got = chat.format_chat(turns.withColumn("parts", chat.text_part(F.col("text"))))
    read = F.array_join(F.transform(chat.read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.read_loss(F.col("formatted"), F.col("loss"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return got.select("conv_id", F.size(chat.read_turns(F.col("formatted"))).cast("bigint").alias("n_turns"), sha(read).alias("turns_sha256"),
                      F.length(loss).cast("bigint").alias("loss_chars"), sha(loss).alias("loss_sha256"),
                      F.length("formatted").cast("bigint").alias("formatted_chars"))


def op3_order_minhash(spark: SparkSession, sf: str) -> DataFrame:
    """Order MinHash of every document and of its edited text; likeness to the edited text and the next document."""
    got = omh.with_neighbours(table(spark, sf, "documents"))
    f = F.col("fingerprint")
    return got.select(F.col("id").alias("doc_id"), F.length("text").cast("bigint").alias("n_chars"),
                      F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), f, "edited_fingerprint",
                      omh.likeness(f, F.col("edited_fingerprint")).alias("near_edited"), omh.likeness(f, F.col("next_fingerprint")).alias("near_next"))


def op4_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line dedup: lines of every document, those cut as cross-site boilerplate, and what is left."""
    got = lines.with_kept_lines(table(spark, sf, "documents").select("doc_id", "text", "source"))
    c = F.col("lines")
    return got.select("doc_id", c["n_lines"].alias("n_lines"), c["n_removed"].alias("n_removed"),
                      F.sha2(F.coalesce(c["kept"], F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of every document, learned from the documents and labels that are not held out."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs.where(~toxicity.held_out()), table(spark, sf, "labels"))
    got = toxicity.with_score(docs, model, out="score")
    return got.select("doc_id", toxicity.held_out().alias("held_out"), "score",
                      F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark decontamination: hit words and items of every document."""
    got = decontam.with_hits(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))
    n = decontam.n_hit()
    return got.select("doc_id", F.col("hits.n_words").alias("n_words"), n.alias("n_hit"),
                      F.size("hits.items").cast("bigint").alias("n_items"), decontam.digest("hits.items").alias("items_sha256"),
                      (n > 0).alias("contaminated"))


def op10_language(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    docs = table(spark, sf, "documents")
    model = langid.fit_on_training_rows(docs)
    got = langid.with_language(docs.select("doc_id", "text"), model)
    return got.select("doc_id", langid.held_out().alias("held_out"), F.col("language.lang").alias("lang_pred"),
                      F.col("language.score").alias("score"))


def op11_partenum(spark: SparkSession, sf: str) -> DataFrame:
    """Similarity join on four-word shingles: set size and component of every document."""
    return partenum.similar_texts(table(spark, sf, "documents"))


def op12_merkle(spark: SparkSession, sf: str) -> DataFrame:
    """Merkle manifest of the documents, and what becomes of the root where a text loses its line ends."""
    docs = table(spark, sf, "documents")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(hit, F.translate("text", "\n", "")).otherwise(F.col("text"))
    got = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], changed={"text": tampered})
    named = {"leaf": "leaf", "subroot": "subroot", "root": "root", "proof": "proof_sha256", "folded": "folded_root"}
    return got.select(F.col("id").alias("doc_id"), *[merkle.hex_digest(F.col(c)).alias(n) for c, n in named.items()],
                      (F.col("folded") == F.col("root")).alias("verified"))


def op13_periodic(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of repeated words of every document, some with a planted repetition, and the texts with runs collapsed."""
    docs = periodic.with_probe(table(spark, sf, "documents").select("doc_id", "text"))
    got = periodic.with_runs(docs.select("doc_id", "probe"), "probe")
    runs = F.col("runs.runs")
    return (got.withColumn("best", periodic.longest(runs))
            .select("doc_id", F.size(runs).cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
                    periodic.digest(runs).alias("runs_sha256"), F.sha2(F.col("runs.collapsed").cast("binary"), 256).alias("collapsed_sha256")))


QUERIES = {"op1_bpe": op1_bpe, "op2_chat": op2_chat, "op3_order_minhash": op3_order_minhash, "op4_lines": op4_lines,
           "op5_toxicity": op5_toxicity, "op6_decontamination": op6_decontamination, "op7_suffix_array": op7_suffix_array, "op8_licenses": op8_licenses, "op9_simhash": op9_simhash, "op10_language": op10_language,
           "op11_partenum": op11_partenum, "op12_merkle": op12_merkle, "op13_periodic": op13_periodic}
ORACLES: dict[str, str] = {"op2_chat": chat.ORACLE, "op4_lines": lines.ORACLE, "op6_decontamination": decontam.ORACLE,
                           "op12_merkle": merkle.ORACLE}
