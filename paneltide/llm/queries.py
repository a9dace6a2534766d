"""Registered queries of the training-data operators: whole tables in, digests
of whole results out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import crosstok, decontam, langid, neardup, packing, periodic, phrases, pii, quality, secrets, suffixes, toxicity, warc
from .common import remainder_of_id, table

#: Scores from which a document counts as toxic.
TOXIC = 0.3
RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
#: Setting that names the pseudonym key; the default is for tests and demos.
KEY_SETTING, DEMO_KEY = "spark.paneltide.pii.key", "demonstration key"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), may_learn=remainder_of_id("id", 4) != 2)
    return toxicity.score(docs, model).select(
        F.col("row.doc_id").alias("doc_id"), (remainder_of_id("row.doc_id", 4) == 2).alias("held_out"), "score",
        F.when(F.col("score") >= TOXIC, 1).otherwise(0).alias("predicted"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.pack(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return pieces.select(F.col("row.doc_id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find(docs, secrets.train(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(secrets.as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        secrets.as_text(F.col("spans")).alias("spans"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.classes(docs).select(F.col("id").alias("doc_id"), "class_id", "class_size", F.col("first").alias("kept"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    q = [F.col(f"q.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return quality.judge(quality.measures(docs, model)).select("doc_id", *q, "base_failed", "kept", F.col("q.score").alias("score"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pii.pseudonymise(docs, key=spark.conf.get(KEY_SETTING, DEMO_KEY))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", "text", *[count(k) for k in pii.KINDS])


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return phrases.remove_repeats(docs).select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed",
                                               F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    benchmark = table(spark, sf_dir, "benchmark")
    found = decontam.annotate(docs, benchmark).withColumn("row", F.struct("row.doc_id"))
    found = decontam.judged(decontam.with_items(found, benchmark))
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(ids.cast("binary"), 256).alias("items_sha256"), "contaminated")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    pieces = langid.read_pieces(public_tokenizers.path(PIECES))
    model = langid.fit(docs, pieces, may_learn=remainder_of_id("id", 3) != 1)
    return langid.predict(docs.select("doc_id", "text"), pieces, model).select(
        F.col("row.doc_id").alias("doc_id"), (remainder_of_id("row.doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = crosstok.align_corpus(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, public_tokenizers.path(PIECES))
    return found.select(F.col("row.doc_id").alias("doc_id"), *crosstok.MEASURES, "n_best", "count_sum", "groups_sha256")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", periodic.planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic.find_runs(docs).select("*", periodic.longest(F.col("runs")).alias("best"))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select(F.col("row.doc_id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
                        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("kept").cast("binary"), 256).alias("collapsed_sha256"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.remove_repeats(docs).select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                                                F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_packing, op3_secrets, op4_near_duplicates, op5_quality, op6_pii, op7_substring_dedup, op8_warc,
    op9_decontamination, op10_language_id, op11_token_alignment, op12_periodic_runs, op13_suffix_dedup)}
