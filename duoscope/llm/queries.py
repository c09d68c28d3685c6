"""The queries of the text operators and their SQL counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duoscope.llm import (
    automaton,
    bpe,
    counts,
    language,
    licences,
    minhash,
    pii,
    ppm,
    repeats,
    runs,
    simhash,
    urls,
    variants,
)
from duoscope.llm.common import crc_mod, documents, id_text

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
VOCABULARY = "word_bpe_49k.json"
#: Texts with more tokens are over the limit.
TOKEN_LIMIT = 2048


def op1_licence_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(documents(spark, sf_dir), licences.known(spark))
    return found.select("doc_id", "text_digest", "licence", F.concat_ws(",", "notices").alias("notices"))


def op2_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir))
    counts = [
        F.size(F.filter(F.col("base.kind"), F.lit(k).eqNullSafe)).cast("long").alias(f"n_{kind}")
        for k, kind in enumerate(pii.KINDS)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.spans_text("base").cast("binary"), 256).alias("base_sha256"),
        pii.spans_text("spans").alias("spans"),
    )


def op3_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    scanned = automaton.scan(documents(spark, sf_dir).select("doc_id", "text"), items)
    return scanned.select(
        "doc_id",
        F.col(automaton.WORDS).alias("n_words"),
        automaton.hit_words().alias("n_hit"),
        F.size(automaton.ITEMS).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(automaton.ITEMS)).cast("binary"), 256).alias("items_sha256"),
        (F.size(automaton.SPANS) > 0).alias("contaminated"),
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    encoded = bpe.encode(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks, public_tokenizers.PATTERN).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op5_partial_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(
        "doc_id", "text", (crc_mod("doc_id", 10) != 0).alias("training")
    )
    return ppm.score(docs, "training").select(
        "doc_id",
        (~F.col("training")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
        "n_bytes",
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprints(documents(spark, sf_dir))


def op7_merged_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(documents(spark, sf_dir))


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "lang", "text"
    )
    langs, model = language.train(docs.filter("not held_out"))
    judged = language.predict(docs.select("doc_id", "held_out", "text"), langs, model)
    return judged.select("doc_id", "held_out", f"{language.ANSWER}.*")


def op9_association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels belong to the page with the same id: toxic or low quality ones are to be blocked."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(
        F.col("doc_id").alias("page_id"),
        ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("blocked"),
    )
    mined = urls.mine(pages.join(labels, "page_id").select("url", "blocked"))
    return urls.judge(pages, mined).withColumn("mined", F.concat_ws(" ", "mined"))


def op10_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(documents(spark, sf_dir))


def op11_synchronised_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth document by the crc32 of its id ends in repeats of a stretch of its own."""
    h = F.crc32(id_text().cast("binary"))
    g = F.floor(h / 10)

    def first(n: Column) -> Column:
        return F.when(n > 0, g % n).otherwise(0)

    def period(n: Column) -> Column:
        return 1 + F.floor((n - first(n)) / (3 + g % 8))

    edited = F.when(h % 10 == 0, runs.with_repeated_words(F.col("text"), first, period)).otherwise(F.col("text"))
    found = runs.periodic_runs(documents(spark, sf_dir).select("doc_id", edited.alias("text")))
    best = found.withColumn("best", runs.best_run())
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(runs.runs_text().cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_prefix_suffix_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.count_words(documents(spark, sf_dir), misspelt=variants.MISSPELT)
    return variants.spelling_groups(words)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = counts.read_vocabulary(public_tokenizers.path(VOCABULARY))
    return counts.count_tokens(documents(spark, sf_dir), vocabulary).withColumn(
        "over_limit", F.col("n_tokens") > TOKEN_LIMIT
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_licence_digests,
        op2_contextual_pii,
        op3_suffix_automaton,
        op4_byte_bpe,
        op5_partial_matching,
        op6_simhash,
        op7_merged_transforms,
        op8_language_mixture,
        op9_association_rules,
        op10_dart_minhash,
        op11_synchronised_runs,
        op12_prefix_suffix_variants,
        op13_token_counts,
    )
}
ORACLES: dict[str, str] = {op1_licence_digests.__name__: licences.scan_sql()}
