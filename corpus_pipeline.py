"""Prepares a corpus: language, near copies, benchmark passages, personal data, tokens.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of docs.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duoscope.llm import automaton, bpe, language, minhash, pii

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
#: Columns that stages read; all others are carried along under numbers.
READ = ("doc_id", "text", "lang")


def carrying(stage):
    """The stage with its other columns renamed by position, so that no name of theirs clashes or needs quotes."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        plain = [name if name in READ else f"carried_{k}" for k, name in enumerate(names)]
        return stage(spark, docs.toDF(*plain), sf_dir).toDF(*names)

    return run


@carrying
def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which at least one language is identified, be they mixtures; the others go:
    null and empty texts and those without a letter. Rows that repeat stay, null ids too. A
    table that teaches no language, all ``lang`` being null, loses nothing."""
    langs, model = language.train(docs)
    if not langs:
        return docs
    judged = language.with_languages(docs, langs, model)
    known = F.col(language.ANSWER)["lang_pred"] != language.UNKNOWN
    return judged.filter(known).drop(language.ANSWER)


@carrying
def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id; of equal rows one.
    Texts without words, null and empty ones too, are no copies and stay."""
    return minhash.deduplicated(docs)


@carrying
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of ``benchmark``; mostly contaminated ones go. Rows without
    words, null and empty texts too, stay, as do rows that repeat."""
    return automaton.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@carrying
def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with marks in the place of personal data; null and empty texts and rows that
    repeat stay as they are."""
    return pii.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and ``text``, the text that the ids stand for. A null text
    has no ids and becomes empty; other columns are left out, rows that repeat stay."""
    ranks = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    tokens = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    return bpe.decode(tokens, ranks, public_tokenizers.PATTERN).selectExpr(
        "doc_id", "n_tokens", "ids", "decode(bytes, 'utf-8') as text"
    )


STAGES = [
    ("language", identified),
    ("near_copies", deduplicated),
    ("benchmark", decontaminated),
    ("personal_data", redacted),
    ("tokens", encoded),
]
#: No stage but the filters on its columns can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
