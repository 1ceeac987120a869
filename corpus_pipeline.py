"""A corpus pipeline: stages over the documents, each written and read again by the next.

In every stage rows that repeat an id are documents of their own, null ids are ids like others, columns beside
doc_id and text pass through whatever their names (the last stage gives columns of its own), and an empty table gives an
empty one. A null text has no letter, so it ends at the first stage; the stages after it say what they do with one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import bpe, ecoc, line_dedup, ngram_join, wu_manber
from tickloom.llm.sieve import fresh
from tickloom.session import apply_settings, materialise

# Near copies: words of a shingle, and the least similarity in percent.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without a letter and ambiguous ones go.

    The training rows of the model are the documents themselves, outside the held-out fold, with a lang and a text. A document's lang
    stays as it was given. Null and empty texts go; without a training row all go. Copies are told alike.
    """
    apply_settings(spark)
    model = ecoc.fit(docs.where(ecoc.fold("doc_id") != 2))
    clash = [c for c in docs.columns if c in ("lang_pred", "score", "ambiguous")]
    names = dict(zip(clash, fresh(docs.columns, *clash)))
    told = ecoc.predict(docs.withColumnsRenamed(names), model)
    kept = told.where((F.col("lang_pred") != ecoc.UNKNOWN) & ~F.col("ambiguous"))
    return kept.select(*(F.col(names.get(c, c)).alias(c) for c in docs.columns))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat another line of the corpus; documents of which nothing is left go.

    n_chars, where there is one, is that of the shortened text. Null and empty texts have no line and stay. Of
    equal and of similar lines the one of the smallest document id (null first) and number stays.
    """
    apply_settings(spark)
    cut = line_dedup.clean_documents(docs)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id (null last), one of those that repeat it.

    Texts without a word, null ones too, are near nothing and stay.
    """
    apply_settings(spark)
    return ngram_join.keep_one(docs, width=NEAR_WORDS, percent=NEAR_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage occurs; null and empty texts hold none and stay, copies go together."""
    apply_settings(spark)
    return wu_manber.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, with digests of the ids and of what they decode to; a null or empty text has no id.

    Rows are doc_id, lang, source, ids, n_tokens and the digests; other columns are left behind.
    """
    apply_settings(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = docs.select("doc_id", "lang", "source", "text")
    return bpe.digests(bpe.encode(docs, path, public_tokenizers.PATTERN, decoded="decoded")).drop("decoded")


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_copies", near_copies),
    ("decontaminate", decontaminate),
    ("tokens", tokens),
]

# Classifier and tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    name, stage = STAGES[-1]
    return materialise(stage(spark, docs, sf_dir), name)
