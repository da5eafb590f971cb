"""A training corpus from documents: language, near-duplicates, repeated passages, mix, tokens.

Every stage is written as Parquet and read again before the next one, so a lost executor costs
a stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from calibra.functions.sizing import scratch_path
from calibra.llm import bpe, language, mixing, simhash, substring_dedup
from calibra.llm.queries import LANGUAGES


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, with the language that was found.

    A null or empty text and one without letters has no language and goes; rows that repeat are judged
    each; a missing tag or source is no evidence; other columns stay as they are; no rows give no rows.
    """
    out, names = language.identify(docs, declared="lang", host="source", languages=LANGUAGES)
    out = out.where(names["accepted"])
    return out.select(*[F.col(names["language"]).alias(c) if c == "lang" else F.col(c) for c in docs.columns])


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Texts without words are alike and so one group; rows that repeat an id are one document, and one of them
    stays; a row without id links with nothing and stays; texts are compared whole; no rows give no rows.
    """
    return simhash.simhash_dedup(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document keeps; a text that is wholly cut goes.

    Earlier is the smaller id, a missing one comes last, and rows that repeat an id cut nothing of each
    other. Null and empty texts stay; ``n_chars`` of a cut text is its new length; no rows give no rows.
    """
    out, names = substring_dedup.dedup_substrings(docs)
    spans = F.col(names["spans"])
    out = out.where((F.size(spans) == 0) | (F.length(F.trim("text")) > 0))
    cut = F.when(F.size(spans) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", cut).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, three times at most.

    A missing source is one of its own, the last; a text without words has size 0 and is taken as its
    source's offset falls; rows that repeat an id are documents each; no rows give no rows.
    """
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix and the text they decode to, a row for each time it is taken.

    A null text counts as empty: no ids, and an empty decoded text; a missing id stays missing; columns
    but id and text are left behind; no rows give no rows.
    """
    return bpe.encode(docs, decoded=True)


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substrings),
    ("mixing", mix),
    ("bpe", encode),
]

# Models, rolling hashes and tokenizers are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a row per document taken, with its ids and their decoded text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
