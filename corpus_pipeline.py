"""The corpus pipeline: language ID, exact dedup, near-dedup, decontamination, tokens.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its
predecessor kept, read back from Parquet.  All but the last return the
columns of ``docs``; the last returns ``doc_id``, ``n_tokens``,
``ids_sha256`` and ``decoded_sha256``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermon.llm import bpe, decontaminate, exact, langid, simhash
from lettermon.llm.queries import table, tokenizer_path
from lettermon.llm.scratch import materialise

#: No SQL: language models, fingerprints and tokens are not expressible in it.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without any letter, and null texts,
    are rejected.  Ambiguous answers are kept: a short or mixed text is no
    reject.  Without a single labelled row nothing can be told and only
    texts without a letter go."""
    model = langid.learn(docs.where(~langid.held_out()))
    if not model.languages:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return docs.where(langid.predicted(F.col("text"), model)["lang_pred"] != langid.UNKNOWN)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null counts as empty) the longest original, then the
    smallest id, null last; of repeated rows the first stored.  Very long
    texts are compared whole; an empty table stays empty; all columns stay."""
    return exact.exact_survivors(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group (3-word shingles, 2 bits) the smallest id, null
    last; of repeated rows the first stored.  Null and blank texts are one
    group; very long texts are read whole; an empty table stays empty; all
    columns stay."""
    return simhash.simhash_survivors(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark.  Null and empty texts
    contain none; very long texts are searched whole; repeated rows go or
    stay together; without items all stay; all columns stay."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what remains, a row per row; a null text
    counts as empty, very long ones are encoded whole."""
    return bpe.encode_round_trip(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE encoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
