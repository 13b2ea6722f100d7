"""The registered queries of the operators, one per operator, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import balltree, bpe, decontaminate, exact, hilbert, html, langid, licenses, phrases, simhash, toolchat, toxicity, urls

# Rules for parts of sites.
URL_RULES = (
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer file: in ``$TOKENIZER_DIR`` if that is set, else where its package has it."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hex64(value):
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's labelled outcome is the ``labels`` row of its id."""
    return urls.filter_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES,
                            suffixes=urls.PUBLIC_SUFFIXES)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_main_text(table(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a test item: lower-cased words of letters and
    digits, shingles of five words, containment of 0.8 or more."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "shared", "shingles", "containment")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return groups.select("doc_id", hex64("fp").alias("fingerprint"), "component_id")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toolchat.format_chats(table(spark, sf_dir, "conversations"))


def op10_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = hilbert.shard_documents(table(spark, sf_dir, "documents"), shards=8)
    return shards.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_license_scan, op2_url_filter, op3_exact_dedup, op4_html_extraction, op5_decontamination, op6_language_id,
        op7_simhash, op8_bpe, op9_chat_formatting, op10_hilbert_sharding, op11_ranked_search, op12_toxicity,
        op13_phrases)
}
