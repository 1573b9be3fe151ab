"""One query per operator, each over its whole table, and the SQL of those that SQL can express."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vinlake.llm import bpe, langid, mixing, neighbours, ordinal, outliers, phrases, pii, simhash, suffixes, toxicity, urls, whitening
from vinlake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every text encoded and decoded again, as digests."""
    encoded = bpe.encode_documents(table(spark, folder, "documents"), BYTE_VOCABULARY)
    return encoded.select(
        "doc_id",
        bpe.token_count(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_langid(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every text."""
    return langid.identify(table(spark, folder, "documents"), PIECES)


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and group of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op5_ordinal(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade and tail probability of every text, learned from the labels of three quarters of the ids."""
    return ordinal.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every text."""
    return outliers.judge(table(spark, folder, "documents"))


def op7_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Links and group of every vector."""
    return neighbours.near_duplicates(table(spark, folder, "embeddings"))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every text."""
    found = pii.find(table(spark, folder, "documents"))
    numbers = [f"n_{kind}" for kind in pii.KINDS]
    return found.select("doc_id", *numbers, F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Probability that a document is toxic, learned from the labels of three quarters of the ids."""
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Parts, rule and verdict of every page's URL."""
    return urls.judge(table(spark, folder, "pages"), table(spark, folder, "labels"))


def op11_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every text without the passages that occur twice."""
    found = suffixes.cut_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector on the eight largest principal components, scaled to unit variance."""
    return whitening.whiten(table(spark, folder, "embeddings"))


def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 best collocations of every language."""
    return phrases.mine(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_bpe": op1_bpe,
    "op2_mixing": op2_mixing,
    "op3_langid": op3_langid,
    "op4_simhash": op4_simhash,
    "op5_ordinal": op5_ordinal,
    "op6_outliers": op6_outliers,
    "op7_neighbours": op7_neighbours,
    "op8_pii": op8_pii,
    "op9_toxicity": op9_toxicity,
    "op10_urls": op10_urls,
    "op11_suffixes": op11_suffixes,
    "op12_whitening": op12_whitening,
    "op13_phrases": op13_phrases,
}
ORACLE_SQL: dict[str, str] = {"op13_phrases": phrases.SQL}
