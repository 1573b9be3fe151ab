"""The corpus pipeline: operators in a row, each working on all that the one before it kept.

Every stage takes and gives documents (doc_id, text, lang, source, n_chars, and any further columns), but for
the last, which gives tokens.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vinlake.llm import bpe, mixing, pii, simhash, toxicity
from vinlake.llm.common import stored, table
from vinlake.llm.queries import BYTE_VOCABULARY
from vinlake.operators.joins import left_join_splittable


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold.

    NULL and empty texts stay: nothing in them is toxic. Without labels nothing is learned, so all stay.
    """
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels)
    if not len(model[0]):
        return docs
    score = toxicity.scorer(docs, model)
    clean = (toxicity.predicted(score(F.col("text"))) == 0) | (F.coalesce(F.length("text"), F.lit(0)) == 0)
    return docs.filter(clean)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id, the first of them if it repeats.

    Rows are numbered, so that repeated and NULL ids leave exactly one row of a group as well.
    """
    place = F.struct(F.col("doc_id").isNull(), "doc_id", F.monotonically_increasing_id())
    # The row travels whole in one column, so names of its columns cannot clash with those used here.
    numbered = stored(docs.select(place.alias("place"), F.struct("*").alias("row")), "numbered")
    groups = simhash.near_duplicates(numbered, "place", "row.text")
    kept = groups.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("place"))
    return left_join_splittable(numbered, kept, "place", "left_semi").select("row.*")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind; n_chars follows the text."""
    masked = pii.mask(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: up to three times, or not at all."""
    return mixing.repeated(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as tokens: doc_id, source, ids (four little-endian bytes each) and their number."""
    ids = bpe.encode(F.col("text"), BYTE_VOCABULARY)
    packed = docs.select("doc_id", "source", ids.alias("ids"))
    return packed.withColumn("n_tokens", bpe.token_count(F.col("ids")))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode),
]
# No SQL: the trained models and the seeded mix have no counterpart in it. See tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
