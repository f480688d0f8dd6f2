"""Corpus pipeline: quality, near duplicates, contamination, personal data, packing.

``STAGES`` lists (name, function) in order. A function takes (spark, docs, sf_dir) and returns a
DataFrame; ``run`` writes each result as Parquet in the shared scratch folder and reads it back as
the next stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import common, decontaminate, ngram_join, packing, pii, quality
from ledgerspark.llm.queries import PII_KEY, word_bpe


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    labels = common.table(spark, sf_dir, "labels")
    scored = quality.classify(docs, labels, keep=docs.columns)
    return scored.where("predicted = 1").select(*[f"`{c}`" for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; documents without words all stay."""
    numbered = common.stored(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    gone = ngram_join.near_duplicates(numbered, row="_row").where(~F.col("stays"))
    return numbered.join(gone.select(F.col("row").alias("_row")), "_row", "left_anti") \
        .select(*[f"`{c}`" for c in docs.columns])


def free_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.md5(F.col("text")))
    found = decontaminate.contamination(docs.select(key.alias("doc_id"), "text"),
                                        common.table(spark, sf_dir, "benchmark"))
    bad = found.where("n_hit > 0").select(F.col("doc_id").alias("_key")).distinct()
    return docs.withColumn("_key", key).join(bad, "_key", "left_anti") \
        .select(*[f"`{c}`" for c in docs.columns])


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data replaced by pseudonyms; n_chars follows the text."""
    out = pii.pseudonymise(docs, PII_KEY)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[f"`{c}`" for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset."""
    return packing.pack_documents(docs, word_bpe())


STAGES = [
    ("quality", good_quality),
    ("near duplicates", one_of_each_group),
    ("decontamination", free_of_benchmark),
    ("personal data", without_personal_data),
    ("packing", packed),
]

#: The stages run models and hashing that DuckDB SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
