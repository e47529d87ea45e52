"""A corpus pipeline of the operators in ``clientele.llm``.

``STAGES`` are applied in order; each reads what the one before has written. All but the
last return the columns of documents. Nulls, empty and repeated rows are treated as the
stages' operators say; an empty table comes out as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm.containment import drop_contaminated
from clientele.llm.gray_index import keep_one_of_each
from clientele.llm.line_dedup import drop_repeated_lines
from clientele.llm.line_frequency import keep_good_documents
from clientele.llm.packing import pack_documents
from clientele.llm.scratch import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the others stay whole."""
    return keep_good_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id has, too, go; ``n_chars`` follows the text.
    A document that loses all its lines stays with an empty text."""
    kept = drop_repeated_lines(docs)
    if "n_chars" in kept.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast("bigint"))
    return kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by four-word shingles and at most four
    bits of the SimHash, stays, the one with the smallest id."""
    return keep_one_of_each(docs, words=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 1024 tokens; one row per piece."""
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-duplicate removal", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: SQL has no tokenizer, fingerprints or packing; a test holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table, each written and read back by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "_"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
