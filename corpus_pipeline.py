"""A corpus from raw documents to packed sequences, in five stages over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from buzzmill.llm import classifier, mixing, packing, pii, setjoin
from buzzmill.llm.queries import table, tokenizer_path
from buzzmill.llm.shared import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts as bad go; it learns from the labels of these documents that are not held out."""
    return classifier.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a Jaccard similarity of 0.8 of five-word shingles, the one with the least id stays."""
    return setjoin.deduplicate(docs, percent=80, size=5)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind in brackets."""
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources meet their targets: documents are dropped, repeated, or cut at a threshold."""
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of 4096. Workers remember fewer words than alone, as they keep the memory of all stages."""
    return packing.pack(docs, tokenizer_path(), cached_words=250_000)


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("PII", personal_data), ("mixing", mixture), ("packing", sequences)]

#: Classifier, graph components and tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{k}")
    return docs
