"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buzzmill.llm import ann, classifier, fingerprints, mixing, packing, pii, resampling, rules, search, setjoin, suffix_dedup, token_counts, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The vocabulary's place, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))[0]


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.join_components(table(spark, sf_dir, "documents"), percent=85, size=4).drop("row_key")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.dedup(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_spans(table(spark, sf_dir, "documents"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.measured(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_neighbours, op2_quality_rules, op3_quality_classifier, op4_packing, op5_suffix_dedup, op6_ngram_jaccard, op7_warc, op8_mixing, op9_substring_dedup, op10_pii, op11_resampling, op12_ranked_search, op13_token_counts)}


def oracle_sql() -> dict[str, str]:
    return {"op5_suffix_dedup": suffix_dedup.ORACLE, "op6_ngram_jaccard": setjoin.ORACLE, "op7_warc": warc.ORACLE, "op8_mixing": mixing.ORACLE, "op9_substring_dedup": fingerprints.ORACLE, "op11_resampling": resampling.ORACLE, "op12_ranked_search": search.ORACLE}
