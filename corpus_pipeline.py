"""From raw documents to token ids: every stage works on what the one before it kept."""

from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import decontamination, mixing, quality, simhash, tokens
from tillwise.llm.common import Scratch, free_name, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio."""
    figures = (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "log_ratio", "kept"
    )
    names = {name: free_name(docs, f"_{name}") for name in figures}
    judged = quality.assess(docs, table(spark, sf_dir, "labels"), names=names)
    return judged.where(names["kept"]).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents taken twice are there twice, documents beyond it are not."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token ids; a row per document with its place in them."""
    return tokens.token_index(docs)


STAGES = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("mixing", source_mix),
    ("tokens", token_ids),
]

# Hashes, vocabularies and edit distances are not SQL: the tests use brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        scratch.release()
    return docs
