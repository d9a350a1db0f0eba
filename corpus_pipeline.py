"""A corpus from raw documents to packed sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm.cutting_stock import pack_cutting_stock
from tallyloom.llm.fm_classifier import fit, keep_good
from tallyloom.llm.line_chunks import dedup_line_runs
from tallyloom.llm.ngram_trie import keep_one_of_each
from tallyloom.llm.spaced_seeds import decontaminate
from tallyloom.llm.store import materialize, reach_workers

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the given tables, does not reject."""
    reach_workers(spark)
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(given, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return keep_good(docs.select(*COLUMNS), model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of two or more worded lines that stand earlier; emptied ones go."""
    reach_workers(spark)
    kept = dedup_line_runs(docs).where("n_removed_lines = 0 or trim(text) <> ''")
    return kept.selectExpr(
        "doc_id",
        "text",
        "lang",
        "source",
        "if(n_removed_lines = 0, n_chars, cast(length(text) as bigint)) as n_chars",
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that similarity links, that of the smallest id."""
    reach_workers(spark)
    return keep_one_of_each(docs).select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    reach_workers(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in the sequences."""
    reach_workers(spark)
    return pack_cutting_stock(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("packing", packing),
]
#: No SQL expresses the classifier or the tokenizer; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
