"""The registered queries of this package, over the whole of their tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.collocations import collocations
from tallyloom.llm.cutting_stock import pack_cutting_stock
from tallyloom.llm.fertility import fertility_rules
from tallyloom.llm.fm_classifier import fit, score
from tallyloom.llm.line_chunks import dedup_line_runs, dedup_lines
from tallyloom.llm.multi_index import hard_negatives
from tallyloom.llm.ngram_trie import near_duplicates
from tallyloom.llm.oracle import ORACLE_SQL  # noqa: F401
from tallyloom.llm.pii import personal_data
from tallyloom.llm.pivotal_mix import mixing_plan
from tallyloom.llm.prefix_free import remove_repeats
from tallyloom.llm.secrets import find_secrets
from tallyloom.llm.spaced_seeds import contamination
from tallyloom.llm.store import reach_workers
from tallyloom.llm.token_packing import pack_tokens


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_secret_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(_read(spark, sf_dir, "documents"))


def op2_ngram_trie_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"))


def op3_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility_rules(_read(spark, sf_dir, "documents"))


def op4_prefix_free_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_read(spark, sf_dir, "documents"))


def op5_factorisation_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return score(docs, fit(docs, _read(spark, sf_dir, "labels")))


def op6_line_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(_read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_lines",
        "n_removed_lines",
        "n_removed_chunks",
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


def op6_line_run_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_line_runs(_read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_lines",
        "n_removed_lines",
        "n_removed_runs",
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


def op7_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_tokens(_read(spark, sf_dir, "documents"), matrices=False)


def op8_spaced_seed_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(_read(spark, sf_dir, "documents"))


def op10_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_cutting_stock(_read(spark, sf_dir, "documents"))


def op11_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing_plan(_read(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op12_multi_index_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _read(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives(vectors, anchors=F.col("vec_id") % 50 == 0)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_battery,
        op2_ngram_trie_join,
        op3_fertility_rules,
        op4_prefix_free_dedup,
        op5_factorisation_quality,
        op6_line_chunk_dedup,
        op6_line_run_dedup,
        op7_token_packing,
        op8_spaced_seed_contamination,
        op9_personal_data,
        op10_cutting_stock_packing,
        op11_pivotal_mixing,
        op12_multi_index_negatives,
        op13_collocations,
    )
}
