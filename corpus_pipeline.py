"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next.

quality (rejected documents go), near duplicates (one of each group stays), benchmark contamination (hit
documents go), secrets (masked in the text), mixing (how often each document is taken).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, minhash, mixing, quality, secret_scan
from tidemark.llm.common import fresh, table
from tidemark.llm.langid import held_out
from tidemark.session import settle

# The classifier is fitted and hashes are not DuckDB's: tested against a brute-force version.
ORACLE_SQL = None


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows, written, and the name of a column that numbers them: ids may be null or stand for several texts."""
    name = fresh(docs, "_row")
    return settle(docs.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def named_by(docs: DataFrame, row: str) -> DataFrame:
    """The texts under their row numbers, as the operators take them."""
    return docs.select(F.col(row).alias("doc_id"), "text")


def without(docs: DataFrame, row: str, gone: DataFrame) -> DataFrame:
    """Rows of `docs` whose number is not among the doc_id of `gone`."""
    return docs.join(gone.select(F.col("doc_id").alias(row)), row, "left_anti").drop(row)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores below one half go, each scored by its own text; null and empty texts score alike."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    known = docs.select("doc_id", "text", held_out("doc_id", 3, 1).alias("held_out"))
    name = fresh(docs, "_quality")
    scored = quality.score(docs, quality.fit(known, labels), name=name)
    return scored.where(F.col(name) >= 0.5).drop(name)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the row of the smallest id stays, null last; ties: the row read first.

    Rows are judged by their own text, whatever their id. Texts without a word have no copies and stay.
    """
    rows, row = numbered(docs)
    found = minhash.near_duplicates(named_by(rows, row)).select(F.col("doc_id").alias(row), "component_id")
    grouped = rows.select(row, "doc_id").join(found, row)
    first = grouped.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("first"))
    stays = first.select(F.col(f"first.{row}").alias(row))
    return rows.join(stays, row, "left_semi").drop(row)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds a benchmark window go, each judged by its own text; null text stays."""
    rows, row = numbered(docs)
    found = decontaminate.contamination(named_by(rows, row), table(spark, sf_dir, "benchmark"))
    return without(rows, row, found.where("contaminated"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masked texts; n_chars follows the text where it did before."""
    before = fresh(docs, "_before")
    clean = secret_scan.redact(docs.withColumn(before, F.length("text")))
    length = F.when(F.col("n_chars") == F.col(before), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", length).drop(before)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """For every row how often it is taken (epochs) and how many words that makes (taken); see mix_documents."""
    return mixing.mix_documents(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scan", secrets_stage),
    ("mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
