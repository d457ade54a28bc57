"""Layer files with provenance columns, content fingerprints and read-back checks."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import read_source

META_PREFIX = "_"
_WORDS = 4
_WORD_HEX = 15


def row_sha(columns: list[str]) -> Column:
    """SHA-256 of the row's columns as text, each behind its length, so that no two rows read the same."""
    cells = [F.col(c).cast("string") for c in columns]
    return F.sha2(
        F.concat(*[F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in cells]), 256
    )


def _fingerprint(hashes: DataFrame, sha: str) -> DataFrame:
    """One hash for a bag of hashes, whatever their order, in constant memory per task.

    Words are summed, so rows that repeat count as often as they occur.
    """
    words = [
        F.sum(
            F.conv(F.substring(sha, 1 + i * _WORD_HEX, _WORD_HEX), 16, 10).cast("decimal(19,0)").cast("decimal(28,0)")
        ).cast("string").alias(f"_w{i}")
        for i in range(_WORDS)
    ]
    folded = hashes.agg(F.count(F.lit(1)).alias("n"), *words)
    text = F.concat_ws("-", "n", *[F.coalesce(F.col(f"_w{i}"), F.lit("0")) for i in range(_WORDS)])
    return folded.select("n", F.sha2(text.cast("string"), 256).alias("fingerprint"))


def content_fingerprint(df: DataFrame) -> DataFrame:
    """(n, fingerprint) of a table's rows."""
    return _fingerprint(df.select(row_sha(df.columns).alias("_sha")), "_sha")


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) per file; files are hashed in parallel, each below 2 GB."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def file_fingerprint(spark: SparkSession, path: str) -> DataFrame:
    return _fingerprint(file_hashes(spark, path), "sha256")


def with_metadata(df: DataFrame, layer: str, source_hash: str | None = None) -> DataFrame:
    """Add the provenance columns; the write time is one literal for the whole run."""
    extra = {
        "_ingested_at": F.lit(datetime.now(timezone.utc).isoformat()),
        "_source_layer": F.lit(layer),
    }
    if source_hash is not None:
        extra["_source_hash"] = F.lit(source_hash[:16])
    return df.withColumns(extra)


def write_layer(
    df: DataFrame,
    path: str,
    *,
    layer: str,
    source_hash: str | None = None,
    partition_by: list[str] | None = None,
    mode: str = "errorifexists",
) -> int:
    """Write a layer and return its row count, taken from the write itself."""
    seen = Observation()
    watched = with_metadata(df, layer, source_hash).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = watched.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return int(seen.get["rows"])


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    return read_source(spark, path)


def layer_shape(df: DataFrame) -> DataFrame:
    """Row count with the number of provenance and business columns."""
    meta = [c for c in df.columns if c.startswith(META_PREFIX)]
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(meta)).alias("n_meta"),
        F.lit(len(df.columns) - len(meta)).alias("n_business"),
    )


def check_layer(
    spark: SparkSession, path: str, *, rows_written: int, contract: list[str], time: str
) -> DataFrame:
    """Read a layer back: rows, missing contract columns and years present, with a verdict."""
    layer = read_layer(spark, path)
    missing = len(set(contract) - set(layer.columns))
    found = layer.agg(
        F.count(F.lit(1)).alias("rows_read"), F.count_distinct(F.year(time)).alias("n_years")
    )
    return found.select(
        F.lit(rows_written).cast("bigint").alias("rows_written"),
        "rows_read",
        F.lit(missing).alias("missing_columns"),
        "n_years",
        ((F.col("rows_read") == rows_written) & F.lit(missing == 0) & (F.col("n_years") == 1)).alias(
            "ok"
        ),
    )
