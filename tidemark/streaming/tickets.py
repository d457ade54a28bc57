"""The ingest, volume and scoring steps on an unbounded ticket stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from tidemark.sources.contracts import require_columns
from tidemark.sources.layers import with_metadata


def read_tickets(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """New Parquet files of a folder as a stream, under a declared schema."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    )


def bronze_stream(
    stream: DataFrame, contract: list[str], *, key: str = "numero", time: str = "aberto", lateness: str = "1 day"
) -> DataFrame:
    """Contract check, one row per key within the lateness, provenance columns.

    State holds keys of the lateness span only.
    """
    require_columns(stream, contract)
    # Watermarks need an instant; under UTC the cast changes nothing.
    timed = stream.withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", lateness)
    return with_metadata(timed.dropDuplicatesWithinWatermark([key]), "bronze").drop("_at")


def volume_stream(stream: DataFrame, *, time: str = "aberto", width: str = "1 day", lateness: str = "1 day") -> DataFrame:
    """(data, total) per closed window; late rows beyond the watermark are left out."""
    timed = stream.withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", lateness)
    counts = timed.groupBy(F.window("_at", width)).agg(F.count(F.lit(1)).alias("total"))
    return counts.select(F.col("window.start").cast("timestamp_ntz").alias("inicio"), "total")


def score_batches(
    model: PipelineModel, score: Callable[[PipelineModel, DataFrame], DataFrame], path: str
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that scores each batch into its own folder, so a retry overwrites it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        score(model, batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def start_append(stream: DataFrame, path: str, checkpoint: str, **options: str) -> DataStreamWriter:
    """A Parquet sink in append mode; started again with the same ``checkpoint`` it goes on where it stopped."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .options(**options)
    )
