"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# One local folder per process, used only where the session names no shared one.
_LOCAL: dict[str, str] = {}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; the cluster's own conf wins otherwise."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Zone-less timestamps turn into epoch numbers without a shift only under UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder named by spark.checkpoint.dir.

    Only a local session that names none (tests) gets a local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not root:
        root = _LOCAL.setdefault("root", tempfile.mkdtemp(prefix="tidemark-"))
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def parallel_parts(spark: SparkSession, floor: int = 8) -> int:
    """Into how many range pieces an ordered operator cuts its input: as many as a shuffle has."""
    return max(floor, int(spark.conf.get("spark.sql.shuffle.partitions")))


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared work folder and read it back: it survives lost executors."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
