"""Small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters keep their case."""
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have."""
    while name in df.columns:
        name = f"_{name}"
    return name


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def any_of(strings: list[str]) -> str:
    """A regular expression for one of the strings, the longest first."""
    special = set(r"\.[]{}()<>*+-=!?^$|/")
    return "|".join("".join(f"\\{c}" if c in special - set("<>/-=!") else c for c in s) for s in sorted(strings, key=len, reverse=True))
