"""Inputs that the test tables do not hold: missing times and scores, text ids, repeated rows, unequal duplicates."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import causal, ranking
from tidemark.plans.medallion import first_per_key
from tidemark.sources import layers

ROWS = [(1, "a", "2024-01-01"), (2, "a", "2024-01-02"), (3, "a", "2024-01-03"), (4, "a", None), (5, "a", None)]


def timed(spark, rows=ROWS):
    return spark.createDataFrame(rows, "id long, k string, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))


def test_rows_without_a_time_come_last(spark):
    found = causal.prior_count(timed(spark), key="k", time="t", tiebreak="id", out="n")
    assert [r["n"] for r in found.orderBy("id").collect()] == [0, 1, 2, 3, 4]
    strict = causal.prior_count(timed(spark), key="k", time="t", tiebreak="id", out="n", ties="strict")
    assert [r["n"] for r in strict.orderBy("id").collect()] == [0, 1, 2, 3, 3]
    load = causal.rolling_prior_count(timed(spark), key="k", time="t", out="n")
    assert [r["n"] for r in load.orderBy("id").collect()] == [0, 0, 0, 0, 0]


def test_text_ids_on_a_hot_instant(spark):
    rows = spark.range(5000).select(
        F.concat(F.lit("INC"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("id"), F.lit("a").alias("k"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("t"), F.col("id").alias("place"),
    )
    found = causal.prior_count(rows, key="k", time="t", tiebreak="id", out="n")
    assert found.where("n != place").count() == 0


def test_fingerprint_sees_repeats_and_cell_borders(spark):
    def of(rows):
        return layers.content_fingerprint(spark.createDataFrame(rows, "a string, b string")).first()

    assert of([("x", "x")] * 2) != of([("y", "y")] * 2)
    assert of([("a#b", "c")]) != of([("a", "b#c")])
    assert of([("\\N", "c")]) != of([(None, "c")])


def test_first_row_does_not_depend_on_the_order_of_rows(spark):
    rows = [(1, 5, "x"), (1, 5, "y"), (1, 7, "z")]
    a, b = (
        first_per_key(spark.createDataFrame(r, "id int, s int, v string"), keys=["id"], seq="s").collect()
        for r in (rows, rows[::-1])
    )
    assert a == b and a[0]["s"] == 5


def test_a_missing_score_is_an_error(spark):
    rows = spark.createDataFrame([(1, 0.5), (0, None)], "y int, score double")
    with pytest.raises(Exception, match="a score is null"):
        ranking.threshold_table(rows, []).collect()
