"""Properties on skewed, generated and given rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from tidemark.operators import causal, folds, profile, ranking
from tidemark.operators.ordering import add_prior, exact_quantiles, find_cuts, midranks
from tidemark.plans import medallion
from tidemark.sources.tables import table, tickets


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows share one key, half of those one instant."""
    draw = random.Random(7)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(6000):
        key = "hot" if i % 3 else f"k{draw.randint(0, 40)}"
        when = start if key == "hot" and i % 2 else start + timedelta(seconds=draw.randint(0, 400_000))
        rows.append((i, key, when, draw.randint(0, 1)))
    return spark.createDataFrame(rows, "id bigint, k string, t timestamp_ntz, y int").repartition(6)


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_segmented_count_equals_the_plain_window(skewed):
    cuts = find_cuts(skewed, ["t", "id"])
    assert cuts.hot and cuts.second
    got = causal.prior_count(skewed, key="k", time="t", tiebreak="id", out="n").select("id", "n")
    w = Window.partitionBy("k").orderBy("t", "id")
    same(got, skewed.select("id", (F.row_number().over(w) - 1).cast("bigint").alias("n")))


def test_segments_split_the_hot_key(skewed):
    from tidemark.operators.ordering import add_segment

    cuts = find_cuts(skewed, ["t", "id"])
    sizes = add_segment(skewed, ["t", "id"], cuts).groupBy("k", "_seg").count()
    assert sizes.agg(F.max("count")).first()[0] < skewed.count() / 5


def test_segmented_gap_equals_the_plain_window(skewed):
    got = causal.hours_since_previous(skewed, key="k", time="t", tiebreak="id", out="h").select("id", "h")
    w = Window.partitionBy("k").orderBy("t", "id")
    micros = F.unix_micros(F.col("t").cast("timestamp"))
    same(got, skewed.select("id", ((micros - F.lag(micros).over(w)) / 3.6e9).alias("h")))


def test_rolling_equals_the_range_window(skewed):
    got = causal.rolling_prior_count(skewed, key="k", time="t", out="n").select("id", "n")
    micros = F.unix_micros(F.col("t").cast("timestamp"))
    w = Window.partitionBy("k").orderBy(micros).rangeBetween(-3_600_000_000, -1)
    same(got, skewed.select("id", F.count(F.lit(1)).over(w).alias("n")))


def test_strict_equals_rank(skewed):
    got = causal.prior_count(skewed, key="k", time="t", tiebreak="id", out="n", ties="strict").select("id", "n")
    w = Window.partitionBy("k").orderBy("t")
    same(got, skewed.select("id", (F.rank().over(w) - 1).cast("bigint").alias("n")))


def test_history_does_not_see_later_rows(spark, sf_dir):
    rows = medallion.silver(tickets(spark, sf_dir), year=2024)
    cut = rows.agg(F.expr("percentile_approx(numero, 0.6)")).first()[0]
    whole = medallion.ticket_history(rows).where(F.col("numero") <= cut)
    early = medallion.ticket_history(rows.where(F.col("numero") <= cut))
    same(whole, early)


def test_quantiles_equal_the_builtin(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    got = exact_quantiles(rows, ["l_returnflag"], "l_extendedprice", {"a": 0.1, "b": 0.99})
    want = rows.groupBy("l_returnflag").agg(
        F.percentile("l_extendedprice", F.lit(0.1)).alias("a"),
        F.percentile("l_extendedprice", F.lit(0.99)).alias("b"),
    )
    for g, w in zip(got.orderBy("l_returnflag").collect(), want.orderBy("l_returnflag").collect()):
        assert (g["a"], g["b"]) == (pytest.approx(w["a"]), pytest.approx(w["b"]))


def test_group_counts_add_up(spark, sf_dir):
    rows = tickets(spark, sf_dir)
    total = profile.group_counts(rows, ["prioridade", "status"]).agg(F.sum("n")).first()[0]
    assert total == rows.count()


def test_auc_is_invariant_under_monotone_scores(spark, skewed):
    rows = skewed.select("id", "y", (F.hash("id") % 500 / 1000.0).alias("score"))
    moved = rows.withColumn("score", F.exp(3 * F.col("score")) + 2)
    assert ranking.roc_auc(rows, []).first()[0] == pytest.approx(ranking.roc_auc(moved, []).first()[0])


def test_interval_brackets_the_point(spark, skewed):
    rows = skewed.where("id < 800").select("id", "y", ((F.col("y") * 300 + F.col("id") % 700) / 1000.0).alias("score"))
    got = ranking.bootstrap_interval(rows, [], replicates=40).first()
    assert got["low"] <= got["point"] <= got["high"] and got["n_valid"] == 40


def test_folds_are_disjoint_and_ordered(spark, sf_dir):
    plan = folds.expanding_folds("2024-01-01", 1, 1, 3)
    rows = folds.assign_folds(tickets(spark, sf_dir).select("numero", "aberto"), time="aberto", folds=plan)
    assert rows.groupBy("numero", "fold").count().where("count > 1").count() == 0
    ends = rows.groupBy("fold").agg(
        F.max(F.when(F.col("side") == "train", F.col("aberto"))).alias("a"),
        F.min(F.when(F.col("side") == "test", F.col("aberto"))).alias("b"),
    )
    assert all(r["a"] < r["b"] for r in ends.collect())


def test_midranks_sum(spark, skewed):
    ranks = midranks(skewed, ["k"], "t")
    got = ranks.groupBy("k").agg(F.sum(F.col("n") * F.col("midrank")).alias("s"), F.sum("n").alias("n"))
    assert all(r["s"] == r["n"] * (r["n"] + 1) / 2 for r in got.collect())


def test_running_sums_without_keys(spark, skewed):
    got = add_prior(skewed, [], ["t", "id"], sums={"before": F.lit(1)})
    assert got.agg(F.sum("before"), F.max("before"), F.count_distinct("before")).first() == (
        6000 * 5999 // 2, 5999, 6000,
    )


def plan_text(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["clean_text", "token_count", "calendar_features", "causal_count", "risk_table"])
def test_no_python_in_expressions(spark, sf_dir, name):
    text = plan_text(spark_entry.queries()[name](spark, sf_dir))
    assert "Python" not in text and "Pandas" not in text


def test_year_filter_reaches_the_scan(spark, sf_dir):
    text = plan_text(spark_entry.queries()["regime_filter"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text


def test_first_per_key_prunes_before_the_shuffle(spark, sf_dir):
    text = plan_text(spark_entry.queries()["dedup_first"](spark, sf_dir))
    assert text.count("WindowGroupLimit") == 2


def _brute_interval(rows, metric, replicates, spare):
    import numpy as np

    from tidemark.operators import ranking, resample

    ids = [f"42#{i}" for i, _, _ in rows]
    import hashlib

    keys = np.array([[int(hashlib.md5(t.encode()).hexdigest()[7 * k : 7 * k + 7], 16) for k in range(3)] for t in ids])
    y, score = (np.array([r[k] for r in rows], dtype=float) for k in (1, 2))
    values = []
    for b in range(1, replicates * spare + 1):
        w = resample.poisson_weights(ranking.POISSON_STEPS, *keys.T, np.array([b]))[:, 0]
        if len(values) == replicates or not (w * y).sum():
            continue
        cuts = sorted(set(score[w > 0]), reverse=True)
        n, pos = (np.array([(v * w)[score == c].sum() for c in cuts]) for v in (np.ones(len(y)), y))
        n_ge, tp = np.cumsum(n), np.cumsum(pos)
        if metric == "average_precision":
            values.append((pos * tp / n_ge).sum() / tp[-1])
        elif metric == "precision_at_10":
            values.append((pos * np.clip(10 - n_ge + n, 0, n) / n).sum() / min(10, n_ge[-1]))
        elif n_ge[-1] > tp[-1]:
            neg = n - pos
            below = neg.sum() - np.cumsum(neg)
            values.append((pos * (below + neg / 2)).sum() / (tp[-1] * neg.sum()))
    return np.mean(values), np.std(values), *np.quantile(values, [0.05, 0.95]), len(values)


@pytest.mark.parametrize("metric", ["average_precision", "roc_auc", "precision_at_10"])
def test_resampled_intervals_against_brute_force(spark, metric):
    """A score that a third of the rows share, a group with a single positive (many void draws) and one without."""
    from tidemark.operators import ranking

    groups = {
        "a": [(i, int(i % 7 == 0), 0.5 if i % 3 == 0 else (i * 37 % 101) / 101) for i in range(600)],
        "b": [(i, int(i == 3), (i * 11 % 13) / 13) for i in range(700, 740)] + [(3, 1, 0.4)],
        "c": [(i, 0, i / 100) for i in range(800, 830)],
    }
    frame = spark.createDataFrame([(g, *r) for g, rows in groups.items() for r in rows], "g string, id long, y int, score double").repartition(6)
    found = {r["g"]: r for r in ranking.bootstrap_interval(frame, ["g"], metric=metric, replicates=20).collect()}
    for g in "ab":
        want = _brute_interval(groups[g], metric, 20, 20)
        assert tuple(found[g][c] for c in ("mean", "sd", "low", "high", "n_valid")) == pytest.approx(want), g
    assert found["c"]["n_valid"] is None
