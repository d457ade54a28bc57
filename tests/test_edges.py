"""Nulls, ties, boundaries, single groups and empty input, with values worked out by hand."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.functions.pvalues import chi2_p_value
from tidemark.functions.text import clean_text, token_count
from tidemark.operators import association, causal, folds, forecast, profile, ranking, series
from tidemark.operators.ordering import exact_quantiles, midranks
from tidemark.plans import medallion


def at(text: str) -> datetime:
    return datetime.fromisoformat(f"2025-01-01 {text}")


def column(frame, name, order="id"):
    return [r[name] for r in frame.orderBy(order).collect()]


EVENTS = "id bigint, k string, t timestamp_ntz"


def test_prior_count_null_key(spark):
    rows = spark.createDataFrame([(1, "a", at("01:00")), (2, None, at("02:00")), (3, "a", at("03:00"))], EVENTS)
    got = causal.prior_count(rows, key="k", time="t", tiebreak="id", out="n")
    assert column(got, "n") == [0, None, 1]


def test_prior_count_ties(spark):
    rows = spark.createDataFrame([(i, "a", at("01:00")) for i in (1, 2, 3)] + [(4, "a", at("02:00"))], EVENTS)
    kw = dict(key="k", time="t", tiebreak="id", out="n")
    assert column(causal.prior_count(rows, **kw), "n") == [0, 1, 2, 3]
    assert column(causal.prior_count(rows, ties="strict", **kw), "n") == [0, 0, 0, 3]
    with pytest.raises(ValueError):
        causal.prior_count(rows, ties="other", **kw)


def test_hours_since_previous(spark):
    rows = spark.createDataFrame(
        [(1, "a", at("01:00")), (2, "a", at("01:00")), (3, "a", at("02:30")), (4, None, at("03:00"))], EVENTS
    )
    got = causal.hours_since_previous(rows, key="k", time="t", tiebreak="id", out="h")
    assert column(got, "h") == [None, 0.0, 1.5, None]


def test_rolling_count_edges(spark):
    times = ["00:00", "00:30", "01:00", "01:00", "02:00"]
    rows = spark.createDataFrame(
        [(i, "a", at(t)) for i, t in enumerate(times)] + [(9, None, at("02:00"))], EVENTS
    )
    got = causal.rolling_prior_count(rows, key="k", time="t", out="n")
    assert column(got, "n") == [0, 1, 2, 2, 2, 0]


def test_causal_on_empty_and_single(spark):
    empty = spark.createDataFrame([], EVENTS)
    one = spark.createDataFrame([(1, "a", at("01:00"))], EVENTS)
    for frame, expected in ((empty, []), (one, [0])):
        assert column(causal.prior_count(frame, key="k", time="t", tiebreak="id", out="n"), "n") == expected
        assert column(causal.rolling_prior_count(frame, key="k", time="t", out="n"), "n") == expected


def test_low_volume_null_group(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "a")], "id bigint, g string")
    got = causal.low_volume_flag(rows, group="g", out="f", minimum=100)
    assert column(got, "f") == [True, False, True]


def test_target_rate_uses_the_past_only(spark):
    rows = spark.createDataFrame(
        [(1, "a", at("01:00"), 1), (2, "a", at("02:00"), 0), (3, "a", at("03:00"), 1)], EVENTS + ", y int"
    )
    got = causal.ordered_target_rate(
        rows, key="k", time="t", tiebreak="id", target="y", out="r", prior=0.5, strength=1.0
    )
    assert column(got, "r") == [0.5, 0.75, 0.5]


def test_mean_of_previous_seven(spark):
    days = spark.createDataFrame([(date(2025, 1, 1 + i), i) for i in range(9)], "data date, v bigint")
    got = days.select("data", series.mean_of_previous("v", [], "data", 7).alias("m"))
    assert column(got, "m", "data") == [None] * 7 + [3.0, 4.0]


def test_quantiles_interpolate(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("a", 10), ("b", 5)], "g string, v int")
    got = {r["g"]: r for r in exact_quantiles(rows, ["g"], "v", {"p": 0.9}).collect()}
    assert got["a"]["p"] == pytest.approx(7.9) and got["a"]["n"] == 4
    assert got["b"]["p"] == 5.0


def test_cap_keeps_nulls(spark):
    rows = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 10), (5, None)], "id bigint, v int")
    got = column(medallion.capped(rows, "v", "c", 0.9), "c")
    assert got[:3] == [1.0, 2.0, 3.0] and got[3] == pytest.approx(7.9) and got[4] is None
    report = medallion.cap_report(rows, "v", 0.9).first()
    assert (report["n_above"], report["pct_above"]) == (1, 20.0)


def test_cap_report_empty(spark):
    report = medallion.cap_report(spark.createDataFrame([], "v int"), "v").first()
    assert (report["cap"], report["n_above"], report["pct_above"]) == (None, 0, 0.0)


def test_first_per_key_nulls_are_one_key(spark):
    rows = spark.createDataFrame([(1, None), (2, None), (3, 1)], "id bigint, k int")
    assert column(medallion.first_per_key(rows, keys=["k"], seq="id"), "id") == [1, 3]


def test_weeks(spark):
    days = ["2025-01-01", "2025-01-05", "2024-12-31", "2025-01-07", "2025-01-08"]
    rows = spark.createDataFrame([(d,) for d in days], "d string").withColumn("d", F.col("d").cast("date"))
    got = {
        str(r["d"]): (r["u"], str(r["w"]))
        for r in rows.select(
            "d", cal.sunday_week_label(F.col("d")).alias("u"), cal.week_of_wednesday(F.col("d")).alias("w")
        ).collect()
    }
    assert [got[d][0] for d in days[:3]] == ["2025-W00", "2025-W01", "2024-W52"]
    assert [got[d][1] for d in ("2025-01-01", "2025-01-07", "2025-01-08")] == [
        "2025-01-01", "2025-01-01", "2025-01-08",
    ]


def test_holidays(spark):
    days = cal.future_days(spark, "2024-12-30", 400)
    got = {str(r["data"]): r for r in days.collect()}
    assert got["2024-12-31"]["vespera_feriado"] == 1
    assert got["2025-01-01"]["feriado"] == 1 and got["2025-01-02"]["dia_seguinte_feriado"] == 1
    assert got["2025-04-18"]["feriado"] == 1 and got["2025-04-17"]["vespera_feriado"] == 1
    assert got["2025-12-31"]["vespera_feriado"] == 1
    assert got["2025-03-04"]["feriado"] == 0


def test_shift_names(spark):
    rows = spark.createDataFrame([(0,), (5,), (6,), (17,), (18,), (None,)], "h int")
    got = [r["s"] for r in rows.select("h", cal.shift_name(F.col("h")).alias("s")).collect()]
    assert got == ["madrugada", "madrugada", "comercial", "comercial", "noite", None]


@pytest.mark.parametrize(
    "text, clean",
    [
        ("Verificação do Nó Nº 3 — não OK", "verificacao 3 nao ok"),
        ("Até já, você!", "ate ja voce"),
        ("cœur ß ½", "cur 12"),
        ("e-mail@host", "mail host"),
        ("de para com", ""),
        (None, None),
        ("", ""),
    ],
)
def test_clean_text(spark, text, clean):
    rows = spark.createDataFrame([(text,)], "t string")
    assert rows.select(clean_text(F.col("t")).alias("c")).first()["c"] == clean


def test_clean_text_can_fold_stop_words(spark):
    rows = spark.createDataFrame([("Até já, você chegou!",)], "t string")
    assert rows.select(clean_text(F.col("t"), fold_stopwords=True).alias("c")).first()["c"] == "chegou"


def test_token_count(spark):
    rows = spark.createDataFrame([(1, ""), (2, None), (3, "a b"), (4, "  a\t b\n ")], "id bigint, t string")
    assert column(rows.withColumn("n", token_count(F.col("t"))), "n") == [0, 0, 2, 2]


def test_half_even_rounding(spark):
    rows = spark.createDataFrame([("a", 0.25), ("b", 2.45)], "g string, v double")
    got = {r["g"]: r["media"] for r in profile.duration_reference(rows, "v", ["g"]).collect()}
    assert got == {"a": 0.2, "b": 2.4}


def test_folds():
    got = folds.expanding_folds("2025-01-01")
    assert [str(f.train_end) for f in got] == ["2025-07-29", "2025-09-16", "2025-11-04"]
    assert [str(f.test_start) for f in got] == ["2025-07-30", "2025-09-17", "2025-11-05"]
    assert [str(f.test_end) for f in got] == ["2025-09-16", "2025-11-04", "2025-12-23"]


def test_fold_last_day(spark):
    fold = folds.expanding_folds("2025-01-01", 1, 1, 1)
    rows = spark.createDataFrame([(1, datetime(2025, 1, 7, 10))], "id bigint, t timestamp_ntz")
    assert [r["side"] for r in folds.assign_folds(rows, time="t", folds=fold).collect()] == ["train"]
    assert folds.assign_folds(rows, time="t", folds=fold, reference_bounds=True).count() == 0


def test_forecast_errors(spark):
    rows = spark.createDataFrame([(1, 0, 1.0), (2, 10, 8.0), (3, 20, 25.0)], "h int, actual int, forecast double")
    got = forecast.forecast_metrics(rows, []).first()
    assert (got["mae"], got["rmse"], got["mape"], got["medae"], got["mdape"]) == (2.67, 3.16, 22.5, 2.0, 22.5)
    assert (got["erro_h1"], got["erro_h7"]) == (1.0, None)


SCORES = [(1, 1, 0.9), (2, 0, 0.8), (3, 1, 0.8), (4, 0, 0.1)]


def test_ranking_metrics(spark):
    rows = spark.createDataFrame(SCORES, "id bigint, y int, score double")
    assert ranking.precision_at(rows, [], [1]).first()["precision_at_1"] == 1.0
    assert ranking.precision_at_share(rows, [], 0.5).first()["precision"] == 0.5
    assert ranking.precision_at_share(rows, [], 1.0).first()["k"] == 4
    assert ranking.average_precision(rows, []).first()[0] == pytest.approx(0.8333333)
    assert ranking.roc_auc(rows, []).first()[0] == 0.875
    best = ranking.cost_threshold(rows, [], cost_fp=1, cost_fn=15).first()
    assert (best["threshold"], best["cost"]) == (0.8, 1.0)


def test_ranking_single_class(spark):
    rows = spark.createDataFrame([(1, 0, 0.2), (2, 0, 0.1)], "id bigint, y int, score double")
    assert ranking.roc_auc(rows, []).first()[0] is None
    assert ranking.average_precision(rows, []).first()[0] is None
    none = ranking.threshold_metrics(rows, [], 0.5).first()
    assert (none["precision"], none["recall"], none["f1"]) == (0.0, 0.0, 0.0)


def test_cost_switch(spark):
    rows = spark.createDataFrame([(1, 0, 0.9), (2, 1, 0.1)], "id bigint, y int, score double")
    kw = dict(cost_fp=1, cost_fn=1)
    assert ranking.cost_threshold(rows, [], **kw).first()["cost"] == 1.0
    true_cost = ranking.cost_threshold(rows, [], cost_fp=10, cost_fn=9).first()
    lenient = ranking.cost_threshold(rows, [], cost_fp=10, cost_fn=9, reference_counts=True).first()
    assert (true_cost["cost"], lenient["cost"]) == (10.0, 9.0)


def test_chi_square(spark):
    cells = spark.createDataFrame(
        [("a", "x", 10), ("a", "y", 20), ("b", "x", 30), ("b", "y", 5)], "a string, b string, n bigint"
    )
    got = association.chi_square(cells, [], "a", "b").first()
    assert got["chi2"] == pytest.approx(16.578, abs=1e-3) and got["dof"] == 1
    wide = cells.union(spark.createDataFrame([("c", "x", 7)], cells.schema))
    expected = 0.0
    rows, cols, n = {"a": 30, "b": 35, "c": 7}, {"x": 47, "y": 25}, 72
    seen = {("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 30, ("b", "y"): 5, ("c", "x"): 7}
    for r in rows:
        for c in cols:
            e = rows[r] * cols[c] / n
            expected += (seen.get((r, c), 0) - e) ** 2 / e
    assert association.chi_square(wide, [], "a", "b").first()["chi2"] == pytest.approx(expected)


def test_cramers_v_of_a_constant_is_null(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "x")], "a string, b string")
    assert association.cramers_v(rows, [("a", "b")]).first()["v"] is None


@pytest.mark.parametrize("stat, dof, p", [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (18.307038, 10, 0.05), (0.0, 3, 1.0)])
def test_p_values(spark, stat, dof, p):
    rows = spark.createDataFrame([(stat,)], "s double")
    assert rows.select(chi2_p_value(F.col("s"), dof).alias("p")).first()["p"] == pytest.approx(p, abs=1e-6)


def test_midranks(spark):
    rows = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (5.0,)], "v double")
    got = {r["v"]: r["midrank"] for r in midranks(rows, [], "v").collect()}
    assert got == {1.0: 1.0, 2.0: 2.5, 5.0: 4.0}


def test_shares_null_on_the_missing_side(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "c string, w int")
    got = {r["c"]: r for r in profile.compare_shares(rows, "c", F.col("w") == 1, F.col("w") == 2).collect()}
    assert got["a"]["pct_first"] == 100.0 and got["a"]["pct_second"] is None
    assert got["b"]["pct_first"] is None and got["b"]["pct_second"] == 100.0


def test_empty_inputs_keep_their_schema(spark):
    scores = spark.createDataFrame([], "id bigint, y int, score double, model string")
    assert ranking.average_precision(scores, ["model"]).columns == ["model", "average_precision"]
    assert ranking.bootstrap_interval(scores, ["model"], replicates=3).count() == 0
    rows = spark.createDataFrame([], "a string, b string, v double")
    assert association.cramers_v(rows, [("a", "b")]).count() == 0
    assert profile.pareto(rows, "a", 5).count() == 0
    assert profile.histogram(rows, "v", 5).count() == 0
    assert profile.boxplot_stats(rows, "v", ["a"]).count() == 0


def test_ceiling_ladder(spark):
    weekly = spark.createDataFrame(
        [("a", 100.0, 110.0), ("b", 90.0, 101.0), ("c", 80.0, 90.0), ("d", 10.0, 20.0), ("e", 500.0, 600.0)],
        "serie string, week double, high double",
    )
    contracts = spark.createDataFrame([(s, 100.0) for s in "abcd"] + [("e", None)], "serie string, ceiling double")
    got = {r["serie"]: r["alert"] for r in forecast.ceiling_alert(weekly, contracts, ["serie"]).collect()}
    assert got == {"a": "CRÍTICO", "b": "ATENÇÃO", "c": "ATENÇÃO", "d": "OK", "e": "SEM TETO"}


def test_spanning_folds_cover_every_day():
    from datetime import date

    got = folds.spanning_folds(date(2025, 1, 1), date(2025, 12, 30), test_weeks=7, n_folds=3)
    assert got[-1].test_end == date(2025, 12, 30) and all(f.train_start == date(2025, 1, 1) for f in got)
    assert all((f.test_start - f.train_end).days == 1 and (f.test_end - f.test_start).days == 48 for f in got)
    assert [a.test_end for a in got[:-1]] == [b.train_end for b in got[1:]]
    with pytest.raises(ValueError):
        folds.spanning_folds(date(2025, 1, 1), date(2025, 3, 1))


def test_resamples_refuse_no_draws(spark):
    from tidemark.operators import ranking

    rows = spark.createDataFrame([(1, 1, 0.5)], "id long, y int, score double")
    with pytest.raises(ValueError):
        ranking.bootstrap_interval(rows, [], spare=0)
