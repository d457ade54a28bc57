"""Series, backtests and forecasts over the daily order volume of each priority."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import forecast, resample, series
from tidemark.operators.folds import Fold, observed_span, spanning_folds
from tidemark.plans.registry import query, rounded, sql_chi2_tail, with_tickets
from tidemark.session import settle
from tidemark.sources.tables import table, tickets

KEYS = ["serie"]
HORIZON = 49
TEST_WEEKS = HORIZON // 7


def _span(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    return observed_span(table(spark, sf_dir, "orders"), "o_orderdate")


def _folds(spark: SparkSession, sf_dir: str) -> list[Fold]:
    """Three folds that together cover every observed day."""
    return spanning_folds(*_span(spark, sf_dir), test_weeks=TEST_WEEKS)


_SPAN = "sp AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders)"
_FOLDS = f"""{_SPAN}, f AS (SELECT i AS fold, lo AS a, hi - {HORIZON} * (4 - i) AS b, hi - {HORIZON} * (4 - i) + 1 AS c,
  hi - {HORIZON} * (3 - i) AS e FROM sp, (VALUES (1), (2), (3)) AS v(i))"""


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("serie"), "o_orderdate")
    return series.daily_counts(orders, time="o_orderdate", keys=KEYS)


DAILY = """cnt AS (SELECT o_orderpriority AS serie, CAST(o_orderdate AS DATE) AS data, count(*) AS n FROM orders GROUP BY 1, 2),
spine AS (SELECT serie, CAST(unnest(generate_series(min(data), max(data), INTERVAL 1 DAY)) AS DATE) AS data FROM cnt GROUP BY 1),
d AS (SELECT serie, data, coalesce(n, 0) AS total FROM spine LEFT JOIN cnt USING (serie, data))"""


def _rounded_all(df: DataFrame, names: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({n: rounded(n, digits) for n in names})


@query(
    "volume_lags",
    f"""WITH {DAILY} SELECT serie, data, total, {", ".join(
        f"lag(total, {k}) OVER w AS volume_lag_{k}" for k in range(1, 8))} FROM d WINDOW w AS (PARTITION BY serie ORDER BY data)""",
)
def volume_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily(spark, sf_dir).select("*", *series.lags("total", KEYS, "data", 7, "volume_lag"))


def _sql_mean(frame: str, size: int) -> str:
    w = f"(PARTITION BY serie ORDER BY data ROWS BETWEEN {frame})"
    return f"CASE WHEN count(*) OVER {w} = {size} THEN round(avg(total) OVER {w}, 6) END"


@query(
    "ma7_until_yesterday",
    f"WITH {DAILY} SELECT serie, data, {_sql_mean('7 PRECEDING AND 1 PRECEDING', 7)} AS media FROM d",
)
def ma7_until_yesterday(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = series.mean_of_previous("total", KEYS, "data", 7)
    return daily(spark, sf_dir).select("serie", "data", rounded(mean).alias("media"))


@query(
    "rolling_mean",
    f"""WITH {DAILY} SELECT serie, data, {_sql_mean('6 PRECEDING AND CURRENT ROW', 7)} AS media_7,
    {_sql_mean('29 PRECEDING AND CURRENT ROW', 30)} AS media_30 FROM d""",
)
def rolling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily(spark, sf_dir).select(
        "serie",
        "data",
        *[rounded(series.trailing_mean("total", KEYS, "data", n)).alias(f"media_{n}") for n in (7, 30)],
    )


@query(
    "series_diff",
    f"""WITH {DAILY}, f AS (SELECT *, total - lag(total) OVER (PARTITION BY serie ORDER BY data) AS diff FROM d)
    SELECT *, diff - lag(diff, 7) OVER (PARTITION BY serie ORDER BY data) AS season_diff FROM f""",
)
def series_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.differences(daily(spark, sf_dir), value="total", keys=KEYS, day="data")


@query(
    "anomalous_jumps",
    f"""WITH {DAILY}, f AS (SELECT *, total - lag(total) OVER (PARTITION BY serie ORDER BY data) AS change FROM d),
    z AS (SELECT *, (change - avg(change) OVER (PARTITION BY serie)) / stddev_samp(change) OVER (PARTITION BY serie) AS z FROM f)
    SELECT serie, data, total, change, round_even(z, 2)::DOUBLE AS z FROM z WHERE abs(z) > 3""",
)
def anomalous_jumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.anomalous_jumps(daily(spark, sf_dir), value="total", keys=KEYS, day="data")


@query(
    "jump_context",
    with_tickets(
        """c AS (SELECT CAST(aberto AS DATE) AS data, count(*) AS total FROM tickets GROUP BY 1),
        f AS (SELECT *, total - lag(total) OVER (ORDER BY data) AS change FROM c),
        z AS (SELECT *, (change - avg(change) OVER ()) / stddev_samp(change) OVER () AS z FROM f)
        SELECT data, any_value(total) AS total, any_value(change) AS change, round_even(any_value(z), 2)::DOUBLE AS z,
          round(100.0 * count(incidente_pai) / count(*), 6)::DOUBLE AS pct_incidente FROM z
        JOIN tickets ON CAST(aberto AS DATE) = data WHERE abs(z) > 1.5 GROUP BY 1"""
    ),
)
def jump_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tickets(spark, sf_dir).select("aberto", "incidente_pai")
    days = series.daily_counts(
        rows, time="aberto", measures={"em_incidente": F.col("incidente_pai").isNotNull()}
    )
    # The share needs only the day's two counts, so jump days never meet single tickets again.
    jumps = series.anomalous_jumps(days, value="total", keys=[], day="data", limit=1.5)
    share = 100.0 * F.col("em_incidente") / F.nullif(F.col("total"), F.lit(0))
    return jumps.select("data", "total", "change", "z", rounded(share).alias("pct_incidente"))


@query(
    "leak_check_lag",
    f"""WITH {DAILY} SELECT serie, count(*) AS n_checked, CAST(0 AS BIGINT) AS n_wrong FROM d
    WHERE data > (SELECT min(data) FROM d AS f WHERE f.serie = d.serie) GROUP BY 1""",
)
def leak_check_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = daily(spark, sf_dir)
    lagged = days.select("serie", "data", *series.lags("total", KEYS, "data", 1, "lag"))
    yesterday = days.select("serie", F.date_add("data", 1).alias("data"), "total")
    return (
        lagged.join(yesterday, ["serie", "data"])
        .groupBy("serie")
        .agg(
            F.count(F.lit(1)).alias("n_checked"),
            F.count_if(~F.col("lag_1").eqNullSafe(F.col("total"))).alias("n_wrong"),
        )
    )


@query(
    "weekly_resample",
    f"""WITH {DAILY} SELECT serie, CAST(date_trunc('week', data - INTERVAL 2 DAY) + INTERVAL 8 DAY AS DATE) AS week_end,
    CAST(sum(total) AS BIGINT) AS total, count(*) AS n_days FROM d GROUP BY 1, 2""",
)
def weekly_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.weekly_sums(daily(spark, sf_dir), value="total", keys=KEYS, day="data")


@query(
    "seasonal_decompose",
    f"""WITH {DAILY}, t AS (SELECT *, isodow(data) AS ph, CASE WHEN count(*) OVER w = 7 THEN avg(total) OVER w END AS trend
      FROM d WINDOW w AS (PARTITION BY serie ORDER BY data ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
    p AS (SELECT serie, ph, avg(total - trend) AS m FROM t GROUP BY 1, 2),
    c AS (SELECT serie, ph, m - avg(m) OVER (PARTITION BY serie) AS seasonal FROM p)
    SELECT serie, data, total, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal,
      round(total - trend - seasonal, 6) AS remainder FROM t JOIN c USING (serie, ph)""",
)
def seasonal_decompose(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = series.seasonal_decompose(daily(spark, sf_dir), value="total", keys=KEYS, day="data")
    return _rounded_all(found, ["trend", "seasonal", "remainder"])


@query(
    "acf",
    f"""WITH {DAILY}, c AS (SELECT serie, data, total - avg(total) OVER (PARTITION BY serie) AS x FROM d),
    v AS (SELECT serie, sum(x * x) AS v FROM c GROUP BY 1)
    SELECT a.serie, CAST(k AS INTEGER) AS lag, round(sum(a.x * b.x) / any_value(v.v), 6) AS acf
    FROM range(1, 31) AS r(k), c AS a JOIN c AS b ON a.serie = b.serie AND b.data = a.data - CAST(k AS INTEGER)
    JOIN v ON v.serie = a.serie GROUP BY 1, 2""",
)
def acf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = series.autocorrelation(daily(spark, sf_dir), value="total", keys=KEYS, day="data")
    return found.withColumn("acf", rounded("acf"))


@query("pacf")
def pacf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = series.autocorrelation(daily(spark, sf_dir), value="total", keys=KEYS, day="data")
    return forecast.partial_autocorrelation(found, KEYS).withColumn("pacf", rounded("pacf"))


@query(
    "kpss_stat",
    f"""WITH {DAILY}, e AS (SELECT serie, data, total - avg(total) OVER (PARTITION BY serie) AS x FROM d),
    s AS (SELECT serie, sum(p * p) AS ss, count(*) AS n FROM (SELECT serie, sum(x) OVER (PARTITION BY serie ORDER BY data) AS p
      FROM e) GROUP BY 1),
    g AS (SELECT a.serie, k, sum(a.x * b.x) AS g FROM range(0, 11) AS r(k), e AS a JOIN e AS b
      ON a.serie = b.serie AND b.data = a.data - CAST(k AS INTEGER) GROUP BY 1, 2),
    l AS (SELECT serie, sum(CASE WHEN k = 0 THEN g ELSE 2 * (1 - k / 11) * g END) AS lr FROM g GROUP BY 1)
    SELECT serie, n, round(ss / (n * lr), 6) AS kpss FROM s JOIN l USING (serie)""",
)
def kpss_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = series.kpss_level(daily(spark, sf_dir), value="total", keys=KEYS, day="data", n_lags=10)
    return found.withColumn("kpss", rounded("kpss"))


@query("adf_stat")
def adf_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forecast.unit_root_statistic(daily(spark, sf_dir), KEYS, "total", n_lags=7)
    return found.withColumn("adf", rounded("adf"))


_FORMS = f"""{DAILY}, g AS (SELECT *, total - lag(total) OVER (PARTITION BY serie ORDER BY data) AS diff FROM d),
  h AS (SELECT *, diff - lag(diff, 7) OVER (PARTITION BY serie ORDER BY data) AS season_diff FROM g),
  fm AS (SELECT serie, data, unnest(['total', 'diff', 'season_diff']) AS form, unnest([total, diff, season_diff]) AS x FROM h)"""


@query(
    "kpss_forms",
    f"""WITH {_FORMS}, e AS (SELECT serie, form, data, x - avg(x) OVER (PARTITION BY serie, form) AS x FROM fm WHERE x IS NOT NULL),
    s AS (SELECT serie, form, sum(p * p) AS ss, count(*) AS n FROM (SELECT serie, form,
      sum(x) OVER (PARTITION BY serie, form ORDER BY data) AS p FROM e) GROUP BY 1, 2),
    c AS (SELECT a.serie, a.form, k, sum(a.x * b.x) AS g FROM range(0, 11) AS r(k), e AS a JOIN e AS b
      ON a.serie = b.serie AND a.form = b.form AND b.data = a.data - CAST(k AS INTEGER) GROUP BY 1, 2, 3),
    l AS (SELECT serie, form, sum(CASE WHEN k = 0 THEN g ELSE 2 * (1 - k / 11) * g END) AS lr FROM c GROUP BY 1, 2)
    SELECT serie, form, n, round(ss / (n * lr), 6) AS kpss, 0.463::DOUBLE AS critical_5pct, ss / (n * lr) > 0.463 AS rejected
    FROM s JOIN l USING (serie, form)""",
)
def kpss_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    forms = series.difference_forms(daily(spark, sf_dir), value="total", keys=KEYS, day="data")
    found = series.kpss_level(forms, value="total", keys=[*KEYS, "form"], day="data", n_lags=10)
    return series.against_critical(found, "kpss").withColumn("kpss", rounded("kpss"))


@query("adf_forms")
def adf_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    forms = series.difference_forms(daily(spark, sf_dir), value="total", keys=KEYS, day="data")
    found = forecast.unit_root_statistic(forms, [*KEYS, "form"], "total", n_lags=7)
    return series.against_critical(found, "adf").withColumn("adf", rounded("adf"))


# --- backtest ------------------------------------------------------------------------------------


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    days = forecast.split_days(daily(spark, sf_dir), _folds(spark, sf_dir))
    return days.where("side = 'train'"), days.where("side = 'test'")


def _baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.baseline_forecasts(_sides(spark, sf_dir)[0], KEYS, "total", HORIZON)


_TRAIN = f"""{DAILY}, {_FOLDS}, tr AS (SELECT serie, fold, data, total, b, c FROM d JOIN f ON data BETWEEN a AND b),
te AS (SELECT serie, fold, data, total AS actual FROM d JOIN f ON data BETWEEN c AND e)"""
_FORECASTS = f"""{_TRAIN}, bf AS (SELECT x.serie, x.fold, CAST(h AS INTEGER) AS h, CAST(x.b + CAST(h AS INTEGER) AS DATE) AS data,
    max(x.total) FILTER (x.data = x.b)::DOUBLE AS ingenuo,
    max(x.total) FILTER (x.data = x.b - 6 + CAST((h - 1) % 7 AS INTEGER))::DOUBLE AS sazonal_7,
    avg(x.total) AS media_7 FROM tr AS x, range(1, {HORIZON + 1}) AS r(h) WHERE x.data > x.b - 7
    GROUP BY x.serie, x.fold, h, x.b),
  fc AS (SELECT serie, fold, h, data, unnest(['ingenuo', 'sazonal_7', 'media_7']) AS model,
    unnest([ingenuo, sazonal_7, media_7]) AS forecast FROM bf)"""


@query(
    "baseline_forecasts",
    f"WITH {_FORECASTS} SELECT serie, fold, model, h, data, round(forecast, 6)::DOUBLE AS forecast FROM fc",
)
def baseline_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _baselines(spark, sf_dir).withColumn("forecast", rounded("forecast"))


def _sql_metrics(source: str) -> str:
    e, p = "abs(actual - forecast)", "100.0 * abs(actual - forecast) / nullif(abs(actual), 0)"
    return f"""SELECT serie, fold, model, round_even(avg({e}), 2)::DOUBLE AS mae, round_even(sqrt(avg({e} * {e})), 2)::DOUBLE AS rmse,
    round_even(avg({p}), 2)::DOUBLE AS mape, round_even(quantile_cont({e}, 0.5), 2)::DOUBLE AS medae,
    round_even(quantile_cont({p}, 0.5), 2)::DOUBLE AS mdape, round_even(max({e}) FILTER (h = 1), 2)::DOUBLE AS erro_h1,
    round_even(max({e}) FILTER (h = 7), 2)::DOUBLE AS erro_h7 FROM {source} JOIN te USING (serie, fold, data) GROUP BY 1, 2, 3"""


@query("forecast_metrics", f"WITH {_FORECASTS} {_sql_metrics('fc')}")
def forecast_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test = _sides(spark, sf_dir)
    scored = forecast.with_actuals(_baselines(spark, sf_dir), test, KEYS, "total")
    return forecast.forecast_metrics(scored, [*KEYS, "fold", "model"])


@query(
    "model_leaderboard",
    f"""WITH {_FORECASTS}, m AS ({_sql_metrics('fc')}),
    t AS (SELECT serie, model, avg(mae) AS mean, stddev_samp(mae) AS std, quantile_cont(mae, 0.5) AS median FROM m GROUP BY 1, 2)
    SELECT serie, model, round(mean, 6) AS mean, round(std, 6) AS std, round(median, 6)::DOUBLE AS median,
      first_value(model) OVER (PARTITION BY serie ORDER BY mean, model) AS best_mean,
      first_value(model) OVER (PARTITION BY serie ORDER BY median, model) AS best_median FROM t""",
)
def model_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forecast.leaderboard(forecast_metrics(spark, sf_dir), KEYS)
    return _rounded_all(found, ["mean", "std", "median"])


@query(
    "ensemble_weights",
    f"""WITH {_FORECASTS}, en AS (SELECT serie, fold, h, data, 'peso_' || w AS model,
      CAST(w AS DOUBLE) * sazonal_7 + (1 - CAST(w AS DOUBLE)) * media_7 AS forecast
      FROM bf, (VALUES ('1.0'), ('0.7'), ('0.5'), ('0.3'), ('0.0')) AS v(w))
    SELECT serie, fold, model, round(avg(abs(actual - forecast)), 6) AS mae FROM en JOIN te USING (serie, fold, data) GROUP BY 1, 2, 3""",
)
def ensemble_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test = _sides(spark, sf_dir)
    mixed = forecast.blend(_baselines(spark, sf_dir), KEYS, "sazonal_7", "media_7")
    scored = forecast.with_actuals(mixed, test, KEYS, "total")
    error = F.avg(F.abs(F.col("actual") - F.col("forecast")))
    return scored.groupBy("serie", "fold", "model").agg(rounded(error).alias("mae"))


@query(
    "duan_correction",
    f"""WITH {_TRAIN}, l AS (SELECT *, ln(1 + total) AS x FROM tr),
    r AS (SELECT *, CASE WHEN count(*) OVER w = 7 THEN x - avg(x) OVER w END AS res FROM l
      WINDOW w AS (PARTITION BY serie, fold ORDER BY data ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
    k AS (SELECT serie, fold, avg(exp(res)) AS factor, avg(x) FILTER (data > b - 7) AS f FROM r GROUP BY 1, 2)
    SELECT serie, fold, CAST(h AS INTEGER) AS h, round(exp(f) - 1, 6) AS plain, round(factor, 6) AS factor,
      round(exp(f) * factor - 1, 6) AS corrected FROM k, range(1, 8) AS q(h)""",
)
def duan_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _sides(spark, sf_dir)
    found = forecast.smearing_forecasts(train, KEYS, "total", 7)
    return _rounded_all(found, ["plain", "factor", "corrected"])


_RESIDUALS = """rs AS (SELECT serie, fold, data, total - l AS residual, l AS fitted FROM (SELECT *,
  lag(total, 7) OVER (PARTITION BY serie, fold ORDER BY data) AS l FROM tr) WHERE l IS NOT NULL)"""
_BANDS = f"""{_FORECASTS}, {_RESIDUALS}, q AS (SELECT serie, fold, quantile_cont(residual, 0.025) AS lo,
  quantile_cont(residual, 0.975) AS hi FROM rs GROUP BY 1, 2),
  bd AS (SELECT serie, fold, h, data, sazonal_7 AS forecast, sazonal_7 + lo AS low, sazonal_7 + hi AS high FROM bf JOIN q USING (serie, fold))"""


def _banded(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _sides(spark, sf_dir)
    points = forecast.baseline_forecasts(train, KEYS, "total", HORIZON).where("model = 'sazonal_7'")
    residuals = forecast.seasonal_residuals(train, KEYS, "total")
    return forecast.residual_interval(points.drop("model"), residuals, [*KEYS, "fold"])


@query(
    "residual_interval",
    f"""WITH {_BANDS} SELECT serie, fold, h, data, forecast, round(low, 6)::DOUBLE AS low, round(high, 6)::DOUBLE AS high FROM bd""",
)
def residual_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_all(_banded(spark, sf_dir), ["low", "high"])


@query(
    "residual_diagnostics",
    f"""WITH {_TRAIN}, {_RESIDUALS}, c AS (SELECT *, residual - avg(residual) OVER (PARTITION BY serie, fold) AS x,
      residual * residual AS sq FROM rs),
    g AS (SELECT *, lag(x) OVER (PARTITION BY serie, fold ORDER BY data) AS px FROM c),
    m AS (SELECT serie, fold, count(*) AS n, avg(x^2) AS m2, avg(x^3) AS m3, avg(x^4) AS m4, sum(x * px) / sum(x * x) AS r1,
      corr(sq, fitted) AS rho FROM g GROUP BY 1, 2),
    x AS (SELECT serie, fold, n, n * (n + 2) * r1 * r1 / (n - 1) AS ljung_box, m3 / m2^1.5 AS skew, m4 / (m2 * m2) AS kurtosis,
      n / 6 * ((m3 / m2^1.5)^2 + (m4 / (m2 * m2) - 3)^2 / 4) AS jarque_bera, n * rho * rho AS breusch_pagan FROM m)
    SELECT serie, fold, n, round(skew, 6) AS skew, round(kurtosis, 6) AS kurtosis, {", ".join(
      f"round({c}, 6) AS {c}, {sql_chi2_tail(c, str(dof))} AS {c}_p" for c, dof in forecast.RESIDUAL_TESTS.items())} FROM x""",
)
def residual_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _sides(spark, sf_dir)
    residuals = forecast.seasonal_residuals(train, KEYS, "total")
    found = forecast.residual_diagnostics(residuals, [*KEYS, "fold"])
    p_values = [f"{c}_p" for c in forecast.RESIDUAL_TESTS]
    return _rounded_all(found, ["skew", "kurtosis", *forecast.RESIDUAL_TESTS, *p_values])


_WEEK = f"""{_BANDS}, lw AS (SELECT serie, fold, CAST(sum(total) AS BIGINT) AS last_week FROM tr WHERE data > b - 7 GROUP BY 1, 2),
  wk AS (SELECT serie, fold, sum(forecast) AS week, sum(low) AS low, sum(high) AS high FROM bd WHERE h <= 7 GROUP BY 1, 2),
  wp AS (SELECT serie, fold, week, low, high, last_week, week < 0 OR week > 5 * last_week AS implausible
    FROM wk JOIN lw USING (serie, fold))"""


def _weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _sides(spark, sf_dir)
    recent = forecast.recent_values(train, KEYS, "total")
    last = recent.select(
        *KEYS, "fold", F.aggregate("recent", F.lit(0).cast("bigint"), lambda a, v: a + v).alias("last_week")
    )
    return forecast.weekly_projection(_banded(spark, sf_dir), [*KEYS, "fold"], last)


@query(
    "weekly_projection",
    f"""WITH {_WEEK} SELECT serie, fold, week, round(low, 6)::DOUBLE AS low, round(high, 6)::DOUBLE AS high, last_week,
    implausible FROM wp""",
)
def weekly_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_all(_weekly(spark, sf_dir), ["low", "high"])


@query(
    "weekly_direct",
    f"""WITH {_TRAIN}, w AS (SELECT serie, fold, date_trunc('week', data - INTERVAL 2 DAY) AS k, CAST(sum(total) AS BIGINT) AS total
      FROM tr GROUP BY 1, 2, 3 HAVING count(*) = 7),
    g AS (SELECT *, total - lag(total) OVER (PARTITION BY serie, fold ORDER BY k) AS y FROM w),
    h AS (SELECT *, lag(y) OVER (PARTITION BY serie, fold ORDER BY k) AS x FROM g),
    m AS (SELECT serie, fold, count(*) AS n_weeks, arg_max(total, k) AS last_week, arg_max(y, k) AS last_y,
      regr_slope(y, x) AS phi, regr_intercept(y, x) AS c FROM h GROUP BY 1, 2)
    SELECT serie, fold, n_weeks, last_week, round(phi, 6) AS phi, round(last_week + c + phi * last_y, 6) AS week,
      last_week + c + phi * last_y < 0 OR last_week + c + phi * last_y > 5 * last_week AS implausible FROM m""",
)
def weekly_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _sides(spark, sf_dir)
    return _rounded_all(forecast.weekly_direct(train, KEYS, "total"), ["phi", "week"])


@query(
    "ceiling_alert",
    f"""WITH {_WEEK}, k AS (SELECT o_orderpriority AS serie, CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE
      round(count(*) / (SELECT hi - lo + 1 FROM sp) * 7 * CASE o_orderpriority WHEN '1-URGENT' THEN 0.7 WHEN '5-LOW' THEN 3.0 ELSE 1.4 END, 1)::DOUBLE END
      AS ceiling FROM orders GROUP BY 1)
    SELECT serie, fold, week, ceiling, round_even(100.0 * week / ceiling, 1)::DOUBLE AS use_pct,
      CASE WHEN ceiling IS NULL THEN 'SEM TETO' WHEN week / ceiling >= 1 THEN 'CRÍTICO' WHEN high / ceiling >= 1 THEN 'ATENÇÃO'
        WHEN week / ceiling >= 0.8 THEN 'ATENÇÃO' ELSE 'OK' END AS alert FROM wp LEFT JOIN k USING (serie)""",
)
def ceiling_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = _span(spark, sf_dir)
    days = (last - first).days + 1
    factor = F.expr("CASE serie WHEN '1-URGENT' THEN 0.7D WHEN '5-LOW' THEN 3.0D ELSE 1.4D END")
    contracts = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("serie"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "serie",
            F.when(F.col("serie") != "2-HIGH", F.round(F.col("n") / days * 7 * factor, 1)).alias("ceiling"),
        )
    )
    found = forecast.ceiling_alert(_weekly(spark, sf_dir), contracts, KEYS)
    return found.select("serie", "fold", "week", "ceiling", "use_pct", "alert")


@query(
    "ar1_coeff",
    f"""WITH {DAILY}, {_FOLDS}, x AS (SELECT *, total - lag(total) OVER w AS y FROM d
      WINDOW w AS (PARTITION BY serie ORDER BY data)),
    z AS (SELECT *, lag(y) OVER (PARTITION BY serie ORDER BY data) AS y1 FROM x)
    SELECT serie, fold, count(*) AS n, round(regr_slope(y, y1), 6) AS phi, round(regr_intercept(y, y1), 6) AS intercept
    FROM z JOIN f ON data BETWEEN a AND b WHERE y1 IS NOT NULL GROUP BY 1, 2""",
)
def ar1_coeff(spark: SparkSession, sf_dir: str) -> DataFrame:
    design = forecast.design_rows(daily(spark, sf_dir), KEYS, "total")
    train = forecast.split_days(design, _folds(spark, sf_dir)).where("side = 'train'")
    return _rounded_all(forecast.first_order_coefficients(train, KEYS), ["phi", "intercept"])


def _design(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    design = forecast.split_days(forecast.design_rows(daily(spark, sf_dir), KEYS, "total"), _folds(spark, sf_dir))
    return design.where("side = 'train'"), design.where("side = 'test'")


def _sql_eliminate(name: str, given: str, keys: str, pivots: str) -> str:
    """Gauss-Jordan elimination of a small augmented matrix of (keys, i, j, v): pivot after pivot, all groups at once."""
    on = " AND ".join(f"{{0}}.{k} = s.{k}" for k in keys.split(", "))
    own = ", ".join(f"s.{k}" for k in keys.split(", "))
    return f"""{name}(k, {keys}, i, j, v) AS (SELECT 0, {keys}, i, j, v FROM {given} UNION ALL
      SELECT s.k + 1, {own}, s.i, s.j, CASE WHEN s.i = s.k + 1 THEN s.v / p.v ELSE s.v - c.v * r.v / p.v END FROM {name} s
      JOIN {name} p ON {on.format("p")} AND p.i = s.k + 1 AND p.j = s.k + 1
      JOIN {name} c ON {on.format("c")} AND c.i = s.i AND c.j = s.k + 1
      JOIN {name} r ON {on.format("r")} AND r.i = s.k + 1 AND r.j = s.j WHERE s.k < {pivots})"""


_LONG, _AR, _MA = forecast.LONG_ORDER, forecast.MOST_AR, forecast.MOST_MA
_LONG_TERMS = ", ".join(["1.0::DOUBLE", *(f"l{k}::DOUBLE" for k in range(1, _LONG + 1)), "y::DOUBLE"])
_SHORT_TERMS = ", ".join(["1.0::DOUBLE", *(f"l{k}::DOUBLE" for k in range(1, _AR + 1)), *(f"e{k}" for k in range(1, _MA + 1)), "y::DOUBLE"])
_ORDERS = ", ".join(
    f"({n}, {p}, {q}, [1, {''.join(f'{k + 1}, ' for k in range(1, p + 1))}{''.join(f'{_AR + 1 + k}, ' for k in range(1, q + 1))}{_AR + _MA + 2}])"
    for n, (p, q) in enumerate(forecast.arima_orders())
)
_BETA = ", ".join(f"coalesce(max(v) FILTER (term = {t}), 0)::DOUBLE AS b{t}" for t in range(1, _AR + _MA + 2))
_MOVED = " + ".join(["b1", *(f"b{k + 1} * d{k}" for k in range(1, _AR + 1)), *(f"b{_AR + 1 + k} * e{k}" for k in range(1, _MA + 1))])
_COEFS = ", ".join(f"b{t}" for t in range(1, _AR + _MA + 2))
_STATE = ", ".join([*(f"d{k}" for k in range(1, _AR + 1)), *(f"e{k}" for k in range(1, _MA + 1))])
_SHIFTED = ", ".join(["moved", *(f"d{k}" for k in range(1, _AR)), "0.0::DOUBLE", *(f"e{k}" for k in range(1, _MA))])
_ARIMA = f"""{DAILY}, {_FOLDS},
  x AS (SELECT *, total - lag(total) OVER (PARTITION BY serie ORDER BY data) AS y FROM d),
  l AS (SELECT *, {", ".join(f"lag(y, {k}) OVER (PARTITION BY serie ORDER BY data) AS l{k}" for k in range(1, _LONG + 1))} FROM x),
  tr AS (SELECT fold, l.*, [{_LONG_TERMS}] AS t FROM l JOIN f ON data BETWEEN a AND b WHERE l{_LONG} IS NOT NULL),
  g0 AS (SELECT serie, fold, i, j, sum(t[i] * t[j]) AS v FROM tr, range(1, {_LONG + 3}) AS a(i), range(1, {_LONG + 3}) AS b(j) GROUP BY ALL),
  {_sql_eliminate("s0", "g0", "serie, fold", str(_LONG + 1))},
  b0 AS (SELECT serie, fold, list(v ORDER BY i) AS beta FROM s0 WHERE k = {_LONG + 1} AND j = {_LONG + 2} AND i <= {_LONG + 1} GROUP BY 1, 2),
  sh AS (SELECT tr.*, y - list_dot_product(beta, t[1:{_LONG + 1}]) AS e0 FROM tr JOIN b0 USING (serie, fold)),
  el AS (SELECT *, {", ".join(f"lag(e0, {k}) OVER (PARTITION BY serie, fold ORDER BY data) AS e{k}" for k in range(1, _MA + 1))} FROM sh),
  st AS (SELECT serie, fold, [{_SHORT_TERMS}] AS t FROM el WHERE e{_MA} IS NOT NULL),
  n1 AS (SELECT serie, fold, count(*) AS n FROM st GROUP BY 1, 2),
  full_gram AS (SELECT serie, fold, i, j, sum(t[i] * t[j]) AS v FROM st, range(1, {_AR + _MA + 3}) AS a(i), range(1, {_AR + _MA + 3}) AS b(j) GROUP BY ALL),
  o(o, p, q, cols) AS (VALUES {_ORDERS}),
  g1 AS (SELECT serie, fold, o, list_position(cols, i) AS i, list_position(cols, j) AS j, v, len(cols) AS size
    FROM full_gram, o WHERE list_contains(cols, i) AND list_contains(cols, j)),
  {_sql_eliminate("s1", "g1", "serie, fold, o, size", "s.size - 1")},
  done AS (SELECT * FROM s1 WHERE k = size - 1 AND j = size),
  bics AS (SELECT serie, fold, o, n * ln(v / n) + (size - 1) * ln(n) AS bic FROM done JOIN n1 USING (serie, fold) WHERE i = size),
  won AS (SELECT serie, fold, o, bic FROM bics QUALIFY row_number() OVER (PARTITION BY serie, fold ORDER BY bic, o) = 1),
  coefs AS (SELECT serie, fold, p, q, bic, {_BETA} FROM (SELECT done.*, p, q, bic, cols[i] AS term FROM done JOIN won USING (serie, fold, o) JOIN o USING (o) WHERE i < size) GROUP BY ALL),
  now AS (SELECT serie, fold, max(data) AS start, arg_max(total, data)::DOUBLE AS level, {", ".join(
      f"max({c}) FILTER (n = {k})::DOUBLE AS {c0}{k}" for c, c0, m in (("y", "d", _AR), ("e0", "e", _MA)) for k in range(1, m + 1))}
    FROM (SELECT *, row_number() OVER (PARTITION BY serie, fold ORDER BY data DESC) AS n FROM el) GROUP BY 1, 2),
  ahead(serie, fold, start, h, level, {_STATE}, {_COEFS}) AS (
    SELECT serie, fold, start, 0, level, {_STATE}, {_COEFS} FROM now JOIN coefs USING (serie, fold)
    UNION ALL
    SELECT serie, fold, start, h + 1, level + moved, {_SHIFTED}, {_COEFS} FROM (SELECT *, {_MOVED} AS moved FROM ahead WHERE h < {HORIZON}))"""


@query(
    "arima_order",
    f"WITH RECURSIVE {_ARIMA} SELECT serie, fold, p, q, round(bic, 4)::DOUBLE AS bic, {', '.join(f'round(b{t}, 6)::DOUBLE AS b{t}' for t in range(1, _AR + _MA + 2))} FROM coefs",
)
def arima_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _sides(spark, sf_dir)
    fits = forecast.fit_arima(train, KEYS, "total")
    betas = [rounded(F.col("beta")[t - 1]).alias(f"b{t}") for t in range(1, _AR + _MA + 2)]
    return fits.select(*KEYS, "fold", "p", "q", rounded("bic", 4).alias("bic"), *betas)


@query(
    "all_baselines",
    f"""WITH RECURSIVE {_ARIMA},
    r AS (SELECT serie, fold, max(data) AS start, arg_max(total, data)::DOUBLE AS last, list(total ORDER BY data)[-7:] AS recent FROM d JOIN f ON data BETWEEN a AND b GROUP BY 1, 2),
    m AS (SELECT serie, fold, start, h, unnest(['ingenuo', 'sazonal_7', 'media_7']) AS model,
      unnest([last, recent[(h - 1) % 7 + 1]::DOUBLE, list_avg(recent)::DOUBLE]) AS forecast FROM r, range(1, {HORIZON + 1}) AS t(h))
    SELECT serie, fold, model, h::INTEGER AS h, CAST(start + h::INTEGER AS DATE) AS data, round(forecast, 6)::DOUBLE AS forecast FROM m
    UNION ALL SELECT serie, fold, 'arima', h::INTEGER, CAST(start + h::INTEGER AS DATE), round(level, 6)::DOUBLE FROM ahead WHERE h > 0""",
)
def all_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _sides(spark, sf_dir)
    return _rounded_all(forecast.all_baselines(train, KEYS, "total", HORIZON), ["forecast"])


_PATHS = 500
_DRAWN = ", ".join(["moved", *(f"d{k}" for k in range(1, _AR)), "shock", *(f"e{k}" for k in range(1, _MA))])


@query(
    "path_interval",
    f"""WITH RECURSIVE {_ARIMA},
    pool AS (SELECT serie, fold, list(e0 ORDER BY e0) AS pool FROM sh GROUP BY 1, 2),
    mark AS (SELECT serie, fold, h, md5(concat_ws('#', '42', serie, fold, h)) AS m FROM now, range(1, {HORIZON + 1}) AS t(h)),
    keyed AS (SELECT serie, fold, h, {", ".join(f"CAST('0x' || substr(m, {1 + 7 * k}, 7) AS BIGINT) AS u{k}" for k in range(3))} FROM mark),
    shock AS (SELECT serie, fold, h, path, pool[CAST(floor({resample.sql_uniform("u0", "u1", "u2", "path")} * len(pool)) AS BIGINT) + 1] AS shock
      FROM keyed JOIN pool USING (serie, fold), range(1, {_PATHS + 1}) AS r(path)),
    sim(serie, fold, path, h, level, {_STATE}, {_COEFS}) AS (
      SELECT serie, fold, path, 0, level, {_STATE}, {_COEFS} FROM now JOIN coefs USING (serie, fold), range(1, {_PATHS + 1}) AS r(path)
      UNION ALL
      SELECT serie, fold, path, h + 1, level + moved, {_DRAWN}, {_COEFS} FROM (
        SELECT sim.*, shock.shock, {_MOVED} + shock.shock AS moved FROM sim
        JOIN shock ON shock.serie = sim.serie AND shock.fold = sim.fold AND shock.path = sim.path AND shock.h = sim.h + 1)),
    spans AS (SELECT serie, fold, path, 'day' AS span, h, level AS v FROM sim WHERE h > 0
      UNION ALL SELECT serie, fold, path, 'week', (h - 1) // 7 + 1, sum(level) FROM sim WHERE h > 0 GROUP BY 1, 2, 3, 4, 5)
    SELECT serie, fold, span, h::INTEGER AS h, round(quantile_cont(v, 0.025), 4)::DOUBLE AS low, round(quantile_cont(v, 0.975), 4)::DOUBLE AS high
    FROM spans GROUP BY 1, 2, 3, 4""",
)
def path_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _sides(spark, sf_dir)
    found = forecast.path_intervals(forecast.fit_arima(train, KEYS, "total"), KEYS, HORIZON, _PATHS)
    return _rounded_all(found, ["low", "high"], 4)


@query("arx_backtest")
def arx_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _design(spark, sf_dir)
    fits = forecast.fit_autoregressions(train, test, KEYS, "total")
    points = forecast.autoregression_forecasts(fits, KEYS)
    scored = forecast.with_actuals(points, test, KEYS, "total")
    metrics = forecast.forecast_metrics(scored, [*KEYS, "fold", "model", "p", "bic"])
    return metrics.withColumn("bic", rounded("bic", 4))


@query("arx_parsimony")
def arx_parsimony(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _design(spark, sf_dir)
    fits = forecast.fit_autoregressions(train, test, KEYS, "total")
    return forecast.parsimony_choice(fits, KEYS, "calendario", "calendario_reduzido")


@query("arx_forecast")
def arx_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refit on every day of a series and forecast the next seven with residual bounds."""
    days = daily(spark, sf_dir)
    train = forecast.design_rows(days, KEYS, "total").withColumn("fold", F.lit(0))
    ahead = days.groupBy(*KEYS).agg(F.max("data").alias("_last")).select(
        *KEYS,
        F.lit(0).alias("fold"),
        F.explode(F.sequence(F.date_add("_last", 1), F.date_add("_last", 7))).alias("data"),
    )
    # A small table read twice: by the forecasts and by the residuals behind their bounds.
    fits = settle(forecast.fit_autoregressions(train, ahead, KEYS, "total"), "fits")
    points = forecast.autoregression_forecasts(fits, KEYS).drop("p", "bic")
    residuals = forecast.autoregression_residuals(train, fits, KEYS, "total")
    banded = forecast.residual_interval(points, residuals, [*KEYS, "fold", "model"])
    return banded.drop("fold").withColumns(
        {c: rounded(c, 4) for c in ("forecast", "low", "high")}
    ).withColumn("chamados", F.bround(F.greatest(F.col("forecast"), F.lit(0.0))).cast("int"))
