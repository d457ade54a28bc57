"""Backtests of many daily series: baselines, autoregressions, errors, intervals, alerts.

Series rows are days, so every per-series window or list here is bounded by the calendar or by the
forecast horizon.  All (series, fold) pairs are one DataFrame.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.pvalues import chi2_p_value
from tidemark.functions.calendar import cyclic, holiday_flags
from tidemark.operators.resample import uniforms
from tidemark.operators.folds import Fold, assign_folds
from tidemark.operators.series import weekly_sums
from tidemark.session import settle

ENSEMBLE_WEIGHTS = [1.0, 0.7, 0.5, 0.3, 0.0]
EXOGENOUS = [
    "dow_sin",
    "dow_cos",
    "fim_de_semana",
    "feriado",
    "vespera_feriado",
    "dia_seguinte_feriado",
]
# Model variants: weekly lag or not, and the calendar columns they use.
SPECS = {
    "sazonal": (True, []),
    "calendario": (False, EXOGENOUS),
    "sazonal_feriados": (True, EXOGENOUS[3:]),
    "calendario_reduzido": (False, EXOGENOUS[2:]),
}
MAX_ORDER = 3
SEASON = 7


def split_days(daily: DataFrame, folds: list[Fold], day: str = "data") -> DataFrame:
    """(…, fold, side) of the days of each series."""
    return assign_folds(daily, time=day, folds=folds)


def recent_values(train: DataFrame, keys: list[str], value: str, day: str = "data") -> DataFrame:
    """(keys, fold, last_day, last, recent, mean7): the last seven days of each training part."""
    group = [*keys, "fold"]
    tail = train.withColumn("_last", F.max(day).over(Window.partitionBy(*group))).where(
        F.datediff("_last", day) < SEASON
    )
    return tail.groupBy(*group).agg(
        F.max("_last").alias("last_day"),
        F.max_by(value, day).alias("last"),
        F.transform(F.array_sort(F.collect_list(F.struct(day, value))), lambda s: s[value]).alias("recent"),
        F.avg(value).alias("mean7"),
    )


def baseline_forecasts(
    train: DataFrame, keys: list[str], value: str, horizon: int, day: str = "data"
) -> DataFrame:
    """(keys, fold, model, h, data, forecast) of the naive, seasonal-naive and mean-of-week models."""
    recent = recent_values(train, keys, value, day)
    steps = recent.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    season = F.element_at("recent", ((F.col("h") - 1) % F.size("recent") + 1).cast("int"))
    models = F.array(
        *[
            F.struct(F.lit(name).alias("model"), forecast.cast("double").alias("forecast"))
            for name, forecast in (
                ("ingenuo", F.col("last")),
                ("sazonal_7", season),
                ("media_7", F.col("mean7")),
            )
        ]
    )
    return steps.select(
        *keys,
        "fold",
        "h",
        F.date_add("last_day", F.col("h")).alias(day),
        F.explode(models).alias("_m"),
    ).select(*keys, "fold", "_m.model", "h", day, "_m.forecast")


def with_actuals(
    forecasts: DataFrame, test: DataFrame, keys: list[str], value: str, day: str = "data"
) -> DataFrame:
    return forecasts.join(
        test.select(*keys, "fold", day, F.col(value).alias("actual")), [*keys, "fold", day]
    )


def forecast_metrics(scored: DataFrame, groups: list[str]) -> DataFrame:
    """Absolute, squared and percentage errors per group, and the errors one and seven days out.

    Days with an actual of 0 take no part in the percentage errors.
    """
    error = F.abs(F.col("actual") - F.col("forecast"))
    share = 100.0 * error / F.nullif(F.abs("actual"), F.lit(0))
    rows = scored.select(*groups, "h", error.alias("_e"), share.alias("_p"))
    return rows.groupBy(*groups).agg(
        F.bround(F.avg("_e"), 2).alias("mae"),
        F.bround(F.sqrt(F.avg(F.col("_e") * F.col("_e"))), 2).alias("rmse"),
        F.bround(F.avg("_p"), 2).alias("mape"),
        F.bround(F.percentile("_e", F.lit(0.5)), 2).alias("medae"),
        F.bround(F.percentile("_p", F.lit(0.5)), 2).alias("mdape"),
        F.bround(F.max(F.when(F.col("h") == 1, F.col("_e"))), 2).alias("erro_h1"),
        F.bround(F.max(F.when(F.col("h") == 7, F.col("_e"))), 2).alias("erro_h7"),
    )


def leaderboard(metrics: DataFrame, keys: list[str], error: str = "mae") -> DataFrame:
    """(keys, model, mean, std, median, best_mean, best_median): models over folds.

    A model best by mean but not by median wins on few folds only.
    """
    table = metrics.groupBy(*keys, "model").agg(
        F.avg(error).alias("mean"),
        F.stddev_samp(error).alias("std"),
        F.percentile(error, F.lit(0.5)).alias("median"),
    )
    best = table.groupBy(*keys).agg(
        F.min_by("model", F.struct("mean", "model")).alias("best_mean"),
        F.min_by("model", F.struct("median", "model")).alias("best_median"),
    )
    if keys:
        return table.join(best, keys)
    row = best.select(F.struct("*")).scalar()
    return table.withColumn("_b", row).select(*table.columns, "_b.*")


def blend(forecasts: DataFrame, keys: list[str], model: str, other: str, day: str = "data") -> DataFrame:
    """(…, model, h, data, forecast) of w * model + (1 - w) * other for the fixed weights."""
    wide = forecasts.groupBy(*keys, "fold", "h", day).agg(
        F.max(F.when(F.col("model") == model, F.col("forecast"))).alias("_a"),
        F.max(F.when(F.col("model") == other, F.col("forecast"))).alias("_b"),
    )
    weights = F.array(*[F.lit(w) for w in ENSEMBLE_WEIGHTS])
    return wide.withColumn("_w", F.explode(weights)).select(
        *keys,
        "fold",
        F.concat(F.lit("peso_"), F.format_number("_w", 1)).alias("model"),
        "h",
        day,
        (F.col("_w") * F.col("_a") + (1 - F.col("_w")) * F.col("_b")).alias("forecast"),
    )


def smearing_forecasts(
    train: DataFrame, keys: list[str], value: str, horizon: int, day: str = "data"
) -> DataFrame:
    """(keys, fold, h, plain, factor, corrected) of the weekly mean on the log scale.

    The way back multiplies by the mean of exp(residual) of the training part.
    """
    group = [*keys, "fold"]
    logs = train.withColumn("_log", F.log1p(F.col(value).cast("double")))
    w = Window.partitionBy(*group).orderBy(day).rowsBetween(-SEASON, -1)
    fitted = F.when(F.count("_log").over(w) == SEASON, F.avg("_log").over(w))
    factors = (
        logs.withColumn("_r", F.col("_log") - fitted)
        .groupBy(*group)
        .agg(F.avg(F.exp("_r")).alias("factor"))
    )
    level = recent_values(logs, keys, "_log", day).select(*group, F.col("mean7").alias("_f"))
    return (
        level.join(factors, group)
        .withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
        .select(
            *group,
            "h",
            F.expm1("_f").alias("plain"),
            "factor",
            (F.exp("_f") * F.col("factor") - 1).alias("corrected"),
        )
    )


def seasonal_residuals(train: DataFrame, keys: list[str], value: str, day: str = "data") -> DataFrame:
    """(keys, fold, data, fitted, residual) of the seasonal-naive model inside the training part."""
    w = Window.partitionBy(*keys, "fold").orderBy(day)
    fitted = F.lag(value, SEASON).over(w).cast("double")
    return (
        train.withColumn("fitted", fitted)
        .where(F.col("fitted").isNotNull())
        .select(*keys, "fold", day, "fitted", (F.col(value) - F.col("fitted")).alias("residual"))
    )


def residual_interval(
    forecasts: DataFrame, residuals: DataFrame, groups: list[str], level: float = 0.95
) -> DataFrame:
    """Add low and high: the point plus the residual quantiles, the limit of drawing residuals.

    The band does not widen with the horizon.
    """
    tail = (1 - level) / 2
    band = residuals.groupBy(*groups).agg(
        F.percentile("residual", F.lit(tail)).alias("_lo"),
        F.percentile("residual", F.lit(1 - tail)).alias("_hi"),
    )
    return forecasts.join(band, groups).select(
        *forecasts.columns,
        (F.col("forecast") + F.col("_lo")).alias("low"),
        (F.col("forecast") + F.col("_hi")).alias("high"),
    )


# Residual test -> degrees of freedom.
RESIDUAL_TESTS = {"ljung_box": 1, "jarque_bera": 2, "breusch_pagan": 1}


def residual_diagnostics(residuals: DataFrame, groups: list[str], day: str = "data") -> DataFrame:
    """Autocorrelation (lag 1), normality and variance statistics of residuals, from moments, with their p-values."""
    ordered = Window.partitionBy(*groups).orderBy(day)
    e = residuals.withColumn(
        "_c", F.col("residual") - F.avg("residual").over(Window.partitionBy(*groups))
    )
    e = e.withColumn("_l", F.lag("_c").over(ordered)).withColumn(
        "_sq", F.col("residual") * F.col("residual")
    )
    m = e.groupBy(*groups).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.avg(F.pow("_c", F.lit(2))).alias("m2"),
        F.avg(F.pow("_c", F.lit(3))).alias("m3"),
        F.avg(F.pow("_c", F.lit(4))).alias("m4"),
        (F.sum(F.col("_c") * F.col("_l")) / F.nullif(F.sum(F.col("_c") * F.col("_c")), F.lit(0.0))).alias("r1"),
        F.covar_pop("_sq", "fitted").alias("cov"),
        (F.var_pop("_sq") * F.var_pop("fitted")).alias("spread"),
    )
    n, m2 = F.col("n"), F.nullif(F.col("m2"), F.lit(0.0))
    skew = F.col("m3") / F.pow(m2, F.lit(1.5))
    kurt = F.col("m4") / (m2 * m2)
    return m.select(
        *groups,
        n.cast("bigint").alias("n"),
        (n * (n + 2) * F.col("r1") * F.col("r1") / (n - 1)).alias("ljung_box"),
        skew.alias("skew"),
        kurt.alias("kurtosis"),
        (n / 6 * (skew * skew + (kurt - 3) * (kurt - 3) / 4)).alias("jarque_bera"),
        (n * F.col("cov") * F.col("cov") / F.nullif(F.col("spread"), F.lit(0.0))).alias("breusch_pagan"),
    ).withColumns({f"{name}_p": chi2_p_value(F.col(name), dof) for name, dof in RESIDUAL_TESTS.items()})


def weekly_projection(
    banded: DataFrame, groups: list[str], last_week: DataFrame, factor: float = 5.0
) -> DataFrame:
    """Sum of seven daily forecasts and of their bounds, and whether it is out of all proportion."""
    sums = banded.where(F.col("h") <= SEASON).groupBy(*groups).agg(
        F.sum("forecast").alias("week"), F.sum("low").alias("low"), F.sum("high").alias("high")
    )
    return sums.join(last_week, groups).select(
        *groups,
        "week",
        "low",
        "high",
        "last_week",
        ((F.col("week") < 0) | (F.col("week") > factor * F.col("last_week"))).alias("implausible"),
    )


def weekly_direct(
    train: DataFrame, keys: list[str], value: str, day: str = "data", factor: float = 5.0
) -> DataFrame:
    """(keys, fold, n_weeks, last_week, phi, week, implausible): next week from the weekly grain itself.

    A first-order autoregression of the changes between complete weeks; unlikely sums are marked.
    """
    group = [*keys, "fold"]
    weeks = weekly_sums(train, value=value, keys=group, day=day).where(F.col("n_days") == SEASON)
    w = Window.partitionBy(*group).orderBy("week_end")
    changes = weeks.withColumn("_d", (F.col("total") - F.lag("total").over(w)).cast("double"))
    changes = changes.withColumn("_d1", F.lag("_d").over(w))
    pairs = F.col("_d1").isNotNull()
    fits = changes.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_weeks"),
        F.max_by("total", "week_end").alias("last_week"),
        F.max_by("_d", "week_end").alias("_last_d"),
        F.regr_slope("_d", "_d1").alias("phi"),
        F.avg(F.when(pairs, F.col("_d"))).alias("_y"),
        F.avg(F.when(pairs, F.col("_d1"))).alias("_x"),
    )
    # Without spread there is no slope and the mean change stands in.
    phi = F.coalesce("phi", F.lit(0.0))
    step = F.coalesce(F.col("_y") + phi * (F.col("_last_d") - F.col("_x")), F.lit(0.0))
    week = F.col("last_week") + step
    return fits.select(
        *group,
        "n_weeks",
        "last_week",
        "phi",
        week.alias("week"),
        ((week < 0) | (week > factor * F.col("last_week"))).alias("implausible"),
    )


def ceiling_alert(
    weekly: DataFrame, contracts: DataFrame, keys: list[str], ceiling: str = "ceiling"
) -> DataFrame:
    """Add use of a contract ceiling in percent and an alert; no ceiling, no alert."""
    joined = weekly.join(contracts, keys, "left")
    use = 100.0 * F.col("week") / F.nullif(F.col(ceiling), F.lit(0.0))
    upper = 100.0 * F.col("high") / F.nullif(F.col(ceiling), F.lit(0.0))
    return joined.select(
        *weekly.columns,
        ceiling,
        F.bround(use, 1).alias("use_pct"),
        F.when(F.col(ceiling).isNull(), F.lit("SEM TETO"))
        .when(use >= 100, F.lit("CRÍTICO"))
        .when(upper >= 100, F.lit("ATENÇÃO"))
        .when(use >= 80, F.lit("ATENÇÃO"))
        .otherwise(F.lit("OK"))
        .alias("alert"),
    )


# --- autoregressions with calendar columns -------------------------------------------------------

_TERMS = ["_one", *[f"_d{k}" for k in range(1, MAX_ORDER + 1)], f"_d{SEASON}", *[f"_x_{c}" for c in EXOGENOUS]]


def _exogenous(day: str) -> list[Column]:
    dow = F.weekday(day)
    return [
        *cyclic(dow, 7, "dow"),
        (dow >= 5).cast("int").alias("fim_de_semana"),
        *holiday_flags(F.col(day)),
    ]


def exogenous_changes(days: DataFrame, day: str = "data") -> DataFrame:
    """Add each calendar column's change since the day before.

    The calendar is worked out once per distinct day and joined; it has as many rows as days.
    """
    both = days.select(day).distinct().withColumn("_before", F.date_sub(day, 1))
    now = both.select("*", *_exogenous(day))
    past = now.select("*", *[c.alias(f"_p_{n}") for c, n in zip(_exogenous("_before"), EXOGENOUS)])
    changes = past.select(
        day, *[(F.col(c) - F.col(f"_p_{c}")).cast("double").alias(f"_x_{c}") for c in EXOGENOUS]
    )
    return days.join(F.broadcast(changes), day, "left").select(*days.columns, *[f"_x_{c}" for c in EXOGENOUS])


def design_rows(daily: DataFrame, keys: list[str], value: str, day: str = "data") -> DataFrame:
    """First differences with their lags and the calendar changes; the first days drop out."""
    w = Window.partitionBy(*keys).orderBy(day)
    d = daily.withColumn("_d", (F.col(value) - F.lag(value).over(w)).cast("double"))
    lagged = d.select(
        *daily.columns,
        "_d",
        F.lit(1.0).alias("_one"),
        *[F.lag("_d", k).over(w).alias(f"_d{k}") for k in [*range(1, MAX_ORDER + 1), SEASON]],
    )
    return exogenous_changes(lagged, day)


def _chosen(seasonal: bool, exog: list[str], order: int) -> list[int]:
    names = ["_one", *[f"_d{k}" for k in range(1, order + 1)]]
    names += [f"_d{SEASON}"] if seasonal else []
    names += [f"_x_{c}" for c in exog]
    return [_TERMS.index(n) for n in names]


def fit_autoregressions(
    train: DataFrame, future: DataFrame, keys: list[str], value: str, day: str = "data"
) -> DataFrame:
    """(keys, fold, spec, p, bic, beta, start, path): order by BIC and a recursive forecast per variant.

    ``train`` holds design rows with a fold; ``future`` holds (keys, fold, day) of the days to predict.
    Spark sums the cross products and gathers at most a horizon of calendar rows per (series, fold);
    the workers only solve the small systems.
    """
    group = [*keys, "fold"]
    all_terms = [*_TERMS, "_d"]
    size = len(all_terms)
    complete = train.dropna(subset=all_terms)
    cross = [
        F.sum(F.col(all_terms[i]) * F.col(all_terms[j])).alias(f"_g{i}_{j}")
        for i in range(size)
        for j in range(i, size)
    ]
    grams = complete.groupBy(*group).agg(F.count(F.lit(1)).alias("n_rows"), *cross)
    grams = grams.select(
        *group,
        "n_rows",
        F.array(*[F.col(f"_g{min(i, j)}_{max(i, j)}") for i in range(size) for j in range(size)]).alias("gram"),
    )
    tail = train.withColumn("_last", F.max(day).over(Window.partitionBy(*group))).where(
        F.datediff("_last", day) < SEASON
    )
    state = tail.groupBy(*group).agg(
        F.max(day).alias("start"),
        F.max_by(value, day).cast("double").alias("level"),
        F.transform(F.array_sort(F.collect_list(F.struct(day, "_d"))), lambda s: s["_d"]).alias("changes"),
    )
    ahead = exogenous_changes(future.select(*group, day), day)
    ahead = ahead.groupBy(*group).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(day, F.array(*[F.col(f"_x_{c}") for c in EXOGENOUS]).alias("x")))),
            lambda s: s["x"],
        ).alias("ahead")
    )
    one_row = grams.join(state, group).join(ahead, group)
    schema = one_row.select(*group).schema
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                gram = np.asarray(row.gram, dtype=float).reshape(size, size)
                ids = [getattr(row, k) for k in group]
                x_ahead = [np.asarray(x, dtype=float) for x in row.ahead]
                for spec, (seasonal, exog) in SPECS.items():
                    best = None
                    for order in range(MAX_ORDER + 1):
                        cols = _chosen(seasonal, exog, order)
                        xx, xy = gram[np.ix_(cols, cols)], gram[cols, -1]
                        beta = np.linalg.lstsq(xx, xy, rcond=1e-10)[0]
                        rss = max(gram[-1, -1] - 2 * beta @ xy + beta @ xx @ beta, 1e-12)
                        bic = row.n_rows * np.log(rss / row.n_rows) + len(cols) * np.log(row.n_rows)
                        if best is None or bic < best[0]:
                            full = np.zeros(size - 1)
                            full[cols] = beta
                            best = (bic, order, full)
                    bic, order, beta = best
                    changes, level, path = list(row.changes), row.level, []
                    for x in x_ahead:
                        lags = [changes[-k] if len(changes) >= k else 0.0 for k in range(1, MAX_ORDER + 1)]
                        week = changes[-SEASON] if len(changes) >= SEASON else 0.0
                        step = float(beta @ np.concatenate([[1.0], lags, [week], x]))
                        changes.append(step)
                        level += step
                        path.append(level)
                    out.append((*ids, spec, order, float(bic), beta.tolist(), row.start, path))
            yield pd.DataFrame(out, columns=[*group, "spec", "p", "bic", "beta", "start", "path"])

    return one_row.mapInPandas(
        solve, f"{fields}, spec string, p int, bic double, beta array<double>, start date, path array<double>"
    )


def autoregression_forecasts(fits: DataFrame, keys: list[str], day: str = "data") -> DataFrame:
    """(keys, fold, model, p, bic, h, data, forecast) from fitted paths."""
    steps = fits.select(
        *keys,
        "fold",
        F.col("spec").alias("model"),
        "p",
        "bic",
        "start",
        F.posexplode("path").alias("_i", "forecast"),
    )
    return steps.select(
        *keys,
        "fold",
        "model",
        "p",
        "bic",
        (F.col("_i") + 1).alias("h"),
        F.date_add("start", F.col("_i") + 1).alias(day),
        "forecast",
    )


def autoregression_residuals(
    train: DataFrame, fits: DataFrame, keys: list[str], value: str, day: str = "data"
) -> DataFrame:
    """(keys, fold, model, data, fitted, residual) on the level scale, start-up days left out."""
    rows = train.dropna(subset=[*_TERMS, "_d"]).select(
        *keys, "fold", day, value, "_d", F.array(*[F.col(t) for t in _TERMS]).alias("_x")
    )
    joined = rows.join(fits.select(*keys, "fold", F.col("spec").alias("model"), "beta"), [*keys, "fold"])
    step = F.aggregate(
        F.zip_with("_x", "beta", lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v
    )
    return joined.select(
        *keys,
        "fold",
        "model",
        day,
        (F.col(value) - F.col("_d") + step).alias("fitted"),
        (F.col("_d") - step).alias("residual"),
    )


def parsimony_choice(fits: DataFrame, keys: list[str], full: str, reduced: str) -> DataFrame:
    """(keys, n_folds, n_reduced, chosen): the smaller variant where BIC prefers it in most folds."""
    wide = fits.groupBy(*keys, "fold").agg(
        F.max(F.when(F.col("spec") == full, F.col("bic"))).alias("_f"),
        F.max(F.when(F.col("spec") == reduced, F.col("bic"))).alias("_r"),
    )
    votes = wide.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_folds"), F.count_if(F.col("_r") < F.col("_f")).alias("n_reduced")
    )
    return votes.withColumn(
        "chosen",
        F.when(F.col("n_reduced") * 2 > F.col("n_folds"), F.lit(reduced)).otherwise(F.lit(full)),
    )


def first_order_coefficients(train: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, fold, n, phi, intercept) of the difference on its first lag."""
    rows = train.where(F.col("_d1").isNotNull())
    return rows.groupBy(*keys, "fold").agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope("_d", "_d1").alias("phi"),
        F.regr_intercept("_d", "_d1").alias("intercept"),
    )


def unit_root_statistic(
    daily: DataFrame, keys: list[str], value: str, day: str = "data", n_lags: int = 7
) -> DataFrame:
    """(keys, n, adf): t value of the level in a fixed-lag unit-root regression with a constant."""
    w = Window.partitionBy(*keys).orderBy(day)
    base = daily.select(*keys, day, F.col(value).cast("double").alias("_v"))
    d = base.withColumn("_y", F.lag("_v").over(w)).withColumn("_d", F.col("_v") - F.col("_y"))
    rows = d.select(
        *keys, "_d", "_y", F.lit(1.0).alias("_one"),
        *[F.lag("_d", k).over(w).alias(f"_l{k}") for k in range(1, n_lags + 1)],
    )
    terms = ["_y", "_one", *[f"_l{k}" for k in range(1, n_lags + 1)], "_d"]
    size = len(terms)
    sums = rows.dropna().groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.sum(F.col(terms[i]) * F.col(terms[j])).alias(f"_g{i}_{j}")
            for i in range(size)
            for j in range(i, size)
        ],
    )
    grams = sums.select(
        *keys,
        "n",
        F.array(*[F.col(f"_g{min(i, j)}_{max(i, j)}") for i in range(size) for j in range(size)]).alias("gram"),
    )

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = []
            for n, flat in zip(batch["n"], batch["gram"]):
                gram = np.asarray(flat, dtype=float).reshape(size, size)
                inverse = np.linalg.pinv(gram[:-1, :-1])
                beta = inverse @ gram[:-1, -1]
                rss = gram[-1, -1] - beta @ gram[:-1, -1]
                error = np.sqrt(max(rss, 0.0) / max(n - size + 1, 1) * inverse[0, 0])
                values.append(float(beta[0] / error) if error > 0 else None)
            yield batch[[*keys, "n"]].assign(adf=values)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in grams.select(*keys, "n").schema.fields)
    return grams.mapInPandas(solve, f"{fields}, adf double")


def partial_autocorrelation(acf: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, lag, pacf) from a few autocorrelations per series, by the Levinson recursion."""
    lists = acf.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("lag", "acf"))), lambda s: s["acf"]).alias("r")
    )

    def recurse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                r = np.asarray(row.r, dtype=float)
                phi = np.zeros(0)
                for k in range(1, len(r) + 1):
                    known = r[: k - 1]
                    last = (r[k - 1] - phi @ known[::-1]) / (1 - phi @ known)
                    phi = np.append(phi - last * phi[::-1], last)
                    out.append((*[getattr(row, c) for c in keys], k, float(last)))
            yield pd.DataFrame(out, columns=[*keys, "lag", "pacf"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lists.select(*keys).schema.fields)
    return lists.mapInPandas(recurse, f"{fields}, lag int, pacf double")


# --- moving-average terms in two stages ----------------------------------------------------------

LONG_ORDER = 10
MOST_AR, MOST_MA = 3, 3


def _cross_products(rows: DataFrame, group: list[str], terms: list[str]) -> DataFrame:
    """(group, n_rows, gram): sums of products of all pairs of terms, one row per group."""
    pairs = [(i, j) for i in range(len(terms)) for j in range(i, len(terms))]
    sums = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.sum(F.col(terms[i]) * F.col(terms[j])).alias(f"_g{i}_{j}") for i, j in pairs]
    )
    size = range(len(terms))
    return sums.select(*group, "n_rows", F.array(*[F.col(f"_g{min(i, j)}_{max(i, j)}") for i in size for j in size]).alias("gram"))


def _regressions(grams: DataFrame, group: list[str], choices: list[tuple[int, ...]], n_terms: int) -> DataFrame:
    """(group, beta, choice, bic): of the column choices the one of least BIC; absent columns have coefficient 0."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in grams.select(*group).schema.fields)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                gram = np.asarray(row.gram, dtype=float).reshape(n_terms, n_terms)
                best = None
                for number, columns in enumerate(choices):
                    cols = list(columns)
                    xx, xy = gram[np.ix_(cols, cols)], gram[cols, -1]
                    beta = np.linalg.lstsq(xx, xy, rcond=1e-12)[0]
                    rss = max(gram[-1, -1] - 2 * beta @ xy + beta @ xx @ beta, 1e-12)
                    bic = row.n_rows * np.log(rss / row.n_rows) + len(cols) * np.log(row.n_rows)
                    if best is None or bic < best[0]:
                        full = np.zeros(n_terms - 1)
                        full[cols] = beta
                        best = (float(bic), number, full.tolist())
                out.append((*[getattr(row, g) for g in group], best[2], best[1], best[0]))
            yield pd.DataFrame(out, columns=[*group, "beta", "choice", "bic"])

    return grams.mapInPandas(solve, f"{fields}, beta array<double>, choice int, bic double")


def arima_orders() -> list[tuple[int, int]]:
    """(p, q) from few terms to many: the first of equal BIC is the smallest."""
    return sorted(((p, q) for p in range(MOST_AR + 1) for q in range(MOST_MA + 1)), key=lambda o: (sum(o), o))


def fit_arima(train: DataFrame, keys: list[str], value: str, day: str = "data") -> DataFrame:
    """(keys, fold, p, q, bic, beta, start, level, changes, shocks, pool) of a pure ARIMA(p, 1, q) per series and fold.

    Two stages on sums of cross products: a long autoregression of the first differences, whose residuals stand
    for the shocks, then a regression on lagged differences and lagged shocks; (p, q) by BIC. ``beta`` is the
    constant, the lags of the difference and of the shocks; ``pool`` holds all shocks, sorted. ``train`` holds (keys, fold, day, value) without gaps.
    """
    group = [*keys, "fold"]
    w = Window.partitionBy(*group).orderBy(day)
    lags = [f"_l{k}" for k in range(1, LONG_ORDER + 1)]
    change = train.select(*group, day, F.col(value).cast("double").alias("_v"), (F.col(value) - F.lag(value).over(w)).cast("double").alias("_d"))
    rows = change.select("*", F.lit(1.0).alias("_one"), *[F.lag("_d", k).over(w).alias(c) for k, c in enumerate(lags, 1)])
    long_terms = ["_one", *lags, "_d"]
    whole = rows.dropna(subset=long_terms)
    first = _regressions(_cross_products(whole, group, long_terms), group, [tuple(range(LONG_ORDER + 1))], len(long_terms))
    # Days of a series are bounded by the calendar, and so are these windows.
    fitted = whole.join(first.select(*group, "beta"), group)
    expected = sum(F.col("beta")[i] * F.col(c) for i, c in enumerate(long_terms[:-1]))
    shocked = fitted.withColumn("_e", F.col("_d") - expected)
    shocks = [f"_e{k}" for k in range(1, MOST_MA + 1)]
    shocked = settle(shocked.select(*group, day, "_v", "_one", *lags[:MOST_AR], "_d", "_e", *[F.lag("_e", k).over(w).alias(c) for k, c in enumerate(shocks, 1)]), "shocks")
    terms = ["_one", *lags[:MOST_AR], *shocks, "_d"]
    orders = arima_orders()
    choices = [(0, *range(1, p + 1), *range(MOST_AR + 1, MOST_AR + q + 1)) for p, q in orders]
    second = _regressions(_cross_products(shocked.dropna(subset=terms), group, terms), group, choices, len(terms))
    last = shocked.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc(day)))).where(F.col("_n") <= max(MOST_AR, MOST_MA))

    def newest(column: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.struct("_n", column))), lambda s: s[column])

    state = last.groupBy(*group).agg(
        F.max(day).alias("start"), F.max_by("_v", day).alias("level"), newest("_d").alias("changes"), newest("_e").alias("shocks")
    )
    order = F.element_at(F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p, q in orders]), F.col("choice") + 1)
    pool = shocked.groupBy(*group).agg(F.sort_array(F.collect_list("_e")).alias("pool"))
    return second.withColumn("_o", order).join(state, group).join(pool, group).select(
        *group, "_o.p", "_o.q", "bic", "beta", "start", "level", "changes", "shocks", "pool"
    )


def arima_forecasts(fits: DataFrame, keys: list[str], horizon: int, day: str = "data", model: str = "arima") -> DataFrame:
    """(keys, fold, model, h, data, forecast): the fitted recursion, coming shocks at their mean of 0."""
    beta = F.col("beta")

    def step(acc: Column, _: Column) -> Column:
        moved = beta[0] + sum(beta[k] * acc["changes"][k - 1] for k in range(1, MOST_AR + 1)) + sum(
            beta[MOST_AR + k] * acc["shocks"][k - 1] for k in range(1, MOST_MA + 1)
        )
        level = acc["level"] + moved
        return F.struct(
            level.alias("level"),
            F.concat(F.array(moved), F.slice(acc["changes"], 1, MOST_AR - 1)).alias("changes"),
            F.concat(F.array(F.lit(0.0)), F.slice(acc["shocks"], 1, MOST_MA - 1)).alias("shocks"),
            F.concat(acc["path"], F.array(level)).alias("path"),
        )

    start = F.struct("level", "changes", "shocks", F.array().cast("array<double>").alias("path"))
    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step, lambda acc: acc["path"])
    steps = fits.select(*keys, "fold", "start", F.posexplode(path).alias("_i", "forecast"))
    return steps.select(
        *keys, "fold", F.lit(model).alias("model"), (F.col("_i") + 1).alias("h"), F.date_add("start", F.col("_i") + 1).alias(day), "forecast"
    )


def path_intervals(
    fits: DataFrame, keys: list[str], horizon: int, paths: int = 500, level: float = 0.95, seed: int = 42
) -> DataFrame:
    """(keys, fold, span, h, low, high): bounds from simulated paths, per day and per week of seven days.

    Every path runs the fitted recursion with shocks drawn from the observed ones, so bounds widen with the
    horizon, and a week's bound is a bound of the sum. Draws are repeatable: a digest of seed, series, fold and day
    gives a uniform number per path, which looks up the sorted shocks.
    """
    group = [*keys, "fold"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fits.select(*group).schema.fields)
    tail = (1 - level) / 2

    def simulate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers = np.arange(1, paths + 1)
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                ids = [getattr(row, g) for g in group]
                beta, pool = np.asarray(row.beta), np.asarray(row.pool)
                changes = [np.full(paths, v) for v in row.changes]
                shocks = [np.full(paths, v) for v in row.shocks]
                at, levels = np.full(paths, row.level), []
                for h in range(1, horizon + 1):
                    mark = hashlib.md5("#".join(str(v) for v in (seed, *ids, h)).encode()).hexdigest()
                    drawn = uniforms(*([int(mark[7 * k : 7 * k + 7], 16)] for k in range(3)), numbers)[0]
                    shock = pool[(drawn * len(pool)).astype(int)]
                    moved = beta[0] + sum(beta[k + 1] * changes[k] for k in range(MOST_AR)) + sum(
                        beta[MOST_AR + k + 1] * shocks[k] for k in range(MOST_MA)
                    ) + shock
                    at = at + moved
                    changes, shocks = [moved, *changes[:-1]], [shock, *shocks[:-1]]
                    levels.append(at)
                for h, values in enumerate(levels, 1):
                    out.append((*ids, "day", h, *np.quantile(values, [tail, 1 - tail])))
                for week in range(horizon // SEASON):
                    total = sum(levels[week * SEASON : (week + 1) * SEASON])
                    out.append((*ids, "week", week + 1, *np.quantile(total, [tail, 1 - tail])))
            yield pd.DataFrame(out, columns=[*group, "span", "h", "low", "high"])

    return fits.mapInPandas(simulate, f"{fields}, span string, h int, low double, high double")


def all_baselines(train: DataFrame, keys: list[str], value: str, horizon: int, day: str = "data") -> DataFrame:
    """The three simple baselines and the pure ARIMA in one table of (keys, fold, model, h, data, forecast)."""
    simple = baseline_forecasts(train, keys, value, horizon, day)
    return simple.unionByName(arima_forecasts(fit_arima(train, keys, value, day), keys, horizon, day))
