"""Daily and weekly series: gap-filled spines, lags, moving means, differences, jumps.

Everything here works on rows already aggregated to one per (series, day).  A series holds at most as
many rows as there are calendar days, so a window per series is small however many tickets it counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import day_spine, week_of_wednesday


def daily_counts(
    df: DataFrame,
    *,
    time: str,
    keys: list[str] | None = None,
    day: str = "data",
    measures: dict[str, Column] | None = None,
) -> DataFrame:
    """Rows per (key, day) between the first and last observed day; empty days hold 0.

    ``measures`` maps further output columns to conditions counted in the same pass.
    """
    keys = keys or []
    measures = measures or {}
    names = ["total", *measures]
    counts = (
        df.where(F.col(time).isNotNull())
        .withColumn(day, F.to_date(time))
        .groupBy(*keys, day)
        .agg(
            F.count(F.lit(1)).alias("total"),
            *[F.count_if(c).alias(n) for n, c in measures.items()],
        )
    )
    spine = day_spine(counts, keys, day)
    return spine.join(counts, [*keys, day], "left").select(
        *keys, day, *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names]
    )


def per_series(keys: list[str], day: str):
    return Window.partitionBy(*keys).orderBy(day)


def lags(value: str, keys: list[str], day: str, count: int, prefix: str) -> list[Column]:
    w = per_series(keys, day)
    return [F.lag(value, k).over(w).alias(f"{prefix}_{k}") for k in range(1, count + 1)]


def mean_of_previous(value: str, keys: list[str], day: str, size: int) -> Column:
    """Mean of the ``size`` days before the row; null until they are all there."""
    w = per_series(keys, day).rowsBetween(-size, -1)
    return F.when(F.count(value).over(w) == size, F.avg(value).over(w))


def trailing_mean(value: str, keys: list[str], day: str, size: int) -> Column:
    """Mean of the last ``size`` days with the row's own (not for features: it sees the present)."""
    w = per_series(keys, day).rowsBetween(1 - size, 0)
    return F.when(F.count(value).over(w) == size, F.avg(value).over(w))


def differences(df: DataFrame, *, value: str, keys: list[str], day: str, season: int = 7) -> DataFrame:
    """Add ``diff`` (to the day before) and ``season_diff`` (of diff to a season before)."""
    w = per_series(keys, day)
    first = df.withColumn("diff", F.col(value) - F.lag(value).over(w))
    return first.withColumn("season_diff", F.col("diff") - F.lag("diff", season).over(w))


def anomalous_jumps(
    df: DataFrame, *, value: str, keys: list[str], day: str, limit: float = 3.0
) -> DataFrame:
    """Days whose change lies more than ``limit`` sample deviations from the mean change."""
    w = per_series(keys, day)
    whole = Window.partitionBy(*keys)
    changes = df.withColumn("change", F.col(value) - F.lag(value).over(w))
    scored = changes.withColumn(
        "z",
        (F.col("change") - F.avg("change").over(whole))
        / F.nullif(F.stddev_samp("change").over(whole), F.lit(0.0)),
    )
    return scored.where(F.abs("z") > limit).withColumn("z", F.bround("z", 2))


def weekly_sums(df: DataFrame, *, value: str, keys: list[str], day: str) -> DataFrame:
    """Wednesday-to-Tuesday sums, labelled with the closing Tuesday."""
    return (
        df.groupBy(*keys, F.date_add(week_of_wednesday(F.col(day)), 6).alias("week_end"))
        .agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n_days"))
    )


def missing_days(counts: DataFrame, *, keys: list[str], day: str) -> DataFrame:
    """Calendar days of the observed span without any row."""
    return day_spine(counts, keys, day).join(counts.select(*keys, day), [*keys, day], "left_anti")


def seasonal_decompose(
    df: DataFrame, *, value: str, keys: list[str], day: str, period: int = 7
) -> DataFrame:
    """Classical additive parts: centred moving mean, mean by phase, remainder."""
    half = period // 2
    w = per_series(keys, day)
    centred = w.rowsBetween(-half, half)
    parts = df.withColumn(
        "trend", F.when(F.count(value).over(centred) == period, F.avg(value).over(centred))
    )
    phase = F.weekday(day) if period == 7 else F.datediff(F.col(day), F.lit("1970-01-01")) % period
    parts = parts.withColumn("_phase", phase).withColumn("_detrended", F.col(value) - F.col("trend"))
    parts = parts.withColumn("_raw", F.avg("_detrended").over(Window.partitionBy(*keys, "_phase")))
    # Phase means are centred, each phase weighing the same, so that a season sums to zero.
    means = parts.groupBy(*keys, "_phase").agg(F.avg("_detrended").alias("_m"))
    centre = means.groupBy(*keys).agg(F.avg("_m").alias("_c"))
    if keys:
        parts = parts.join(centre, keys, "left")
    else:
        parts = parts.withColumn("_c", centre.select("_c").scalar())
    return parts.select(
        *df.columns,
        "trend",
        (F.col("_raw") - F.col("_c")).alias("seasonal"),
        (F.col("_detrended") - (F.col("_raw") - F.col("_c"))).alias("remainder"),
    )


def autocorrelation(
    df: DataFrame, *, value: str, keys: list[str], day: str, max_lag: int = 30
) -> DataFrame:
    """(key, lag, acf) for lags 1..max_lag around the mean of the whole series."""
    w = per_series(keys, day)
    centred = df.withColumn("_c", F.col(value) - F.avg(value).over(Window.partitionBy(*keys)))
    shifted = centred.select(
        *keys, "_c", *[F.lag("_c", k).over(w).alias(f"_l{k}") for k in range(1, max_lag + 1)]
    )
    sums = shifted.groupBy(*keys).agg(
        F.sum(F.col("_c") * F.col("_c")).alias("_v"),
        *[F.sum(F.col("_c") * F.col(f"_l{k}")).alias(f"_s{k}") for k in range(1, max_lag + 1)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(k).alias("lag"),
                (F.col(f"_s{k}") / F.nullif(F.col("_v"), F.lit(0.0))).alias("acf"),
            )
            for k in range(1, max_lag + 1)
        ]
    )
    return sums.select(*keys, F.explode(rows).alias("_r")).select(*keys, "_r.*")


def kpss_level(df: DataFrame, *, value: str, keys: list[str], day: str, n_lags: int) -> DataFrame:
    """(key, n, kpss): level-stationarity statistic with a Bartlett window of ``n_lags``."""
    w = per_series(keys, day)
    centred = df.withColumn("_e", F.col(value) - F.avg(value).over(Window.partitionBy(*keys)))
    steps = centred.select(
        *keys,
        "_e",
        F.sum("_e").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_s"),
        *[F.lag("_e", k).over(w).alias(f"_l{k}") for k in range(1, n_lags + 1)],
    )
    sums = steps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("_s") * F.col("_s")).alias("_ss"),
        F.sum(F.col("_e") * F.col("_e")).alias("_g0"),
        *[F.sum(F.col("_e") * F.col(f"_l{k}")).alias(f"_g{k}") for k in range(1, n_lags + 1)],
    )
    long_run = F.col("_g0")
    for k in range(1, n_lags + 1):
        weight = 2.0 * (1 - k / (n_lags + 1))
        long_run = long_run + weight * F.coalesce(F.col(f"_g{k}"), F.lit(0.0))
    return sums.select(
        *keys, "n", (F.col("_ss") / F.nullif(F.col("n") * long_run, F.lit(0.0))).alias("kpss")
    )


# Published 5 % points of both tests with a constant and no trend.
CRITICAL_5PCT = {"kpss": 0.463, "adf": -2.86}


def difference_forms(df: DataFrame, *, value: str, keys: list[str], day: str) -> DataFrame:
    """(keys, day, form, value): the level, its difference and the seasonal difference of that, without their empty heads."""
    names = [value, "diff", "season_diff"]
    forms = F.array(*[F.struct(F.lit(n).alias("form"), F.col(n).cast("double").alias("_v")) for n in names])
    wide = differences(df, value=value, keys=keys, day=day)
    return (
        wide.select(*keys, day, F.explode(forms).alias("_f"))
        .select(*keys, day, "_f.form", F.col("_f._v").alias(value))
        .where(F.col(value).isNotNull())
    )


def against_critical(found: DataFrame, statistic: str) -> DataFrame:
    """Add the 5 % point and whether the test's null hypothesis falls: KPSS above it, the unit root below it."""
    limit, at = F.lit(CRITICAL_5PCT[statistic]), F.col(statistic)
    return found.withColumns({"critical_5pct": limit, "rejected": at > limit if statistic == "kpss" else at < limit})
