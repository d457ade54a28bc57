"""Counts, shares, quantiles and other descriptive tables of tickets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import day_spine, sunday_week_label
from tidemark.operators.ordering import exact_quantiles
from tidemark.sources.contracts import unpivot_text

def row_count() -> Column:
    return F.count(F.lit(1))


def counts_for_agreement() -> Column:
    return F.col("entrou_kpi") == "SIM"


def eligible(df: DataFrame) -> DataFrame:
    """Tickets that count for the agreement, with the 0/1 target; an unknown outcome is 0."""
    return df.where(counts_for_agreement()).withColumn(
        "target", F.coalesce((F.col("kpi_violado") == "SIM").cast("int"), F.lit(0))
    )


def profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """(column_name, dtype, n_filled, n_null, pct_null, n_distinct), most empty first.

    Exact distinct counts come from one count of (column, value) cells; ``approximate`` reads the table
    once without a shuffle of values.
    """
    kinds = dict(df.dtypes)
    if approximate:
        sums = df.agg(
            row_count().alias("_rows"),
            *[F.count(c).alias(f"f_{c}") for c in df.columns],
            *[F.approx_count_distinct(c).alias(f"d_{c}") for c in df.columns],
        )
        cells = F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.col(f"f_{c}").alias("n_filled"),
                    (F.col("_rows") - F.col(f"f_{c}")).alias("n_null"),
                    F.col(f"d_{c}").alias("n_distinct"),
                )
                for c in df.columns
            ]
        )
        found = sums.select(F.explode(cells).alias("_r")).select("_r.*")
    else:
        counts = unpivot_text(df, df.columns).groupBy("column_name", "value").agg(row_count().alias("n"))
        filled = F.col("value").isNotNull()
        found = counts.groupBy("column_name").agg(
            F.coalesce(F.sum(F.when(filled, F.col("n"))), F.lit(0)).alias("n_filled"),
            F.coalesce(F.sum(F.when(~filled, F.col("n"))), F.lit(0)).alias("n_null"),
            F.count("value").alias("n_distinct"),
        )
    named = F.create_map(*[x for c, k in kinds.items() for x in (F.lit(c), F.lit(k))])
    share = 100.0 * F.col("n_null") / (F.col("n_filled") + F.col("n_null"))
    return found.select(
        "column_name",
        F.element_at(named, F.col("column_name")).alias("dtype"),
        "n_filled",
        "n_null",
        F.bround(share, 2).alias("pct_null"),
        "n_distinct",
    ).orderBy(F.desc("pct_null"), "column_name")


def temporal_coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, first_time, last_time, n_days) per time column, in one pass."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("at")) for c in columns]
    )
    times = df.select(F.explode(cells).alias("_c")).select("_c.*")
    days = times.groupBy("column_name", F.to_date("at").alias("_d")).agg(
        F.min("at").alias("_a"), F.max("at").alias("_b")
    )
    return days.groupBy("column_name").agg(
        F.min("_a").alias("first_time"), F.max("_b").alias("last_time"), F.count("_d").alias("n_days")
    )


def group_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key; a null in any key drops the row, as in the tables this replaces."""
    return df.dropna(subset=keys).groupBy(*keys).agg(row_count().alias("n"))


def rate_by(df: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """(keys, n, n_positive, rate_pct) of a 0/1 column."""
    return (
        df.dropna(subset=keys)
        .groupBy(*keys)
        .agg(row_count().alias("n"), F.sum(flag).alias("n_positive"))
        .withColumn("rate_pct", F.bround(100.0 * F.col("n_positive") / F.col("n"), 2))
    )


def duration_reference(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Median, mean, 90 % quantile and count per group, one decimal, longest median first."""
    rows = df.dropna(subset=[*keys, value])
    spread = exact_quantiles(rows, keys, value, {"mediana": 0.5, "p90": 0.9})
    means = rows.groupBy(*keys).agg(F.avg(value).alias("media"))
    return (
        spread.join(means, keys)
        .select(
            *keys,
            F.bround("mediana", 1).alias("mediana"),
            F.bround("media", 1).alias("media"),
            F.bround("p90", 1).alias("p90"),
            "n",
        )
        .orderBy(F.desc("mediana"), *keys)
    )


def describe(df: DataFrame, value: str, keys: list[str], probs: dict[str, float]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quantiles per group."""
    rows = df.dropna(subset=[*keys, value])
    moments = rows.groupBy(*keys).agg(
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    spread = exact_quantiles(rows, keys, value, probs)
    if keys:
        return spread.join(moments, keys)
    row = moments.select(F.struct("*").alias("m")).scalar()
    return spread.withColumn("_m", row).select(*spread.columns, "_m.*")


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Long contingency table: (a, b, n)."""
    return group_counts(df, [a, b])


def crosstab_margins(df: DataFrame, a: str, b: str, label: str = "All") -> DataFrame:
    """Long contingency table with row, column and grand totals under ``label``."""
    cells = df.dropna(subset=[a, b]).cube(a, b).agg(
        row_count().alias("n"), F.grouping(a).alias("_ga"), F.grouping(b).alias("_gb")
    )
    return cells.select(
        F.when(F.col("_ga") == 1, F.lit(label)).otherwise(F.col(a)).alias(a),
        F.when(F.col("_gb") == 1, F.lit(label)).otherwise(F.col(b)).alias(b),
        "n",
    )


def crosstab_row_share(df: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, n, pct): share of b inside a, in percent."""
    cells = crosstab(df, a, b)
    totals = cells.groupBy(a).agg(F.sum("n").alias("_t"))
    return cells.join(totals, a).select(a, b, "n", (100.0 * F.col("n") / F.col("_t")).alias("pct"))


def pivot_mean(df: DataFrame, row: str, column: str, values: list, flag: str) -> DataFrame:
    """Wide table of means with a declared column list; absent cells are null."""
    return df.dropna(subset=[row]).groupBy(row).pivot(column, values).agg(F.avg(flag))


def pareto(df: DataFrame, value: str, top: int, keep_null: bool = False) -> DataFrame:
    """(value, n, pct, cum_pct) of the ``top`` most frequent values.

    The running share of a leading value needs only the values before it, so it is taken over the
    report's ``top`` rows and divided by the total of all values.
    """
    rows = df if keep_null else df.where(F.col(value).isNotNull())
    counts = rows.groupBy(value).agg(row_count().alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    leading = counts.orderBy(F.desc("n"), F.asc_nulls_first(value)).limit(top)
    running = Window.orderBy(F.desc("n"), F.asc_nulls_first(value)).rowsBetween(
        Window.unboundedPreceding, 0
    )
    return leading.select(
        value,
        "n",
        (100.0 * F.col("n") / total).alias("pct"),
        (100.0 * F.sum("n").over(running) / total).alias("cum_pct"),
    )


def cardinality(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, n_filled, n_distinct, uniqueness)."""
    counts = (
        unpivot_text(df, columns)
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(row_count().alias("n"))
    )
    return counts.groupBy("column_name").agg(
        F.sum("n").alias("n_filled"), F.count(F.lit(1)).alias("n_distinct")
    ).withColumn("uniqueness", F.col("n_distinct") / F.col("n_filled"))


def duplicate_counts(df: DataFrame, key_sets: dict[str, list[str]]) -> DataFrame:
    """(scope, n_rows, n_repeated): rows that repeat an earlier one, nulls being equal."""
    parts = []
    for scope, keys in key_sets.items():
        copies = df.groupBy(*keys).agg(row_count().alias("_n"))
        parts.append(
            copies.agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
                F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_repeated"),
            ).select(F.lit(scope).alias("scope"), "n_rows", "n_repeated")
        )
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def top_groups(df: DataFrame, group: str, n: int) -> DataFrame:
    """The ``n`` most frequent groups; ties go to the smaller value."""
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(row_count().alias("_n"))
        .orderBy(F.desc("_n"), group)
        .limit(n)
        .select(group)
    )


def bucket_top(df: DataFrame, group: str, n: int, out: str, other: str = "Outro") -> DataFrame:
    """Keep the ``n`` most frequent values and call everything else, null too, ``other``."""
    # The joined side has n rows by construction, so it may be sent to every task.
    kept = top_groups(df, group, n).withColumn("_kept", F.lit(True))
    return df.join(F.broadcast(kept), group, "left").select(
        *df.columns, F.when(F.col("_kept"), F.col(group)).otherwise(F.lit(other)).alias(out)
    )


def rate_of_top_groups(df: DataFrame, group: str, flag: str, n: int) -> DataFrame:
    """Rate per group, for the ``n`` largest groups, taken from one count of all groups."""
    return rate_by(df, [group], flag).orderBy(F.desc("n"), group).limit(n)


def weekly_positives(df: DataFrame, time: str, flag: str) -> DataFrame:
    """(week, n): positive rows per Sunday-first week that has any."""
    return (
        df.where((F.col(flag) == 1) & F.col(time).isNotNull())
        .groupBy(sunday_week_label(F.to_date(time)).alias("week"))
        .agg(row_count().alias("n"))
    )


def dispersion_index(df: DataFrame, time: str, flag: str) -> DataFrame:
    """Variance over mean of the daily positives, over every day of the observed span."""
    days = (
        df.where(F.col(time).isNotNull())
        .groupBy(F.to_date(time).alias("_d"))
        .agg(F.sum(flag).alias("_y"))
    )
    full = day_spine(days, [], "_d").join(days, "_d", "left").select(
        F.coalesce("_y", F.lit(0)).alias("_y")
    )
    stats = full.agg(
        row_count().alias("n_days"), F.avg("_y").alias("mean"), F.var_samp("_y").alias("variance")
    )
    return stats.withColumn("dispersion", F.col("variance") / F.nullif(F.col("mean"), F.lit(0.0)))


def weekend_ratio(df: DataFrame, time: str, flag: str) -> DataFrame:
    """Positive rate on weekdays and weekends, in percent, and their ratio."""
    weekend = F.weekday(F.to_date(time)) >= 5
    rates = df.where(F.col(time).isNotNull()).agg(
        (100.0 * F.avg(F.when(~weekend, F.col(flag)))).alias("weekday_pct"),
        (100.0 * F.avg(F.when(weekend, F.col(flag)))).alias("weekend_pct"),
    )
    return rates.withColumn(
        "ratio", F.col("weekend_pct") / F.nullif(F.col("weekday_pct"), F.lit(0.0))
    )


def mode_by(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Most frequent value per key; the smallest among equals."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(row_count().alias("n"))
    return counts.groupBy(*keys).agg(
        F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias("mode"), F.max("n").alias("n")
    )


def sample_rows(df: DataFrame, key: str, size: int, seed: int) -> DataFrame:
    """At most ``size`` rows, the ones with the smallest seeded hash: repeatable on any layout."""
    mix = F.md5(F.concat_ws("#", F.lit(str(seed)), F.col(key).cast("string")))
    return df.withColumn("_h", mix).orderBy("_h", key).limit(size).drop("_h")


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """(bin, lower, upper, n) of equal-width bins between the extremes; the last one is closed."""
    ends = df.agg(
        F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi")
    )
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    placed = df.where(F.col(value).isNotNull()).select(
        F.col(value).cast("double").alias("_v"), lo.alias("_lo"), hi.alias("_hi")
    )
    # Without a spread everything falls into the first bin.
    place = F.when(F.col("_hi") > F.col("_lo"), F.width_bucket("_v", "_lo", "_hi", F.lit(bins))).otherwise(1)
    width = (F.col("_hi") - F.col("_lo")) / bins
    return (
        placed.withColumn("bin", F.least(place, F.lit(bins)).cast("int"))
        .groupBy("bin", "_lo", "_hi")
        .agg(row_count().alias("n"))
        .select(
            "bin",
            (F.col("_lo") + (F.col("bin") - 1) * width).alias("lower"),
            (F.col("_lo") + F.col("bin") * width).alias("upper"),
            "n",
        )
    )


def boxplot_stats(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Five numbers, whisker ends at 1.5 quartile ranges and outlier count per group."""
    rows = df.dropna(subset=[*keys, value]).select(*keys, value)
    box = exact_quantiles(rows, keys, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    # Repeated values are counted before they meet the quartiles.
    counts = rows.groupBy(*keys, value).agg(row_count().alias("_c"))
    return counts.join(box, keys).groupBy(*keys).agg(
        F.max("n").alias("n"),
        F.min(value).alias("min"),
        F.max("q1").alias("q1"),
        F.max("median").alias("median"),
        F.max("q3").alias("q3"),
        F.max(value).alias("max"),
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("_c"))), F.lit(0)).alias("n_outliers"),
    )


def null_share_by(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """(group, column_name, n, pct_null)."""
    sums = (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(row_count().alias("n"), *[F.count(c).alias(f"_f_{c}") for c in columns])
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                (100.0 * (F.col("n") - F.col(f"_f_{c}")) / F.col("n")).alias("pct_null"),
            )
            for c in columns
        ]
    )
    return sums.select(group, "n", F.explode(cells).alias("_c")).select(group, "n", "_c.*")


def value_shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, n, pct) for several columns in one pass."""
    counts = (
        unpivot_text(df, columns)
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(row_count().alias("n"))
    )
    totals = counts.groupBy("column_name").agg(F.sum("n").alias("_t"))
    return counts.join(totals, "column_name").select(
        "column_name", "value", "n", (100.0 * F.col("n") / F.col("_t")).alias("pct")
    )


def compare_shares(df: DataFrame, column: str, first: Column, second: Column) -> DataFrame:
    """(column, pct_first, pct_second) of two populations; null where one lacks the value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count_if(first).alias("_a"), F.count_if(second).alias("_b")
    )
    totals = counts.agg(F.struct(F.sum("_a").alias("a"), F.sum("_b").alias("b")).alias("t")).scalar()

    def share(name: str, side: str) -> Column:
        return F.when(
            F.col(name) > 0, 100.0 * F.col(name) / F.col("_t").getField(side)
        )

    return (
        counts.withColumn("_t", totals)
        .where((F.col("_a") > 0) | (F.col("_b") > 0))
        .select(column, share("_a", "a").alias("pct_first"), share("_b", "b").alias("pct_second"))
    )


def calendar_matrix(daily: DataFrame, day: str, value: str) -> DataFrame:
    """Weekday by ISO week matrix of daily means; cells without a day hold 0."""
    weeks = list(range(1, 54))
    wide = (
        daily.select(F.weekday(day).alias("dia_semana"), F.weekofyear(day).alias("_week"), value)
        .groupBy("dia_semana")
        .pivot("_week", weeks)
        .agg(F.avg(value))
    )
    return wide.select(
        "dia_semana", *[F.coalesce(F.col(str(w)), F.lit(0.0)).alias(f"semana_{w:02d}") for w in weeks]
    )
