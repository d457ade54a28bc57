"""Association and rank statistics from counted values."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.pvalues import chi2_p_value
from tidemark.operators.ordering import midranks


def chi_square(counts: DataFrame, keys: list[str], a: str, b: str, n: str = "n") -> DataFrame:
    """(keys, n, n_a, n_b, dof, chi2) of long contingency tables, one per key.

    The empty cells enter through the identity sum((o-e)^2/e) = n * sum(o^2/(row*col)) - n.  Tables of
    two by two get the continuity correction.
    """
    rows = counts.groupBy(*keys, a).agg(F.sum(n).alias("_ra"))
    cols = counts.groupBy(*keys, b).agg(F.sum(n).alias("_cb"))
    size = rows.groupBy(*keys).agg(
        F.sum("_ra").alias("n"),
        F.count(F.lit(1)).alias("n_a"),
        F.sum(1.0 / F.col("_ra")).alias("_inv_a"),
    )
    width = cols.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_b"), F.sum(1.0 / F.col("_cb")).alias("_inv_b")
    )
    cells = counts.join(rows, [*keys, a]).join(cols, [*keys, b])
    expected = F.col("_ra") * F.col("_cb")
    if keys:
        sizes = size.join(width, keys)
        cells = cells.join(sizes.select(*keys, F.col("n").alias("_n")), keys)
    else:
        sizes = size.withColumn("_w", width.select(F.struct("*")).scalar()).select("*", "_w.*").drop("_w")
        cells = cells.withColumn("_n", size.select("n").scalar())
    parts = cells.groupBy(*keys).agg(
        F.sum(F.col(n) * F.col(n) / expected).alias("_q"),
        F.max(F.abs(F.col(n) - expected / F.col("_n"))).alias("_d"),
    )
    if keys:
        joined = sizes.join(parts, keys)
    else:
        joined = sizes.withColumn("_p", parts.select(F.struct("*")).scalar()).select("*", "_p.*").drop("_p")
    # In a 2x2 table every cell is equally far from its expectation.
    shrunk = F.col("_d") - F.least(F.lit(0.5), F.col("_d"))
    yates = shrunk * shrunk * F.col("n") * F.col("_inv_a") * F.col("_inv_b")
    plain = F.greatest(F.lit(0.0), F.col("n") * F.col("_q") - F.col("n"))
    return joined.select(
        *keys,
        "n",
        "n_a",
        "n_b",
        ((F.col("n_a") - 1) * (F.col("n_b") - 1)).alias("dof"),
        F.when((F.col("n_a") == 2) & (F.col("n_b") == 2), yates).otherwise(plain).alias("chi2"),
    )


def missingness_test(df: DataFrame, category: str, column: str) -> DataFrame:
    """Chi-square test of whether ``column`` is empty more often in some categories."""
    counts = (
        df.where(F.col(category).isNotNull())
        .groupBy(category, F.col(column).isNull().alias("_missing"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    found = chi_square(counts, [], category, "_missing")
    return found.withColumn("p_value", chi2_p_value(F.col("chi2"), F.col("dof")))


def pair_counts(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(column_a, column_b, a, b, n) for all pairs in one pass and one shuffle."""
    cells = F.array(
        *[
            F.struct(
                F.lit(a).alias("column_a"),
                F.lit(b).alias("column_b"),
                F.col(a).cast("string").alias("a"),
                F.col(b).cast("string").alias("b"),
            )
            for a, b in pairs
        ]
    )
    long = df.select(F.explode(cells).alias("_c")).select("_c.*")
    return (
        long.where(F.col("a").isNotNull() & F.col("b").isNotNull())
        .groupBy("column_a", "column_b", "a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def cramers_v(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(column_a, column_b, n, chi2, v): bias-corrected strength; null for a constant column."""
    tests = chi_square(pair_counts(df, pairs), ["column_a", "column_b"], "a", "b")
    n, r, k = F.col("n"), F.col("n_a"), F.col("n_b")
    phi = F.greatest(F.lit(0.0), F.col("chi2") / n - (k - 1) * (r - 1) / (n - 1))
    rows = r - (r - 1) * (r - 1) / (n - 1)
    cols = k - (k - 1) * (k - 1) / (n - 1)
    room = F.least(rows, cols) - 1
    return tests.where("n > 1").select(
        "column_a",
        "column_b",
        "n",
        "chi2",
        F.when(room > 0, F.sqrt(phi / room)).alias("v"),
    )


def cramers_v_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Long symmetric matrix (column_a, column_b, v) with ones on the diagonal."""
    upper = cramers_v(df, list(combinations(columns, 2))).select("column_a", "column_b", "v")
    both = F.array(
        F.struct("column_a", "column_b", "v"),
        F.struct(F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), "v"),
    )
    mirrored = upper.select(F.explode(both).alias("_r")).select("_r.*")
    names = df.sparkSession.createDataFrame([(c, c, 1.0) for c in columns], mirrored.schema)
    return mirrored.unionByName(names)


def kruskal_wallis(df: DataFrame, value: str, group: str) -> DataFrame:
    """(n, n_groups, n_excluded, h, p_value): tie-corrected rank statistic over the filled rows."""
    filled = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    ranks = midranks(filled, [], value, "_rank")
    ties = ranks.agg(
        F.struct(
            F.sum("n").alias("total"),
            F.sum(F.col("n").cast("double") * F.col("n") * F.col("n") - F.col("n")).alias("ties"),
        )
    ).scalar()
    cells = filled.groupBy(group, value).agg(F.count(F.lit(1)).alias("_c"))
    sums = (
        cells.join(ranks.select(value, "_rank"), value)
        .groupBy(group)
        .agg(F.sum(F.col("_c") * F.col("_rank")).alias("_r"), F.sum("_c").alias("_g"))
    )
    out = df.agg(F.count_if(F.col(value).isNull() | F.col(group).isNull())).scalar()
    total = sums.agg(
        F.sum(F.col("_r") * F.col("_r") / F.col("_g")).alias("_s"),
        F.count(F.lit(1)).alias("n_groups"),
    ).withColumn("_t", ties)
    n = F.col("_t.total").cast("double")
    raw = 12.0 / (n * (n + 1)) * F.col("_s") - 3 * (n + 1)
    return total.select(
        F.col("_t.total").alias("n"),
        "n_groups",
        out.alias("n_excluded"),
        (raw / F.nullif(1 - F.col("_t.ties") / (n * n * n - n), F.lit(0.0))).alias("h"),
    ).withColumn("p_value", chi2_p_value(F.col("h"), F.col("n_groups") - 1))


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """(n, rho): correlation of mid-ranks over rows filled on both sides."""
    rows = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b)
    ra = midranks(rows, [], a, "_ra").drop("n")
    rb = midranks(rows, [], b, "_rb").drop("n")
    # Equal pairs are counted before they meet their ranks.
    pairs = rows.groupBy(a, b).agg(F.count(F.lit(1)).cast("double").alias("w"))
    ranked = pairs.join(ra, a).join(rb, b)
    x, y, w = F.col("_ra"), F.col("_rb"), F.col("w")
    s = ranked.agg(
        F.sum(w).alias("n"),
        F.sum(w * x).alias("x"),
        F.sum(w * y).alias("y"),
        F.sum(w * x * x).alias("xx"),
        F.sum(w * y * y).alias("yy"),
        F.sum(w * x * y).alias("xy"),
    )
    n = F.col("n")
    cov = n * F.col("xy") - F.col("x") * F.col("y")
    scale = F.sqrt(
        (n * F.col("xx") - F.col("x") * F.col("x")) * (n * F.col("yy") - F.col("y") * F.col("y"))
    )
    return s.select(n.cast("bigint").alias("n"), (cov / F.nullif(scale, F.lit(0.0))).alias("rho"))


def _correlations(df: DataFrame, named: dict[str, Column]) -> DataFrame:
    names = list(named)
    values = df.select(*[c.cast("double").alias(n) for n, c in named.items()])
    pairs = list(combinations(names, 2))

    def corr(a: str, b: str) -> Column:
        # Spelled out, because the built-in raises for a column without spread.
        spread = F.stddev_pop(F.when(F.col(b).isNotNull(), F.col(a))) * F.stddev_pop(
            F.when(F.col(a).isNotNull(), F.col(b))
        )
        return F.covar_pop(a, b) / F.nullif(spread, F.lit(0.0))

    one = values.agg(*[corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    cells = F.array(
        *[
            F.struct(
                F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"{i}").alias("r")
            )
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return one.select(F.explode(cells).alias("_c")).select("_c.*")


def pearson_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_a, column_b, r) for each pair, over the rows filled on both sides, in one pass."""
    return _correlations(df, {c: F.col(c) for c in columns})


def nullity_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_a, column_b, r) of the emptiness of two columns; constant ones drop out."""
    return _correlations(df, {c: F.col(c).isNull().cast("int") for c in columns}).where(
        F.col("r").isNotNull()
    )
