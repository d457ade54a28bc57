"""Ordered operators without a single-task window.

A plain ``partition by key order by x`` window puts a whole key on one task, and a window without a
key puts the table there.  Here the order is first cut into range segments of about equal row count:
each (key, segment) is aggregated, the few totals per key are accumulated, and only rows inside one
segment are windowed.  The cuts are literals, so every branch of the plan sees the same segments; they
steer balance only, never the result.  A value so frequent that it fills whole segments by itself is
cut again by the tie-breaking column.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import parallel_parts

_EDGE = float("inf")


@dataclass(frozen=True)
class Cuts:
    """Range cuts of an order: of its first column, its over-full values, and its second column."""

    first: tuple[float, ...] = ()
    hot: tuple[float, ...] = ()
    second: tuple[float, ...] = ()
    skip: int = 0  # leading bytes that all texts of the second column share


def _as_number(df: DataFrame, name: str, skip: int = 0) -> Column:
    """A number that never falls along the column; of a text the six bytes behind the first ``skip``."""
    kind = dict(df.dtypes)[name]
    if kind == "string":
        lead = F.substring(F.col(name).cast("binary"), skip + 1, 6)
        return F.conv(F.rpad(F.hex(lead), 12, "0"), 16, 10).cast("double")
    if kind == "timestamp_ntz" or kind == "timestamp":
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    if kind == "date":
        return F.unix_date(name).cast("double")
    return F.col(name).cast("double")


def find_cuts(df: DataFrame, order: list[str], parts: int | None = None) -> Cuts:
    """Quantile cuts of the order columns (one sketch pass over one column, bounded result)."""
    parts = parts or parallel_parts(df.sparkSession)
    probs = [i / parts for i in range(1, parts)]

    def sketch(frame: DataFrame, name: str, skip: int = 0) -> list[float]:
        found = frame.select(_as_number(frame, name, skip).alias("_x")).approxQuantile(
            "_x", probs, 1.0 / (2 * parts)
        )
        return sorted(v for v in found if v == v and abs(v) != _EDGE)

    first = sketch(df, order[0])
    hot = tuple(sorted({a for a, b in zip(first, first[1:]) if a == b}))
    second: tuple[float, ...] = ()
    skip = 0
    if hot and len(order) > 1:
        inside = df.where(_as_number(df, order[0]).isin(*hot))
        if dict(df.dtypes)[order[1]] == "string":
            ends = inside.agg(F.min(order[1]), F.max(order[1])).first()
            skip = len(os.path.commonprefix([(e or "").encode() for e in ends]))
        second = tuple(sorted(set(sketch(inside, order[1], skip))))
    return Cuts(tuple(sorted(set(first))), hot, second, skip)


def _bucket(df: DataFrame, value: Column, cuts: tuple[float, ...], out: str) -> DataFrame:
    if not cuts:
        return df.withColumn(out, F.lit(0).cast("bigint"))
    raw = f"{out}_raw"
    frame = df.withColumn(raw, value)
    frame = Bucketizer(
        splits=[-_EDGE, *cuts, _EDGE], inputCol=raw, outputCol=out, handleInvalid="keep"
    ).transform(frame)
    # Null and NaN come last, in a segment of their own.
    return frame.withColumn(out, F.coalesce(F.col(out).cast("bigint"), F.lit(len(cuts) + 1).cast("bigint"))).drop(raw)


def add_segment(df: DataFrame, order: list[str], cuts: Cuts, out: str = "_seg") -> DataFrame:
    """Add the segment number; it never decreases along the order."""
    frame = _bucket(df, _as_number(df, order[0]), cuts.first, out)
    if not cuts.second:
        return frame
    frame = _bucket(frame, _as_number(df, order[1], cuts.skip), cuts.second, "_sub")
    width = len(cuts.second) + 2
    # An over-full value is the left edge of its bucket: its pieces come first, the rest after them.
    # Rows without an order value are cut by the second column as well.
    split = _as_number(df, order[0]).isin(*cuts.hot) | F.col(order[0]).isNull()
    piece = F.when(F.coalesce(split, F.lit(False)), F.col("_sub")).otherwise(width - 1)
    return frame.withColumn(out, F.col(out) * width + piece).drop("_sub")


def add_prior(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    sums: dict[str, Column] | None = None,
    maxima: dict[str, Column] | None = None,
    wholes: dict[str, str] | None = None,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Add, per row, sums (0 at the start) and maxima (null at the start) over the rows before it.

    ``wholes`` maps further columns to names in ``sums`` whose total over the whole key they hold; the
    totals per segment are at hand, so this takes no further shuffle.  ``keys`` must not be null.  ``order`` must be a total order inside a key; null and NaN come last.
    """
    sums, maxima, wholes = sums or {}, maxima or {}, wholes or {}
    cuts = cuts or find_cuts(df, order)
    rows = add_segment(df, order, cuts)
    for name, value in {**sums, **maxima}.items():
        rows = rows.withColumn(f"_in_{name}", value)
    group = [*keys, "_seg"]
    totals = rows.groupBy(*group).agg(
        *[F.sum(f"_in_{n}").alias(f"_t_{n}") for n in sums],
        *[F.max(f"_in_{n}").alias(f"_t_{n}") for n in maxima],
    )
    # A key has at most one total per segment, so this window stays small whatever the key holds.
    over_segments = (
        Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *group,
        *[F.sum(f"_t_{n}").over(over_segments).alias(f"_o_{n}") for n in sums],
        *[F.max(f"_t_{n}").over(over_segments).alias(f"_o_{n}") for n in maxima],
        *[F.sum(f"_t_{of}").over(Window.partitionBy(*keys)).alias(n) for n, of in wholes.items()],
    )
    inside = Window.partitionBy(*group).orderBy(*[F.col(c).asc_nulls_last() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        *df.columns,
        "_seg",
        *[F.sum(f"_in_{n}").over(inside).alias(f"_p_{n}") for n in sums],
        *[F.max(f"_in_{n}").over(inside).alias(f"_p_{n}") for n in maxima],
    )
    joined = rows.join(offsets, group, "left")
    return joined.select(
        *df.columns,
        *[
            (F.coalesce(F.col(f"_p_{n}"), F.lit(0)) + F.coalesce(F.col(f"_o_{n}"), F.lit(0))).alias(n)
            for n in sums
        ],
        *[F.coalesce(F.col(f"_p_{n}"), F.col(f"_o_{n}")).alias(n) for n in maxima],
        *wholes,
    )


def value_counts_before(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(key, value, n, n_before, n_key): rows per value, with a smaller value, and of the whole key."""
    filled = df.where(F.col(value).isNotNull())
    counts = filled.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    # Cuts come from the rows, one column and no shuffle; a segment then holds at most as many distinct
    # values as its even share of the rows.
    return add_prior(
        counts,
        keys,
        [value],
        sums={"n_before": F.col("n")},
        wholes={"n_key": "n_before"},
        cuts=find_cuts(filled, [value]),
    )


def midranks(df: DataFrame, keys: list[str], value: str, out: str = "midrank") -> DataFrame:
    """(key, value) -> average rank of the tied rows, with their number ``n``."""
    return value_counts_before(df, keys, value).select(
        *keys, value, "n", (F.col("n_before") + (F.col("n") + 1) / 2.0).alias(out)
    )


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """Linear-interpolation quantiles per key, with ``n``, from counted values.

    No task holds more than a range segment of the distinct values of a key.
    """
    ranked = value_counts_before(df, keys, value)
    first, last = F.col("n_before"), F.col("n_before") + F.col("n") - 1
    picks = []
    for name, p in probs.items():
        place = (F.col("n_key") - 1) * F.lit(float(p))
        for side, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            picks.append(F.max(F.when(at.between(first, last), F.col(value))).alias(f"_{name}_{side}"))
    found = ranked.groupBy(*keys).agg(F.max("n_key").alias("n"), *picks)
    return found.select(
        *keys,
        "n",
        *[
            (
                F.col(f"_{name}_lo").cast("double")
                + (F.col(f"_{name}_hi") - F.col(f"_{name}_lo"))
                * ((F.col("n") - 1) * F.lit(float(p)) - F.floor((F.col("n") - 1) * F.lit(float(p))))
            ).alias(name)
            for name, p in probs.items()
        ],
    )
