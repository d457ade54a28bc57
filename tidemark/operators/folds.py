"""Expanding training folds and the assignment of rows to them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Fold:
    fold: int
    train_start: date
    train_end: date
    test_start: date
    test_end: date


def _offsets(fold: int, min_train_weeks: int, test_weeks: int) -> tuple[int, int]:
    """Days from the first day to the first test day of a fold (counted from 1), and behind its last one."""
    split = 7 * (min_train_weeks + (fold - 1) * test_weeks)
    return split, split + 7 * test_weeks


def expanding_folds(
    start: date | str, min_train_weeks: int = 30, test_weeks: int = 7, n_folds: int = 3
) -> list[Fold]:
    """Training always begins at ``start`` and grows by one test span per fold."""
    first = date.fromisoformat(start) if isinstance(start, str) else start

    def fold(number: int) -> Fold:
        split, behind = (first + timedelta(days=d) for d in _offsets(number, min_train_weeks, test_weeks))
        return Fold(number, first, split - timedelta(days=1), split, behind - timedelta(days=1))

    return [fold(number) for number in range(1, n_folds + 1)]


def spanning_folds(first: date, last: date, test_weeks: int = 7, n_folds: int = 3) -> list[Fold]:
    """Folds over all of ``first`` to ``last``: the last test span ends on the last day, every fold trains from the first."""
    span = timedelta(weeks=test_weeks)
    ends = [last - span * (n_folds - number) for number in range(1, n_folds + 1)]
    if ends[0] - span < first:
        raise ValueError("the days are too few for a training part before the first test span")
    return [
        Fold(number, first, end - span, end - span + timedelta(days=1), end) for number, end in enumerate(ends, 1)
    ]


def observed_span(df: DataFrame, time: str) -> tuple[date, date]:
    """First and last day of a time column: one row reaches the driver."""
    span = df.agg(F.min(F.to_date(time)).alias("first"), F.max(F.to_date(time)).alias("last")).first()
    if span["first"] is None:
        raise ValueError("no row has a time")
    return span["first"], span["last"]


def folds_from_data(
    df: DataFrame,
    *,
    time: str,
    min_train_weeks: int = 30,
    test_weeks: int = 7,
    n_folds: int = 3,
) -> DataFrame:
    """The fold table, starting at the first observed day."""
    start = df.agg(F.min(F.to_date(time)).alias("train_start")).where("train_start is not null")
    spans = [(n, *_offsets(n, min_train_weeks, test_weeks)) for n in range(1, n_folds + 1)]
    offsets = F.array(
        *[F.struct(F.lit(n).alias("fold"), F.lit(x).alias("split"), F.lit(y).alias("behind")) for n, x, y in spans]
    )
    return start.select("train_start", F.explode(offsets).alias("f")).select(
        "f.fold",
        "train_start",
        F.date_add("train_start", F.col("f.split") - 1).alias("train_end"),
        F.date_add("train_start", F.col("f.split")).alias("test_start"),
        F.date_add("train_start", F.col("f.behind") - 1).alias("test_end"),
    )


def _inside(time: Column, first: date, last: date, reference_bounds: bool) -> Column:
    start = F.lit(first.isoformat()).cast("timestamp_ntz")
    if reference_bounds:
        return (time >= start) & (time <= F.lit(last.isoformat()).cast("timestamp_ntz"))
    after = F.lit((last + timedelta(days=1)).isoformat()).cast("timestamp_ntz")
    return (time >= start) & (time < after)


def in_fold(time: str, fold: Fold, side: str, reference_bounds: bool = False) -> Column:
    """Filter for one side of one fold; a plain time range, so it reaches the scan."""
    at = F.col(time)
    if side == "train":
        return _inside(at, fold.train_start, fold.train_end, reference_bounds)
    return _inside(at, fold.test_start, fold.test_end, reference_bounds)


def assign_folds(
    df: DataFrame, *, time: str, folds: list[Fold], reference_bounds: bool = False
) -> DataFrame:
    """One row per (row, fold, side); a row may train several folds.  No join, no shuffle.

    Days count whole by default.  ``reference_bounds`` ends every span at midnight of its last day,
    which loses what was opened later that day.
    """
    at = F.col(time).cast("timestamp_ntz")
    marks = []
    for f in folds:
        for side, first, last in (
            ("train", f.train_start, f.train_end),
            ("test", f.test_start, f.test_end),
        ):
            marks.append(
                F.when(
                    _inside(at, first, last, reference_bounds),
                    F.struct(F.lit(f.fold).alias("fold"), F.lit(side).alias("side")),
                )
            )
    earliest = min(f.train_start for f in folds)
    latest = max(f.test_end for f in folds)
    span = df.where(_inside(at, earliest, latest, reference_bounds))
    return span.withColumn("_m", F.explode(F.array_compact(F.array(*marks)))).select(
        *df.columns, "_m.fold", "_m.side"
    )
