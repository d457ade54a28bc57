"""History features batch by batch: what earlier days leave behind is carried over, their rows are not read again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.causal import MICROS_PER_HOUR, count_and_gap, epoch_micros, rolling_prior_count
from tidemark.session import settle


@dataclass
class History:
    """Per key the rows so far and the last time (micros), and the rows of the open window behind the newest time."""

    totals: DataFrame
    recent: DataFrame


def empty_history(rows: DataFrame, *, key: str, time: str) -> History:
    none = rows.limit(0)
    return History(none.select(key, F.lit(0).cast("bigint").alias("n"), epoch_micros(time).alias("last")), none.select(key, time))


def advance(
    history: History,
    rows: DataFrame,
    *,
    key: str,
    time: str,
    tiebreak: str,
    count_out: str,
    hours_out: str,
    load_out: str,
    window_micros: int = MICROS_PER_HOUR,
) -> tuple[DataFrame, History]:
    """(the batch with its three features, the history behind it), as one run over all batches would give.

    The features are those of ``count_and_gap`` and ``rolling_prior_count``. Batches come in order of time; a row that
    is not later than its key's history raises. Rows without a time come last in every order, so they belong in the
    last batch. The history is written, so its lineage does not grow from day to day.
    """
    inside = count_and_gap(rows, key=key, time=time, tiebreak=tiebreak, count_out="_n_inside", hours_out="_h_inside")
    before = history.totals.select(F.col(key).alias("_k"), F.col("n").alias("_n_before"), F.col("last").alias("_last"))
    at = epoch_micros(time)
    late = F.when(at <= F.col("_last"), F.raise_error(F.lit("a row is not later than the history of its key")).cast("bigint"))
    joined = inside.join(before, F.col(key) == F.col("_k"), "left").withColumn("_last", F.coalesce(late, F.col("_last")))
    found = joined.select(
        *rows.columns,
        (F.col("_n_inside") + F.coalesce("_n_before", F.lit(0))).alias(count_out),
        F.coalesce("_h_inside", (at - F.col("_last")) / float(MICROS_PER_HOUR)).alias(hours_out),
    )
    # Rows of the open window stand before the batch and only count.
    both = found.withColumn("_new", F.lit(True)).unionByName(history.recent.withColumn("_new", F.lit(False)), allowMissingColumns=True)
    loaded = rolling_prior_count(both, key=key, time=time, out=load_out, window_micros=window_micros)
    done = loaded.where("_new").drop("_new")

    keyed = rows.where(F.col(key).isNotNull())
    seen = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max(at).alias("last"))
    totals = history.totals.unionByName(seen).groupBy(key).agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    open_rows = history.recent.unionByName(keyed.where(F.col(time).isNotNull()).select(key, time))
    newest = open_rows.agg(F.max(at)).scalar()
    recent = open_rows.where(at >= newest - F.lit(window_micros))
    return done, History(settle(totals, "totals"), settle(recent, "recent"))
