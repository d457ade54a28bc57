"""History features that see only the past of a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import Cuts, add_prior, find_cuts
from tidemark.session import settle

MICROS_PER_HOUR = 3_600_000_000


def epoch_micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def _plus_null_keys(done: DataFrame, df: DataFrame, key: str, out: str, value: Column) -> DataFrame:
    """Rows without a key take no part in any history; they come back with a fixed value."""
    return done.unionByName(df.where(F.col(key).isNull()).withColumn(out, value))


def prior_count(
    df: DataFrame,
    *,
    key: str,
    time: str,
    tiebreak: str,
    out: str,
    ties: str = "sequence",
    cuts: Cuts | None = None,
) -> DataFrame:
    """Earlier rows of the same key; null where the key is null. Rows without a time come last.

    ``ties='sequence'`` counts rows of the same instant with a smaller tie-break as earlier,
    ``ties='strict'`` counts only rows of an earlier instant.
    """
    keyed = df.where(F.col(key).isNotNull())
    if ties == "sequence":
        done = add_prior(keyed, [key], [time, tiebreak], sums={out: F.lit(1)}, cuts=cuts)
    elif ties == "strict":
        instants = keyed.groupBy(key, time).agg(F.count(F.lit(1)).alias("_n"))
        cuts = cuts or find_cuts(keyed, [time])
        before = add_prior(
            instants, [key], [time], sums={out: F.col("_n")}, cuts=Cuts(first=cuts.first)
        )
        before = before.select(F.col(key).alias("_k"), F.col(time).alias("_at"), out)
        same = (F.col(key) == F.col("_k")) & F.col(time).eqNullSafe(F.col("_at"))
        done = keyed.join(before, same, "left").select(*df.columns, out)
    else:
        raise ValueError(f"ties must be 'sequence' or 'strict', not {ties!r}")
    return _plus_null_keys(done, df, key, out, F.lit(None).cast("bigint"))


def hours_since_previous(
    df: DataFrame, *, key: str, time: str, tiebreak: str, out: str, cuts: Cuts | None = None
) -> DataFrame:
    """Hours since the previous row of the key; null for its first row and for a null key."""
    keyed = df.where(F.col(key).isNotNull())
    last = add_prior(
        keyed, [key], [time, tiebreak], maxima={"_previous": epoch_micros(time)}, cuts=cuts
    )
    done = last.select(
        *df.columns,
        ((epoch_micros(time) - F.col("_previous")) / float(MICROS_PER_HOUR)).alias(out),
    )
    return _plus_null_keys(done, df, key, out, F.lit(None).cast("double"))


def count_and_gap(
    df: DataFrame,
    *,
    key: str,
    time: str,
    tiebreak: str,
    count_out: str,
    hours_out: str,
    cuts: Cuts | None = None,
) -> DataFrame:
    """``prior_count`` and ``hours_since_previous`` of one key in one shuffle and one sort."""
    keyed = df.where(F.col(key).isNotNull())
    both = add_prior(
        keyed,
        [key],
        [time, tiebreak],
        sums={count_out: F.lit(1)},
        maxima={"_previous": epoch_micros(time)},
        cuts=cuts,
    )
    done = both.select(
        *df.columns,
        count_out,
        ((epoch_micros(time) - F.col("_previous")) / float(MICROS_PER_HOUR)).alias(hours_out),
    )
    empty = df.where(F.col(key).isNull())
    return done.unionByName(
        empty.withColumn(count_out, F.lit(None).cast("bigint")).withColumn(
            hours_out, F.lit(None).cast("double")
        )
    )


def rolling_prior_count(
    df: DataFrame,
    *,
    key: str,
    time: str,
    out: str,
    window_micros: int = MICROS_PER_HOUR,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Rows of the key in ``[t - window, t)``; 0 where the key or the time is null.

    The count is the difference of two running counts, one read at ``t`` and one at ``t - window``.
    Instants are counted first, so neither a busy key nor a busy instant reaches one task whole.
    """
    keyed = df.where(F.col(key).isNotNull())
    instants = keyed.where(F.col(time).isNotNull()).groupBy(key, epoch_micros(time).alias("_t")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    # At one instant the look-back row sorts first: both reads are of strictly earlier rows.
    reads = instants.select(
        key,
        F.explode(
            F.array(
                F.struct(
                    (F.col("_t") - F.lit(window_micros)).alias("at"),
                    F.lit(0).alias("kind"),
                    F.lit(0).cast("bigint").alias("n"),
                    F.col("_t").alias("of"),
                ),
                F.struct(
                    F.col("_t").alias("at"),
                    F.lit(1).alias("kind"),
                    F.col("_n").alias("n"),
                    F.col("_t").alias("of"),
                ),
            )
        ).alias("r"),
    ).select(key, "r.*")
    # Within a key an instant occurs twice at most, so the first level of cuts is enough.
    cuts = cuts or find_cuts(keyed, [time])
    running = add_prior(
        reads, [key], ["at", "kind"], sums={"_before": F.col("n")}, cuts=Cuts(first=cuts.first)
    )
    load = running.groupBy(key, F.col("of").alias("_t")).agg(
        F.sum(F.when(F.col("kind") == 1, F.col("_before")).otherwise(-F.col("_before"))).alias(out)
    )
    done = (
        keyed.withColumn("_t", epoch_micros(time))
        .join(load, [key, "_t"], "left")
        .select(*df.columns, F.coalesce(out, F.lit(0).cast("bigint")).alias(out))
    )
    return _plus_null_keys(done, df, key, out, F.lit(0).cast("bigint"))


def low_volume_flag(
    df: DataFrame, *, group: str, out: str, minimum: int = 100
) -> DataFrame:
    """True where the group has fewer than ``minimum`` rows in ``df``; false for a null group.

    The small groups are stored first: their size is then known when the join is planned, and the wide
    rows are shuffled only where the groups are too many for one task's memory.
    """
    small = settle(
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") < minimum)
        .select(group, F.lit(True).alias(out)),
        "small-groups",
    )
    return df.join(small, group, "left").select(
        *df.columns, F.coalesce(F.col(out), F.lit(False)).alias(out)
    )


def ordered_target_rate(
    df: DataFrame,
    *,
    key: str,
    time: str,
    tiebreak: str,
    target: str,
    out: str,
    prior: float,
    strength: float = 1.0,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Smoothed target rate of the key's earlier rows; a null key is a category of its own."""
    labelled = df.withColumn("_k", F.coalesce(F.col(key).cast("string"), F.lit("Ausente")))
    seen = add_prior(
        labelled,
        ["_k"],
        [time, tiebreak],
        sums={"_y": F.col(target), "_n": F.lit(1)},
        cuts=cuts,
    )
    return seen.select(
        *df.columns,
        ((F.col("_y") + F.lit(strength * prior)) / (F.col("_n") + F.lit(strength))).alias(out),
    )
