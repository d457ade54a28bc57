"""Upper-tail chi-square probabilities for small result tables."""

from __future__ import annotations

from math import erfc, lgamma, log, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def _tail(stat: float, dof: int) -> float:
    """With whole degrees of freedom the tail is a finite sum, and for odd ones erfc beside it."""
    half, odd = stat / 2.0, dof % 2
    if half <= 0:
        return 1.0
    head = erfc(sqrt(half)) if odd else 0.0
    powers = np.arange(dof // 2) + odd / 2.0
    if not len(powers):
        return head
    # Each term is the one before it times half / power; logs keep large ones in range.
    first = -half + powers[0] * log(half) - lgamma(powers[0] + 1)
    logs = first + np.concatenate([[0.0], np.cumsum(log(half) - np.log(powers[1:]))])
    return min(1.0, head + float(np.exp(logs).sum()))


@pandas_udf(DoubleType())
def _tails(stat: pd.Series, dof: pd.Series) -> pd.Series:
    values = [None if pd.isna(x) or pd.isna(d) or d < 1 else _tail(x, int(d)) for x, d in zip(stat, dof)]
    return pd.Series(values, dtype="float64")


def chi2_p_value(stat: Column, dof: Column | int) -> Column:
    """P(X >= stat), null without a statistic or a degree of freedom.

    Two degrees of freedom have a closed form; others use a batch function, so call this on result rows.
    """
    if isinstance(dof, int) and dof == 2:
        return F.exp(-stat / 2.0)
    freedom = F.lit(dof) if isinstance(dof, int) else dof
    return _tails(stat.cast("double"), freedom.cast("int"))
