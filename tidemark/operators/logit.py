"""Logistic regressions by Newton's method, many weighted fits in one pass.

A step needs the sums of gradient and information over the rows. Every task adds up those of all replicates at
once, from blocks of rows: row weights by replicate times the rows' outer products. The sums meet per replicate,
where the small system is solved, and only coefficients reach the driver: replicates times features, the
size of the model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import resample

BLOCK = 512
# A column whose rest, once the others before it are taken out, is below this share of it depends on them.
DEPENDENT = 1e-9
# Coefficients of standardised columns beyond this mean that the likelihood has no maximum.
DIVERGED = 30.0


@dataclass
class Fit:
    """Coefficients per replicate (rows), whether each has settled, and the information of a single fit."""

    coef: np.ndarray
    settled: np.ndarray
    information: np.ndarray | None = None


def _square(flat: np.ndarray, d: int) -> np.ndarray:
    out = np.zeros((d, d))
    i, j = np.triu_indices(d)
    out[i, j] = out[j, i] = flat
    return out


def gram(rows: DataFrame, features: str = "x") -> np.ndarray:
    """Sums of products of all pairs of features: one row per feature comes back."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                x = np.stack(batch[features].to_numpy())
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total)), "v": list(total)})

    parts = rows.select(features).mapInPandas(add, "i bigint, v array<double>")
    found = resample.add_arrays(parts, ["i"], ["v"]).orderBy("i").collect()
    return np.array([r["v"] for r in found])


def dependent_columns(products: np.ndarray) -> dict[int, str]:
    """Columns that the ones before them make superfluous, by pivoted elimination in order; the first is the constant."""
    rest, found = products.astype(float).copy(), {}
    for j in range(len(rest)):
        if rest[j, j] <= DEPENDENT * max(products[j, j], 1e-300):
            # Without the constant's part nothing is left of a constant.
            alone = products[j, j] - (products[0, j] ** 2 / products[0, 0] if j and products[0, 0] else 0.0)
            found[j] = "constant" if alone <= DEPENDENT * max(products[j, j], 1e-300) else "collinear"
            continue
        rest -= np.outer(rest[:, j], rest[j]) / rest[j, j]
    return found


def newton_sums(rows: DataFrame, coef: np.ndarray, columns: list[int], replicates: np.ndarray | None, y: str, features: str) -> DataFrame:
    """(replicate, gradient, information): one row per task and replicate; information is the upper triangle."""
    upper = np.triu_indices(len(columns))
    steps = _poisson_steps()

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gradient, information = np.zeros_like(coef), np.zeros((len(coef), len(upper[0])))
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.iloc[at : at + BLOCK]
                x = np.stack(part[features].to_numpy())[:, columns]
                p = 1.0 / (1.0 + np.exp(-np.clip(x @ coef.T, -500, 500)))
                w = 1.0 if replicates is None else resample.poisson_weights(steps, *(part[k].to_numpy() for k in resample.KEYS), replicates)
                gradient += ((part[y].to_numpy(dtype=float)[:, None] - p) * w).T @ x
                information += (p * (1 - p) * w).T @ (x[:, upper[0]] * x[:, upper[1]])
        yield pd.DataFrame({"replicate": np.arange(len(coef)), "gradient": list(gradient), "information": list(information)})

    keys = () if replicates is None else resample.KEYS
    return rows.select(y, features, *keys).mapInPandas(add, "replicate bigint, gradient array<double>, information array<double>")


def _poisson_steps() -> list[float]:
    from tidemark.operators.ranking import POISSON_STEPS

    return POISSON_STEPS


def _solver(coef: np.ndarray, ridge: np.ndarray):
    """What turns a replicate's sums from all tasks into its Newton step."""

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        r, d = int(part["replicate"].iloc[0]), coef.shape[1]
        g = np.sum(np.stack(part["gradient"].to_numpy()), axis=0) - ridge * coef[r]
        h = _square(np.sum(np.stack(part["information"].to_numpy()), axis=0), d) + np.diag(ridge)
        scale = np.sqrt(np.maximum(np.diag(h), 1e-300))
        flat = h / np.outer(scale, scale)
        sound = bool(np.isfinite(flat).all() and np.diag(h).min() > 1e-12 and np.linalg.eigvalsh(flat)[0] > 1e-12)
        step = np.linalg.solve(flat, g / scale) / scale if sound else np.zeros(d)
        return pd.DataFrame({"replicate": [r], "step": [step], "sound": [sound]})

    return solve


def fit(
    rows: DataFrame,
    columns: list[int],
    *,
    penalty: float = 0.0,
    replicates: np.ndarray | None = None,
    start: np.ndarray | None = None,
    most: int = 40,
    tolerance: float = 1e-8,
    y: str = "y",
    features: str = "x",
) -> Fit:
    """Maximise the (penalised) likelihood of every replicate, or of the rows themselves.

    ``penalty`` is half the weight of the squared coefficients but for the first column, the constant. Fits that
    have settled stay where they are. A fit whose system is singular, or that runs away, does not settle.
    """
    d, count = len(columns), 1 if replicates is None else len(replicates)
    coef = np.tile(np.zeros(d) if start is None else start, (count, 1))
    settled, lost = np.zeros(count, dtype=bool), np.zeros(count, dtype=bool)
    ridge = np.full(d, float(penalty))
    ridge[0] = 0.0
    for _ in range(most):
        going = np.flatnonzero(~settled & ~lost)
        if not len(going):
            break
        at = coef[going]

        sums = newton_sums(rows, at, columns, None if replicates is None else replicates[going], y, features)
        for r in sums.groupBy("replicate").applyInPandas(_solver(at, ridge), "replicate bigint, step array<double>, sound boolean").collect():
            mine, step = going[r["replicate"]], np.array(r["step"])
            largest = np.abs(step).max()
            # Far from the maximum a full step may overshoot.
            coef[mine] += step * min(1.0, 8.0 / largest) if largest > 0 else 0.0
            settled[mine] = r["sound"] and largest < tolerance
            lost[mine] = not r["sound"] or np.abs(coef[mine]).max() > DIVERGED
    information = None
    if replicates is None:
        total = resample.add_arrays(newton_sums(rows, coef, columns, None, y, features), ["replicate"], ["information"]).first()
        information = _square(np.array(total["information"]), d)
    return Fit(coef, settled & ~lost, information)


def standard_errors(information: np.ndarray, least: float = 1e-10) -> np.ndarray | None:
    """From the inverse information; None where it is singular to working accuracy."""
    scale = np.sqrt(np.maximum(np.diag(information), 1e-300))
    flat = information / np.outer(scale, scale)
    if not np.isfinite(flat).all() or np.linalg.eigvalsh(flat)[0] < least:
        return None
    return np.sqrt(np.diag(np.linalg.inv(flat))) / scale


def two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def drawn_replicates(rows: DataFrame, replicates: int, spare: int, y: str = "y") -> np.ndarray:
    """Numbers of the first resamples that hold both classes, out of at most `spare` times as many candidates."""
    sums = resample.weight_sums(rows, [], y, 2 * replicates, _poisson_steps()).first()
    for tried in sorted({2 * replicates, spare * replicates}):
        if tried > 2 * replicates:
            sums = resample.weight_sums(rows, [], y, tried, _poisson_steps()).first()
        n, pos = np.array(sums["n"]), np.array(sums["pos"])
        valid = np.flatnonzero((pos > 0) & (pos < n)) + 1
        if len(valid) >= replicates:
            break
    return valid[:replicates]


SUMMARY = "feature string, coef double, std_error double, p_value double, low double, high double, method string"


def summarise(
    rows: DataFrame,
    names: list[str],
    *,
    replicates: int = 300,
    spare: int = 10,
    level: float = 0.95,
    penalty: float = 1.0,
    first: str = "classic",
    y: str = "y",
    features: str = "x",
) -> DataFrame:
    """(feature, coef, std_error, p_value, low, high, method) of every column, the constant first.

    Three ways, each where the one before it fails: 'classic' maximum likelihood; 'regularised', with a ridge
    penalty and standard errors from the information there; 'bootstrap', penalised fits on resamples that hold
    both classes, with percentile bounds and the sign's share for a p-value. ``first`` skips the ways before it.
    Constant columns and those that others make up take no part; they come with nulls and that as their method.
    """
    if first not in ("classic", "regularised", "bootstrap"):
        raise ValueError(f"no such way: {first}")
    spark = rows.sparkSession
    both = rows.agg(F.min(y), F.max(y)).first()
    if both[0] == both[1]:
        raise ValueError("the rows hold one class only")
    dropped = dependent_columns(gram(rows, features))
    columns = [j for j in range(len(names)) if j not in dropped]
    z = _normal_quantile((1 + level) / 2)
    out = [(names[j], None, None, None, None, None, why) for j, why in dropped.items()]

    def analytic(found: Fit, method: str) -> list[tuple] | None:
        errors = standard_errors(found.information) if found.settled[0] else None
        if errors is None:
            return None
        return [
            (names[j], float(b), float(e), two_sided(b / e), float(b - z * e), float(b + z * e), method)
            for j, b, e in zip(columns, found.coef[0], errors)
        ]

    rows_out = None
    if first == "classic":
        rows_out = analytic(fit(rows, columns, y=y, features=features), "classic")
    if rows_out is None:
        ridge = fit(rows, columns, penalty=penalty, y=y, features=features)
        rows_out = analytic(ridge, "regularised") if first != "bootstrap" else None
    if rows_out is None:
        numbers = drawn_replicates(rows, replicates, spare, y)
        drawn = fit(rows, columns, penalty=penalty, replicates=numbers, start=ridge.coef[0], y=y, features=features)
        draws = drawn.coef[drawn.settled]
        tail = (1 - level) / 2
        low, high = np.quantile(draws, [tail, 1 - tail], axis=0)
        sign = 2 * np.minimum((draws > 0).mean(axis=0), (draws < 0).mean(axis=0))
        rows_out = [
            (names[j], float(draws[:, i].mean()), float(draws[:, i].std(ddof=1)) if len(draws) > 1 else None, float(min(1.0, sign[i])), float(low[i]), float(high[i]), "bootstrap")
            for i, j in enumerate(columns)
        ]
    return spark.createDataFrame(rows_out + out, SUMMARY)


def _normal_quantile(p: float) -> float:
    from statistics import NormalDist

    return NormalDist().inv_cdf(p)
