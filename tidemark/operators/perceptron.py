"""Perceptrons by L-BFGS, several networks in each pass over the rows.

A step needs the loss and its gradient, which are sums over the rows: every task adds them up for all networks at
once, from stored blocks of rows, and only sums as large as the networks' weights meet. Rows carry weights, so
no row is repeated. Weights have the layout of ``MultilayerPerceptronClassificationModel``.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Generator, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import parallel_parts, settle

# Rows per block. A batch of Arrow holds up to 10,000 blocks, unless its limit of bytes comes first.
BLOCK = 256
# Sufficient decrease and curvature of a step, and how many points a search may try.
DECREASE, CURVATURE, TRIES = 1e-4, 0.9, 10
# Differences of so many steps stand for the curvature; the best of so many values must still fall.
MEMORY, VALUES = 10, 20


def blocks(rows: DataFrame, y: str, features: str, weight: Column) -> DataFrame:
    """(n, x, y, w): rows (features an array) dealt out evenly and stored as blocks of numbers."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.iloc[at : at + BLOCK]
                x = np.stack(part["x"].to_numpy()).astype(float)
                yield pd.DataFrame({"n": [len(part)], "x": [x.tobytes()], "y": [part["y"].to_numpy(dtype=float).tobytes()], "w": [part["w"].to_numpy(dtype=float).tobytes()]})

    given = rows.select(F.col(features).alias("x"), F.col(y).cast("double").alias("y"), weight.cast("double").alias("w"))
    dealt = given.repartition(parallel_parts(rows.sparkSession))
    return settle(dealt.mapInPandas(pack, "n int, x binary, y binary, w binary"), "blocks")


def _affine(layers: list[int], weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    found, at = [], 0
    for wide, out in zip(layers, layers[1:]):
        found.append((weights[at : at + wide * out].reshape(wide, out), weights[at + wide * out : at + (wide + 1) * out]))
        at += (wide + 1) * out
    return found


def loss_and_gradient(layers: list[int], weights: np.ndarray, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray]:
    """Weighted sums of cross-entropy and its gradient: logistic hidden units, two outputs that add up to 1."""
    parts, seen = _affine(layers, weights), [x]
    for matrix, bias in parts[:-1]:
        seen.append(1.0 / (1.0 + np.exp(-np.clip(seen[-1] @ matrix + bias, -500, 500))))
    out = seen[-1] @ parts[-1][0] + parts[-1][1]
    out -= out.max(axis=1, keepdims=True)
    log_share = out - np.log(np.exp(out).sum(axis=1, keepdims=True))
    truth = np.eye(layers[-1])[y.astype(int)]
    loss = -float(w @ (truth * log_share).sum(axis=1))
    delta, gradient = (np.exp(log_share) - truth) * w[:, None], []
    for k in range(len(parts) - 1, -1, -1):
        gradient[:0] = [(seen[k].T @ delta).ravel(), delta.sum(axis=0)]
        if k:
            delta = (delta @ parts[k][0].T) * seen[k] * (1.0 - seen[k])
    return loss, np.concatenate(gradient)


def sums(stored: DataFrame, networks: dict[int, tuple[list[int], np.ndarray]]) -> dict[int, tuple[float, np.ndarray]]:
    """Network -> mean loss and gradient over all rows, in one pass."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for n, *numbers in zip(batch["n"], batch["x"], batch["y"], batch["w"]):
                x, y, w = map(np.frombuffer, numbers)
                for i, (layers, weights) in networks.items():
                    loss, gradient = loss_and_gradient(layers, weights, x.reshape(n, -1), y, w)
                    found = np.concatenate([[w.sum(), loss], gradient])
                    total[i] = total[i] + found if i in total else found
        if total:
            yield pd.DataFrame({"i": list(total), "v": list(total.values())})

    # As many tasks as cores, whatever the rows: each returns one array per network, as long as its weights.
    tasks = stored.coalesce(stored.sparkSession.sparkContext.defaultParallelism)
    added = {i: np.zeros(2 + len(weights)) for i, (_, weights) in networks.items()}
    for r in tasks.mapInPandas(add, "i bigint, v array<double>").collect():
        added[r["i"]] += np.array(r["v"])
    return {i: (v[1] / v[0], v[2:] / v[0]) for i, v in added.items()}


Search = Generator[np.ndarray, tuple[float, np.ndarray], tuple[np.ndarray, float, np.ndarray] | None]


def _step(x: np.ndarray, value: float, gradient: np.ndarray, way: np.ndarray, length: float) -> Search:
    """A step along ``way`` that meets the strong Wolfe conditions; none where the search finds no such step."""
    slope = float(gradient @ way)

    def at(t: float):
        point = x + t * way
        f, g = yield point
        return t, f, float(g @ way), point, g

    def between(a, b) -> float:
        low, high = sorted((a, b), key=lambda p: p[0])
        span = high[0] - low[0]
        d1 = low[2] + high[2] - 3 * (low[1] - high[1]) / (low[0] - high[0])
        root = d1 * d1 - low[2] * high[2]
        d2 = root**0.5 if root > 0 else 0.0
        base = high[2] - low[2] + 2 * d2
        t = high[0] - span * (high[2] + d2 - d1) / base if base else low[0] + span / 2
        return min(max(t, low[0] + 0.1 * span), low[0] + 0.9 * span)

    low, high, t = (0.0, value, slope, x, gradient), None, length
    for n in range(TRIES):
        new = yield from at(t)
        if not np.isfinite(new[1]):
            t /= 2.0
        elif new[1] > value + DECREASE * t * slope or (n and new[1] >= low[1]):
            high = new
            break
        elif abs(new[2]) <= CURVATURE * abs(slope):
            return new[3], new[1], new[4]
        elif new[2] >= 0:
            low, high = new, low
            break
        else:
            low, t = new, 1.5 * t
    for _ in range(TRIES if high else 0):
        new = yield from at(between(low, high))
        if new[1] > value + DECREASE * new[0] * slope or new[1] >= low[1]:
            high = new
            continue
        if abs(new[2]) <= CURVATURE * abs(slope):
            return new[3], new[1], new[4]
        if new[2] * (high[0] - low[0]) >= 0:
            high = low
        low = new
    return None


def _direction(gradient: np.ndarray, pairs: deque) -> np.ndarray:
    way, taken = -gradient, []
    for s, y in reversed(pairs):
        share = (s @ way) / (s @ y)
        way = way - share * y
        taken.append(share)
    if pairs:
        s, y = pairs[-1]
        way = way * (s @ y) / (y @ y)
    for (s, y), share in zip(pairs, reversed(taken)):
        way = way + (share - (y @ way) / (s @ y)) * s
    return way


def minimise(x: np.ndarray, steps: int, tolerance: float = 1e-6) -> Generator[np.ndarray, tuple[float, np.ndarray], list[np.ndarray]]:
    """Yields points, is sent value and gradient there, and returns the point before and after each step."""
    value, gradient = yield x
    first, values, path, pairs = abs(value), [value], [x], deque(maxlen=MEMORY)
    while len(path) <= steps and np.linalg.norm(gradient) > max(tolerance * abs(value), 1e-8):
        way = _direction(gradient, pairs)
        found = yield from _step(x, value, gradient, way, 1.0 if pairs else 1.0 / np.linalg.norm(way))
        if found is None:
            if not pairs:
                break
            pairs.clear()  # once more from the plain gradient
            continue
        new, value, after = found
        if (new - x) @ (after - gradient) > 0:
            pairs.append((new - x, after - gradient))
        x, gradient = new, after
        path.append(x)
        values = [*values, value][-VALUES:]
        if abs(value - max(values)) <= tolerance * first:
            break
    return path


def train(stored: DataFrame, networks: dict[int, tuple[list[int], np.ndarray, int]]) -> dict[int, list[np.ndarray]]:
    """Network -> its weights before and after each step; ``networks`` has layers, first weights and steps of each."""
    stored = stored.persist()
    try:
        return _train(stored, networks)
    finally:
        stored.unpersist()


def _train(stored: DataFrame, networks: dict[int, tuple[list[int], np.ndarray, int]]) -> dict[int, list[np.ndarray]]:
    paths: dict[int, list[np.ndarray]] = {}
    runs = {i: minimise(start, steps) for i, (_, start, steps) in networks.items()}
    points = {i: next(run) for i, run in runs.items()}
    while points:
        found = sums(stored, {i: (networks[i][0], point) for i, point in points.items()})
        for i in list(points):
            try:
                points[i] = runs[i].send(found[i])
            except StopIteration as over:
                paths[i] = over.value
                del points[i]
    return paths
