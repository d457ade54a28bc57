"""Periodic runs in word sequences by a dictionary of basic factors.

For every power of two L, equal factors of L words get one name (two names of the level below make one). The
next place of the same name within 2 L words, and again as far behind that, makes an arithmetic progression, and
its step is a proposed period. Proposals are extended both ways by comparing named factors and deduplicated.
A run of period q that is at least 4 q long is proposed at the level L with q <= L < 2 q: its first factor of L
words comes again after exactly q words, and after q more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import WORD, digest, fresh

LEAST_LENGTH, LEAST_TIMES = 6, 4
SLICE_WORDS = 500_000
RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


def basic_factors(word: np.ndarray) -> tuple[list[np.ndarray], list[tuple[np.ndarray, np.ndarray]]]:
    """(names, successors) per level. Names tell all factors of 2^level words apart, from every place on that
    has one; a factor that stands there once has a negative name. Successors are places and the distance to the
    next place of the same factor."""
    names, successors = [], []
    low, active = None, np.arange(len(word))
    while len(active):
        half = (1 << len(names)) >> 1
        if low is None:
            key = word.astype(np.int64)
        else:
            # Only where both halves stand there more than once can the whole.
            active = active[active + half < len(low)]
            active = active[(low[active] >= 0) & (low[active + half] >= 0)]
            key = low[active].astype(np.int64) * len(word) + low[active + half]
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        place = active[order]
        name = -1 - np.arange(len(word) if low is None else max(0, len(low) - half), dtype=np.int64)
        repeated = np.zeros(len(order), dtype=bool)
        repeated[1:] = same
        repeated[:-1] |= same
        name[place[repeated]] = np.cumsum(np.concatenate([[True], ~same])[: len(order)])[repeated]
        names.append(name)
        successors.append((place[:-1][same], np.diff(place)[same]))
        active = np.sort(place[repeated])
        low = name
    return names, successors


def _match(names: list[np.ndarray], at: np.ndarray, step: np.ndarray, forward: bool) -> np.ndarray:
    """How far words and those `step` behind them are the same, from `at` on (or before `at`, backwards)."""
    n = len(names[0])
    far = np.zeros(len(at), dtype=np.int64)
    for level in range(len(names) - 1, -1, -1):
        size, name = 1 << level, names[level]
        going = np.arange(len(at))
        while len(going):
            low = at[going] + far[going] if forward else at[going] - far[going] - size
            going, low = going[inside := (low >= 0) & (low + step[going] + size <= n)], low[inside]
            hit = name[low] == name[low + step[going]]
            going = going[hit]
            far[going] += size
    return far


def find_runs(word: np.ndarray, least_length: int = LEAST_LENGTH, times: int = LEAST_TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and smallest periods of all runs of at least max(least_length, times * period) words.

    By start, then period. `times` is 4 or more: that is what the proposals rest on.
    """
    if times < 4:
        raise ValueError("runs of fewer than four periods are not proposed")
    names, successors = basic_factors(word)
    starts, periods = [], []
    gap = np.zeros(len(word), dtype=np.int64)
    for level, (place, step) in enumerate(successors):
        near = step <= 2 << level
        place, step = place[near], step[near]
        gap[place] = step
        # Three places in one progression; neighbours of the same step are one proposal.
        third = place + step
        chained = gap[np.minimum(third, len(word) - 1)] == step
        first = place[chained]
        marked = np.zeros(len(word) + 1, dtype=np.int64)
        marked[first] = step[chained]
        alone = marked[first - 1] != step[chained]  # marked[-1] is 0
        starts.append(first[alone])
        periods.append(step[chained][alone])
        gap[place] = 0
    if not starts:
        return (np.zeros(0, dtype=np.int64),) * 3
    at, q = np.concatenate(starts), np.concatenate(periods)
    right, left = _match(names, at, q, True), _match(names, at, q, False)
    found = np.stack([at - left, left + right + q, q], axis=1)
    found = np.unique(found[(found[:, 1] >= least_length) & (found[:, 1] >= times * q)], axis=0)
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    return found[:, 0], found[:, 1], found[:, 2]


def _slice_runs(lists: pa.ListArray) -> tuple[pa.Array, pa.Array]:
    """Runs and the text without repetitions, for every row of a slice of word lists."""
    words = lists.flatten()
    size = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    first = ends - size
    coded = words.dictionary_encode()
    # Rows stand one behind another, each followed by a word of its own.
    row = np.repeat(np.arange(len(size)), size)
    joined = np.empty(len(words) + len(size), dtype=np.int64)
    joined[np.arange(len(words)) + row] = coded.indices.to_numpy(zero_copy_only=False)
    joined[ends + np.arange(len(size))] = len(coded.dictionary) + np.arange(len(size))
    start, length, period = find_runs(joined)
    owner = np.searchsorted(ends + np.arange(len(size)), start, side="right")
    # Behind a run's first period all its words go.
    change = np.zeros(len(joined) + 1, dtype=np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = (np.cumsum(change)[np.arange(len(words)) + row]) == 0
    left = np.concatenate([[0], np.cumsum(np.bincount(row[kept], minlength=len(size)))]).astype(np.int32)
    collapsed = pa.compute.binary_join(pa.ListArray.from_arrays(pa.array(left), words.filter(pa.array(kept))), " ")
    rows = pa.StructArray.from_arrays([pa.array(start - first[owner] - owner), pa.array(length), pa.array(period)], names=["start", "length", "period"])
    bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(size)))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), rows), collapsed


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def periodic_runs(docs: DataFrame, words: Column | None = None, text: str = "text") -> DataFrame:
    """Input columns and `runs` (array of start, length, period, by start and period) and `collapsed`.

    A run is a stretch of words with smallest period q, at least max(6, 4 q) long, that can't be extended.
    `collapsed` is the words outside the later periods of all runs, joined by one blank. `words` is an
    array<string> column; by default all words of `text`. Null text, null words and no words: no runs, empty text;
    a null inside the words is left out. Each row is worked on by itself and whole, in memory of some 40 bytes per
    word and level of factors that repeat; repeated rows get equal results. An empty table gives no rows. Columns
    called runs or collapsed are replaced.
    """
    rest = docs.drop("runs", "collapsed")
    given = fresh(rest, "_words")
    if words is None:
        listed = words_of(F.col(f"`{text}`"))
    else:
        listed = F.filter(F.coalesce(words, F.array().cast("array<string>")), lambda w: w.isNotNull())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            size = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            at = 0
            while at < len(size):
                # Rows up to the slice's size; a larger one stands alone.
                until = max(at + 1, at + int(np.searchsorted(np.cumsum(size[at:]), SLICE_WORDS, side="right")))
                runs, collapsed = _slice_runs(lists.slice(at, until - at))
                held = batch.slice(at, until - at)
                yield pa.RecordBatch.from_arrays([*held.columns[:-1], runs, collapsed], names=[*batch.schema.names[:-1], "runs", "collapsed"])
                at = until

    schema = T.StructType([*rest.schema.fields, T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    return docs.select(*[f"`{c}`" for c in rest.columns], listed.alias(given)).mapInArrow(work, schema)


def planted_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and `words`; about a tenth of the documents, told by the checksum of their id, get a planted run.

    A null id counts as the text 'null'. A text without words stays as it is.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    n = F.size("w").cast("long")
    g = F.floor(h / 10)
    split = docs.select(F.col(doc_id).alias("doc_id"), words_of(F.col(text)).alias("w"))
    placed = split.select("doc_id", "w", (n - F.try_mod(g, n)).cast("int").alias("rest"), F.when((h % 10 == 0) & (n > 0), 3 + g % 8).alias("parts"))
    rest = F.col("rest")
    period = (1 + F.floor(rest / F.col("parts"))).cast("int")
    head, block = F.slice("w", 1, F.size("w") - rest), F.slice("w", F.size("w") - rest + 1, period)
    tail = F.slice(F.flatten(F.array_repeat(block, F.ceil(rest / period).cast("int"))), 1, rest)
    return placed.select("doc_id", F.when(F.col("parts").isNotNull(), F.concat(head, tail)).otherwise(F.col("w")).alias("words"))


def runs_digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return found.select(F.col(doc_id).alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best.alias("best"), digest(F.array_join(lines, "")).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256")).select(
        "doc_id",
        "n_runs",
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
