"""Near-duplicate vectors by collision counting over one-dimensional projections.

Unit vectors are projected on random directions. Around each query stands a window on every projection; a pair
collides on a projection if one lies in the other's window, and pairs with enough collisions are verified by
their cosine in double precision. Three projections at a time, cut into cells, bring pairs together: a row goes to its
own cell once and, as a query, to the cells that its windows reach. The window and the count are set for recall: on a
projection a pair at the threshold differs by a normal variate of deviation |u - v|.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.session import settle

PROJECTIONS, TABLES, DIMS = 24, 3, 3
UNITS = 1000  # projections are kept as whole thousandths
BLOCK = 4096  # rows of a cell that are held at once


def window_and_count(least: float) -> tuple[int, int]:
    """Half window of 2.5 deviations of a pair at the threshold, and a count that such a pair misses once in 10^5."""
    half = 2.5 * math.sqrt(2 - 2 * least)
    p = math.erf(2.5 / math.sqrt(2))
    missed, count = 0.0, 0
    while count < PROJECTIONS:
        missed += math.comb(PROJECTIONS, count) * p**count * (1 - p) ** (PROJECTIONS - count)
        if missed > 1e-5:
            break
        count += 1
    return round(half * UNITS), count


def unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled by the largest component first, so that nothing overflows."""
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def project(classes: DataFrame, half: int) -> DataFrame:
    """label, rep, dim, embedding -> label, rep, dim, slot, cell, query, places (PROJECTIONS whole numbers as bytes).

    The directions follow from the dimension alone.
    """
    width = 3 * half

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions: dict[int, np.ndarray] = {}
        corners = np.stack(np.meshgrid(*[[0, 1]] * DIMS, indexing="ij"), axis=-1).reshape(-1, DIMS)
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                if dim not in directions:
                    directions[dim] = np.random.default_rng(int(dim)).standard_normal((dim, PROJECTIONS))
                label, rep = part.column(0).to_numpy(), part.column(1).to_numpy()
                vectors = part.column(3).flatten().to_numpy().reshape(-1, dim)
                places = np.clip(np.rint(unit(vectors) @ directions[dim] * UNITS), -32000, 32000).astype(np.int16)
                packed = np.array([p.tobytes() for p in places], dtype=object)
                for slot in range(TABLES):
                    z = places[:, slot * DIMS : (slot + 1) * DIMS].astype(np.int64)
                    low, high = (z - half) // width, (z + half) // width
                    for own, cells, keep in [
                        (0, z // width, np.ones(len(z), dtype=bool)),
                        *((1, np.where(c, high, low), (~c.astype(bool) | (high > low)).all(axis=1)) for c in corners),
                    ]:
                        at = np.flatnonzero(keep)
                        code = ((cells[at] + 512) << np.arange(0, 10 * DIMS, 10)).sum(axis=1)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(label[at].astype(np.int64)),
                                pa.array(rep[at]),
                                pa.array(np.full(len(at), dim, dtype=np.int64)),
                                pa.array(np.full(len(at), slot, dtype=np.int32)),
                                pa.array(code),
                                pa.array(np.full(len(at), own, dtype=np.int32)),
                                pa.array(packed[at].tolist(), pa.binary()),
                            ],
                            ["label", "rep", "dim", "slot", "cell", "query", "places"],
                        )

    return classes.select("label", "rep", "dim", "embedding").mapInArrow(
        run, "label long, rep long, dim long, slot int, cell long, query int, places binary"
    )


def count_collisions(rows: DataFrame, half: int, count: int) -> DataFrame:
    """Candidates a < b: pairs of a cell that collide on `count` projections, each in the first table where it can.

    Cells with more rows than BLOCK are parted; their queries go to every part. Rows come ordered, a part's own
    rows first, so that a task holds one part and a batch of queries.
    """
    key = ["label", "dim", "slot", "cell"]
    large = rows.where("query = 0").groupBy(*key).count().where(F.col("count") > BLOCK)
    parts = large.select(*key, F.ceil(F.col("count") / BLOCK).cast("int").alias("parts"))
    dealt = rows.join(parts, key, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.when(F.col("query") == 1, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    )
    dealt = dealt.withColumn("part", F.explode(part)).drop("parts")
    whole = [*key, "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, data = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(6)], axis=1)
            rep = batch.column(6).to_numpy()
            places = np.frombuffer(b"".join(batch.column(7).to_pylist()), dtype=np.int16).reshape(-1, PROJECTIONS)
            cuts = np.flatnonzero(np.append(True, (columns[1:] != columns[:-1]).any(axis=1)))
            for begin, end in zip(cuts, np.append(cuts[1:], len(columns))):
                at, query = tuple(columns[begin, :5]), columns[begin, 5]
                if at != now:
                    now, ids, data = at, [], []
                if not query:
                    ids.append(rep[begin:end])
                    data.append(places[begin:end])
                elif ids:
                    ids, data = [np.concatenate(ids)], [np.concatenate(data)]
                    slot = int(at[2])
                    for q in range(begin, end, 256):
                        # Neighbours on this table's projections first, one after the other.
                        x, y = places[q : min(q + 256, end)].astype(np.int32), data[0].astype(np.int32)
                        near = rep[q : min(q + 256, end), None] > ids[0][None, :]
                        for k in range(slot * DIMS, slot * DIMS + DIMS):
                            near &= np.abs(x[:, k, None] - y[None, :, k]) <= half
                        i, j = np.nonzero(near)
                        hits = np.abs(x[i] - y[j]) <= half
                        keep = hits.sum(axis=1) >= count
                        for t in range(slot):
                            keep &= ~hits[:, t * DIMS : (t + 1) * DIMS].all(axis=1)
                        if keep.any():
                            yield pa.RecordBatch.from_arrays([pa.array(ids[0][j[keep]]), pa.array(rep[q + i[keep]])], ["a", "b"])

    ordered = dealt.select(*whole, "query", "rep", "places").repartition(*whole).sortWithinPartitions(*whole, "query", "rep")
    return ordered.mapInArrow(run, "a long, b long")


def verify(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    left = classes.select(F.col("rep").alias("a"), F.col("label").alias("la"), F.col("embedding").alias("ea"), F.col("size").alias("size_a"))
    right = classes.select(F.col("rep").alias("b"), F.col("label").alias("lb"), F.col("embedding").alias("eb"), F.col("size").alias("size_b"))
    both = pairs.distinct().join(left, "a").join(right, "b").where("la = lb and size(ea) = size(eb)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array([len(v) for v in batch.column(4)], dtype=np.int64)
            keep = np.zeros(batch.num_rows, dtype=bool)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                some = batch.take(pa.array(at))
                x, y = (some.column(i).flatten().to_numpy().reshape(-1, dim).astype(np.float64) for i in (4, 5))
                x, y = x / np.abs(x).max(axis=1, keepdims=True), y / np.abs(y).max(axis=1, keepdims=True)
                keep[at] = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1))) >= least
            yield batch.select(["a", "b", "size_a", "size_b"]).filter(pa.array(keep))

    return both.select("a", "b", "size_a", "size_b", "ea", "eb").mapInArrow(run, "a long, b long, size_a long, size_b long")


def similar_vectors(
    vectors: DataFrame, least: float = 0.98, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of `vectors`.

    Vectors with equal components and label are one class, linked with each other; candidates are looked for between
    classes. Linked with nothing (component: itself): null label, null id, and vectors that are null, empty,
    zero or hold null or non-finite components; vectors of different lengths never link. Rows that share an id are
    one where links are followed. A null id has a null component and is kept. An empty table gives no rows.
    Other columns are ignored.
    """
    half, count = window_and_count(least)
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"), F.col(label).cast("long").alias("label")
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("usable", usable).withColumn("h1", F.xxhash64("embedding")).withColumn("h2", F.xxhash64(F.lit(1), "embedding"))
    key = ["label", "h1", "h2"]
    classes = settle(
        rows.where("usable")
        .groupBy(*key)
        .agg(F.min(F.struct("vec_id", "embedding")).alias("r"), F.count("*").alias("size"))
        .select(*key, F.col("r.vec_id").alias("rep"), "r.embedding", F.size("r.embedding").cast("long").alias("dim"), "size"),
        "vectors",
    )
    candidates = count_collisions(settle(project(classes, half), "projected"), half, count)
    links = settle(verify(candidates, classes, least), "links")
    part = components(links, "a", "b").withColumnRenamed("node", "rep")
    found = links.select(F.col("a").alias("rep"), F.col("size_b").alias("n")).unionByName(links.select(F.col("b").alias("rep"), F.col("size_a").alias("n")))
    per_class = (
        classes.select(*key, "rep", "size")
        .join(found.groupBy("rep").agg(F.sum("n").alias("n")), "rep", "left")
        .join(part, "rep", "left")
        .select(*key, (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n"), F.coalesce("component", "rep").alias("component"), F.lit(True).alias("usable"))
    )
    component = F.coalesce("component", "vec_id")
    return (
        rows.select("vec_id", *key, "usable")
        .join(per_class, [*key, "usable"], "left")
        .select(
            "vec_id",
            F.coalesce("n", F.lit(0)).alias("n_links"),
            component.alias("component_id"),
            F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
        )
    )
