"""Near duplicates by min-max hashing.

Each of the permutations of the shingle hashes gives two signature values, the smallest and the largest,
so half the hash evaluations make a signature. Bands of the signature propose pairs; exact Jaccard
similarity over the full sets confirms them. Texts with the same set are one class. In each band's bucket members are
first paired with the smallest one; where a bucket then still holds several components, the pairs between
these are confirmed too, so no group is written out pair by pair and no candidate of a bucket is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shingles import chunks, mix, shingle_hashes, shingle_sets
from tidemark.session import settle

PERMUTATIONS, ROWS = 64, 4  # 32 bands of 4 values: a pair at 0.75 is missed with probability 5e-6
BANDS = 2 * PERMUTATIONS // ROWS
# Of 128 values a pair at 0.75 differs in 24 two-bit digests, give or take 4.4: five of these more are allowed.
MOST_DIFFERENT = 47
# Every shingle sets one bit of a map; a bit that only one text has stands for a shingle that the other lacks.
MAP = 1024
SKETCH = 4 + MAP // 64
_FACTOR = mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64)) | np.uint64(1)
_SHIFT = mix(np.arange(1001, PERMUTATIONS + 1001, dtype=np.uint64))
SIGNED = "doc_id long, n long, h1 long, h2 long, sketch array<long>, bands array<long>"


def min_max_signatures(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Rows of smallest and largest values (2 * PERMUTATIONS columns) for texts that have shingles."""
    first = np.append(0, np.cumsum(n))[:-1]
    out = np.empty((2 * PERMUTATIONS, len(n)), dtype=np.uint64)
    for j in range(PERMUTATIONS):
        value = hashes * _FACTOR[j] + _SHIFT[j]
        out[j] = np.minimum.reduceat(value, first)
        out[PERMUTATIONS + j] = np.maximum.reduceat(value, first)
    return np.ascontiguousarray(out.T)


def _bits(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1).view(np.int64)


def sign(docs: DataFrame) -> DataFrame:
    """doc_id, text -> SIGNED; h1 and h2 tell sets apart, the sketch holds two bits of every signature value,
    then the map of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in chunks(batch.column(1)):
                hashes, n_all = shingle_hashes(data, offsets)
                at = np.append(0, np.cumsum(n_all))
                sets = [np.unique(hashes[at[i] : at[i + 1]]) for i in range(len(n_all))]
                n = np.array([len(s) for s in sets], dtype=np.int64)
                full = np.flatnonzero(n)
                h1, h2 = np.zeros(len(n), dtype=np.uint64), np.zeros(len(n), dtype=np.uint64)
                sketch, bands = np.zeros((len(n), SKETCH), dtype=np.int64), np.zeros((len(n), BANDS), dtype=np.int64)
                if len(full):
                    own = np.concatenate([sets[i] for i in full])
                    first = np.append(0, np.cumsum(n[full]))[:-1]
                    h1[full] = np.add.reduceat(mix(own), first)
                    h2[full] = np.add.reduceat(mix(own ^ np.uint64(0x5851F42D4C957F2D)), first)
                    signature = min_max_signatures(own, n[full])
                    digest = mix(signature)
                    seen = np.zeros((len(full), MAP), dtype=np.uint8)
                    seen[np.repeat(np.arange(len(full)), n[full]), (own >> np.uint64(20)) % np.uint64(MAP)] = 1
                    low, high = digest & np.uint64(1), digest >> np.uint64(1) & np.uint64(1)
                    sketch[full] = np.hstack([_bits(low.astype(np.uint8)), _bits(high.astype(np.uint8)), _bits(seen)])
                    grouped = signature.reshape(len(full), BANDS, ROWS)
                    total = np.arange(BANDS, dtype=np.uint64)[None, :].repeat(len(full), axis=0)
                    for k in range(ROWS):
                        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, k])
                    bands[full] = total.view(np.int64)
                held = np.zeros(len(n) + 1, dtype=np.int32)
                held[1:] = np.cumsum((n > 0) * BANDS)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(n)),
                        pa.array(n),
                        pa.array(h1.view(np.int64)),
                        pa.array(h2.view(np.int64)),
                        pa.ListArray.from_arrays(np.arange(len(n) + 1, dtype=np.int32) * SKETCH, sketch.ravel()),
                        pa.ListArray.from_arrays(held, bands[full].ravel()),
                    ],
                    ["doc_id", "n", "h1", "h2", "sketch", "bands"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, SIGNED)


def alike(a: Column, b: Column) -> Column:
    """Sizes, signature digests and shingle maps allow 0.75; the sizes and maps are sure."""
    x, y = a["sketch"], b["sketch"]
    differ = sum(F.bit_count(x[i].bitwiseXOR(y[i]).bitwiseOR(x[i + 2].bitwiseXOR(y[i + 2]))) for i in range(2))
    lacks = [sum(F.bit_count(u[i].bitwiseAND(F.bitwise_not(v[i]))) for i in range(4, SKETCH)) for u, v in ((x, y), (y, x))]
    shared = F.least(a["n"] - lacks[0], b["n"] - lacks[1])
    sizes = (a["n"] * 100 >= b["n"] * 75) & (b["n"] * 100 >= a["n"] * 75)
    return sizes & (differ <= MOST_DIFFERENT) & (shared * 175 >= (a["n"] + b["n"]) * 75)


def first_common(a: Column, b: Column) -> Column:
    """The bucket of the first band in which two texts meet."""
    return F.get(F.filter(F.zip_with(a, b, lambda x, y: F.when(x == y, x)), lambda x: x.isNotNull()), F.lit(0))


def confirm(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """a, b -> the pairs whose sets have 100 * intersection >= 75 * union, on the full texts."""
    text_b = docs.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    text_a = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    both = pairs.join(text_b, "b").join(text_a, "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Neighbouring rows mostly share the first text: its set is made once. An id may have several texts.
            first = batch.column(2)
            other = pc.not_equal(first[1:], first[:-1]).to_numpy(zero_copy_only=False) if len(first) > 1 else np.zeros(0, dtype=bool)
            fresh = np.flatnonzero(np.append(True, other)) if len(first) else np.zeros(0, dtype=np.int64)
            firsts = shingle_sets(first.take(pa.array(fresh)))
            begins = set(fresh.tolist())
            keep, one = [], np.zeros(0, dtype=np.uint64)
            for i, other in enumerate(shingle_sets(batch.column(3))):
                if i in begins:
                    one = next(firsts)
                same = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(bool(same) and 100 * same >= 75 * (len(one) + len(other) - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, type=pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of `docs`.

    Null, empty and blank texts have no shingles and are linked with nothing. Rows that share an id are one
    document where links are followed. Rows of null id take no part in links, but show the component of an
    equal set; alone, theirs is null and they are kept. An empty table gives no rows. Other columns are ignored.
    """
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = settle(sign(own), "signed")
    classes = settle(
        signed.where("n > 0 and doc_id is not null")
        .groupBy("h1", "h2", "n")
        .agg(F.min(F.struct("doc_id", "sketch", "bands")).alias("r"))
        .select("h1", "h2", "n", F.col("r.doc_id").alias("rep"), "r.sketch", "r.bands"),
        "classes",
    )
    named = own.where("doc_id is not null")
    banded = classes.select("rep", F.explode("bands").alias("bucket")).repartition("bucket")
    hubs = banded.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count("*").alias("m")).where("m > 1").drop("m")
    met = banded.join(hubs, "bucket").where("rep != hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    side = classes.select("rep", F.struct("n", "sketch").alias("x"))

    def plausible(pairs: DataFrame) -> DataFrame:
        return (
            pairs.join(side.toDF("a", "xa"), "a").join(side.toDF("b", "xb"), "b").where(alike(F.col("xa"), F.col("xb"))).select("a", "b")
        )

    first = settle(plausible(met), "pairs")
    # An id with several texts ties their classes together.
    several = signed.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(*(f(c).alias(f"{f.__name__}_{c}") for c in ("h1", "h2") for f in (F.min, F.max)))
    several = several.where("min_h1 != max_h1 or min_h2 != max_h2").select("doc_id")
    reps = signed.join(several, "doc_id", "left_semi").join(classes.select("h1", "h2", "n", "rep"), ["h1", "h2", "n"]).select("doc_id", "rep").distinct()
    least = reps.groupBy("doc_id").agg(F.min("rep").alias("a"))
    tied = reps.join(least, "doc_id").where("rep != a").select("a", F.col("rep").alias("b"))
    links = settle(confirm(first, named).unionByName(tied), "links")
    part = components(links, "a", "b")
    # Buckets that still hold several components: every pair between two of these is a candidate.
    placed = (
        banded.join(part.withColumnRenamed("node", "rep"), "rep", "left")
        .select("bucket", "rep", F.coalesce("component", "rep").alias("component"))
        .repartition("bucket")
    )
    split = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("bucket")
    open_ = settle(placed.join(split, "bucket", "left_semi").join(classes.select("rep", F.struct("n", "sketch").alias("x"), "bands"), "rep"), "open")
    left, right = open_.alias("l"), open_.alias("r")
    crossing = (
        left.join(right, (F.col("l.bucket") == F.col("r.bucket")) & (F.col("l.component") < F.col("r.component")) & alike(F.col("l.x"), F.col("r.x")) & (F.col("l.bucket") == first_common(F.col("l.bands"), F.col("r.bands"))))
        .select(F.least("l.rep", "r.rep").alias("a"), F.greatest("l.rep", "r.rep").alias("b"))
        .distinct()
        .join(first, ["a", "b"], "left_anti")
    )
    second = settle(crossing, "pairs")
    if second.limit(1).count():
        more = settle(confirm(second, named), "links")
        part = components(part.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more), "a", "b")
    grouped = classes.select("h1", "h2", "n", "rep").join(part.withColumnRenamed("node", "rep"), "rep", "left")
    grouped = grouped.select("h1", "h2", "n", F.coalesce("component", "rep").alias("component"))
    return (
        signed.select("doc_id", "h1", "h2", "n")
        .join(grouped, ["h1", "h2", "n"], "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.coalesce("component", "doc_id").alias("component_id"),
            F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept"),
        )
    )
