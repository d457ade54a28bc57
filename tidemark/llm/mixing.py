"""Mixing sources to target weights by weighted sampling without replacement (Efraimidis-Spirakis).

Every document gets the key -ln(u) / weight, with u a uniform hash of its id: the smallest keys of a source
are a weighted sample. A source's target is met by whole passes over it (epochs) and then by documents in
key order until the rest of the token budget is used up. Keys fall into a fixed number of ordered cells per source;
prefix sums over cells find the one cell where the budget ends, and only its rows are ordered one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD
from tidemark.session import settle

CYCLE = (3, 1, 2)


def word_length_weight(chars: Column, words: Column) -> Column:
    """Quality weight: 1 for six characters a word, gaps included, falling to 0.05 at none and at twelve."""
    return F.greatest(F.lit(0.05), F.coalesce(1 - F.abs(chars / F.nullif(words, F.lit(0)) - 6) / 6, F.lit(0.05)))


def source_targets(sizes: DataFrame, budget: float = 1.5, most: float = 2.0, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """source, source_size -> + weight, target. One row per source comes in.

    Weights repeat over sources by code point, null last. Targets share budget x all words by weight; none goes
    above most x its own size, and what is cut is shared again by weight. With sources ordered by the ratio
    size / weight, the cut ones come first, so one running sum finds the level.
    """
    if budget > most:
        raise ValueError("the budget is more than all sources may give")
    # One row per source: these windows see no documents.
    everything = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("_n", F.row_number().over(everything)).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, cycle)), (F.col("_n") - 1) % len(cycle) + 1).cast("double")
    )
    cap = F.col("source_size") * most
    by_ratio = Window.partitionBy(F.lit(0)).orderBy(F.col("_ratio"), F.col("_n"))
    before, whole = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    level = ranked.withColumn("_ratio", cap / F.col("weight")).select(
        "*",
        (
            (F.sum("source_size").over(whole) * budget - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most)
            / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        ).alias("_level"),
    )
    # The level of the first source that isn't cut holds for all behind it.
    first = F.min(F.when(F.col("_ratio") >= F.col("_level"), F.struct("_ratio", "_n", "_level"))).over(whole)
    cut = F.coalesce(
        F.struct("_ratio", "_n") < F.struct(first["_ratio"].alias("_ratio"), first["_n"].alias("_n")), F.lit(True)
    )
    return level.select(
        "source", "source_size", "weight", F.when(cut, cap).otherwise(first["_level"] * F.col("weight")).alias("target")
    )


def key_cell(key: Column, cells: int) -> Column:
    """A number of 0 to cells - 1 that rises with the key.

    The mean of the exponential distributions at thirteen scales, four times apart: whatever weight the rows
    of a source have, it is within twofold of some scale's, so no cell holds more than a small share of them.
    """
    scales = [4.0**i for i in range(-4, 9)]
    return F.least(F.lit(cells - 1), F.floor(sum(1 - F.exp(-key / s) for s in scales) / len(scales) * cells)).cast("int")


def mix_documents(
    docs: DataFrame,
    budget: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    cells: int = 4096,
    quality: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, source, size, source_size, target, epochs (times taken), taken (words): one row per input row.

    `keep` names columns of the input that come along, the text for instance.

    Of the document where the budget ends, the part that is left is taken. Size is the number of words;
    null or empty text has none and is taken for nothing. Rows of null source are a source. Rows with the same id get
    the same key and come in order of size; equal rows share what is left of the budget as if they stood
    one behind the other. Null ids are all one id. An empty table gives no rows. Other columns are ignored.
    """
    hexed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))))
    u = (F.conv(F.substring(hexed, 1, 12), 16, 10).cast("double") + 1) / float(2**48 + 1)
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    rows = settle(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            size.alias("size"),
            (-F.log(u) / (word_length_weight(F.length(text), size) if quality is None else quality)).alias("key"),
            *[F.col(f"`{c}`") for c in keep],
        )
        .withColumn("cell", key_cell(F.col("key"), cells)),
        "mix",
    )
    per_cell = rows.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    targets = source_targets(per_cell.groupBy("source").agg(F.sum("cell_size").alias("source_size")), budget, most)
    plan = targets.withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    ).withColumn("left", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    up_to = Window.partitionBy("source").orderBy("cell")
    filled = per_cell.withColumn("cell_end", F.sum("cell_size").over(up_to)).withColumn(
        "cell_start", F.col("cell_end") - F.col("cell_size")
    )
    same = F.col("p.source").eqNullSafe(F.col("c.source"))
    marks = (
        filled.alias("c")
        .join(plan.alias("p"), same)
        .select("p.*", "c.cell", "c.cell_start", (F.col("cell_start") < F.col("left")).alias("_some"), (F.col("cell_end") > F.col("left")).alias("_cut"))
        .withColumn("_kind", F.when(~F.col("_some"), 0).when(F.col("_cut"), 1).otherwise(2))
        .drop("_some", "_cut")
    )
    cut_at = F.coalesce(F.min(F.when(F.col("_kind") == 1, F.struct("cell", "cell_start"))), F.struct(F.lit(None).cast("int").alias("cell"), F.lit(None).cast("long").alias("cell_start")))
    borders = (
        marks.groupBy("source", "source_size", "target", "epochs", "left")
        .agg(F.max(F.when(F.col("_kind") == 2, F.col("cell"))).alias("full_to"), cut_at.alias("cut"))
        .select("*", F.col("cut.cell").alias("cut_cell"), F.col("cut.cell_start").alias("cut_start"))
        .drop("cut")
    )
    joined = rows.alias("r").join(borders.alias("b"), F.col("r.source").eqNullSafe(F.col("b.source"))).drop(F.col("b.source"))
    inside = F.coalesce(F.col("cell") == F.col("cut_cell"), F.lit(False))
    order = Window.partitionBy("source", "cell").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    whole = joined.where(~inside).withColumn(
        "part", F.when(F.coalesce(F.col("cell") <= F.col("full_to"), F.lit(False)), F.col("size")).otherwise(0)
    )
    split = joined.where(inside).withColumn("_end", F.sum("size").over(order)).withColumn(
        "part",
        F.greatest(
            F.lit(0), F.least(F.col("size"), F.col("left") - F.col("cut_start") - F.col("_end") + F.col("size"))
        ),
    ).drop("_end")
    return whole.unionByName(split).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.when(F.col("size") > 0, F.col("epochs") + (F.col("part") > 0).cast("long")).otherwise(0).alias("epochs"),
        (F.col("size") * F.col("epochs") + F.col("part")).cast("long").alias("taken"),
        *[F.col(f"`{c}`") for c in keep],
    )
