"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

Words are ordered by how often all documents use them. Each window of a benchmark item is looked up by its rarest
word only (its prefix); a place counts if the window fits into the document around that word (length and
position), and then the window and the document's words are compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, digest, text_or_empty
from tidemark.session import settle

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> Column:
    """Words with the empty strings that stand before a first and behind a last gap."""
    return F.split(ascii_lower(text_or_empty(text)), GAP, -1)


def item_windows(items: DataFrame, window: int = 10, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, words: every window of every item; an item of fewer words, but not none, is one window."""
    words = items.select(F.col(item_id).alias("item_id"), F.array_remove(words_of(text), "").alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (window - 1)))
    return words.select("item_id", F.explode(F.transform(starts, lambda i: F.slice(F.col("w"), i, window))).alias("words"))


def match_windows(
    docs: DataFrame, windows: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_words, hits (array of the start among the tokens, the length and the window): one row per row of `docs`.

    Lists of words are stored first: the planner knows their size then, and sends them to all tasks while they
    are small instead of moving every word of every document.
    """
    distinct = windows.select("words").distinct()
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text")).withColumn(
        "key", F.struct("doc_id", F.xxhash64("text").alias("hash"))
    )
    spread = rows.select("key", F.posexplode(words_of("text")).alias("at", "word"))
    vocabulary = settle(distinct.select(F.explode("words").alias("word")).distinct().coalesce(1), "vocabulary")
    counts = rows.select(F.explode(words_of("text")).alias("word")).join(vocabulary, "word").groupBy("word").count()
    # A window with a word that no document has can't occur and falls out here.
    offered = distinct.withColumn("window", F.array_join("words", " ")).select("window", F.size("words").alias("len"), F.posexplode("words").alias("offset", "word"))
    prefixes = settle(
        offered.join(counts, "word")
        .groupBy("window", "len")
        .agg(F.min(F.struct("count", "word", "offset")).alias("rarest"), F.count("*").alias("known"))
        .where("known = len")
        .select("window", "len", F.col("rarest.word").alias("word"), F.col("rarest.offset").alias("offset")),
        "prefixes",
    )
    looked_up = settle(prefixes.select("word").distinct().coalesce(1), "vocabulary")
    places = (
        spread.join(looked_up, "word", "left_semi")
        .join(prefixes, "word")
        .where(F.col("at") >= F.col("offset"))
        .groupBy("key")
        .agg(F.collect_list(F.struct((F.col("at") - F.col("offset") + 1).alias("start"), "len", "window")).alias("places"))
    )
    tokens = rows.join(places, "key", "left").withColumn("w", words_of("text"))
    n = F.size("w")
    empty = (F.get("w", F.lit(0)) == "").cast("int") + F.when(n > 1, (F.element_at("w", -1) == "").cast("int")).otherwise(0)
    verified = F.filter(
        "places",
        lambda p: (p["start"] + p["len"] - 1 <= n) & (F.array_join(F.slice(F.col("w"), p["start"], p["len"]), " ") == p["window"]),
    )
    return tokens.select(
        "doc_id",
        "key",
        (n - empty).cast("long").alias("n_words"),
        F.coalesce(verified, F.array().cast("array<struct<start:int,len:int,window:string>>")).alias("hits"),
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row per row of `docs`.

    Null text has no words. Rows that repeat an id with another text are judged on their own; equal rows get
    the same result. Item ids that are null name no item; items that share an id are one item. An empty benchmark
    hits nothing. Other columns are ignored.
    """
    windows = item_windows(benchmark, window, item_id, item_text)
    matched = settle(match_windows(docs, windows, doc_id, text), "matched")
    hit = F.size(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["len"] - 1)))))
    names = windows.select(F.array_join("words", " ").alias("window"), F.col("item_id").cast("string").alias("item")).distinct()
    items = (
        matched.where(F.size("hits") > 0)
        .select("key", F.explode(F.array_distinct(F.col("hits.window"))).alias("window"))
        .join(names, "window")
        .groupBy("key")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return matched.join(items, "key", "left").select(
        "doc_id",
        "n_words",
        hit.cast("long").alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        digest(F.array_join(listed, ",")).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )
