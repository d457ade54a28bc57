"""Secret scans with an incremental ledger of blobs.

Every version of a file is addressed by its content. A ledger holds, per blob and version of the rules, what was
found there; a scan runs only over pairs that the ledger does not hold, on one copy of each blob, and
findings are joined back to all the places that hold the blob.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import digest, fresh, text_or_empty
from tidemark.session import settle

SPANS = "array<struct<start:long,rank:int,stop:long,kind:string>>"


@dataclass(frozen=True)
class Rule:
    """Matches are leftmost and do not overlap; those whose `group` is shorter than `least` are dropped then."""

    kind: str
    pattern: str
    group: int
    least: int
    likely: str


# Kinds, patterns and least lengths. `likely` is a cheap test that every kept match passes.
RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, r"AKIA[A-Z0-9]{12}"),
    # Runs of 32 and more are the same as runs of any length, without the short ones.
    Rule("hex", r"[0-9a-f]{32,}", 0, 32, r"[0-9a-f]{32}"),
)
VERSION = "1"


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, text -> blob, spans; blobs without findings give no row. Offsets are code points, stop exclusive.

    A match's place is the sum of all gaps and matches before it: the text is split at the pattern, and a
    window per blob and rule adds the lengths up.
    """
    none = F.array().cast("array<struct<rank:int,n:int,gap:int,chars:int,kept:int>>")

    def cuts(rank: int, rule: Rule):
        hits = F.transform(
            F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0)),
            lambda m: F.struct(F.length(m).alias("all"), F.length(F.regexp_extract(m, rule.pattern, rule.group)).alias("kept")),
        )
        gaps = F.transform(F.split("text", rule.pattern, -1), lambda g: F.length(g))
        shaped = F.transform(
            F.arrays_zip(gaps.alias("gap"), hits.alias("hit")),
            lambda x, i: F.struct(
                F.lit(rank).alias("rank"), i.alias("n"), x["gap"].alias("gap"), x["hit"]["all"].alias("chars"), x["hit"]["kept"].alias("kept")
            ),
        )
        return F.when(F.col("text").rlike(rule.likely), shaped).otherwise(none)

    found = [cuts(rank, rule) for rank, rule in enumerate(rules)]
    least = F.element_at(F.array(*(F.lit(r.least) for r in rules)), F.col("rank") + 1)
    kinds = F.element_at(F.array(*(F.lit(r.kind) for r in rules)), F.col("rank") + 1)
    so_far = Window.partitionBy("blob", "rank").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    return (
        blobs.select("blob", F.explode(F.concat(*found)).alias("f"))
        .select("blob", "f.*")
        .where("chars is not null")  # the text behind the last match
        .dropDuplicates(["blob", "rank", "n"])  # where rows share id and text
        .withColumn("stop", F.sum(F.col("gap").cast("long") + F.col("chars")).over(so_far))
        .where(F.col("kept") >= least)
        .groupBy("blob")
        .agg(
            F.sort_array(
                F.collect_list(F.struct((F.col("stop") - F.col("chars")).alias("start"), "rank", "stop", kinds.alias("kind")))
            )
            .cast(SPANS)
            .alias("spans")
        )
    )


def scan_versions(
    versions: DataFrame,
    ledger: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
    rules_version: str = VERSION,
    path: str = "doc_id",
    text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(findings, additions): path, blob, spans for every row of `versions`, and the ledger's new rows.

    The ledger has blob, rules_version and spans; None is an empty one. Append the additions to it. Blobs
    are the SHA-256 of the text; null text is empty. Paths may be null and may repeat (a file's history);
    each row gets its own findings. An empty table gives no rows. Other columns are ignored.
    """
    at = versions.select(F.col(path).alias("path"), text_or_empty(text).alias("text")).withColumn("blob", digest(F.col("text")))
    known = None if ledger is None else ledger.where(F.col("rules_version") == rules_version).select("blob", "spans")
    # One place per blob, on narrow rows: only unseen blobs' texts are moved.
    unseen = at.groupBy("blob").agg(F.min(F.struct("path")).alias("first"))
    if known is not None:
        unseen = unseen.join(known, "blob", "left_anti")
    one = at.alias("a").join(
        unseen.alias("u"), (F.col("a.blob") == F.col("u.blob")) & F.col("a.path").eqNullSafe(F.col("u.first.path"))
    )
    hits = settle(scan_blobs(one.select("a.blob", "a.text"), rules), "secrets")
    none = F.array().cast(SPANS)
    additions = (
        unseen.select("blob")
        .join(hits, "blob", "left")
        .select("blob", F.lit(rules_version).alias("rules_version"), F.coalesce("spans", none).alias("spans"))
    )
    everything = hits if known is None else hits.unionByName(known.where(F.size("spans") > 0))
    findings = at.select("path", "blob").join(everything, "blob", "left").select("path", "blob", F.coalesce("spans", none).alias("spans"))
    return findings, additions


def findings_digest(findings: DataFrame) -> DataFrame:
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return findings.select(
        F.col("path").alias("doc_id"),
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        digest(joined(base)).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, mask: str = "[SECRET]", path: str = "doc_id", text: str = "text") -> DataFrame:
    """The same rows and columns with every found span, or run of overlapping ones, replaced by `mask`."""
    findings, _ = scan_versions(docs, path=path, text=text)
    # By blob, so that rows that share an id keep their own text.
    spans = findings.where(F.size("spans") > 0).select("blob", "spans").dropDuplicates(["blob"])
    by, own = fresh(docs, "_blob"), fresh(docs, "_spans")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc, s):
        inside = s["start"] < acc["at"]
        gap = F.substring(F.col(f"`{text}`"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(
            F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], gap, F.lit(mask))).alias("out"),
            F.greatest(acc["at"], s["stop"]).alias("at"),
        )

    clean = F.aggregate(
        F.col(own), start, step, lambda acc: F.concat(acc["out"], F.substring(F.col(f"`{text}`"), (acc["at"] + 1).cast("int"), F.lit(2**31 - 1)))
    )
    kept = docs.withColumn(by, digest(text_or_empty(text))).join(spans.toDF(by, own), by, "left")
    return kept.withColumn(text, F.when(F.col(own).isNotNull(), clean).otherwise(F.col(f"`{text}`"))).select(*[f"`{c}`" for c in docs.columns])
