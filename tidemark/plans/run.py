"""The whole layer run: raw tickets to bronze, silver and three gold tables, each written once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import medallion
from tidemark.sources import contracts, layers

GOLD_TABLES = ("volume_diario", "tendencias_macro", "chamados_risco")


@dataclass(frozen=True)
class LayerRun:
    """Where the layers are, the audited row counts and the domain surprises of one run."""

    paths: dict[str, str]
    rows: dict[str, int]
    audit: DataFrame
    new_values: DataFrame
    source_hash: str


def _by_day(df: DataFrame, time: str = "aberto") -> DataFrame:
    """Even out the files per opening day; a busy day is split over several tasks and files."""
    return df.withColumn("dia", F.to_date(time)).hint("rebalance", "dia")


def build_layers(
    raw: DataFrame,
    root: str,
    *,
    year: int,
    text_times: bool = False,
    minimum_group: int = 100,
    mode: str = "errorifexists",
) -> LayerRun:
    """Check, type, clean and enrich a raw ticket table below ``root``.

    Every layer is read back from its files by the next one, so no layer is computed twice and a lost
    executor costs one layer at most.  Row counts ride on the writes.
    """
    spark = raw.sparkSession
    root = root.rstrip("/")
    paths = {"bronze": f"{root}/bronze", "silver": f"{root}/silver"}
    paths |= {name: f"{root}/gold/{name}" for name in GOLD_TABLES}
    rows: dict[str, int] = {}
    options = {"mode": mode}

    source_hash = layers.content_fingerprint(raw).first()["fingerprint"]
    bronze = medallion.bronze(raw, contracts.TICKET_CONTRACT, text_times)
    rows["bronze"] = layers.write_layer(
        _by_day(bronze), paths["bronze"], layer="bronze", source_hash=source_hash,
        partition_by=["dia"], **options,
    )

    stored = layers.read_layer(spark, paths["bronze"]).drop("dia")
    stored = stored.drop(*[c for c in stored.columns if c.startswith(layers.META_PREFIX)])
    audit = contracts.RowAudit()
    watched = audit.watch(stored, "bronze")
    in_year = audit.watch(watched.where(medallion.in_year("aberto", year)), "ano")
    first = medallion.first_per_key(in_year, keys=["numero"], seq="aberto")
    single = audit.watch(first, "primeiro_por_numero")
    # The cap is taken over the same single rows, from a branch that counts nothing.
    days = F.col("dia").between(F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year}-12-31").cast("date"))
    pruned = layers.read_layer(spark, paths["bronze"]).where(days).select(*stored.columns)
    unwatched = medallion.first_per_key(
        pruned.where(medallion.in_year("aberto", year)), keys=["numero"], seq="aberto"
    )
    cap = medallion.upper_cap(unwatched, "duracao")
    rows["silver"] = layers.write_layer(
        _by_day(medallion.silver_columns(single, cap.scalar())), paths["silver"], layer="silver",
        source_hash=source_hash, partition_by=["dia"], **options,
    )

    silver = layers.read_layer(spark, paths["silver"]).drop("dia")
    silver = silver.drop("_ingested_at", "_source_layer", "_source_hash")
    gold = {
        "volume_diario": medallion.gold_daily(silver),
        "tendencias_macro": medallion.gold_weekly(silver),
        "chamados_risco": medallion.gold_risk(silver, minimum_group),
    }
    for name, table in gold.items():
        rows[name] = layers.write_layer(
            table, paths[name], layer="gold", source_hash=source_hash, **options
        )
    contracts.require_no_leakage(
        layers.read_layer(spark, paths["chamados_risco"]), contracts.LEAKAGE_COLUMNS, "numero"
    )
    return LayerRun(
        paths=paths,
        rows=rows,
        audit=audit.table(spark),
        new_values=contracts.domain_violations(silver, contracts.TICKET_DOMAINS),
        source_hash=source_hash,
    )
