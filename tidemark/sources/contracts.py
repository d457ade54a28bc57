"""Checks that report and never repair: names, value domains, types, row deltas, leakage."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# The names of the ticket contract.
TICKET_CONTRACT = [
    "numero",
    "prioridade",
    "produto",
    "categoria",
    "subcategoria",
    "grupo_designado",
    "item_configuracao",
    "aberto",
    "resolvido",
    "encerrado",
    "duracao",
    "codigo_fechamento",
    "descricao_resumida",
    "solucao",
    "aberto_por",
    "incidente_pai",
    "status",
    "entrou_kpi",
    "kpi_violado",
]

# Types after the minimal typing of the first layer, where they matter downstream.
TICKET_TYPES = {
    "aberto": "timestamp_ntz",
    "resolvido": "timestamp_ntz",
    "encerrado": "timestamp_ntz",
    "duracao": "bigint",
    "prioridade": "string",
    "status": "string",
    "entrou_kpi": "string",
    "kpi_violado": "string",
    "descricao_resumida": "string",
}

# The known value domains.
TICKET_DOMAINS = {
    "prioridade": ["1 - Crítica", "2 - Alta", "3 - Média", "4 - Baixa", "5 - Muito Baixa"],
    "status": ["Sem Intervenção", "Encerrado", "Encerrado Automaticamente", "Aguardando Problema"],
    "aberto_por": ["Monitoramento", "Manual"],
    "entrou_kpi": ["SIM", "NAO"],
    "kpi_violado": ["SIM", "NAO"],
}

# Columns known only after a ticket was handled.
LEAKAGE_COLUMNS = ["resolvido", "encerrado", "duracao", "codigo_fechamento", "solucao", "status"]


class ContractError(ValueError):
    """A table breaks its contract."""


def unpivot_text(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """(…keep, column_name, value): every named column as text, one row per cell, no shuffle."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return df.select(*(keep or []), F.explode(cells).alias("_cell")).select(*(keep or []), "_cell.*")


def require_columns(df: DataFrame, expected: list[str]) -> list[str]:
    """Raise for missing names (sorted) and return the sorted unexpected ones."""
    missing = sorted(set(expected) - set(df.columns))
    if missing:
        raise ContractError(f"{len(missing)} expected column(s) missing from the source: {missing}")
    return sorted(set(df.columns) - set(expected))


def require_types(df: DataFrame, types: dict[str, str]) -> None:
    """Raise where a present column has another type than declared (names as Spark prints them)."""
    found = dict(df.dtypes)
    wrong = {c: (found[c], t) for c, t in sorted(types.items()) if c in found and found[c] != t}
    if wrong:
        raise ContractError(f"{len(wrong)} column(s) with an unexpected type (found, declared): {wrong}")


def contract_status(df: DataFrame, expected: list[str]) -> DataFrame:
    """(column_name, status, n_filled): ok, missing or extra, with the number of filled cells."""
    names = sorted(set(expected) | set(df.columns))
    status = {
        n: "missing" if n not in df.columns else ("ok" if n in expected else "extra") for n in names
    }
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns])
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("column_name"),
                F.lit(status[n]).alias("status"),
                (F.col(n) if n in df.columns else F.lit(0).cast("bigint")).alias("n_filled"),
            )
            for n in names
        ]
    )
    return filled.select(F.explode(rows).alias("_r")).select("_r.*")


def domain_violations(df: DataFrame, domains: dict[str, list[str]]) -> DataFrame:
    """(column_name, value, n) of values outside their domain; nulls and absent columns are skipped."""
    present = {c: v for c, v in domains.items() if c in df.columns}
    cells = unpivot_text(df, list(present)).where(F.col("value").isNotNull())
    counts = cells.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    known = F.lit(False)
    for name, values in present.items():
        known = known | ((F.col("column_name") == name) & F.col("value").isin(values))
    return counts.where(~known)


def coerce_timestamps(df: DataFrame, columns: list[str], fmt: str | None = None) -> DataFrame:
    """Text to zone-less timestamps; what does not parse becomes null."""

    def parsed(name: str) -> Column:
        args = [F.col(name)] + ([F.lit(fmt)] if fmt else [])
        return F.try_to_timestamp(*args).cast("timestamp_ntz")

    return df.withColumns({c: parsed(c) for c in columns})


def coercion_report(raw: DataFrame, columns: list[str], fmt: str | None = None) -> DataFrame:
    """(column_name, n_raw, n_typed, n_new_null) of a timestamp coercion, in one pass."""
    kept = raw.select(*[F.col(c).alias(f"_raw_{c}") for c in columns], *columns)
    typed = coerce_timestamps(kept, columns, fmt)
    sums = []
    for c in columns:
        sums += [F.count(f"_raw_{c}").alias(f"r_{c}"), F.count(c).alias(f"t_{c}")]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"r_{c}").alias("n_raw"),
                F.col(f"t_{c}").alias("n_typed"),
                (F.col(f"r_{c}") - F.col(f"t_{c}")).alias("n_new_null"),
            )
            for c in columns
        ]
    )
    return typed.agg(*sums).select(F.explode(rows).alias("_r")).select("_r.*")


@dataclass
class RowAudit:
    """Counts rows between steps while the one write or query runs, without extra scans."""

    steps: list[tuple[str, Observation]] = field(default_factory=list)

    def watch(self, df: DataFrame, step: str) -> DataFrame:
        seen = Observation()
        self.steps.append((step, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def table(self, spark: SparkSession) -> DataFrame:
        """(step, n_before, n_after, delta, pct) once an action has run; 0 % of an empty input."""
        counts = [(name, int(seen.get["rows"])) for name, seen in self.steps]
        rows = [
            (step, before, after, after - before, 100.0 * (after - before) / before if before else 0.0)
            for (_, before), (step, after) in zip(counts, counts[1:])
        ]
        return spark.createDataFrame(
            rows, "step string, n_before bigint, n_after bigint, delta bigint, pct double"
        )


def leakage_report(df: DataFrame, forbidden: list[str], key: str) -> DataFrame:
    """(check_name, n_found): forbidden columns present, and surplus rows of the key."""
    present = len(set(forbidden) & set(df.columns))
    copies = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_surplus")
    )
    rows = F.array(
        F.struct(
            F.lit("forbidden_columns").alias("check_name"),
            F.lit(present).cast("bigint").alias("n_found"),
        ),
        F.struct(F.lit("repeated_keys").alias("check_name"), F.col("_surplus").alias("n_found")),
    )
    return copies.select(F.explode(rows).alias("_r")).select("_r.*")


def require_no_leakage(df: DataFrame, forbidden: list[str], key: str) -> None:
    """Raise where a forbidden column or a repeated key is present."""
    found = {r["check_name"]: r["n_found"] for r in leakage_report(df, forbidden, key).collect()}
    if any(found.values()):
        raise ContractError(f"leakage check failed: {found}")
