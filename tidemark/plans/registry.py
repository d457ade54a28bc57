"""Registered queries: a Spark job per key and, where SQL can say it, the same in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import ticket_sql

Job = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Job] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Job], Job]:
    def register(job: Job) -> Job:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = job
        if oracle is not None:
            ORACLE[name] = oracle
        return job

    return register


def with_tickets(body: str) -> str:
    """Put the ticket table in front of a SELECT or of further common table expressions."""
    text = body.strip()
    joiner = " " if text[:6].upper() == "SELECT" else ", "
    return f"WITH tickets AS ({ticket_sql()}){joiner}{text}"


def rounded(column: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, digits)


def sql_chi2_tail(stat: str, dof: str) -> str:
    """Six digits of P(X >= stat): one less the rising series of the lower tail, whose terms are all positive."""
    terms = f"range(0, CAST({stat} + 10 * sqrt({stat}) + 200 AS BIGINT))"
    term = f"exp(-({stat}) / 2 + (({dof}) / 2 + i) * ln(({stat}) / 2) - lgamma(({dof}) / 2 + i + 1))"
    return f"""CASE WHEN {dof} < 1 THEN NULL WHEN {stat} <= 0 THEN 1 ELSE
      round(greatest(0, 1 - list_sum(list_transform({terms}, lambda i: {term}))), 6) END::DOUBLE"""
