"""Readers for raw tables and for the ticket table derived from the event stream."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import pin_utc

CORRUPT = "_corrupt_record"


def read_source(
    spark: SparkSession,
    path: str,
    *,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Read a raw table under a declared schema; a missing path fails with a hint.

    Text formats keep lines that do not fit the schema in ``_corrupt_record``.
    """
    pin_utc(spark)
    reader = spark.read.format(fmt)
    if schema is not None:
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        if fmt in ("csv", "json"):
            schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    for key, value in options.items():
        reader = reader.option(key, value)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"source not found: {path} (load the raw layer first?)") from error
        raise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The ticket table: one row per event, with the columns of the ticket contract.
TICKET_COLUMNS = {
    "numero": "event_id",
    "prioridade": """CASE event_type WHEN 'error' THEN '1 - Crítica' WHEN 'purchase' THEN '2 - Alta'
        WHEN 'signup' THEN '3 - Média' WHEN 'click' THEN '4 - Baixa' ELSE '5 - Muito Baixa' END""",
    "produto": """CASE WHEN event_type IN ('view','click') OR user_id % 5 = 0 THEN NULL
        ELSE concat('prod', user_id % 7) END""",
    "categoria": """CASE WHEN event_type IN ('view','click') OR user_id % 5 = 0 THEN NULL
        ELSE concat('cat', user_id % 4) END""",
    "subcategoria": """CASE WHEN event_type IN ('view','click') OR user_id % 5 = 0 THEN NULL
        ELSE concat('sub', user_id % 9) END""",
    "grupo_designado": "CASE WHEN user_id % 23 = 0 THEN NULL ELSE concat('Team', user_id % 17) END",
    "item_configuracao": "concat('ic', user_id)",
    "aberto": "ts",
    "resolvido": """CASE WHEN event_id % 4 = 0 THEN NULL
        WHEN event_id % 100 = 1 THEN timestampadd(SECOND, CAST(round(value * 3600) AS BIGINT) + 3600, ts)
        ELSE timestampadd(SECOND, CAST(round(value * 1800) AS BIGINT), ts) END""",
    "encerrado": "timestampadd(SECOND, CAST(round(value * 3600) AS BIGINT), ts)",
    "duracao": "CAST(round(value * 3600) AS BIGINT)",
    "codigo_fechamento": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE concat('cod', event_id % 5) END",
    "solucao": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE concat('Ação ', event_id % 11) END",
    "incidente_pai": "CASE WHEN event_id % 9 = 0 THEN concat('INC', user_id % 12) END",
    "aberto_por": "CASE WHEN event_type IN ('view','click') THEN 'Monitoramento' ELSE 'Manual' END",
    "status": """CASE WHEN value < 10 THEN 'Sem Intervenção' WHEN value < 100 THEN 'Encerrado'
        ELSE 'Encerrado Automaticamente' END""",
    "entrou_kpi": "CASE WHEN event_type IN ('error','purchase') THEN 'SIM' ELSE 'NAO' END",
    "kpi_violado": """CASE WHEN event_type NOT IN ('error','purchase') THEN NULL
        WHEN value > 200 THEN 'SIM' ELSE 'NAO' END""",
    "descricao_resumida": """concat('Problema: verificação do ', event_type, ' na máquina ',
        user_id % 10)""",
}


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(*[F.expr(text).alias(name) for name, text in TICKET_COLUMNS.items()])


def ticket_sql() -> str:
    """The same ticket table as the body of a common table expression for an outside SQL engine."""
    columns = dict(TICKET_COLUMNS)
    columns["encerrado"] = "ts + to_seconds(CAST(round(value * 3600) AS BIGINT))"
    columns["resolvido"] = """CASE WHEN event_id % 4 = 0 THEN NULL
        WHEN event_id % 100 = 1 THEN ts + to_seconds(CAST(round(value * 3600) AS BIGINT) + 3600)
        ELSE ts + to_seconds(CAST(round(value * 1800) AS BIGINT)) END"""
    return "SELECT " + ", ".join(f"{text} AS {name}" for name, text in columns.items()) + " FROM events"
