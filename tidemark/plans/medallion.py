"""Bronze, silver and gold ticket tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import day_calendar, hour_calendar, week_of_wednesday
from tidemark.functions.text import clean_text, token_count
from tidemark.operators import causal
from tidemark.operators.ordering import exact_quantiles, find_cuts
from tidemark.operators.series import daily_counts, lags, mean_of_previous
from tidemark.sources.contracts import TICKET_TYPES, coerce_timestamps, require_columns, require_types

UNCATEGORISED = "Não categorizado"
P2_P3 = ["2 - Alta", "3 - Média"]
DAY_COLUMNS = [
    "dia_semana", "fim_de_semana", "feriado", "vespera_feriado", "dia_seguinte_feriado", "dow_sin", "dow_cos",
]
TIME_COLUMNS = ["aberto", "resolvido", "encerrado"]

# The columns of the ticket-grain risk table, in order.
RISK_COLUMNS = [
    "numero", "aberto", "data", "prioridade", "produto", "categoria", "subcategoria",
    "grupo_designado", "item_configuracao", "aberto_por", "descricao_limpa",
    "flag_categorizado", "incidente_pai",
    "hora_abertura", "dia_semana", "fim_de_semana", "hora_sin", "hora_cos", "dow_sin", "dow_cos",
    "turno_abertura", "fora_horario_comercial", "vespera_feriado", "dia_seguinte_feriado", "feriado",
    "descricao_n_tokens", "descricao_contagem_historica",
    "ic_contagem_historica", "ic_horas_desde_ultimo_chamado",
    "grupo_contagem_historica", "grupo_chamados_ultima_hora", "grupo_baixo_volume",
    "tem_incidente_pai", "incidente_pai_contagem_historica",
    "entrou_kpi", "kpi_violado", "pressao_fila_7d",
]

# The silver columns that the risk table is made of.
RISK_INPUTS = [
    "numero", "aberto", "prioridade", "produto", "categoria", "subcategoria", "grupo_designado",
    "item_configuracao", "aberto_por", "descricao_limpa", "flag_categorizado", "incidente_pai",
    "entrou_kpi", "kpi_violado",
]


def in_year(time: str, year: int) -> Column:
    """A calendar year as a range, so that the filter reaches the file statistics."""
    start = F.lit(f"{year}-01-01").cast("timestamp_ntz")
    end = F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")
    return (F.col(time) >= start) & (F.col(time) < end)


def first_per_key(df: DataFrame, *, keys: list[str], seq: str) -> DataFrame:
    """The first row of each key by ``seq``; null keys count as one key.

    Rows with equal ``seq`` are ordered by a hash of the whole row, so that neither the order of the files nor a
    task that runs again changes the survivor.

    The rank filter is applied before the shuffle too, so a repeated key sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(seq).asc_nulls_last(), F.xxhash64(*[f"`{c}`" for c in df.columns]))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def consistency_flags(df: DataFrame) -> DataFrame:
    """Flags of impossible time orders; a missing time is never a violation."""
    return df.withColumns(
        {
            "_flag_encerrado_antes_aberto": F.coalesce(
                F.col("encerrado") < F.col("aberto"), F.lit(False)
            ),
            "_flag_resolvido_apos_encerrado": F.coalesce(
                F.col("resolvido") > F.col("encerrado"), F.lit(False)
            ),
        }
    )


def upper_cap(df: DataFrame, value: str, quantile: float = 0.99) -> DataFrame:
    """One row: the exact quantile used as the cap."""
    return exact_quantiles(df, [], value, {"cap": quantile}).select("cap")


def capped(df: DataFrame, value: str, out: str, quantile: float = 0.99) -> DataFrame:
    """Cap a column at its quantile; null stays null."""
    return df.withColumn(out, _at_most(value, upper_cap(df, value, quantile).scalar()))


def _at_most(value: str, cap: Column) -> Column:
    return F.when(F.col(value) > cap, cap).otherwise(F.col(value).cast("double"))


def cap_report(df: DataFrame, value: str, quantile: float = 0.99) -> DataFrame:
    """(cap, n_above, pct_above): what a cap changes, as a share of all rows with the null ones."""
    cap = upper_cap(df, value, quantile).scalar()
    marked = df.select(value).withColumn("_cap", cap)
    return marked.agg(
        F.max("_cap").alias("cap"),
        F.count_if(F.col(value) > F.col("_cap")).alias("n_above"),
        F.count(F.lit(1)).alias("_n"),
    ).select(
        "cap",
        "n_above",
        F.when(F.col("_n") > 0, 100.0 * F.col("n_above") / F.col("_n")).otherwise(0.0).alias("pct_above"),
    )


def log_duration(value: str) -> Column:
    """log(1 + x) with negative values taken as 0; null stays null."""
    return F.log1p(F.when(F.col(value) < 0, 0.0).otherwise(F.col(value).cast("double")))


def bronze(raw: DataFrame, contract: list[str], text_times: bool = False) -> DataFrame:
    """Contract check and minimal typing: nothing else happens here."""
    require_columns(raw, contract)
    typed = coerce_timestamps(raw, TIME_COLUMNS) if text_times else raw
    require_types(typed, TICKET_TYPES)
    return typed


def silver_columns(clean: DataFrame, cap: Column) -> DataFrame:
    """Flags, duration capped at ``cap``, its logarithm, clean text and coverage."""
    return consistency_flags(clean).withColumns(
        {
            "duracao_capped_p99": _at_most("duracao", cap),
            "duracao_log": log_duration("duracao"),
            "descricao_limpa": clean_text(F.col("descricao_resumida")),
            "flag_categorizado": F.col("produto").isNotNull(),
        }
    )


def silver(df: DataFrame, *, year: int, seq: str = "aberto") -> DataFrame:
    """One row per ticket of one year (its earliest), with flags, capped duration, clean text and coverage."""
    clean = first_per_key(df.where(in_year("aberto", year)), keys=["numero"], seq=seq)
    return silver_columns(clean, upper_cap(clean, "duracao").scalar())


def gold_daily(tickets: DataFrame) -> DataFrame:
    """Gap-filled daily volume with calendar, lags 1..7 and the mean of the seven days before."""
    days = daily_counts(
        tickets, time="aberto", measures={"p2_p3": F.col("prioridade").isin(P2_P3)}
    ).select(
        "data",
        F.col("total").alias("qtde_chamados_total"),
        F.col("p2_p3").alias("qtde_chamados_p2_p3"),
        *day_calendar("data"),
    )
    return days.select(
        "*",
        *lags("qtde_chamados_total", [], "data", 7, "volume_lag"),
        mean_of_previous("qtde_chamados_total", [], "data", 7).alias("media_movel_7d_ate_ontem"),
    )


def gold_weekly(tickets: DataFrame) -> DataFrame:
    """Week x priority x category x product counts, weekly coverage and weekly median duration."""
    labelled = tickets.select(
        week_of_wednesday(F.col("aberto")).alias("semana"),
        "numero",
        "prioridade",
        "duracao",
        F.col("produto").isNotNull().alias("flag_categorizado"),
        F.coalesce("categoria", F.lit(UNCATEGORISED)).alias("categoria_rotulada"),
        F.coalesce("produto", F.lit(UNCATEGORISED)).alias("produto_rotulado"),
    ).where(F.col("semana").isNotNull())
    cells = (
        labelled.where(F.col("prioridade").isNotNull())
        .groupBy("semana", "prioridade", "categoria_rotulada", "produto_rotulado")
        .agg(
            F.count("numero").alias("qtde_chamados"),
        )
    )
    coverage = labelled.groupBy("semana").agg(
        F.avg(F.col("flag_categorizado").cast("int")).alias("pct_categorizado")
    )
    medians = exact_quantiles(
        labelled.where(F.col("prioridade").isNotNull()),
        ["semana", "prioridade"],
        "duracao",
        {"duracao_mediana_semana": 0.5},
    ).drop("n")
    # One row per week.
    return cells.join(F.broadcast(coverage), "semana", "left").join(medians, ["semana", "prioridade"], "left")


def queue_pressure(tickets: DataFrame) -> DataFrame:
    """Ticket -> mean daily volume of the seven days before its opening day."""
    pressure = gold_daily(tickets).select(
        "data", F.col("media_movel_7d_ate_ontem").alias("pressao_fila_7d")
    )
    # One row per calendar day, so every task can hold it and the tickets are not shuffled.
    return (
        tickets.withColumn("data", F.to_date("aberto"))
        .join(F.broadcast(pressure), "data", "left")
        .select(*tickets.columns, "pressao_fila_7d")
    )


def ticket_history(
    tickets: DataFrame, text: str = "descricao_limpa", wanted: Column | None = None
) -> DataFrame:
    """(numero, causal features): every feature runs on three columns and meets the others by number.

    The wide ticket rows stay out of the ordered shuffles. Every ticket is history; with ``wanted`` only the rows for
    which it holds come back, so that the others are not shuffled to meet by number.
    """
    order = {"time": "aberto", "tiebreak": "numero"}
    cuts = find_cuts(tickets, ["aberto", "numero"])
    marks = [] if wanted is None else [wanted.alias("_wanted")]

    def narrow(key: str) -> DataFrame:
        return tickets.select("numero", "aberto", key, *marks)

    def returned(found: DataFrame, *columns: str) -> DataFrame:
        return (found if wanted is None else found.where("_wanted")).select("numero", *columns)

    item = causal.count_and_gap(
        narrow("item_configuracao"),
        key="item_configuracao",
        count_out="ic_contagem_historica",
        hours_out="ic_horas_desde_ultimo_chamado",
        cuts=cuts,
        **order,
    )
    frames = [returned(item, "ic_contagem_historica", "ic_horas_desde_ultimo_chamado")]
    for key, out in (
        ("grupo_designado", "grupo_contagem_historica"),
        (text, "descricao_contagem_historica"),
        ("incidente_pai", "incidente_pai_contagem_historica"),
    ):
        found = causal.prior_count(narrow(key), key=key, out=out, cuts=cuts, **order)
        frames.append(returned(found, out))
    load = causal.rolling_prior_count(
        narrow("grupo_designado"),
        key="grupo_designado",
        time="aberto",
        out="grupo_chamados_ultima_hora",
        cuts=cuts,
    )
    frames.append(returned(load, "grupo_chamados_ultima_hora"))
    history = frames[0]
    for frame in frames[1:]:
        history = history.join(frame, "numero")
    return history


def gold_risk(silver_tickets: DataFrame, minimum: int = 100, wanted: Column | None = None) -> DataFrame:
    """Ticket-grain table of what is known at opening time, with the target columns.

    ``wanted`` names the rows to return; history, volumes and group sizes still come from all tickets.
    """
    base = silver_tickets.withColumn("data", F.to_date("aberto")).select(
        "*",
        *hour_calendar("aberto"),
        token_count(F.col("descricao_limpa")).alias("descricao_n_tokens"),
        F.col("incidente_pai").isNotNull().cast("int").alias("tem_incidente_pai"),
    )
    # Day columns are worked out once per day and joined; the daily table covers every ticket's day.
    days = gold_daily(silver_tickets).select(
        "data", *DAY_COLUMNS, F.col("media_movel_7d_ate_ontem").alias("pressao_fila_7d")
    )
    flagged = causal.low_volume_flag(
        base, group="grupo_designado", out="grupo_baixo_volume", minimum=minimum
    )
    if wanted is not None:
        flagged = flagged.where(wanted)
    return (
        flagged.join(ticket_history(silver_tickets, wanted=wanted), "numero", "left")
        .join(F.broadcast(days), "data", "left")
        .select(*RISK_COLUMNS)
    )
