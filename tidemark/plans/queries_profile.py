"""Descriptive tables, samples, scalar functions and association statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.calendar import (
    future_days,
    holiday_flags,
    sunday_week_label,
    ticket_calendar,
    week_of_wednesday,
)
from tidemark.functions.text import clean_text, token_count
from tidemark.operators import association, profile, series
from tidemark.operators.ordering import midranks
from tidemark.plans import medallion
from tidemark.plans.queries_layers import (
    HOLIDAYS_SQL,
    _sql_cyclic,
    _sql_holidays,
    sql_clean_text,
)
from tidemark.plans.registry import query, rounded, sql_chi2_tail, with_tickets
from tidemark.sources.tables import table, tickets

_ELIGIBLE = (
    "e AS (SELECT *, CASE WHEN kpi_violado = 'SIM' THEN 1 ELSE 0 END AS target "
    "FROM tickets WHERE entrou_kpi = 'SIM')"
)
_TEAM_RATE = (
    "SELECT grupo_designado, count(*) AS n, CAST(sum(target) AS BIGINT) AS n_positive, "
    "round_even(100.0 * sum(target) / count(*), 2)::DOUBLE AS rate_pct FROM e "
    "WHERE grupo_designado IS NOT NULL GROUP BY 1"
)


def _eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.eligible(tickets(spark, sf_dir))


# --- aggregates ----------------------------------------------------------------------------------


@query(
    "group_counts",
    with_tickets(
        """SELECT grupo_designado, CAST(year(aberto) AS INTEGER) AS ano, CAST(hour(aberto) AS INTEGER) AS hora,
        CAST(isodow(aberto) - 1 AS INTEGER) AS dia_semana, count(*) AS n
        FROM tickets WHERE grupo_designado IS NOT NULL GROUP BY ALL"""
    ),
)
def group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tickets(spark, sf_dir).select(
        "grupo_designado",
        F.year("aberto").alias("ano"),
        F.hour("aberto").alias("hora"),
        F.weekday("aberto").alias("dia_semana"),
    )
    return profile.group_counts(rows, rows.columns)


@query("violation_rate", with_tickets(f"{_ELIGIBLE} {_TEAM_RATE}"))
def violation_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.rate_by(_eligible(spark, sf_dir), ["grupo_designado"], "target")


@query(
    "duration_ref",
    with_tickets(
        """SELECT status, prioridade, round_even(quantile_cont(duracao, 0.5), 1)::DOUBLE AS mediana,
        round_even(avg(duracao), 1)::DOUBLE AS media, round_even(quantile_cont(duracao, 0.9), 1)::DOUBLE AS p90,
        count(duracao) AS n FROM tickets GROUP BY 1, 2"""
    ),
)
def duration_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.duration_reference(tickets(spark, sf_dir), "duracao", ["status", "prioridade"])


@query(
    "crosstab",
    with_tickets(
        "SELECT grupo_designado, status, count(*) AS n FROM tickets WHERE grupo_designado IS NOT NULL GROUP BY 1, 2"
    ),
)
def crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.crosstab(tickets(spark, sf_dir), "grupo_designado", "status")


@query(
    "crosstab_margins",
    with_tickets(
        """SELECT coalesce(produto, 'All') AS produto, coalesce(status, 'All') AS status, count(*) AS n
        FROM tickets WHERE produto IS NOT NULL GROUP BY CUBE (produto, status)"""
    ),
)
def crosstab_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.crosstab_margins(tickets(spark, sf_dir), "produto", "status")


@query(
    "crosstab_rowpct",
    with_tickets(
        """SELECT aberto_por, status, count(*) AS n,
        round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY aberto_por), 6)::DOUBLE AS pct
        FROM tickets GROUP BY 1, 2"""
    ),
)
def crosstab_rowpct(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = profile.crosstab_row_share(tickets(spark, sf_dir), "aberto_por", "status")
    return cells.withColumn("pct", rounded("pct"))


_PRIORITIES = ["1 - Crítica", "2 - Alta", "3 - Média", "4 - Baixa", "5 - Muito Baixa"]


@query(
    "pivot_rate",
    with_tickets(
        f"""{_ELIGIBLE} SELECT grupo_designado, {", ".join(
            f"round(avg(target) FILTER (prioridade = '{p}'), 6) AS p{p[0]}" for p in _PRIORITIES)}
        FROM e WHERE grupo_designado IS NOT NULL GROUP BY 1"""
    ),
)
def pivot_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = profile.pivot_mean(
        _eligible(spark, sf_dir), "grupo_designado", "prioridade", _PRIORITIES, "target"
    )
    return wide.select("grupo_designado", *[rounded(F.col(f"`{p}`")).alias(f"p{p[0]}") for p in _PRIORITIES])


@query(
    "calendar_heatmap",
    f"""WITH c AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1),
    s AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM c),
    f AS (SELECT d, coalesce(n, 0) AS n FROM s LEFT JOIN c USING (d))
    SELECT CAST(isodow(d) - 1 AS INTEGER) AS dia_semana, {", ".join(
        f"round(coalesce(avg(n) FILTER (weekofyear(d) = {w}), 0), 6) AS semana_{w:02d}" for w in range(1, 54))}
    FROM f GROUP BY 1""",
)
def calendar_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = series.daily_counts(table(spark, sf_dir, "orders"), time="o_orderdate")
    wide = profile.calendar_matrix(daily, "data", "total")
    return wide.select("dia_semana", *[rounded(c).alias(c) for c in wide.columns[1:]])


@query(
    "pareto",
    with_tickets(
        """c AS (SELECT item_configuracao, count(*) AS n FROM tickets GROUP BY 1),
        r AS (SELECT *, sum(n) OVER (ORDER BY n DESC, item_configuracao) AS acc, sum(n) OVER () AS total,
          row_number() OVER (ORDER BY n DESC, item_configuracao) AS pos FROM c)
        SELECT item_configuracao, n, round(100.0 * n / total, 6)::DOUBLE AS pct,
          round(100.0 * acc / total, 6)::DOUBLE AS cum_pct FROM r WHERE pos <= 20"""
    ),
)
def pareto(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.pareto(tickets(spark, sf_dir), "item_configuracao", 20)
    return found.withColumns({"pct": rounded("pct"), "cum_pct": rounded("cum_pct")})


@query(
    "cardinality",
    with_tickets(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count({c}) AS n_filled, count(DISTINCT {c}) AS n_distinct,
            round(count(DISTINCT {c}) / count({c}), 6) AS uniqueness FROM tickets"""
            for c in ("item_configuracao", "grupo_designado", "produto", "descricao_resumida")
        )
    ),
)
def cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.cardinality(
        tickets(spark, sf_dir), ["item_configuracao", "grupo_designado", "produto", "descricao_resumida"]
    )
    return found.withColumn("uniqueness", rounded("uniqueness"))


@query(
    "dup_counts",
    """SELECT 'row' AS scope, count(*) AS n_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT
      l_orderkey, l_partkey, l_quantity FROM lineitem)) AS n_repeated FROM lineitem
    UNION ALL SELECT 'key', count(*), count(*) - count(DISTINCT l_orderkey) FROM lineitem""",
)
def dup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return profile.duplicate_counts(items, {"row": items.columns, "key": ["l_orderkey"]})


_PROBS = {"p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}


@query(
    "duration_quantiles",
    with_tickets(
        f"""SELECT status, count(duracao) AS n, round(avg(duracao), 4) AS mean, round(stddev_samp(duracao), 4)
        AS std, min(duracao) AS min, max(duracao) AS max, {", ".join(
            f"round(quantile_cont(duracao, {p}), 6)::DOUBLE AS {name}" for name, p in _PROBS.items())}
        FROM tickets GROUP BY 1"""
    ),
)
def duration_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.describe(tickets(spark, sf_dir), "duracao", ["status"], _PROBS)
    return found.select(
        "status",
        "n",
        rounded("mean", 4).alias("mean"),
        rounded("std", 4).alias("std"),
        "min",
        "max",
        *[rounded(p).alias(p) for p in _PROBS],
    )


@query(
    "weekly_positives",
    with_tickets(
        f"""{_ELIGIBLE}, w AS (SELECT strftime(aberto, '%Y-W%U') AS week, count(*) AS n FROM e
          WHERE target = 1 GROUP BY 1)
        SELECT week, n, (SELECT quantile_cont(n, 0.5) FROM w)::DOUBLE AS median_n FROM w"""
    ),
)
def weekly_positives(spark: SparkSession, sf_dir: str) -> DataFrame:
    weeks = profile.weekly_positives(_eligible(spark, sf_dir), "aberto", "target")
    return weeks.withColumn("median_n", weeks.agg(F.percentile("n", F.lit(0.5))).scalar())


@query(
    "dispersion_index",
    with_tickets(
        f"""{_ELIGIBLE}, s AS (SELECT CAST(unnest(generate_series(min(CAST(aberto AS DATE)), max(CAST(aberto AS DATE)),
          INTERVAL 1 DAY)) AS DATE) AS d FROM e),
        c AS (SELECT d, count(numero) AS y FROM s LEFT JOIN e ON CAST(aberto AS DATE) = d AND target = 1 GROUP BY 1)
        SELECT count(*) AS n_days, round(avg(y), 6) AS mean, round(var_samp(y), 6) AS variance,
          round(var_samp(y) / avg(y), 6) AS dispersion FROM c"""
    ),
)
def dispersion_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.dispersion_index(_eligible(spark, sf_dir), "aberto", "target")
    return found.select("n_days", *[rounded(c).alias(c) for c in ("mean", "variance", "dispersion")])


@query(
    "weekend_ratio",
    with_tickets(
        f"""{_ELIGIBLE}, r AS (SELECT avg(target) FILTER (isodow(aberto) < 6) AS a,
          avg(target) FILTER (isodow(aberto) >= 6) AS b FROM e)
        SELECT round(100.0 * a, 6) AS weekday_pct, round(100.0 * b, 6) AS weekend_pct, round(b / a, 6) AS ratio FROM r"""
    ),
)
def weekend_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.weekend_ratio(_eligible(spark, sf_dir), "aberto", "target")
    return found.select(*[rounded(c).alias(c) for c in found.columns])


@query(
    "top_group_rate",
    with_tickets(f"{_ELIGIBLE}, r AS ({_TEAM_RATE}) SELECT * FROM r ORDER BY n DESC, grupo_designado LIMIT 10"),
)
def top_group_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.rate_of_top_groups(_eligible(spark, sf_dir), "grupo_designado", "target", 10)


@query(
    "mode_value",
    with_tickets(
        """c AS (SELECT prioridade, grupo_designado AS v, count(*) AS n FROM tickets
          WHERE grupo_designado IS NOT NULL GROUP BY 1, 2)
        SELECT prioridade, v AS mode, n FROM c QUALIFY row_number() OVER (PARTITION BY prioridade ORDER BY n DESC, v) = 1"""
    ),
)
def mode_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.mode_by(tickets(spark, sf_dir), ["prioridade"], "grupo_designado")


@query(
    "topn_bucket",
    with_tickets(
        """c AS (SELECT grupo_designado AS g, count(*) AS n FROM tickets WHERE grupo_designado IS NOT NULL
          GROUP BY 1 ORDER BY n DESC, g LIMIT 8)
        SELECT coalesce(g, 'Outro') AS grupo, count(*) AS n FROM tickets LEFT JOIN c ON g = grupo_designado GROUP BY 1"""
    ),
)
def topn_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profile.bucket_top(tickets(spark, sf_dir), "grupo_designado", 8, "grupo")
    return profile.group_counts(rows, ["grupo"])


# --- sorts, samples, sets ------------------------------------------------------------------------


@query(
    "topk",
    with_tickets(
        """(SELECT 'head' AS side, numero, duracao FROM tickets ORDER BY duracao DESC, numero LIMIT 15)
        UNION ALL (SELECT 'tail', numero, duracao FROM tickets ORDER BY duracao, numero LIMIT 10)"""
    ).replace("), (SELECT 'head'", ") (SELECT 'head'", 1),
)
def topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tickets(spark, sf_dir).select("numero", "duracao")
    head = rows.orderBy(F.desc("duracao"), "numero").limit(15).withColumn("side", F.lit("head"))
    tail = rows.orderBy("duracao", "numero").limit(10).withColumn("side", F.lit("tail"))
    return head.unionByName(tail)


@query(
    "hash_sample",
    with_tickets("SELECT numero, prioridade FROM tickets ORDER BY md5(concat_ws('#', '42', numero)), numero LIMIT 5000"),
)
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.sample_rows(tickets(spark, sf_dir).select("numero", "prioridade"), "numero", 5000, 42)


@query(
    "missing_days",
    """WITH d AS (SELECT DISTINCT o_orderpriority, CAST(o_orderdate AS DATE) AS d FROM orders),
    s AS (SELECT o_orderpriority, CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS data
      FROM d GROUP BY 1)
    SELECT o_orderpriority, data FROM s WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.d = s.data
      AND d.o_orderpriority = s.o_orderpriority)""",
)
def missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = (
        table(spark, sf_dir, "orders")
        .select("o_orderpriority", F.to_date("o_orderdate").alias("data"))
        .distinct()
    )
    return series.missing_days(days, keys=["o_orderpriority"], day="data")


# --- scalar functions ----------------------------------------------------------------------------


@query("clean_text", f"SELECT doc_id, {sql_clean_text('text')} AS texto FROM documents")
def clean_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", clean_text(F.col("text")).alias("texto"))


@query(
    "token_count",
    r"""SELECT doc_id, CAST(len(regexp_extract_all(text, '\S+')) AS INTEGER) AS n_tokens FROM documents""",
)
def token_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", token_count(F.col("text")).alias("n_tokens"))


@query(
    "text_length_stats",
    """SELECT lang, count(*) AS n, round(avg(length(text)), 4) AS mean, round(stddev_samp(length(text)), 4) AS std,
    CAST(min(length(text)) AS INTEGER) AS min, CAST(max(length(text)) AS INTEGER) AS max,
    quantile_cont(length(text), 0.5)::DOUBLE AS p50, round(quantile_cont(length(text), 0.9), 6)::DOUBLE AS p90
    FROM documents GROUP BY 1""",
)
def text_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = table(spark, sf_dir, "documents").select("lang", F.length("text").alias("chars"))
    found = profile.describe(lengths, "chars", ["lang"], {"p50": 0.5, "p90": 0.9})
    return found.select(
        "lang",
        "n",
        rounded("mean", 4).alias("mean"),
        rounded("std", 4).alias("std"),
        "min",
        "max",
        "p50",
        rounded("p90").alias("p90"),
    )


@query(
    "text_templates",
    with_tickets(
        """c AS (SELECT descricao_resumida, count(*) AS n FROM tickets GROUP BY 1)
        SELECT descricao_resumida, n, round(100.0 * n / (SELECT sum(n) FROM c), 6)::DOUBLE AS pct,
          round(100.0 * (SELECT count(*) FROM c) / (SELECT sum(n) FROM c), 6)::DOUBLE AS uniqueness_pct
        FROM c ORDER BY n DESC, descricao_resumida LIMIT 15"""
    ),
)
def text_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tickets(spark, sf_dir)
    spread = profile.cardinality(rows, ["descricao_resumida"]).select(100.0 * F.col("uniqueness"))
    return profile.pareto(rows, "descricao_resumida", 15).select(
        "descricao_resumida",
        "n",
        rounded("pct").alias("pct"),
        rounded(spread.scalar()).alias("uniqueness_pct"),
    )


@query(
    "calendar_features",
    with_tickets(
        f"""{HOLIDAYS_SQL} SELECT numero, CAST(hour(aberto) AS INTEGER) AS hora_abertura,
        CAST(isodow(aberto) - 1 AS INTEGER) AS dia_semana, CAST(isodow(aberto) >= 6 AS INTEGER) AS fim_de_semana,
        {_sql_cyclic("hour(aberto)", 24, "hora")}, {_sql_cyclic("isodow(aberto) - 1", 7, "dow")},
        CASE WHEN hour(aberto) < 6 THEN 'madrugada' WHEN hour(aberto) < 18 THEN 'comercial' ELSE 'noite' END
          AS turno_abertura, CAST(hour(aberto) NOT BETWEEN 6 AND 17 AS INTEGER) AS fora_horario_comercial,
        {_sql_holidays("CAST(aberto AS DATE)")} FROM tickets"""
    ),
)
def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tickets(spark, sf_dir).select("numero", *ticket_calendar("aberto"))
    return rows.withColumns({c: rounded(c) for c in ("hora_sin", "hora_cos", "dow_sin", "dow_cos")})


@query(
    "holiday_flags",
    f"""WITH {HOLIDAYS_SQL}, d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS data FROM orders)
    SELECT data, {_sql_holidays("data")} FROM d""",
)
def holiday_flags_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("data")).distinct()
    return days.select("data", *holiday_flags(F.col("data")))


@query(
    "cyclical",
    f"""SELECT event_id, {_sql_cyclic("hour(ts)", 24, "hora")}, {_sql_cyclic("month(ts)", 12, "mes")} FROM events""",
)
def cyclical(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.functions.calendar import cyclic

    events = table(spark, sf_dir, "events")
    rows = events.select("event_id", *cyclic(F.hour("ts"), 24, "hora"), *cyclic(F.month("ts"), 12, "mes"))
    return rows.select("event_id", *[rounded(c).alias(c) for c in rows.columns[1:]])


@query(
    "week_wed",
    """SELECT o_orderkey, CAST(date_trunc('week', CAST(o_orderdate AS DATE) - INTERVAL 2 DAY) + INTERVAL 2 DAY AS DATE)
    AS semana, strftime(o_orderdate, '%Y-W%U') AS semana_domingo FROM orders""",
)
def week_wed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        week_of_wednesday(F.col("o_orderdate")).alias("semana"),
        sunday_week_label(F.to_date("o_orderdate")).alias("semana_domingo"),
    )


@query(
    "log_duration",
    with_tickets("SELECT numero, round(ln(1 + greatest(duracao - 3600, 0)), 6) AS duracao_log FROM tickets"),
)
def log_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tickets(spark, sf_dir).select("numero", (F.col("duracao") - 3600).alias("d"))
    return rows.select("numero", rounded(medallion.log_duration("d")).alias("duracao_log"))


@query(
    "cap_p99",
    with_tickets(
        """SELECT numero, round(least(duracao::DOUBLE, (SELECT quantile_cont(duracao, 0.99) FROM tickets)), 6)::DOUBLE
        AS duracao_capped_p99 FROM tickets"""
    ),
)
def cap_p99(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.capped(tickets(spark, sf_dir), "duracao", "c").select(
        "numero", rounded("c").alias("duracao_capped_p99")
    )


@query(
    "cap_report",
    with_tickets(
        """t AS (SELECT CASE WHEN numero % 13 <> 0 THEN duracao END AS d FROM tickets),
        c AS (SELECT quantile_cont(d, 0.99) AS cap FROM t)
        SELECT round(any_value(cap), 6)::DOUBLE AS cap, count(*) FILTER (d > cap) AS n_above,
          round(100.0 * count(*) FILTER (d > cap) / count(*), 6)::DOUBLE AS pct_above FROM t, c"""
    ),
)
def cap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tickets(spark, sf_dir).selectExpr("CASE WHEN numero % 13 <> 0 THEN duracao END AS d")
    return medallion.cap_report(rows, "d").select(
        rounded("cap").alias("cap"), "n_above", rounded("pct_above").alias("pct_above")
    )


@query(
    "duration_check",
    with_tickets(
        """SELECT count(*) AS n, count(*) FILTER (date_diff('second', aberto, encerrado) <> duracao) AS n_other,
        round(avg(date_diff('microsecond', aberto, encerrado) / 6e7), 6) AS mean_minutes,
        round(max(date_diff('microsecond', aberto, encerrado) / 3.6e9), 6) AS max_hours FROM tickets"""
    ),
)
def duration_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros = F.unix_micros(F.col("encerrado").cast("timestamp")) - F.unix_micros(
        F.col("aberto").cast("timestamp")
    )
    rows = tickets(spark, sf_dir).select("duracao", micros.alias("d"))
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("d") != F.col("duracao") * 1_000_000).alias("n_other"),
        rounded(F.avg(F.col("d") / 6e7)).alias("mean_minutes"),
        rounded(F.max(F.col("d") / 3.6e9)).alias("max_hours"),
    )


@query(
    "date_spine",
    """WITH e AS (SELECT o_orderpriority, min(CAST(o_orderdate AS DATE)) - 1 AS a, max(CAST(o_orderdate AS DATE)) + 7 AS b
      FROM orders GROUP BY 1)
    SELECT o_orderpriority, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS data FROM e""",
)
def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderpriority")
        .agg(
            F.date_sub(F.min(F.to_date("o_orderdate")), 1).alias("a"),
            F.date_add(F.max(F.to_date("o_orderdate")), 7).alias("b"),
        )
    )
    return ends.select("o_orderpriority", F.explode(F.sequence("a", "b")).alias("data"))


@query(
    "future_exog",
    f"""WITH {HOLIDAYS_SQL}, s AS (SELECT max(CAST(o_orderdate AS DATE)) + 1 AS a FROM orders),
    d AS (SELECT CAST(unnest(generate_series(a, a + INTERVAL 89 DAY, INTERVAL 1 DAY)) AS DATE) AS data FROM s)
    SELECT data, CAST(isodow(data) >= 6 AS INTEGER) AS fim_de_semana, {_sql_holidays("data")},
      {_sql_cyclic("isodow(data) - 1", 7, "dow")} FROM d""",
)
def future_exog(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = table(spark, sf_dir, "orders").agg(F.max(F.to_date("o_orderdate"))).first()[0]
    days = future_days(spark, str(last), 91).where(F.col("data") > F.lit(last))
    return days.select(
        "data",
        "fim_de_semana",
        "feriado",
        "vespera_feriado",
        "dia_seguinte_feriado",
        rounded("dow_sin").alias("dow_sin"),
        rounded("dow_cos").alias("dow_cos"),
    )


# --- association ---------------------------------------------------------------------------------


def _sql_chi2(counts: str, keys: str = "") -> str:
    """Chi-square over the full grid, cell by cell, with the 2x2 correction."""
    by = f"PARTITION BY {keys}" if keys else ""
    k = f"{keys}, " if keys else ""
    using = f"USING ({keys})" if keys else "ON true"
    return f"""c AS ({counts}), ra AS (SELECT {k}a, sum(n) AS r FROM c GROUP BY {k}a),
      cb AS (SELECT {k}b, sum(n) AS s FROM c GROUP BY {k}b),
      grid AS (SELECT {k}a, b, r, s, sum(r) OVER (PARTITION BY {k}b) AS total,
        count(*) OVER (PARTITION BY {k}b) AS n_a, count(*) OVER (PARTITION BY {k}a) AS n_b
        FROM ra JOIN cb {using}),
      cells AS (SELECT {k}r, s, total, n_a, n_b, coalesce(n, 0) AS o, r * s / total AS e
        FROM grid LEFT JOIN c USING ({k}a, b)),
      chi AS (SELECT {k}CAST(any_value(total) AS BIGINT) AS n, any_value(n_a) AS n_a, any_value(n_b) AS n_b,
        sum(CASE WHEN n_a = 2 AND n_b = 2 THEN pow(abs(o - e) - least(0.5, abs(o - e)), 2) ELSE pow(o - e, 2) END / e) AS chi2
        FROM cells {f"GROUP BY {keys}" if keys else ""})"""


@query(
    "chi2_missingness",
    with_tickets(
        _sql_chi2("SELECT aberto_por AS a, categoria IS NULL AS b, count(*) AS n FROM tickets GROUP BY 1, 2")
        + " SELECT n, n_a, n_b, (n_a - 1) * (n_b - 1) AS dof, round(chi2, 4) AS chi2, "
        + sql_chi2_tail("chi2", "((n_a - 1) * (n_b - 1))") + " AS p_value FROM chi"
    ),
)
def chi2_missingness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return association.missingness_test(tickets(spark, sf_dir), "aberto_por", "categoria").withColumns(
        {"chi2": rounded("chi2", 4), "p_value": rounded("p_value")}
    )


def _sql_pairs(source: str, pairs: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{a}' AS x, '{b}' AS y, CAST({a} AS VARCHAR) AS a, CAST({b} AS VARCHAR) AS b, count(*) AS n
        FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL"""
        for a, b in pairs
    )


_SQL_V = """SELECT x AS column_a, y AS column_b, n, CASE WHEN least(n_a - (n_a - 1)^2 / (n - 1),
  n_b - (n_b - 1)^2 / (n - 1)) > 1 THEN round(sqrt(greatest(0, chi2 / n - (n_a - 1) * (n_b - 1) / (n - 1)) /
  (least(n_a - (n_a - 1)^2 / (n - 1), n_b - (n_b - 1)^2 / (n - 1)) - 1)), 6) END AS v FROM chi"""

_TARGET_PAIRS = [
    ("prioridade", "target"),
    ("grupo_designado", "target"),
    ("produto", "target"),
    ("descricao_resumida", "prioridade"),
    ("descricao_resumida", "grupo_designado"),
]


@query(
    "cramers_v",
    with_tickets(f"{_ELIGIBLE}, {_sql_chi2(_sql_pairs('e', _TARGET_PAIRS), 'x, y')} {_SQL_V}"),
)
def cramers_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = association.cramers_v(_eligible(spark, sf_dir), _TARGET_PAIRS)
    return found.select("column_a", "column_b", "n", rounded("v").alias("v"))


_MATRIX = ["prioridade", "status", "aberto_por", "grupo_designado", "produto"]
_MATRIX_PAIRS = [(a, b) for i, a in enumerate(_MATRIX) for b in _MATRIX[i + 1 :]]


@query(
    "cramers_v_matrix",
    with_tickets(
        f"""{_sql_chi2(_sql_pairs("tickets", _MATRIX_PAIRS), "x, y")}, v AS ({_SQL_V})
        SELECT column_a, column_b, v FROM v UNION ALL SELECT column_b, column_a, v FROM v
        UNION ALL SELECT c, c, CAST(1 AS DOUBLE) FROM (VALUES {", ".join(f"('{c}')" for c in _MATRIX)}) AS m(c)"""
    ),
)
def cramers_v_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return association.cramers_v_matrix(tickets(spark, sf_dir), _MATRIX).withColumn("v", rounded("v"))


@query(
    "kruskal_wallis",
    with_tickets(
        f"""t AS (SELECT CASE WHEN numero % 11 <> 0 THEN duracao END AS v, prioridade AS g FROM tickets),
        r AS (SELECT g, v, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2 AS rk,
          count(*) OVER (PARTITION BY v) AS c FROM t WHERE v IS NOT NULL),
        s AS (SELECT g, sum(rk) AS sr, count(*) AS m FROM r GROUP BY 1),
        k AS (SELECT count(*)::DOUBLE AS n, sum(c * c - 1)::DOUBLE AS ties FROM r),
        x AS (SELECT CAST(any_value(n) AS BIGINT) AS n, count(*) AS n_groups, (SELECT count(*) FROM t WHERE v IS NULL) AS n_excluded,
          (12 / (any_value(n) * (any_value(n) + 1)) * sum(sr * sr / m) - 3 * (any_value(n) + 1)) /
            (1 - any_value(ties) / (any_value(n)^3 - any_value(n))) AS h FROM s, k)
        SELECT n, n_groups, n_excluded, round(h, 4) AS h, {sql_chi2_tail("h", "(n_groups - 1)")} AS p_value FROM x"""
    ),
)
def kruskal_wallis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tickets(spark, sf_dir).selectExpr(
        "CASE WHEN numero % 11 <> 0 THEN duracao END AS duracao", "prioridade"
    )
    return association.kruskal_wallis(rows, "duracao", "prioridade").withColumns(
        {"h": rounded("h", 4), "p_value": rounded("p_value")}
    )


@query(
    "spearman",
    with_tickets(
        f"""{_ELIGIBLE}, t AS (SELECT grupo_designado, count(*) AS n, avg(target) AS rate FROM e
          WHERE grupo_designado IS NOT NULL GROUP BY 1),
        r AS (SELECT rank() OVER (ORDER BY n) + (count(*) OVER (PARTITION BY n) - 1) / 2 AS a,
          rank() OVER (ORDER BY rate) + (count(*) OVER (PARTITION BY rate) - 1) / 2 AS b FROM t)
        SELECT count(*) AS n, round(corr(a, b), 6) AS rho FROM r"""
    ),
)
def spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    teams = (
        _eligible(spark, sf_dir)
        .where(F.col("grupo_designado").isNotNull())
        .groupBy("grupo_designado")
        .agg(F.count(F.lit(1)).alias("volume"), F.avg("target").alias("rate"))
    )
    return association.spearman(teams, "volume", "rate").withColumn("rho", rounded("rho"))


@query(
    "midrank",
    with_tickets(
        """SELECT numero, rank() OVER (PARTITION BY prioridade ORDER BY duracao) +
        (count(*) OVER (PARTITION BY prioridade, duracao) - 1) / 2 AS midrank FROM tickets"""
    ),
)
def midrank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tickets(spark, sf_dir).select("numero", "prioridade", "duracao")
    ranks = midranks(rows, ["prioridade"], "duracao").drop("n")
    return rows.join(ranks, ["prioridade", "duracao"]).select("numero", "midrank")


_NUMERIC = {
    "duracao": "duracao",
    "hora": "hour(aberto)",
    "fim_de_semana": "CASE WHEN {dow} >= 5 THEN 1 ELSE 0 END",
    "categorizado": "CASE WHEN produto IS NULL THEN 0 ELSE 1 END",
    "incidente": "CASE WHEN incidente_pai IS NULL THEN 0 ELSE 1 END",
    "resolucao": "CASE WHEN resolvido IS NOT NULL THEN duracao % 1000 END",
}


@query(
    "pearson_matrix",
    with_tickets(
        "f AS (SELECT "
        + ", ".join(f"{e.format(dow='isodow(aberto) - 1')} AS {c}" for c, e in _NUMERIC.items())
        + " FROM tickets) "
        + " UNION ALL ".join(
            f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS r FROM f"
            for i, a in enumerate(_NUMERIC)
            for b in list(_NUMERIC)[i + 1 :]
        )
    ),
)
def pearson_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tickets(spark, sf_dir).select(
        *[F.expr(e.format(dow="weekday(aberto)")).alias(c) for c, e in _NUMERIC.items()]
    )
    return association.pearson_pairs(rows, list(_NUMERIC)).withColumn("r", rounded("r"))


_NULLABLE = ["produto", "resolvido", "incidente_pai", "kpi_violado", "grupo_designado", "numero"]


@query(
    "nullity_corr",
    with_tickets(
        " UNION ALL ".join(
            f"""SELECT '{a}' AS column_a, '{b}' AS column_b,
            round(corr(CAST({a} IS NULL AS INTEGER), CAST({b} IS NULL AS INTEGER)), 6) AS r FROM tickets"""
            for i, a in enumerate(_NULLABLE[:-1])
            for b in _NULLABLE[i + 1 : -1]
        )
    ),
)
def nullity_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return association.nullity_pairs(tickets(spark, sf_dir), _NULLABLE).withColumn("r", rounded("r"))


_BY_STATUS = ["produto", "incidente_pai", "resolvido", "codigo_fechamento"]


@query(
    "null_by_status",
    with_tickets(
        " UNION ALL ".join(
            f"""SELECT status, '{c}' AS column_name, count(*) AS n,
            round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 6)::DOUBLE AS pct_null FROM tickets GROUP BY 1"""
            for c in _BY_STATUS
        )
    ),
)
def null_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_share_by(tickets(spark, sf_dir), "status", _BY_STATUS).withColumn(
        "pct_null", rounded("pct_null")
    )


_OUTLIER_COLUMNS = ["status", "prioridade", "aberto_por"]


@query(
    "outlier_profile",
    with_tickets(
        "o AS (SELECT * FROM tickets WHERE duracao > (SELECT quantile_cont(duracao, 0.99) FROM tickets)) "
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, {c} AS value, count(*) AS n,
            round(100.0 * count(*) / (SELECT count(*) FROM o), 6)::DOUBLE AS pct FROM o GROUP BY 2"""
            for c in _OUTLIER_COLUMNS
        )
    ),
)
def outlier_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tickets(spark, sf_dir)
    above = rows.where(F.col("duracao") > medallion.upper_cap(rows, "duracao").scalar())
    return profile.value_shares(above, _OUTLIER_COLUMNS).withColumn("pct", rounded("pct"))


@query(
    "regime_profile_compare",
    """WITH c AS (SELECT CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) // 300 AS VARCHAR) || o_orderpriority
        AS grupo, count(*) FILTER (o_orderdate < TIMESTAMP '1997-01-01') AS a,
        count(*) FILTER (o_orderdate >= TIMESTAMP '1997-01-01') AS b FROM orders GROUP BY 1)
    SELECT grupo, CASE WHEN a > 0 THEN round(100.0 * a / (SELECT sum(a) FROM c), 6)::DOUBLE END AS pct_first,
      CASE WHEN b > 0 THEN round(100.0 * b / (SELECT sum(b) FROM c), 6)::DOUBLE END AS pct_second FROM c""",
)
def regime_profile_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderdate",
        "concat(datediff(o_orderdate, DATE '1995-01-01') div 300, o_orderpriority) AS grupo",
    )
    cut = F.lit("1997-01-01").cast("timestamp_ntz")
    found = profile.compare_shares(rows, "grupo", F.col("o_orderdate") < cut, F.col("o_orderdate") >= cut)
    return found.select(
        "grupo", rounded("pct_first").alias("pct_first"), rounded("pct_second").alias("pct_second")
    )


@query(
    "histogram",
    with_tickets(
        """m AS (SELECT min(duracao)::DOUBLE AS lo, max(duracao)::DOUBLE AS hi FROM tickets),
        b AS (SELECT CAST(least(50, floor((duracao - lo) / (hi - lo) * 50) + 1) AS INTEGER) AS bin, lo, hi FROM tickets, m)
        SELECT bin, round(lo + (bin - 1) * (hi - lo) / 50, 4) AS lower, round(lo + bin * (hi - lo) / 50, 4) AS upper,
          count(*) AS n FROM b GROUP BY bin, lo, hi"""
    ),
)
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.histogram(tickets(spark, sf_dir), "duracao", 50)
    return found.withColumns({"lower": rounded("lower", 4), "upper": rounded("upper", 4)})


@query(
    "boxplot_stats",
    with_tickets(
        """q AS (SELECT prioridade, quantile_cont(duracao, 0.25) AS q1, quantile_cont(duracao, 0.5) AS median,
          quantile_cont(duracao, 0.75) AS q3 FROM tickets GROUP BY 1),
        t AS (SELECT *, duracao BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
          FROM tickets JOIN q USING (prioridade))
        SELECT prioridade, count(*) AS n, min(duracao) AS min, round(any_value(q1), 6)::DOUBLE AS q1,
          round(any_value(median), 6)::DOUBLE AS median, round(any_value(q3), 6)::DOUBLE AS q3, max(duracao) AS max,
          min(duracao) FILTER (inside) AS whisker_low, max(duracao) FILTER (inside) AS whisker_high,
          count(*) FILTER (NOT inside) AS n_outliers FROM t GROUP BY 1"""
    ),
)
def boxplot_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.boxplot_stats(tickets(spark, sf_dir), "duracao", ["prioridade"])
    return found.withColumns({c: rounded(c) for c in ("q1", "median", "q3")})
