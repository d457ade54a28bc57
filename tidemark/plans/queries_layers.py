"""Sources, sinks, contracts, filters, joins and the layer tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import STOPWORDS_PT
from tidemark.operators import causal, folds as fold_ops, history, profile
from tidemark.plans import medallion
from tidemark.plans.registry import query, rounded, with_tickets
from tidemark.session import work_folder
from tidemark.sources import contracts, layers
from tidemark.sources.tables import TICKET_COLUMNS, read_source, table, tickets

DOCUMENT_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
YEAR = 2024
MIN_GROUP = 500


def _sql_sha(columns: list[str]) -> str:
    cells = ", ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns)
    return f"sha256(concat({cells}))"


def _sql_fingerprint(hashes: str) -> str:
    words = ", ".join(
        f"coalesce(sum(CAST('0x' || substr(h, {1 + 15 * i}, 15) AS BIGINT)), 0)::VARCHAR AS w{i}" for i in range(4)
    )
    return f"""SELECT n, sha256(concat_ws('-', n, w0, w1, w2, w3)) AS fingerprint
        FROM (SELECT count(*) AS n, {words} FROM ({hashes}))"""


@query(
    "src_scan",
    f"""SELECT n AS n_rows, 5 AS n_columns, fingerprint FROM (
        {_sql_fingerprint("SELECT " + _sql_sha(["doc_id", "text", "lang", "source", "n_chars"]) + " AS h FROM documents")})""",
)
def src_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_source(spark, f"{sf_dir}/documents.parquet", schema=DOCUMENT_SCHEMA)
    return layers.content_fingerprint(docs).select(
        F.col("n").alias("n_rows"), F.lit(len(docs.columns)).alias("n_columns"), "fingerprint"
    )


_HASHED = ["numero", "prioridade", "produto", "grupo_designado", "duracao", "descricao_resumida"]


@query("row_hash", with_tickets(f"SELECT numero, {_sql_sha(_HASHED)} AS row_sha FROM tickets"))
def row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tickets(spark, sf_dir).select("numero", layers.row_sha(_HASHED).alias("row_sha"))


def _write_tickets(spark: SparkSession, sf_dir: str, layer: str, fingerprint: bool = True):
    raw = tickets(spark, sf_dir)
    sha = layers.content_fingerprint(raw.select(*_HASHED)).first()["fingerprint"] if fingerprint else None
    path = work_folder(spark, layer)
    written = layers.write_layer(raw, path, layer=layer, source_hash=sha)
    return path, written


@query(
    "layer_scan",
    with_tickets(
        f"SELECT count(*) AS n_rows, 2 AS n_meta, {len(TICKET_COLUMNS)} AS n_business FROM tickets"
    ),
)
def layer_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _write_tickets(spark, sf_dir, "bronze", fingerprint=False)
    return layers.layer_shape(layers.read_layer(spark, path))


@query(
    "layer_sink",
    with_tickets(
        f"""f AS ({_sql_fingerprint("SELECT " + _sql_sha(_HASHED) + " AS h FROM tickets")})
        SELECT numero, prioridade, duracao, 'bronze' AS _source_layer,
          (SELECT substr(fingerprint, 1, 16) FROM f) AS _source_hash FROM tickets"""
    ),
)
def layer_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _write_tickets(spark, sf_dir, "bronze")
    return layers.read_layer(spark, path).select(
        "numero", "prioridade", "duracao", "_source_layer", "_source_hash"
    )


@query(
    "sink_readback",
    with_tickets(
        """SELECT count(*) AS rows_written, count(*) AS rows_read, 0 AS missing_columns,
        count(DISTINCT year(aberto)) AS n_years, count(DISTINCT year(aberto)) = 1 AS ok FROM tickets"""
    ),
)
def sink_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, written = _write_tickets(spark, sf_dir, "silver", fingerprint=False)
    return layers.check_layer(
        spark, path, rows_written=written, contract=contracts.TICKET_CONTRACT, time="aberto"
    )


@query(
    "schema_contract",
    with_tickets(
        "c AS (SELECT * EXCLUDE (solucao), numero AS lote FROM tickets) "
        + " UNION ALL ".join(
            f"SELECT '{name}' AS column_name, "
            + (
                "'missing' AS status, CAST(0 AS BIGINT) AS n_filled"
                if name == "solucao"
                else f"'{'extra' if name == 'lote' else 'ok'}' AS status, count({name}) AS n_filled FROM c"
            )
            for name in [*TICKET_COLUMNS, "lote"]
        )
    ),
)
def schema_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tickets(spark, sf_dir).drop("solucao").withColumn("lote", F.col("numero"))
    return contracts.contract_status(raw, contracts.TICKET_CONTRACT)


_NARROWED = {
    **contracts.TICKET_DOMAINS,
    "prioridade": contracts.TICKET_DOMAINS["prioridade"][1:],
    "status": ["Sem Intervenção"],
    "aberto_por": ["Monitoramento"],
    "origem": ["nenhuma"],
}


@query(
    "domain_violations",
    with_tickets(
        """SELECT 'prioridade' AS column_name, prioridade AS value, count(*) AS n FROM tickets
        WHERE prioridade = '1 - Crítica' GROUP BY ALL
        UNION ALL SELECT 'status', status, count(*) FROM tickets
        WHERE status IN ('Encerrado', 'Encerrado Automaticamente') GROUP BY ALL
        UNION ALL SELECT 'aberto_por', aberto_por, count(*) FROM tickets
        WHERE aberto_por = 'Manual' GROUP BY ALL"""
    ),
)
def domain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.domain_violations(tickets(spark, sf_dir), _NARROWED)


@query(
    "typing_coerce",
    """SELECT 'aberto' AS column_name, count(*) AS n_raw, count(*) FILTER (event_id % 50 <> 0) AS n_typed,
      count(*) FILTER (event_id % 50 = 0) AS n_new_null FROM events
    UNION ALL SELECT 'encerrado', count(*) FILTER (event_id % 4 <> 0),
      count(*) FILTER (event_id % 4 <> 0 AND event_id % 70 <> 0),
      count(*) FILTER (event_id % 4 <> 0 AND event_id % 70 = 0) FROM events""",
)
def typing_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").selectExpr(
        "CASE WHEN event_id % 50 = 0 THEN 'n/d' ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS aberto",
        """CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 70 = 0 THEN '31/31/2024'
           ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS encerrado""",
    )
    return contracts.coercion_report(raw, ["aberto", "encerrado"], "yyyy-MM-dd HH:mm:ss")


@query(
    "row_delta_audit",
    """WITH n AS (SELECT count(*) AS a, count(*) FILTER (year(o_orderdate) = 1996) AS b,
        count(DISTINCT o_custkey) FILTER (year(o_orderdate) = 1996) AS c FROM orders)
    SELECT 'year_1996' AS step, a AS n_before, b AS n_after, b - a AS delta,
      round(100.0 * (b - a) / a, 6)::DOUBLE AS pct FROM n
    UNION ALL SELECT 'first_per_customer', b, c, c - b, round(100.0 * (c - b) / b, 6)::DOUBLE FROM n""",
)
def row_delta_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = contracts.RowAudit()
    orders = audit.watch(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), "source")
    year = audit.watch(orders.where(medallion.in_year("o_orderdate", 1996)), "year_1996")
    first = audit.watch(
        medallion.first_per_key(year, keys=["o_custkey"], seq="o_orderkey"), "first_per_customer"
    )
    first.write.format("noop").mode("overwrite").save()
    return audit.table(spark).withColumn("pct", rounded("pct"))


_PROFILED = {
    "numero": "bigint",
    "prioridade": "string",
    "produto": "string",
    "grupo_designado": "string",
    "item_configuracao": "string",
    "aberto": "timestamp_ntz",
    "resolvido": "timestamp_ntz",
    "duracao": "bigint",
    "incidente_pai": "string",
    "kpi_violado": "string",
    "descricao_resumida": "string",
}


@query(
    "profile",
    with_tickets(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, '{kind}' AS dtype, count({c}) AS n_filled,
            count(*) - count({c}) AS n_null, round_even(100.0 * (count(*) - count({c})) / count(*), 2)::DOUBLE
            AS pct_null, count(DISTINCT {c}) AS n_distinct FROM tickets"""
            for c, kind in _PROFILED.items()
        ).replace("SELECT 'numero'", "SELECT 'numero'", 1)
    ),
)
def profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile(tickets(spark, sf_dir).select(*_PROFILED))


@query(
    "temporal_coverage",
    with_tickets(
        """SELECT 'aberto' AS column_name, min(aberto) AS first_time, max(aberto) AS last_time,
        count(DISTINCT CAST(aberto AS DATE)) AS n_days FROM tickets
        UNION ALL SELECT 'resolvido', min(resolvido), max(resolvido),
        count(DISTINCT CAST(resolvido AS DATE)) FROM tickets"""
    ),
)
def temporal_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.temporal_coverage(tickets(spark, sf_dir), ["aberto", "resolvido"])


@query(
    "leak_guard",
    with_tickets(
        """SELECT 'forbidden_columns' AS check_name, CAST(5 AS BIGINT) AS n_found
        UNION ALL SELECT 'repeated_keys', count(*) - count(DISTINCT item_configuracao) FROM tickets"""
    ),
)
def leak_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.leakage_report(
        tickets(spark, sf_dir).drop("solucao"), contracts.LEAKAGE_COLUMNS, "item_configuracao"
    )


@query(
    "regime_filter",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) = 1996",
)
def regime_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.where(medallion.in_year("o_orderdate", 1996)).select("o_orderkey", "o_orderdate")


@query(
    "eligible_target",
    with_tickets(
        """SELECT numero, CASE WHEN kpi_violado = 'SIM' THEN 1 ELSE 0 END AS target
        FROM tickets WHERE entrou_kpi = 'SIM'"""
    ),
)
def eligible_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.eligible(tickets(spark, sf_dir)).select("numero", "target")


@query(
    "consistency_flags",
    with_tickets(
        """t AS (SELECT numero, aberto, resolvido,
          CASE WHEN numero % 97 = 0 THEN NULL WHEN numero % 31 = 0 THEN aberto - INTERVAL 1 HOUR
          ELSE encerrado END AS encerrado FROM tickets)
        SELECT numero, coalesce(encerrado < aberto, false) AS _flag_encerrado_antes_aberto,
          coalesce(resolvido > encerrado, false) AS _flag_resolvido_apos_encerrado FROM t"""
    ),
)
def consistency_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = tickets(spark, sf_dir).withColumn(
        "encerrado",
        F.expr(
            """CASE WHEN numero % 97 = 0 THEN NULL WHEN numero % 31 = 0 THEN aberto - INTERVAL 1 HOUR
            ELSE encerrado END"""
        ),
    )
    return medallion.consistency_flags(odd).select(
        "numero", "_flag_encerrado_antes_aberto", "_flag_resolvido_apos_encerrado"
    )


@query(
    "coverage_flag",
    with_tickets("SELECT numero, produto IS NOT NULL AS flag_categorizado FROM tickets"),
)
def coverage_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tickets(spark, sf_dir).select("numero", F.col("produto").isNotNull().alias("flag_categorizado"))


@query(
    "null_labels",
    with_tickets(
        """SELECT coalesce(categoria, 'Não categorizado') AS categoria_rotulada,
        coalesce(produto, 'Não categorizado') AS produto_rotulado, coalesce(grupo_designado, 'Ausente')
        AS grupo_rotulado, count(*) AS n FROM tickets GROUP BY ALL"""
    ),
)
def null_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = tickets(spark, sf_dir).select(
        F.coalesce("categoria", F.lit(medallion.UNCATEGORISED)).alias("categoria_rotulada"),
        F.coalesce("produto", F.lit(medallion.UNCATEGORISED)).alias("produto_rotulado"),
        F.coalesce("grupo_designado", F.lit("Ausente")).alias("grupo_rotulado"),
    )
    return labelled.groupBy(*labelled.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    "dedup_first",
    with_tickets(
        """SELECT incidente_pai, numero, aberto_por FROM tickets
        QUALIFY row_number() OVER (PARTITION BY incidente_pai ORDER BY numero) = 1"""
    ),
)
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.first_per_key(
        tickets(spark, sf_dir).select("incidente_pai", "numero", "aberto_por"),
        keys=["incidente_pai"],
        seq="numero",
    )


# --- gold tables ---------------------------------------------------------------------------------

HOLIDAYS_SQL = """years AS (SELECT CAST(unnest(range(1990, 2036)) AS BIGINT) AS y),
e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
e2 AS (SELECT *, b // 4 AS d, b % 4 AS e, (b - (b + 8) // 25 + 1) // 3 AS g FROM e1),
e3 AS (SELECT *, (19 * a + b - d - g + 15) % 30 AS h, c // 4 AS i, c % 4 AS k FROM e2),
e4 AS (SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM e3),
e5 AS (SELECT *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS p FROM e4),
holidays AS (SELECT make_date(y, p // 31, p % 31 + 1) - 2 AS d FROM e5
  UNION ALL SELECT make_date(y, m, dd) FROM years, (VALUES (1, 1), (4, 21), (5, 1), (9, 7), (10, 12),
    (11, 2), (11, 15), (12, 25)) AS v(m, dd)
  UNION ALL SELECT make_date(y, 11, 20) FROM years WHERE y >= 2024)"""


def _sql_holidays(day: str) -> str:
    return f"""CAST({day} IN (SELECT d FROM holidays) AS INTEGER) AS feriado,
    CAST({day} + 1 IN (SELECT d FROM holidays) AS INTEGER) AS vespera_feriado,
    CAST({day} - 1 IN (SELECT d FROM holidays) AS INTEGER) AS dia_seguinte_feriado"""


def _sql_cyclic(value: str, period: int, prefix: str) -> str:
    return (
        f"round(sin(2 * pi() * ({value}) / {period}), 6) AS {prefix}_sin, "
        f"round(cos(2 * pi() * ({value}) / {period}), 6) AS {prefix}_cos"
    )


_DAILY_SQL = f"""counts AS (SELECT CAST(aberto AS DATE) AS data, count(*) AS total,
    count(*) FILTER (prioridade IN ('2 - Alta', '3 - Média')) AS p2 FROM tickets GROUP BY 1),
  spine AS (SELECT CAST(unnest(generate_series(min(data), max(data), INTERVAL 1 DAY)) AS DATE) AS data FROM counts),
  daily AS (SELECT data, coalesce(total, 0) AS qtde_chamados_total, coalesce(p2, 0) AS qtde_chamados_p2_p3
    FROM spine LEFT JOIN counts USING (data)),
  lagged AS (SELECT *, {", ".join(f"lag(qtde_chamados_total, {k}) OVER (ORDER BY data) AS volume_lag_{k}" for k in range(1, 8))},
    CASE WHEN count(*) OVER w = 7 THEN avg(qtde_chamados_total) OVER w END AS media_movel_7d_ate_ontem
    FROM daily WINDOW w AS (ORDER BY data ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))"""


@query(
    "daily_volume",
    with_tickets(
        f"""{_DAILY_SQL}, {HOLIDAYS_SQL}
        SELECT data, qtde_chamados_total, qtde_chamados_p2_p3, CAST(isodow(data) - 1 AS INTEGER) AS dia_semana,
        CAST(isodow(data) >= 6 AS INTEGER) AS fim_de_semana, {_sql_holidays("data")},
        CAST(day(data) AS INTEGER) AS dia_do_mes, CAST(month(data) AS INTEGER) AS mes,
        {_sql_cyclic("isodow(data) - 1", 7, "dow")}, {", ".join(f"volume_lag_{k}" for k in range(1, 8))},
        round(media_movel_7d_ate_ontem, 6) AS media_movel_7d_ate_ontem FROM lagged"""
    ),
)
def daily_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = medallion.gold_daily(tickets(spark, sf_dir))
    return daily.withColumns(
        {c: rounded(c) for c in ("dow_sin", "dow_cos", "media_movel_7d_ate_ontem")}
    )


@query(
    "queue_pressure",
    with_tickets(
        f"""{_DAILY_SQL} SELECT numero, round(media_movel_7d_ate_ontem, 6) AS pressao_fila_7d
        FROM tickets LEFT JOIN lagged ON lagged.data = CAST(aberto AS DATE)"""
    ),
)
def queue_pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.queue_pressure(tickets(spark, sf_dir)).select(
        "numero", rounded("pressao_fila_7d").alias("pressao_fila_7d")
    )


@query(
    "weekly_macro",
    with_tickets(
        """t AS (SELECT CAST(date_trunc('week', CAST(aberto AS DATE) - INTERVAL 2 DAY) + INTERVAL 2 DAY AS DATE)
          AS semana, numero, prioridade, duracao, produto IS NOT NULL AS ok,
          coalesce(categoria, 'Não categorizado') AS categoria_rotulada,
          coalesce(produto, 'Não categorizado') AS produto_rotulado FROM tickets),
        c AS (SELECT semana, avg(CAST(ok AS INTEGER)) AS pct FROM t GROUP BY 1),
        m AS (SELECT semana, prioridade, quantile_cont(duracao, 0.5) AS med FROM t GROUP BY 1, 2)
        SELECT semana, prioridade, categoria_rotulada, produto_rotulado, count(numero) AS qtde_chamados,
          round(any_value(pct), 6) AS pct_categorizado,
          round(CAST(any_value(med) AS DOUBLE), 6) AS duracao_mediana_semana
        FROM t JOIN c USING (semana) JOIN m USING (semana, prioridade)
        GROUP BY 1, 2, 3, 4"""
    ),
)
def weekly_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekly = medallion.gold_weekly(tickets(spark, sf_dir))
    return weekly.select(
        "semana",
        "prioridade",
        "categoria_rotulada",
        "produto_rotulado",
        "qtde_chamados",
        rounded("pct_categorizado").alias("pct_categorizado"),
        rounded("duracao_mediana_semana").alias("duracao_mediana_semana"),
    )


def sql_clean_text(text: str) -> str:
    stop = ", ".join(f"'{w}'" for w in STOPWORDS_PT)
    plain = f"regexp_replace(strip_accents(lower({text})), '[^\\x00-\\x7F]', '', 'g')"
    tokens = f"string_split(trim(regexp_replace({plain}, '[^a-z0-9]+', ' ', 'g')), ' ')"
    return f"array_to_string([w FOR w IN {tokens} IF w NOT IN ({stop})], ' ')"


_RISK_SQL = f"""{_DAILY_SQL}, {HOLIDAYS_SQL},
  s AS (SELECT *, CAST(aberto AS DATE) AS data, {sql_clean_text("descricao_resumida")} AS descricao_limpa
    FROM tickets WHERE year(aberto) = {YEAR}),
  big AS (SELECT grupo_designado, count(*) AS n FROM s GROUP BY 1)
SELECT numero, aberto, s.data, prioridade, produto, categoria, subcategoria, s.grupo_designado,
  item_configuracao, aberto_por, descricao_limpa, produto IS NOT NULL AS flag_categorizado, incidente_pai,
  CAST(hour(aberto) AS INTEGER) AS hora_abertura, CAST(isodow(s.data) - 1 AS INTEGER) AS dia_semana,
  CAST(isodow(s.data) >= 6 AS INTEGER) AS fim_de_semana,
  {_sql_cyclic("hour(aberto)", 24, "hora")}, {_sql_cyclic("isodow(s.data) - 1", 7, "dow")},
  CASE WHEN hour(aberto) < 6 THEN 'madrugada' WHEN hour(aberto) < 18 THEN 'comercial' ELSE 'noite' END
    AS turno_abertura,
  CAST(hour(aberto) < 6 OR hour(aberto) >= 18 AS INTEGER) AS fora_horario_comercial,
  {_sql_holidays("s.data")},
  CAST(len(string_split(descricao_limpa, ' ')) AS INTEGER) AS descricao_n_tokens,
  row_number() OVER (PARTITION BY descricao_limpa ORDER BY aberto, numero) - 1 AS descricao_contagem_historica,
  row_number() OVER ic - 1 AS ic_contagem_historica,
  round(date_diff('microsecond', lag(aberto) OVER ic, aberto) / 3.6e9, 6) AS ic_horas_desde_ultimo_chamado,
  CASE WHEN s.grupo_designado IS NOT NULL THEN row_number() OVER g - 1 END AS grupo_contagem_historica,
  CASE WHEN s.grupo_designado IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY s.grupo_designado ORDER BY aberto
    RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING) END AS grupo_chamados_ultima_hora,
  s.grupo_designado IS NOT NULL AND big.n < {MIN_GROUP} AS grupo_baixo_volume,
  CAST(incidente_pai IS NOT NULL AS INTEGER) AS tem_incidente_pai,
  CASE WHEN incidente_pai IS NOT NULL THEN row_number() OVER (PARTITION BY incidente_pai ORDER BY aberto, numero)
    - 1 END AS incidente_pai_contagem_historica,
  entrou_kpi, kpi_violado, round(media_movel_7d_ate_ontem, 6) AS pressao_fila_7d
FROM s LEFT JOIN lagged ON lagged.data = s.data LEFT JOIN big ON big.grupo_designado IS NOT DISTINCT FROM s.grupo_designado
WINDOW ic AS (PARTITION BY item_configuracao ORDER BY aberto, numero),
  g AS (PARTITION BY s.grupo_designado ORDER BY aberto, numero)"""


@query("risk_table", with_tickets(_RISK_SQL))
def risk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Gold reads silver from its layer file: seven branches share one cleaning pass.
    path = work_folder(spark, "silver")
    layers.write_layer(medallion.silver(tickets(spark, sf_dir), year=YEAR), path, layer="silver")
    risk = medallion.gold_risk(layers.read_layer(spark, path), minimum=MIN_GROUP)
    floats = ["hora_sin", "hora_cos", "dow_sin", "dow_cos", "ic_horas_desde_ultimo_chamado", "pressao_fila_7d"]
    return risk.withColumns({c: rounded(c) for c in floats})


# --- folds ---------------------------------------------------------------------------------------

def ticket_folds(spark: SparkSession, sf_dir: str) -> list[fold_ops.Fold]:
    """Three folds of one test week that end on the last observed day, trained from the first."""
    return fold_ops.spanning_folds(*fold_ops.observed_span(tickets(spark, sf_dir), "aberto"), test_weeks=1)


SQL_FOLDS = """span AS (SELECT min(CAST(aberto AS DATE)) AS lo, max(CAST(aberto AS DATE)) AS hi FROM tickets),
f AS (SELECT i AS fold, lo AS a, CAST(hi - 7 * (4 - i) AS DATE) AS b, CAST(hi - 7 * (4 - i) + 1 AS DATE) AS c, CAST(hi - 7 * (3 - i) AS DATE) AS d
  FROM span, (VALUES (1), (2), (3)) AS v(i))"""


@query(
    "fold_assign",
    with_tickets(
        f"""{SQL_FOLDS}
        SELECT numero, fold, 'train' AS side FROM tickets JOIN f ON CAST(aberto AS DATE) BETWEEN a AND b
        UNION ALL SELECT numero, fold, 'test' FROM tickets JOIN f ON CAST(aberto AS DATE) BETWEEN c AND d"""
    ),
)
def fold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold_ops.assign_folds(
        tickets(spark, sf_dir).select("numero", "aberto"), time="aberto", folds=ticket_folds(spark, sf_dir)
    ).select("numero", "fold", "side")


@query(
    "fold_assign_refbounds",
    with_tickets(
        f"""{SQL_FOLDS}
        SELECT numero, fold, 'train' AS side FROM tickets JOIN f ON aberto BETWEEN a AND b
        UNION ALL SELECT numero, fold, 'test' FROM tickets JOIN f ON aberto BETWEEN c AND d"""
    ),
)
def fold_assign_refbounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold_ops.assign_folds(
        tickets(spark, sf_dir).select("numero", "aberto"),
        time="aberto",
        folds=ticket_folds(spark, sf_dir),
        reference_bounds=True,
    ).select("numero", "fold", "side")


@query(
    "folds",
    """WITH s AS (SELECT min(CAST(o_orderdate AS DATE)) AS a FROM orders)
    SELECT CAST(i + 1 AS INTEGER) AS fold, a AS train_start, CAST(a + CAST((30 + 7 * i) * 7 - 1 AS INTEGER) AS DATE) AS train_end,
      CAST(a + CAST((30 + 7 * i) * 7 AS INTEGER) AS DATE) AS test_start, CAST(a + CAST((37 + 7 * i) * 7 - 1 AS INTEGER) AS DATE) AS test_end
    FROM s, range(3) AS r(i)""",
)
def folds_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold_ops.folds_from_data(table(spark, sf_dir, "orders"), time="o_orderdate")


# --- causal features -----------------------------------------------------------------------------

_KEYED = "WITH o AS (SELECT o_orderkey, o_orderdate, CASE WHEN o_custkey % 7 <> 0 THEN o_custkey END AS k FROM orders)"


def _keyed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderdate", "CASE WHEN o_custkey % 7 <> 0 THEN o_custkey END AS k"
    )


@query(
    "causal_count",
    f"""{_KEYED} SELECT o_orderkey, CASE WHEN k IS NOT NULL THEN
    row_number() OVER (PARTITION BY k ORDER BY o_orderdate, o_orderkey) - 1 END AS n_prior FROM o""",
)
def causal_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return causal.prior_count(
        _keyed_orders(spark, sf_dir), key="k", time="o_orderdate", tiebreak="o_orderkey", out="n_prior"
    ).select("o_orderkey", "n_prior")


@query(
    "causal_count_strict",
    f"""{_KEYED} SELECT o_orderkey, CASE WHEN k IS NOT NULL THEN
    rank() OVER (PARTITION BY k ORDER BY o_orderdate) - 1 END AS n_prior FROM o""",
)
def causal_count_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return causal.prior_count(
        _keyed_orders(spark, sf_dir),
        key="k",
        time="o_orderdate",
        tiebreak="o_orderkey",
        out="n_prior",
        ties="strict",
    ).select("o_orderkey", "n_prior")


@query(
    "hours_since_last",
    f"""{_KEYED} SELECT o_orderkey, CASE WHEN k IS NOT NULL THEN round(date_diff('microsecond',
    lag(o_orderdate) OVER (PARTITION BY k ORDER BY o_orderdate, o_orderkey), o_orderdate) / 3.6e9, 6) END
    AS hours FROM o""",
)
def hours_since_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return causal.hours_since_previous(
        _keyed_orders(spark, sf_dir), key="k", time="o_orderdate", tiebreak="o_orderkey", out="hours"
    ).select("o_orderkey", rounded("hours").alias("hours"))


@query(
    "rolling_1h_load",
    with_tickets(
        """SELECT numero, CASE WHEN grupo_designado IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY grupo_designado
        ORDER BY aberto RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING) END
        AS n_last_hour FROM tickets"""
    ),
)
def rolling_1h_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return causal.rolling_prior_count(
        tickets(spark, sf_dir).select("numero", "aberto", "grupo_designado"),
        key="grupo_designado",
        time="aberto",
        out="n_last_hour",
    ).select("numero", "n_last_hour")


@query(
    "history_batches",
    with_tickets(
        """SELECT numero, CASE WHEN grupo_designado IS NOT NULL THEN row_number() OVER (PARTITION BY grupo_designado ORDER BY aberto, numero) - 1 END AS n_prior,
        CASE WHEN grupo_designado IS NOT NULL THEN round(date_diff('microsecond', lag(aberto) OVER (PARTITION BY grupo_designado
          ORDER BY aberto, numero), aberto) / 3.6e9, 6) END AS hours,
        CASE WHEN grupo_designado IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY grupo_designado
          ORDER BY aberto RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING) END AS n_last_hour FROM tickets"""
    ),
)
def history_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, gap and load of the last hour, worked out in three batches of days that only read what the ones before left."""
    rows = tickets(spark, sf_dir).select("numero", "aberto", "grupo_designado")
    first, last = fold_ops.observed_span(rows, "aberto")
    third = (last - first).days // 3 + 1
    part = F.floor(F.datediff(F.to_date("aberto"), F.lit(first)) / third)
    past = history.empty_history(rows, key="grupo_designado", time="aberto")
    done = []
    for batch in range(3):
        found, past = history.advance(
            past, rows.where(part == batch), key="grupo_designado", time="aberto", tiebreak="numero",
            count_out="n_prior", hours_out="hours", load_out="n_last_hour",
        )
        done.append(found.select("numero", "n_prior", rounded("hours").alias("hours"), "n_last_hour"))
    return done[0].unionByName(done[1]).unionByName(done[2])


def _sql_low_volume(where: str, minimum: int) -> str:
    return with_tickets(
        f"""SELECT numero, grupo_designado IS NOT NULL AND count(*) OVER (PARTITION BY grupo_designado) < {minimum}
        AS grupo_baixo_volume FROM tickets {where}"""
    )


@query("low_volume_flag", _sql_low_volume("", 500))
def low_volume_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return causal.low_volume_flag(
        tickets(spark, sf_dir).select("numero", "grupo_designado"),
        group="grupo_designado",
        out="grupo_baixo_volume",
        minimum=500,
    ).select("numero", "grupo_baixo_volume")


@query("low_volume_flag_eligible", _sql_low_volume("WHERE entrou_kpi = 'SIM'", 220))
def low_volume_flag_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return causal.low_volume_flag(
        profile.eligible(tickets(spark, sf_dir)).select("numero", "grupo_designado"),
        group="grupo_designado",
        out="grupo_baixo_volume",
        minimum=220,
    ).select("numero", "grupo_baixo_volume")


@query(
    "ordered_target_stat",
    with_tickets(
        """e AS (SELECT numero, aberto, coalesce(grupo_designado, 'Ausente') AS k,
          CASE WHEN kpi_violado = 'SIM' THEN 1 ELSE 0 END AS y FROM tickets WHERE entrou_kpi = 'SIM')
        SELECT numero, round((coalesce(sum(y) OVER w, 0) + 2.0 * 0.02) / (count(*) OVER w + 2.0), 6)::DOUBLE AS rate
        FROM e WINDOW w AS (PARTITION BY k ORDER BY aberto, numero
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
    ),
)
def ordered_target_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profile.eligible(tickets(spark, sf_dir)).select("numero", "aberto", "grupo_designado", "target")
    return causal.ordered_target_rate(
        rows,
        key="grupo_designado",
        time="aberto",
        tiebreak="numero",
        target="target",
        out="rate",
        prior=0.02,
        strength=2.0,
    ).select("numero", rounded("rate").alias("rate"))
