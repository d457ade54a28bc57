"""Ranking metrics over two length-based scores of the labelled documents, per language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import ranking, resample
from tidemark.plans.registry import query, rounded
from tidemark.sources.tables import table

GROUPS = ["model", "fold"]


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, fold, id, y, score)"""
    rows = table(spark, sf_dir, "labels").join(
        table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id"
    )
    models = F.array(
        F.struct(F.lit("longo").alias("model"), (F.col("n_chars") / 1e5).alias("score")),
        F.struct(F.lit("curto").alias("model"), (1 - (F.col("n_chars") % 1000) / 1e3).alias("score")),
    )
    return rows.select(
        F.col("lang").alias("fold"), F.col("doc_id").alias("id"), F.col("toxic").alias("y"),
        F.explode(models).alias("_m"),
    ).select("_m.model", "fold", "id", "y", "_m.score")


SCORES = """s AS (SELECT unnest(['longo', 'curto']) AS model, lang AS fold, doc_id AS id, toxic AS y,
  unnest([n_chars / 1e5, 1 - (n_chars % 1000) / 1e3]) AS score FROM labels JOIN documents USING (doc_id))"""

# Highest score first: rows and positives at or above each distinct score.
_STEPS = """d AS (SELECT model, fold, score, count(*) AS n, sum(y) AS pos FROM s GROUP BY 1, 2, 3),
t AS (SELECT *, sum(n) OVER w AS n_ge, sum(pos) OVER w AS tp, sum(n) OVER (PARTITION BY model, fold) AS n_total,
  sum(pos) OVER (PARTITION BY model, fold) AS n_pos FROM d
  WINDOW w AS (PARTITION BY model, fold ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
_AP = "sum(pos * tp / n_ge) / nullif(any_value(n_pos), 0)"
_AUC = (
    "(SELECT model, fold, (sum(CASE WHEN y = 1 THEN rk END) - any_value(p) * (any_value(p) + 1) / 2) / "
    "nullif(any_value(p) * any_value(q), 0) AS auc FROM (SELECT *, rank() OVER (PARTITION BY model, fold "
    "ORDER BY score) + (count(*) OVER (PARTITION BY model, fold, score) - 1) / 2 AS rk, "
    "sum(y) OVER (PARTITION BY model, fold) AS p, sum(1 - y) OVER (PARTITION BY model, fold) AS q FROM s) "
    "GROUP BY 1, 2)"
)


@query(
    "average_precision",
    f"WITH {SCORES}, {_STEPS} SELECT model, fold, round({_AP}, 6)::DOUBLE AS average_precision FROM t GROUP BY 1, 2",
)
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranking.average_precision(scores(spark, sf_dir), GROUPS)
    return found.withColumn("average_precision", rounded("average_precision"))


@query("roc_auc", f"WITH {SCORES} SELECT model, fold, round(auc, 6)::DOUBLE AS roc_auc FROM {_AUC}")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.roc_auc(scores(spark, sf_dir), GROUPS).withColumn("roc_auc", rounded("roc_auc"))


_HEADS = ", ".join(
    f"round(avg(y) FILTER (rn <= {k}), 6) AS precision_at_{k}" for k in (10, 20, 50)
)


@query(
    "precision_at_k",
    f"""WITH {SCORES}, r AS (SELECT *, row_number() OVER (PARTITION BY model, fold ORDER BY score DESC, id) AS rn,
      count(*) OVER (PARTITION BY model, fold) AS size FROM s)
    SELECT model, fold, {_HEADS}, round(avg(y) FILTER (rn <= greatest(1, floor(size * 0.1))), 6) AS precision_top_tenth
    FROM r GROUP BY 1, 2""",
)
def precision_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scores(spark, sf_dir)
    heads = ranking.precision_at(rows, GROUPS, [10, 20, 50])
    tenth = ranking.precision_at_share(rows, GROUPS, 0.1).select(
        *GROUPS, rounded("precision").alias("precision_top_tenth")
    )
    return heads.join(tenth, GROUPS).select(
        *GROUPS,
        *[rounded(f"precision_at_{k}").alias(f"precision_at_{k}") for k in (10, 20, 50)],
        "precision_top_tenth",
    )


_REPLICATES, _SPARE = 1000, 20
_WEIGHT = " + ".join(f"CAST(u >= {step:.17e} AS INTEGER)" for step in ranking.POISSON_STEPS)


def _drawn(rows: str, candidates: str) -> str:
    """Rows with their weight in every candidate replicate that the second table names."""
    return f"""SELECT model, fold, b, score, y, {_WEIGHT} AS w FROM (
      SELECT *, {resample.sql_uniform("h1", "h2", "h3", "b")} AS u FROM {rows} JOIN {candidates} USING (model, fold))"""


# Candidates without a positive are passed over: the first thousand with one are the replicates.
_DRAWS = f"""k AS (SELECT *, CAST('0x' || substr(m, 1, 7) AS BIGINT) AS h1, CAST('0x' || substr(m, 8, 7) AS BIGINT) AS h2,
    CAST('0x' || substr(m, 15, 7) AS BIGINT) AS h3 FROM (SELECT *, md5(concat_ws('#', '42', id)) AS m FROM s)),
  kp AS (SELECT * FROM k WHERE y = 1),
  all_b AS (SELECT model, fold, b FROM (SELECT DISTINCT model, fold FROM kp), range(1, {_REPLICATES * _SPARE} + 1) AS r(b)),
  valid AS (SELECT model, fold, b FROM ({_drawn("kp", "all_b")}) GROUP BY 1, 2, 3 HAVING sum(w) > 0
    QUALIFY row_number() OVER (PARTITION BY model, fold ORDER BY b) <= {_REPLICATES}),
  w AS ({_drawn("k", "valid")}),
  bd AS (SELECT model, fold, b, score, sum(w) AS n, sum(w * y) AS pos FROM w GROUP BY ALL HAVING sum(w) > 0),
  bt AS (SELECT *, sum(n) OVER o AS n_ge, sum(pos) OVER o AS tp, sum(pos) OVER (PARTITION BY model, fold, b) AS n_pos
    FROM bd WINDOW o AS (PARTITION BY model, fold, b ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
  bv AS (SELECT model, fold, b, {_AP} AS v FROM bt GROUP BY 1, 2, 3 HAVING any_value(n_pos) > 0),
  iv AS (SELECT model, fold, avg(v) AS mean, stddev_pop(v) AS sd, quantile_cont(v, 0.05) AS low,
    quantile_cont(v, 0.95) AS high, count(*) AS n_valid FROM bv GROUP BY 1, 2)"""


@query(
    "bootstrap_ci",
    f"""WITH {SCORES}, {_STEPS}, {_DRAWS}, p AS (SELECT model, fold, {_AP} AS point FROM t GROUP BY 1, 2)
    SELECT model, fold, round(point, 6)::DOUBLE AS point, round(mean, 6)::DOUBLE AS mean, round(sd, 6)::DOUBLE AS sd,
      round(low, 6)::DOUBLE AS low, round(high, 6)::DOUBLE AS high, n_valid FROM p LEFT JOIN iv USING (model, fold)""",
)
def bootstrap_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranking.bootstrap_interval(scores(spark, sf_dir), GROUPS, replicates=_REPLICATES)
    return found.withColumns({c: rounded(c) for c in ("point", "mean", "sd", "low", "high")})


@query(
    "rare_event_eval",
    f"""WITH {SCORES}, {_STEPS}, {_DRAWS},
    p AS (SELECT model, fold, CAST(any_value(n_total) AS BIGINT) AS n, CAST(any_value(n_pos) AS BIGINT) AS n_pos,
      {_AP} AS point FROM t GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY model, fold ORDER BY score DESC, id) AS rn FROM s),
    h AS (SELECT model, fold, {_HEADS} FROM r GROUP BY 1, 2)
    SELECT model, fold, n, n_pos, round_even(point, 4)::DOUBLE AS average_precision, round_even(low, 4)::DOUBLE AS ap_low,
      round_even(high, 4)::DOUBLE AS ap_high, round_even(auc, 4)::DOUBLE AS roc_auc,
      {", ".join(f"round_even(precision_at_{k}, 4)::DOUBLE AS precision_at_{k}" for k in (10, 20, 50))}
    FROM p LEFT JOIN iv USING (model, fold) LEFT JOIN h USING (model, fold) LEFT JOIN {_AUC} AS a USING (model, fold)""",
)
def rare_event_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rare_event_report(scores(spark, sf_dir), GROUPS, replicates=_REPLICATES)


@query(
    "cost_threshold",
    f"""WITH {SCORES}, {_STEPS}, c AS (SELECT model, fold, score AS threshold, (n_ge - tp) * 1.0 + (n_pos - tp) * 15.0 AS cost,
      tp, n_ge - tp AS fp, n_pos - tp AS fn FROM t)
    SELECT model, fold, threshold, cost::DOUBLE AS cost, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
      CAST(fn AS BIGINT) AS fn FROM c
    QUALIFY row_number() OVER (PARTITION BY model, fold ORDER BY cost, threshold) = 1""",
)
def cost_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.cost_threshold(scores(spark, sf_dir), GROUPS, cost_fp=1, cost_fn=15)


@query(
    "threshold_metrics",
    f"""WITH {SCORES}, c AS (SELECT model, fold, count(*) FILTER (score >= 0.02 AND y = 1) AS tp,
      count(*) FILTER (score >= 0.02 AND y = 0) AS fp, count(*) FILTER (score < 0.02 AND y = 1) AS fn,
      count(*) FILTER (score < 0.02 AND y = 0) AS tn FROM s GROUP BY 1, 2)
    SELECT *, round(coalesce(tp / nullif(tp + fp, 0), 0), 6)::DOUBLE AS precision,
      round(coalesce(tp / nullif(tp + fn, 0), 0), 6)::DOUBLE AS recall,
      round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6)::DOUBLE AS f1 FROM c""",
)
def threshold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranking.threshold_metrics(scores(spark, sf_dir), GROUPS, 0.02)
    return found.withColumns({c: rounded(c) for c in ("precision", "recall", "f1")})
