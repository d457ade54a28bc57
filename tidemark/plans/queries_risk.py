"""Risk models over the eligible tickets of the gold table."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import causal, folds as fold_ops, logit, profile, ranking, risk
from tidemark.plans import medallion
from tidemark.plans.queries_layers import SQL_FOLDS, YEAR, sql_clean_text, ticket_folds
from tidemark.plans.queries_profile import _ELIGIBLE, _eligible
from tidemark.plans.registry import query, rounded, with_tickets
from tidemark.functions.text import clean_text
from tidemark.session import settle, work_folder
from tidemark.sources.tables import table, tickets

_STORED: dict[tuple[str, str], str] = {}


def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eligible gold rows with the target and the team flag taken among eligible rows.

    The table is written once per application and tables folder: learners pass over it many times.
    """
    place = (spark.sparkContext.applicationId, sf_dir)
    if place not in _STORED:
        # Other columns are neither shuffled nor stored; the choice of a ticket's first row still sees them.
        clean = medallion.silver(tickets(spark, sf_dir), year=YEAR).select(medallion.RISK_INPUTS)
        clean = settle(clean, "silver")
        counted = medallion.gold_risk(clean, wanted=profile.counts_for_agreement())
        rows = profile.eligible(counted).drop("grupo_baixo_volume")
        flagged = causal.low_volume_flag(
            rows, group="grupo_designado", out="grupo_baixo_volume", minimum=220
        )
        path = work_folder(spark, "risk")
        flagged.write.parquet(path)
        _STORED[place] = path
    return spark.read.parquet(_STORED[place])


def _fold_rows(spark: SparkSession, sf_dir: str, fold: fold_ops.Fold) -> tuple[DataFrame, DataFrame]:
    rows = model_rows(spark, sf_dir)
    return (
        rows.where(fold_ops.in_fold("aberto", fold, "train")),
        rows.where(fold_ops.in_fold("aberto", fold, "test")),
    )


def _spanning(spark: SparkSession, sf_dir: str) -> list[fold_ops.Fold]:
    """Three folds of one test week that end on the last observed day."""
    return fold_ops.spanning_folds(*fold_ops.observed_span(model_rows(spark, sf_dir), "aberto"), test_weeks=1)


def _evaluate(scored: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, n, n_pos, average_precision, roc_auc)"""
    steps = ranking.threshold_table(scored, groups, y="target")
    return steps.groupBy(*groups).agg(
        F.max("n_total").alias("n"),
        F.max("n_pos").alias("n_pos"),
        rounded(ranking.average_precision_expr()).alias("average_precision"),
        rounded(ranking.roc_auc_expr()).alias("roc_auc"),
    )


def _stack(frames: list[DataFrame]) -> DataFrame:
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame)
    return stacked


@query(
    "baseline_rate",
    with_tickets(
        f"""{_ELIGIBLE}, {SQL_FOLDS},
        tr AS (SELECT fold, prioridade, target FROM e JOIN f ON CAST(aberto AS DATE) BETWEEN a AND b),
        r AS (SELECT fold, prioridade, avg(target) AS rate FROM tr WHERE prioridade <> '2 - Alta' GROUP BY 1, 2),
        g AS (SELECT fold, avg(target) AS rate FROM tr GROUP BY 1)
        SELECT numero, fold, target, round(coalesce(r.rate, g.rate), 6) AS score FROM e
        JOIN f ON CAST(aberto AS DATE) BETWEEN c AND d JOIN g USING (fold) LEFT JOIN r USING (fold, prioridade)"""
    ),
)
def baseline_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _eligible(spark, sf_dir).select("numero", "aberto", "prioridade", "target")
    split = fold_ops.assign_folds(rows, time="aberto", folds=ticket_folds(spark, sf_dir))
    # One priority is hidden from training, so the fall-back to the overall rate is exercised.
    train = split.where("side = 'train'").withColumn(
        "prioridade", F.when(F.col("prioridade") != "2 - Alta", F.col("prioridade"))
    )
    scored = risk.group_rate_scores(train, split.where("side = 'test'"), ["fold"], "prioridade", "target")
    return scored.select("numero", "fold", "target", rounded("score").alias("score"))


@query(
    "class_weights",
    with_tickets(
        f"""{_ELIGIBLE} SELECT target, count(*) AS n, round(sum(count(*)) OVER () / (2.0 * count(*)), 6)::DOUBLE AS balanced,
        round(CASE WHEN target = 1 THEN (sum(count(*)) OVER () - count(*)) / count(*) ELSE 1 END, 6)::DOUBLE AS positive
        FROM e GROUP BY 1"""
    ),
)
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = risk.class_weights(_eligible(spark, sf_dir), "target")
    return found.withColumns({c: rounded(c) for c in ("balanced", "positive")})


@query(
    "standardise",
    with_tickets(
        f"""{_ELIGIBLE}, {SQL_FOLDS},
        x AS (SELECT numero, aberto, duracao, hour(aberto) AS hora, CASE WHEN numero % 9 <> 0 THEN duracao % 60 END AS resto,
          7 AS fixo FROM e),
        s AS (SELECT avg(duracao) AS m1, stddev_pop(duracao) AS s1, avg(hora) AS m2, stddev_pop(hora) AS s2,
          avg(resto) AS m3, stddev_pop(resto) AS s3 FROM x JOIN f ON fold = 3 AND CAST(aberto AS DATE) BETWEEN a AND b)
        SELECT numero, round((duracao - m1) / s1, 6) AS duracao, round((hora - m2) / s2, 6) AS hora,
          round((resto - m3) / s3, 6) AS resto, CAST(0 AS DOUBLE) AS fixo FROM x, s"""
    ),
)
def standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _eligible(spark, sf_dir).selectExpr(
        "numero",
        "aberto",
        "duracao",
        "hour(aberto) AS hora",
        "CASE WHEN numero % 9 <> 0 THEN duracao % 60 END AS resto",
        "7 AS fixo",
    )
    columns = ["duracao", "hora", "resto", "fixo"]
    train = rows.where(fold_ops.in_fold("aberto", ticket_folds(spark, sf_dir)[-1], "train"))
    found = risk.standardise(train, rows, columns)
    return found.select("numero", *[rounded(c).alias(c) for c in columns])


@query(
    "temporal_split",
    with_tickets(
        f"""{_ELIGIBLE} SELECT numero, CASE WHEN row_number() OVER (ORDER BY aberto, numero) <=
        floor((SELECT count(*) FROM e) * 0.8::DOUBLE) THEN 'fit' ELSE 'validation' END AS part FROM e"""
    ),
)
def temporal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _eligible(spark, sf_dir).select("numero", "aberto")
    return risk.temporal_split(rows, time="aberto", tiebreak="numero").select("numero", "part")


_SEPARATED = ["prioridade", "grupo_designado", "produto", "status"]


@query(
    "separation_check",
    with_tickets(
        f"{_ELIGIBLE} "
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, coalesce({c}, 'Ausente') AS value, count(*) AS n,
            CAST(sum(target) AS BIGINT) AS n_positive, sum(target) IN (0, count(*)) AS separated FROM e GROUP BY 2"""
            for c in _SEPARATED
        )
    ),
)
def separation_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk.separation_report(_eligible(spark, sf_dir), _SEPARATED, "target")


@query(
    "text_tfidf",
    f"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all({sql_clean_text("text")}, '[a-z0-9]{{2,}}')) AS term FROM documents),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY 1, 2),
    v AS (SELECT term, count(*) AS df FROM tf GROUP BY 1 HAVING count(*) >= 2 ORDER BY sum(tf) DESC, term LIMIT 200),
    x AS (SELECT doc_id, term, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w FROM tf JOIN v USING (term))
    SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM x""",
)
def text_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", clean_text(F.col("text")).alias("texto"))
    tokens = F.filter(F.split("texto", " "), lambda t: F.length(t) >= 2)
    return risk.term_weights(docs, row_id="doc_id", tokens=tokens).withColumn("weight", rounded("weight"))


@query("feature_matrix")
def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = risk.filled(model_rows(spark, sf_dir), risk.CATEGORICAL, risk.NUMERIC)
    stages = risk.linear_stages(risk.CATEGORICAL, risk.NUMERIC, rows.count())
    model = Pipeline(stages=stages).fit(rows)
    path = work_folder(spark, "matrix-model")
    model.save(path)
    matrix = PipelineModel.load(path).transform(rows)
    values = risk.vector_to_array("features")
    return matrix.select(
        "numero",
        "target",
        F.size(values).alias("n_slots"),
        rounded(F.aggregate(values, F.lit(0.0), lambda a, v: a + v)).alias("slot_sum"),
    )


@query("logit_folds")
def logit_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    coefficients, scores = [], []
    for fold in _spanning(spark, sf_dir):
        train, test = _fold_rows(spark, sf_dir, fold)
        model = risk.fit_logistic(train, "target")
        scores.append(model.score(test, "numero", ["target"]).withColumn("fold", F.lit(fold.fold)))
        coefficients += [(fold.fold, *c) for c in model.coefficients()]
    quality = _evaluate(_stack(scores), ["fold"]).drop("n", "n_pos")
    table_of = spark.createDataFrame(
        coefficients, "fold int, feature string, coef double, odds_ratio double"
    )
    return table_of.join(quality, "fold").withColumns(
        {"coef": rounded("coef"), "odds_ratio": rounded("odds_ratio")}
    )


_NEWTON_STEPS = 12
_SUMS = ", ".join(f"sum((y - p) * x{i}) AS g{i}" for i in range(3)) + ", " + ", ".join(
    f"sum(p * (1 - p) * x{i} * x{j}) AS h{i}{j}" for i in range(3) for j in range(i, 3)
)
_DET = "(h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02))"
# The inverse of the symmetric three by three information, row by row.
_INVERSE = {
    (0, 0): "(h11 * h22 - h12 * h12)", (0, 1): "(h02 * h12 - h01 * h22)", (0, 2): "(h01 * h12 - h02 * h11)",
    (1, 1): "(h00 * h22 - h02 * h02)", (1, 2): "(h01 * h02 - h00 * h12)", (2, 2): "(h00 * h11 - h01 * h01)",
}


def _step(i: int) -> str:
    return "(" + " + ".join(f"{_INVERSE[min(i, j), max(i, j)]} * g{j}" for j in range(3)) + f") / {_DET}"


@query(
    "logit_newton",
    with_tickets(
        f"""RECURSIVE_MARK {_ELIGIBLE},
        raw AS (SELECT target AS y, hour(aberto)::DOUBLE AS a, day(aberto)::DOUBLE AS b FROM e),
        m AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb FROM raw),
        x AS (SELECT y, 1.0::DOUBLE AS x0, (a - ma) / sa AS x1, (b - mb) / sb AS x2 FROM raw, m),
        newton(k, b0, b1, b2, v0, v1, v2) AS (
          SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
          UNION ALL
          SELECT k + 1, b0 + {_step(0)}, b1 + {_step(1)}, b2 + {_step(2)},
            {", ".join(f"{_INVERSE[i, i]} / {_DET}" for i in range(3))} FROM (
            SELECT k, b0, b1, b2, {_SUMS} FROM (
              SELECT k, b0, b1, b2, x.*, 1 / (1 + exp(-(b0 * x0 + b1 * x1 + b2 * x2))) AS p FROM newton, x WHERE k < {_NEWTON_STEPS})
            GROUP BY k, b0, b1, b2))
        SELECT unnest(['const', 'hora', 'dia']) AS feature, round(unnest([b0, b1, b2]), 6) AS coef,
          round(sqrt(unnest([v0, v1, v2])), 6) AS std_error, 'classic' AS method FROM newton WHERE k = {_NEWTON_STEPS}"""
    ).replace("WITH tickets", "WITH RECURSIVE tickets", 1).replace("RECURSIVE_MARK ", ""),
)
def logit_newton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Newton sums on two columns and the constant, small enough for SQL to solve."""
    rows = _eligible(spark, sf_dir).select(
        "target", F.hour("aberto").cast("double").alias("hora"), F.day("aberto").cast("double").alias("dia")
    )
    scaled = risk.standardise(rows, rows, ["hora", "dia"])
    given = settle(scaled.select(F.col("target").alias("y"), F.array(F.lit(1.0), "hora", "dia").alias("x")), "newton")
    found = logit.summarise(given, ["const", "hora", "dia"])
    return found.select("feature", rounded("coef").alias("coef"), rounded("std_error").alias("std_error"), "method")


_REPLICATES = 300
_SIGNIFICANCE = ("coef", "std_error", "p_value", "low", "high")


@query("logit_significance")
def logit_significance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priority and shift first; then every category, among them teams without a positive; then resampled."""
    train, _ = _fold_rows(spark, sf_dir, _spanning(spark, sf_dir)[-1])
    tables = [
        risk.logit_significance(
            train, "target", categories=categories, numbers=risk.NUMERIC, row_id="numero", replicates=_REPLICATES, **way
        ).withColumn("model", F.lit(model))
        for model, categories, way in (
            ("short", ["prioridade", "turno_abertura"], {}),
            ("resampled", ["prioridade", "turno_abertura"], {"first": "bootstrap"}),
            ("whole", risk.CATEGORICAL, {}),
        )
    ]
    return _stack(tables).withColumns({c: rounded(c) for c in _SIGNIFICANCE})


@query(
    "encoding_totals",
    with_tickets(
        f"{_ELIGIBLE} "
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, coalesce({c}, 'Ausente') AS value, CAST(sum(target) AS BIGINT) AS positives,
            count(*) AS n, round((sum(target) + (SELECT avg(target) FROM e)) / (count(*) + 1), 6)::DOUBLE AS rate FROM e GROUP BY 2"""
            for c in _SEPARATED
        )
    ),
)
def encoding_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category totals kept per month and merged, with the smoothed rate they give."""
    rows = _eligible(spark, sf_dir)
    month = F.month("aberto")
    parts = [risk.encoding_totals(rows.where(month % 3 == part), _SEPARATED, "target") for part in range(3)]
    prior = rows.agg(F.avg("target")).scalar()
    merged = risk.merge_totals(*parts)
    return merged.withColumn("rate", rounded((F.col("positives") + prior) / (F.col("n") + 1)))


def _tuned(spark: SparkSession, sf_dir: str) -> list[tuple[fold_ops.Fold, DataFrame, DataFrame, DataFrame]]:
    """(fold, train, test, trials): every fold searched in its own training part, no trial pruned, folds side by side."""
    sides = [(fold, *_fold_rows(spark, sf_dir, fold)) for fold in _spanning(spark, sf_dir)]
    with ThreadPoolExecutor(len(sides)) as pool:
        trials = list(pool.map(lambda side: risk.tune_boosted(side[1], 1.0), sides))
    return [(*side, found) for side, found in zip(sides, trials)]


@query("gbt_risk")
def gbt_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winners of each fold's search, fitted on its training part, beside the rate baseline: the whole report."""
    scores, tuned = [], _tuned(spark, sf_dir)
    with ThreadPoolExecutor(len(tuned)) as pool:
        models = list(pool.map(lambda side: risk.fit_boosted(side[1], **risk.best_settings(side[3], "rounds")), tuned))
    for (fold, train, test, _), model in zip(tuned, models):
        base = risk.group_rate_scores(train, test, [], "prioridade", "target")
        for name, scored in (("arvores", model.score(test, ["target"])), ("taxa", base)):
            kept = scored.select(F.lit(name).alias("model"), F.lit(fold.fold).alias("fold"), F.col("numero").alias("id"), F.col("target").alias("y"), "score")
            scores.append(kept)
    # Scores are stored before the metrics read them several times.
    return ranking.rare_event_report(settle(_stack(scores), "scores"), ["model", "fold"])


@query("gbt_tuning")
def gbt_tuning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stack([trials.withColumn("fold", F.lit(fold.fold)) for fold, _, _, trials in _tuned(spark, sf_dir)])


@query("feature_importance")
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = risk.fit_boosted(model_rows(spark, sf_dir))
    rows = spark.createDataFrame(model.importance(), "feature string, importance double")
    return rows.orderBy(F.desc("importance"), "feature").limit(15).withColumn(
        "importance", rounded("importance")
    )


def _clusters(spark: SparkSession, sf_dir: str):
    train, test = _fold_rows(spark, sf_dir, _spanning(spark, sf_dir)[-1])
    found = risk.fit_text_clusters(train, clusters=6)
    return found, train, test


@query("text_clusters")
def text_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, train, test = _clusters(spark, sf_dir)
    rows = found.assign(train).withColumn("side", F.lit("train")).unionByName(
        found.assign(test).withColumn("side", F.lit("test"))
    )
    return rows.groupBy("side", "cluster").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "silhouette", F.lit(found.silhouette).cast("double")
    )


@query("cluster_rate")
def cluster_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, train, _ = _clusters(spark, sf_dir)
    return profile.rate_by(found.assign(train), ["cluster"], "target")


@query("mlp_risk")
def mlp_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _fold_rows(spark, sf_dir, _spanning(spark, sf_dir)[-1])
    best, _ = risk.tune_perceptron(train)
    model = risk.fit_perceptron(train, hidden=best["hidden"], max_iter=best["maxIter"])
    scored = risk.score_rows(model, test, "numero", ["target"]).withColumn(
        "model", F.lit("-".join(map(str, best["hidden"])))
    )
    return _evaluate(settle(scored, "scores"), ["model"])


@query("batch_score")
def batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a stored logistic and a stored boosted model, both loaded again without their training rows."""
    rows = model_rows(spark, sf_dir)
    path, boosted = work_folder(spark, "risk-model"), work_folder(spark, "risk-model")
    risk.fit_logistic(rows, "target").model.save(path)
    risk.fit_boosted(rows).save(boosted)
    scored = risk.score_rows(PipelineModel.load(path), rows, "numero", ["target"]).withColumn("model", F.lit("logistica"))
    trees = risk.BoostedRiskModel.load(spark, boosted).score(rows, ["target"]).withColumn("model", F.lit("arvores"))
    both = scored.unionByName(trees)
    return both.select("model", "numero", "target", rounded("score").alias("score"))
