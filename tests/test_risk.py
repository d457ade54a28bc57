"""Model fits on tickets with a planted signal, and encodings against their definition."""

from __future__ import annotations

import math
from unittest.mock import MagicMock

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tidemark.operators import logit, perceptron, ranking, resample, risk
from tidemark.operators.folds import expanding_folds, in_fold
from tidemark.plans import all_queries, medallion
from tidemark.session import settle, work_folder
from tidemark.sources.tables import tickets

FOLD = expanding_folds("2024-01-01", 3, 1, 1)[0]


@pytest.fixture(scope="module")
def planted(spark, sf_dir):
    """Gold rows whose target follows night shifts and one priority."""
    clean = medallion.silver(tickets(spark, sf_dir), year=2024)
    rows = medallion.gold_risk(clean)
    noise = F.abs(F.hash("numero")) % 100
    chance = F.when(F.col("turno_abertura") == "noite", 45).otherwise(3) + F.when(
        F.col("prioridade") == "2 - Alta", 30
    ).otherwise(0)
    return settle(rows.withColumn("target", (noise < chance).cast("int")), "planted")


@pytest.fixture(scope="module")
def sides(planted):
    return planted.where(in_fold("aberto", FOLD, "train")), planted.where(in_fold("aberto", FOLD, "test"))


def quality(scored) -> float:
    return ranking.average_precision(scored, [], y="target").first()[0]


@pytest.fixture(scope="module")
def base(sides):
    return quality(risk.group_rate_scores(*sides, [], "prioridade", "target"))


def test_logistic_finds_the_signal(spark, sides, base):
    model = risk.fit_logistic(sides[0], "target")
    scored = model.score(sides[1], "numero", ["target"])
    low, high = scored.agg(F.min("score"), F.max("score")).first()
    assert 0 <= low and high <= 1 and quality(scored) > base
    top = sorted(model.coefficients(), key=lambda c: -c[1])[:3]
    assert "turno_abertura=noite" in [c[0] for c in top]
    assert all(c[2] == pytest.approx(math.exp(c[1])) for c in top)


def test_stored_model_scores_one_row(spark, sides):
    model = risk.fit_logistic(sides[0], "target")
    path = work_folder(spark, "model")
    model.model.save(path)
    one = sides[1].limit(1)
    again = risk.score_rows(PipelineModel.load(path), one, "numero", []).first()
    assert 0 <= again["score"] <= 1


def test_boosted_trees_find_the_signal(spark, sides, base):
    model = risk.fit_boosted(sides[0], maxIter=8, maxDepth=3)
    scored = model.score(sides[1], ["target"])
    assert scored.count() == sides[1].count()
    assert quality(scored) > base
    names = dict(model.importance())
    assert sum(names.values()) == pytest.approx(1.0)
    assert names["turno_abertura"] + names["hora_sin"] + names["hora_cos"] + names["fora_horario_comercial"] > 0.2


def test_perceptron_finds_the_signal(spark, sides):
    best, results = risk.tune_perceptron(sides[0], grid=[{"hidden": [8], "maxIter": 30}])
    model = risk.fit_perceptron(sides[0], hidden=best["hidden"], max_iter=best["maxIter"])
    scored = risk.score_rows(model, sides[1], "numero", ["target"])
    share = sides[1].agg(F.avg("target")).first()[0]
    assert len(results) == 1 and quality(scored) > 1.3 * share


def test_tuning_reports_every_trial(spark, sides):
    tuned = risk.tune_boosted(sides[0], trials=4, max_iter=(2, 5), depth=(2, 3))
    got = tuned.collect()
    assert [r["trial"] for r in got] == [1, 2, 3, 4] and all(0 <= r["average_precision"] <= 1 for r in got)
    # A third goes on to the second rung; the winner comes from there.
    assert sorted(r["rounds"] for r in got) == [2, 2, 5, 5] and all(1 <= r["iterations"] <= r["rounds"] for r in got)
    best = risk.best_settings(tuned)
    assert best["maxIter"] in [r["iterations"] for r in got if r["rounds"] == 5]


def test_tuning_needs_a_positive(spark, sides):
    with pytest.raises(ValueError):
        risk.tune_boosted(sides[0].withColumn("target", F.lit(0)), trials=1)


def test_significance_paths(spark, sides):
    classic = risk.logit_significance(
        sides[0], "target", categories=["turno_abertura", "prioridade"], numbers=["fim_de_semana"], row_id="numero"
    ).collect()
    assert {r["method"] for r in classic} == {"classic"}
    night = next(r for r in classic if r["feature"] == "turno_abertura=noite")
    assert night["p_value"] < 0.01 and night["low"] < night["coef"] < night["high"]
    assert classic[0]["feature"] == "const"
    marked = sides[0].withColumn("produto", F.when(F.col("target") == 0, F.lit("so_negativos"))).withColumn("dobro", F.col("fim_de_semana") * 2)
    given = {"categories": ["produto"], "numbers": ["fim_de_semana", "dobro"], "row_id": "numero"}
    ridge = {r["feature"]: r["method"] for r in risk.logit_significance(marked, "target", **given).collect()}
    assert ridge == {"const": "regularised", "produto=so_negativos": "regularised", "fim_de_semana": "regularised", "dobro": "collinear"}
    drawn = risk.logit_significance(marked, "target", **given, replicates=4, first="bootstrap").collect()
    assert {r["method"] for r in drawn} == {"bootstrap", "collinear"}
    assert all(0 <= r["p_value"] <= 1 and r["low"] <= r["coef"] <= r["high"] for r in drawn if r["method"] == "bootstrap")


def newton(x, y, w, penalty):
    beta = np.zeros(x.shape[1])
    ridge = np.full(len(beta), penalty)
    ridge[0] = 0
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ beta))
        h = (x * (w * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        beta = beta + np.linalg.solve(h, x.T @ (w * (y - p)) - ridge * beta)
    return beta, h


def test_replicates_are_fitted_as_one_by_one(spark):
    rng = np.random.default_rng(3)
    x = np.column_stack([np.ones(400), rng.normal(size=(400, 2))])
    y = (rng.random(400) < 1 / (1 + np.exp(1 - x[:, 1]))).astype(int)
    rows = spark.createDataFrame([(int(b), a.tolist(), i) for i, (a, b) in enumerate(zip(x, y))], "y int, x array<double>, id long")
    rows = settle(rows.repartition(5).select("y", "x", *[c.alias(k) for k, c in resample.draw_keys(F.col("id"), 42).items()]), "given")
    numbers = logit.drawn_replicates(rows, 6, 10)
    assert numbers.tolist() == [1, 2, 3, 4, 5, 6]
    got = logit.fit(rows, [0, 1, 2], penalty=1.0, replicates=numbers)
    keys = rows.select("x", "y", *resample.KEYS).toPandas()
    xs, ys = np.stack(keys["x"].to_numpy()), keys["y"].to_numpy()
    w = resample.poisson_weights(ranking.POISSON_STEPS, *(keys[k].to_numpy() for k in resample.KEYS), numbers)
    assert got.settled.all() and 0.9 < w.mean() < 1.1
    for i in range(len(numbers)):
        assert got.coef[i] == pytest.approx(newton(xs, ys, w[:, i], 1.0)[0], abs=1e-7)
    plain = logit.fit(rows, [0, 1, 2])
    beta, h = newton(xs, ys, np.ones(400), 0.0)
    assert plain.coef[0] == pytest.approx(beta, abs=1e-7)
    assert logit.standard_errors(plain.information) == pytest.approx(np.sqrt(np.diag(np.linalg.inv(h))), abs=1e-7)
    with pytest.raises(ValueError, match="one class"):
        logit.summarise(rows.where("y = 1"), ["const", "a", "b"])


def test_dependent_columns_are_named():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(2, 50))
    x = np.column_stack([np.ones(50), a, np.full(50, 3.0), b, a - 2 * b + 1, np.zeros(50)])
    assert logit.dependent_columns(x.T @ x) == {2: "constant", 4: "collinear", 5: "constant"}


def test_staged_scores_are_those_of_shorter_ensembles(spark, sides):
    inputs, matrix = risk.tree_matrix(sides[0])
    models = {1: risk.fit_trees(matrix, maxIter=5, maxDepth=3), 2: risk.fit_trees(matrix, maxIter=3, maxDepth=2)}
    held = inputs.features(sides[1], "numero").select("numero", "features", risk.vector_to_array("features").alias("x"))
    got = {(r["trial"], r["iterations"], r["numero"]): r["score"] for r in risk.staged_scores(held, models, [2, 3, 5], ["numero"]).collect()}
    assert {k[:2] for k in got} == {(1, 2), (1, 3), (1, 5), (2, 2), (2, 3)}
    whole = models[1].transform(held).select("numero", risk.positive_probability().alias("p")).collect()
    assert all(r["p"] == pytest.approx(1 / (1 + math.exp(-2 * got[1, 5, r["numero"]]))) for r in whole)
    # A boosted model of fewer rounds is a prefix of the longer one.
    short = risk.fit_trees(matrix, maxIter=2, maxDepth=3).transform(held).select("numero", risk.positive_probability().alias("p")).collect()
    assert all(r["p"] == pytest.approx(1 / (1 + math.exp(-2 * got[1, 2, r["numero"]]))) for r in short)


def test_stored_boosted_model_scores_alike(spark, sides):
    model = risk.fit_boosted(sides[0], maxIter=3, maxDepth=2)
    path = work_folder(spark, "boosted")
    model.save(path)
    again = risk.BoostedRiskModel.load(spark, path)
    assert sorted(map(tuple, again.score(sides[1], ["target"]).collect())) == sorted(map(tuple, model.score(sides[1], ["target"]).collect()))


def test_totals_of_parts_add_up(sides):
    parts = [risk.encoding_totals(sides[0].where(F.col("numero") % 3 == i), risk.CATEGORICAL, "target") for i in range(3)]
    whole = risk.encoding_totals(sides[0], risk.CATEGORICAL, "target")
    assert sorted(map(tuple, risk.merge_totals(*parts).collect())) == sorted(map(tuple, whole.collect()))


def test_unseen_category_is_all_zero(spark, sides):
    ready = risk.filled(sides[0], risk.CATEGORICAL, risk.NUMERIC)
    from pyspark.ml import Pipeline

    model = Pipeline(stages=risk.linear_stages(risk.CATEGORICAL, risk.NUMERIC, ready.count())).fit(ready)
    odd = ready.limit(1).withColumns({c: F.lit("nunca visto") for c in risk.CATEGORICAL})
    vector = model.transform(odd).first()["features"].toArray()
    names = risk.vector_names(model, risk.CATEGORICAL, risk.NUMERIC)
    assert len(vector) == len(names)
    assert all(v == 0 for n, v in zip(names, vector) if "=" in n)


def test_scaler_uses_the_population_deviation(spark, sides):
    ready = risk.filled(sides[0], risk.CATEGORICAL, risk.NUMERIC)
    from pyspark.ml import Pipeline

    model = Pipeline(stages=risk.linear_stages(risk.CATEGORICAL, risk.NUMERIC, ready.count())).fit(ready)
    slot = risk.vector_names(model, risk.CATEGORICAL, risk.NUMERIC).index("descricao_n_tokens")
    values = model.transform(ready).select(
        risk.vector_to_array("features").getItem(slot).alias("a"), "numero"
    )
    direct = risk.standardise(ready, ready, ["descricao_n_tokens"]).select("numero", "descricao_n_tokens")
    worst = values.join(direct, "numero").agg(F.max(F.abs(F.col("a") - F.col("descricao_n_tokens")))).first()[0]
    assert worst < 1e-9


def test_training_rates_equal_the_running_definition(spark, sides):
    got = risk.encode_training(
        sides[0].select("numero", "aberto", "prioridade", "produto", "target"),
        ["prioridade", "produto"], row_id="numero", time="aberto", target="target", prior=0.1,
    )
    rows = got.orderBy("aberto", "numero").collect()
    seen: dict[str, list[int]] = {}
    for r in rows:
        past = seen.setdefault(r["produto"] or risk.MISSING, [0, 0])
        assert r["taxa_produto"] == pytest.approx((past[0] + 0.1) / (past[1] + 1))
        past[0] += r["target"]
        past[1] += 1


def test_scoring_rates_use_training_totals(spark, sides):
    columns = ["numero", "aberto", "prioridade", "target"]
    got = risk.encode_scoring(
        sides[0].select(columns), sides[1].select(columns).withColumn("prioridade", F.lit("nova")),
        ["prioridade"], row_id="numero", target="target", prior=0.25,
    )
    assert got.select("taxa_prioridade").distinct().collect() == [(0.25,)]


def test_text_clusters_and_rates(spark, sides):
    found = risk.fit_text_clusters(sides[0], clusters=3, starts=2)
    rows = found.assign(sides[1])
    assert rows.count() == sides[1].count()
    assert rows.agg(F.max("cluster")).first()[0] <= 2 and -1 <= found.silhouette <= 1


def test_repeated_positives_balance(spark, sides):
    got = risk.repeat_positives(sides[0].select("target"), "target").groupBy("target").count()
    n = {r["target"]: r["count"] for r in got.collect()}
    assert 0.7 < n[1] / n[0] < 1.4


@pytest.mark.parametrize("name", ["feature_matrix", "cluster_rate", "batch_score"])
def test_model_queries_on_given_rows(spark, sf_dir, name):
    assert all_queries()[name](spark, sf_dir).count() > 0


def test_queries_run_the_whole_job(monkeypatch):
    from datetime import date

    from tidemark.plans import queries_risk as q

    calls, frame = [], MagicMock()
    monkeypatch.setattr(q, "model_rows", lambda *_: frame)
    monkeypatch.setattr(q, "F", MagicMock())
    monkeypatch.setattr(q.fold_ops, "in_fold", lambda time, fold, side: calls.append((fold.test_end, {})))
    monkeypatch.setattr(q.fold_ops, "observed_span", lambda *_: (date(2024, 1, 1), date(2024, 1, 30)))
    for name in ("fit_boosted", "tune_boosted", "fit_text_clusters", "logit_significance", "fit_perceptron", "score_rows"):
        monkeypatch.setattr(q.risk, name, lambda *_, name=name, **given: calls.append((name, given)) or frame)
    monkeypatch.setattr(q.risk, "tune_perceptron", lambda *_, **given: calls.append(("grid", given)) or ({"hidden": [2], "maxIter": 1}, []))
    for name in ("_evaluate", "settle"):
        monkeypatch.setattr(q, name, MagicMock())
    for job in (q.gbt_tuning, q.feature_importance, q.text_clusters, q.mlp_risk, q.logit_significance):
        monkeypatch.setattr(q, "rounded", MagicMock())
        job(MagicMock(), "")
    given = [(n, set(k)) for n, k in calls if isinstance(n, str)]
    assert given.count(("tune_boosted", set())) == 3 and ("fit_boosted", set()) in given and ("grid", set()) in given
    assert ("fit_text_clusters", {"clusters"}) in given
    tests = [k for n, k in calls if n == "logit_significance"]
    assert all(k["replicates"] == 300 and k["numbers"] == q.risk.NUMERIC for k in tests) and tests[-1]["categories"] == q.risk.CATEGORICAL
    assert {n for n, _ in calls if isinstance(n, date)} == {date(2024, 1, d) for d in (16, 23, 30)}


def test_networks_are_trained_together_with_row_weights(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3))
    y = (rng.random(300) < 1 / (1 + np.exp(1 - 2 * x[:, 1]))).astype(int)
    rows = spark.createDataFrame([(int(b), a.tolist()) for a, b in zip(x, y)], "y int, x array<double>")
    twice = F.when(F.col("y") == 1, 2).otherwise(1)
    given = perceptron.blocks(rows, "y", "x", twice)
    first = {1: ([3, 4, 2], rng.normal(size=26)), 2: ([3, 2, 2], rng.normal(size=14))}
    got = perceptron.sums(given, first)
    repeated = np.concatenate([np.arange(300), np.flatnonzero(y)])
    for i, (layers, weights) in first.items():
        loss, gradient = perceptron.loss_and_gradient(layers, weights, x[repeated], y[repeated], np.ones(len(repeated)))
        assert got[i][0] == pytest.approx(loss / len(repeated)) and got[i][1] == pytest.approx(gradient / len(repeated), abs=1e-12)
        nudge = np.eye(len(weights))[3] * 1e-6
        near = [perceptron.loss_and_gradient(layers, weights + d, x, y, np.ones(300))[0] for d in (nudge, -nudge)]
        assert (near[0] - near[1]) / 2e-6 == pytest.approx(perceptron.loss_and_gradient(layers, weights, x, y, np.ones(300))[1][3], rel=1e-4)
    # Side by side or alone, and over few steps or many, a network takes the same way down.
    both = perceptron.train(given, {i: (*n, 6) for i, n in first.items()})
    alone = perceptron.train(given, {1: (*first[1], 3)})[1]
    assert len(alone) == 4 and all(a == pytest.approx(b, abs=1e-9) for a, b in zip(alone, both[1]))
    last = {i: perceptron.sums(given, {i: (n[0], both[i][-1])})[i][0] for i, n in first.items()}
    assert all(last[i] < got[i][0] for i in first)


def test_perceptron_options_share_their_passes(spark, sides, monkeypatch):
    """Options that differ in steps only are one network, and the stored model answers as its weights do."""
    passes, sums = [], perceptron.sums
    monkeypatch.setattr(perceptron, "sums", lambda rows, networks: passes.append(sorted(networks)) or sums(rows, networks))
    options = [{"hidden": [4], "maxIter": 2}, {"hidden": [4], "maxIter": 5}, {"hidden": [3], "maxIter": 5}]
    models = risk.fit_perceptrons(sides[0], options)
    assert passes[0] == [0, 1] and len(passes) <= 5 * perceptron.TRIES
    assert [list(m.stages[-1].getLayers())[1] for m in models] == [4, 4, 3]
    last = models[1].stages[-1]
    seen = models[1].transform(risk.filled(sides[1], risk.CATEGORICAL, risk.NUMERIC)).select(
        risk.vector_to_array("features").alias("x"), risk.positive_probability().alias("p")
    ).limit(20).collect()
    for r in seen:
        loss, _ = perceptron.loss_and_gradient(list(last.getLayers()), last.weights.toArray(), np.array([r["x"]]), np.ones(1), np.ones(1))
        assert r["p"] == pytest.approx(math.exp(-loss))


def test_networks_follow_the_library_learner(spark):
    """In one block without repeated rows the loss is the library's, and so is the way down."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(8)
    x = rng.normal(size=(100, 3))
    y = (rng.random(100) < 1 / (1 + np.exp(-2 * x[:, 0] * x[:, 1]))).astype(int)
    rows = spark.createDataFrame([(int(b), a.tolist()) for a, b in zip(x, y)], "y int, x array<double>").coalesce(1)
    ready = rows.withColumn("features", array_to_vector("x"))
    plain = MultilayerPerceptronClassifier(labelCol="y", layers=[3, 5, 4, 2], seed=42)
    start = plain.copy({plain.maxIter: 0}).fit(ready).weights.toArray()
    path = perceptron.train(perceptron.blocks(rows, "y", "x", F.lit(1)), {0: ([3, 5, 4, 2], start, 12)})[0]
    for steps in (3, 12):
        assert path[steps] == pytest.approx(plain.copy({plain.maxIter: steps}).fit(ready).weights.toArray(), abs=1e-5)
