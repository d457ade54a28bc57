"""Risk models of rare events on pyspark.ml, with encodings that see training rows only."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    ElementwiseProduct,
    Normalizer,
    OneHotEncoder,
    RegexTokenizer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import boosting, logit, perceptron, search
from tidemark.operators.ordering import add_prior
from tidemark.operators.profile import sample_rows
from tidemark.operators.ranking import average_precision
from tidemark.operators.resample import draw_keys
from tidemark.session import parallel_parts, settle, work_folder
from tidemark.sources.contracts import unpivot_text

MISSING = "Ausente"

CATEGORICAL = [
    "prioridade",
    "produto",
    "categoria",
    "subcategoria",
    "grupo_designado",
    "aberto_por",
    "turno_abertura",
]
TEXT = "descricao_limpa"
NUMERIC = [
    "flag_categorizado",
    "fim_de_semana",
    "feriado",
    "vespera_feriado",
    "dia_seguinte_feriado",
    "fora_horario_comercial",
    "hora_sin",
    "hora_cos",
    "dow_sin",
    "dow_cos",
    "descricao_n_tokens",
    "descricao_contagem_historica",
    "pressao_fila_7d",
    "ic_contagem_historica",
    "ic_horas_desde_ultimo_chamado",
    "grupo_contagem_historica",
    "grupo_chamados_ultima_hora",
    "grupo_baixo_volume",
    "tem_incidente_pai",
    "incidente_pai_contagem_historica",
]


# --- simple rates and weights --------------------------------------------------------------------


def group_rate_scores(
    train: DataFrame, test: DataFrame, keys: list[str], category: str, target: str, out: str = "score"
) -> DataFrame:
    """Score test rows with the training rate of their category; unseen ones get the overall rate.

    ``keys`` (folds) keep several splits apart in one job.
    """
    # Stored, the rates have a known size, so the planner can tell whether every task may hold them.
    rates = settle(
        train.where(F.col(category).isNotNull())
        .groupBy(*keys, category)
        .agg(F.avg(target).alias("_rate")),
        "rates",
    )
    overall = train.groupBy(*keys).agg(F.avg(target).alias("_all"))
    if keys:
        joined = test.join(rates, [*keys, category], "left").join(overall, keys, "left")
    else:
        joined = test.join(rates, category, "left").withColumn("_all", overall.select("_all").scalar())
    return joined.select(*test.columns, F.coalesce("_rate", "_all").alias(out))


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """(target, n, balanced, positive): n/(2 n_c), and 1 against negatives per positive."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    size = counts.agg(
        F.struct(
            F.sum("n").alias("all"),
            F.sum(F.when(F.col(target) == 1, F.col("n"))).alias("pos"),
        )
    ).scalar()
    with_size = counts.withColumn("_s", size)
    return with_size.select(
        target,
        "n",
        (F.col("_s.all") / (2.0 * F.col("n"))).alias("balanced"),
        F.when(F.col(target) == 1, (F.col("_s.all") - F.col("_s.pos")) / F.col("_s.pos"))
        .otherwise(F.lit(1.0))
        .alias("positive"),
    )


def with_balanced_weight(df: DataFrame, target: str, out: str = "peso") -> DataFrame:
    size = df.agg(
        F.struct(F.count(F.lit(1)).alias("all"), F.coalesce(F.sum(target), F.lit(0)).alias("pos"))
    ).scalar()
    of_class = F.when(F.col(target) == 1, F.col("_s.pos")).otherwise(F.col("_s.all") - F.col("_s.pos"))
    return df.withColumn("_s", size).withColumn(out, F.col("_s.all") / (2.0 * of_class)).drop("_s")


def separation_report(df: DataFrame, categories: list[str], target: str) -> DataFrame:
    """(column_name, value, n, n_positive, separated): categories that hold one class only."""
    cells = unpivot_text(df, categories, keep=[target])
    return (
        cells.groupBy("column_name", F.coalesce("value", F.lit(MISSING)).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(target).alias("n_positive"))
        .withColumn(
            "separated", (F.col("n_positive") == 0) | (F.col("n_positive") == F.col("n"))
        )
    )


def standardise(train: DataFrame, df: DataFrame, columns: list[str]) -> DataFrame:
    """Centre and scale by training mean and population deviation; a constant becomes 0."""
    stats = train.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in columns],
            *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
        )
    ).scalar()
    scaled = df.withColumn("_t", stats)
    values = {
        c: F.when(F.col(f"_t.s_{c}") > 0, (F.col(c) - F.col(f"_t.m_{c}")) / F.col(f"_t.s_{c}"))
        .when(F.col(c).isNotNull(), F.lit(0.0))
        for c in columns
    }
    return scaled.withColumns(values).drop("_t")


def temporal_split(
    df: DataFrame, *, time: str, tiebreak: str, validation_share: float = 0.2, out: str = "part"
) -> DataFrame:
    """Mark the last share of the rows by time as 'validation', the rest as 'fit'."""
    placed = add_prior(
        df, [], [time, tiebreak], sums={"_before": F.lit(1)}, wholes={"_size": "_before"}
    )
    cut = F.floor(F.col("_size") * F.lit(1 - validation_share))
    return (
        placed.withColumn(out, F.when(F.col("_before") < cut, F.lit("fit")).otherwise(F.lit("validation")))
        .drop("_before", "_size")
    )


# --- category encoding ---------------------------------------------------------------------------


def _category_cells(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    return unpivot_text(df, columns, keep=keep).withColumn(
        "value", F.coalesce("value", F.lit(MISSING))
    )


def _widen(cells: DataFrame, columns: list[str], row_id: str, rate: Column) -> DataFrame:
    return cells.groupBy(row_id).agg(
        *[F.max(F.when(F.col("column_name") == c, rate)).alias(f"taxa_{c}") for c in columns]
    )


def encode_training(
    train: DataFrame,
    columns: list[str],
    *,
    row_id: str,
    time: str,
    target: str,
    prior: float,
    strength: float = 1.0,
) -> DataFrame:
    """Add a smoothed target rate per category column from the row's own past, all in one ordered pass."""
    cells = _category_cells(train, columns, [row_id, time, target])
    seen = add_prior(
        cells,
        ["column_name", "value"],
        [time, row_id],
        sums={"_y": F.col(target), "_n": F.lit(1)},
    )
    rate = (F.col("_y") + F.lit(strength * prior)) / (F.col("_n") + F.lit(strength))
    return train.join(_widen(seen, columns, row_id, rate), row_id)


def encoding_totals(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """(column_name, value, positives, n): what a category's rate is made of. Totals of parts add up to the whole's."""
    return (
        _category_cells(df, columns, [target])
        .groupBy("column_name", "value")
        .agg(F.sum(target).cast("bigint").alias("positives"), F.count(F.lit(1)).alias("n"))
    )


def merge_totals(*parts: DataFrame) -> DataFrame:
    """Totals of several days or regions as if they had been counted together."""
    return reduce(DataFrame.unionByName, parts).groupBy("column_name", "value").agg(
        F.sum("positives").alias("positives"), F.sum("n").alias("n")
    )


def encode_with_totals(
    totals: DataFrame, df: DataFrame, columns: list[str], *, row_id: str, prior: float, strength: float = 1.0
) -> DataFrame:
    """Add the rate columns to rows outside the training part; an unseen category gets the prior."""
    cells = _category_cells(df, columns, [row_id]).join(totals, ["column_name", "value"], "left")
    rate = (F.coalesce("positives", F.lit(0)) + F.lit(strength * prior)) / (F.coalesce("n", F.lit(0)) + F.lit(strength))
    return df.join(_widen(cells, columns, row_id, rate), row_id)


def encode_scoring(
    train: DataFrame,
    test: DataFrame,
    columns: list[str],
    *,
    row_id: str,
    target: str,
    prior: float,
    strength: float = 1.0,
) -> DataFrame:
    """Add the same columns to rows outside the training part, from its totals."""
    totals = settle(encoding_totals(train, columns, target), "totals")
    return encode_with_totals(totals, test, columns, row_id=row_id, prior=prior, strength=strength)


# --- feature matrices ----------------------------------------------------------------------------


def filled(df: DataFrame, categories: list[str], numbers: list[str]) -> DataFrame:
    """Categories without value get a label, numbers without value a 0 (linear and neural models)."""
    return df.withColumns(
        {
            **{c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING)) for c in categories},
            **{c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numbers},
        }
    )


def linear_stages(
    categories: list[str], numbers: list[str], n_rows: int, drop_first: bool = False
) -> list:
    """One-hot categories (an unseen one is all zeros) and standardised numbers in ``features``.

    The scaler divides by the sample deviation; the product turns that into the population one.
    """
    indexed = [f"{c}_i" for c in categories]
    hot = [f"{c}_h" for c in categories]
    correction = math.sqrt(n_rows / (n_rows - 1)) if n_rows > 1 else 1.0
    stages = [
        StringIndexer(
            inputCols=categories,
            outputCols=indexed,
            handleInvalid="skip" if drop_first else "keep",
            # Descending order makes the alphabetically first category the dropped one.
            stringOrderType="alphabetDesc" if drop_first else "alphabetAsc",
        ),
        OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
        VectorAssembler(inputCols=numbers, outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
        ElementwiseProduct(
            inputCol="scaled", outputCol="centred", scalingVec=Vectors.dense([correction] * len(numbers))
        ),
        VectorAssembler(inputCols=[*hot, "centred"], outputCol="features"),
    ]
    return stages


def vector_names(model: PipelineModel, categories: list[str], numbers: list[str], drop_first: bool = False) -> list[str]:
    """Names of the slots of ``features`` in order."""
    names = []
    for column, labels in zip(categories, model.stages[0].labelsArray):
        kept = labels[:-1] if drop_first else labels
        names += [f"{column}={label}" for label in kept]
    return [*names, *numbers]


def positive_probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column)).getItem(1)


def stored(model, purpose: str = "model"):
    """Save a fitted model to the shared work folder and load it back.

    A loaded model drops its training summary, and with it the session that summary holds on to.
    """
    path = work_folder(SparkSession.active(), purpose)
    model.save(path)
    return type(model).load(path)


# --- logistic models -----------------------------------------------------------------------------


@dataclass
class LinearRiskModel:
    model: PipelineModel
    names: list[str]

    def score(self, df: DataFrame, row_id: str, keep: list[str]) -> DataFrame:
        ready = filled(df, CATEGORICAL, NUMERIC)
        return self.model.transform(ready).select(
            row_id, *keep, positive_probability().alias("score")
        )

    def coefficients(self) -> list[tuple[str, float, float]]:
        values = self.model.stages[-1].coefficients.toArray()
        return [(n, float(v), math.exp(float(v))) for n, v in zip(self.names, values)]


def fit_logistic(
    train: DataFrame, target: str, penalty: float = 1.0, max_iter: int = 100
) -> LinearRiskModel:
    """Balanced logistic regression; ``penalty`` is the inverse of the usual C of an unaveraged loss."""
    ready = with_balanced_weight(filled(train, CATEGORICAL, NUMERIC), target)
    # Balanced weights add up to the number of rows.
    n_rows = train.count()
    learner = LogisticRegression(
        featuresCol="features",
        labelCol=target,
        weightCol="peso",
        regParam=penalty / max(n_rows, 1),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
    )
    stages = linear_stages(CATEGORICAL, NUMERIC, n_rows)
    model = stored(Pipeline(stages=[*stages, learner]).fit(ready))
    return LinearRiskModel(model, vector_names(model, CATEGORICAL, NUMERIC))


def logit_matrix(
    train: DataFrame, target: str, *, categories: list[str], numbers: list[str], row_id: str, seed: int = 42
) -> tuple[DataFrame, list[str]]:
    """(y, x, draw keys) with the constant first, stored, and the columns' names.

    One-hot categories without their first value, and standardised numbers. A category with a single value is the
    constant; it has no column of its own.
    """
    ready = filled(train, categories, numbers)
    several = ready.agg(*[(F.min(c) != F.max(c)).alias(c) for c in categories], F.count(F.lit(1)).alias("_n")).first()
    categories = [c for c in categories if several[c]]
    prep = Pipeline(stages=linear_stages(categories, numbers, several["_n"], drop_first=True)).fit(ready)
    names = ["const", *vector_names(prep, categories, numbers, drop_first=True)]
    rows = prep.transform(ready).select(
        F.col(target).cast("int").alias("y"),
        F.concat(F.array(F.lit(1.0)), vector_to_array("features")).alias("x"),
        *[c.alias(k) for k, c in draw_keys(F.col(row_id), seed).items()],
    )
    # Dealt out evenly: a Newton pass costs by the row.
    return settle(rows.repartition(parallel_parts(train.sparkSession)), "logit"), names


def logit_significance(
    train: DataFrame,
    target: str,
    *,
    categories: list[str],
    numbers: list[str],
    row_id: str,
    replicates: int = 300,
    level: float = 0.95,
    seed: int = 42,
    first: str = "classic",
) -> DataFrame:
    """(feature, coef, std_error, p_value, low, high, method); see ``logit.summarise`` for the three ways."""
    rows, names = logit_matrix(train, target, categories=categories, numbers=numbers, row_id=row_id, seed=seed)
    return logit.summarise(rows, names, replicates=replicates, level=level, first=first)


# --- boosted trees -------------------------------------------------------------------------------

ABSENT = -1.0

_NULLABLE = [
    "pressao_fila_7d",
    "ic_contagem_historica",
    "ic_horas_desde_ultimo_chamado",
    "grupo_contagem_historica",
    "incidente_pai_contagem_historica",
]


def _tree_inputs(df: DataFrame) -> DataFrame:
    """Empty numbers become a sentinel with an indicator beside it; empty text becomes ''."""
    return df.withColumns(
        {
            **{f"nulo_{c}": F.col(c).isNull().cast("double") for c in _NULLABLE},
            **{c: F.coalesce(F.col(c).cast("double"), F.lit(ABSENT)) for c in NUMERIC},
            TEXT: F.coalesce(TEXT, F.lit("")),
        }
    )


@dataclass
class TreeInputs:
    """All that turns tickets into tree features: category totals, text vocabulary, the training share of positives."""

    prep: PipelineModel
    totals: DataFrame
    prior: float

    @property
    def slots(self) -> list[str]:
        return [*CATEGORICAL, *NUMERIC, *_NULLABLE, *[TEXT] * len(self.prep.stages[1].vocabulary)]

    def features(self, df: DataFrame, row_id: str) -> DataFrame:
        """Rows outside the training part with ``features``."""
        encoded = encode_with_totals(self.totals, df, CATEGORICAL, row_id=row_id, prior=self.prior)
        return self.prep.transform(_tree_inputs(encoded))


def tree_matrix(
    train: DataFrame, *, target: str = "target", row_id: str = "numero", time: str = "aberto", vocabulary: int = 200
) -> tuple[TreeInputs, DataFrame]:
    """The inputs learned from ``train`` and its matrix (row_id, target, features, peso), written once for any number of fits.

    ``train`` should be a stored table: each pass over it is then a scan, not a recomputation.
    """
    prior = float(train.agg(F.avg(target)).first()[0] or 0.0)
    totals = settle(encoding_totals(train, CATEGORICAL, target), "totals")
    encoded = encode_training(train, CATEGORICAL, row_id=row_id, time=time, target=target, prior=prior)
    rates = [f"taxa_{c}" for c in CATEGORICAL]
    flags = [f"nulo_{c}" for c in _NULLABLE]
    encoded = settle(_tree_inputs(encoded), "encoded")
    prep = Pipeline(
        stages=[
            RegexTokenizer(inputCol=TEXT, outputCol="tokens", pattern="\\w\\w+", gaps=False),
            CountVectorizer(inputCol="tokens", outputCol="words", vocabSize=vocabulary, minDF=2),
            VectorAssembler(inputCols=[*rates, *NUMERIC, *flags, "words"], outputCol="features"),
        ]
    ).fit(encoded)
    ready = with_balanced_weight(prep.transform(encoded), target).select(
        row_id, F.col(target).cast("double").alias(target), "features", "peso"
    )
    # Stored: the tree rounds then run on as many tasks as the matrix is large.
    return TreeInputs(prep, totals, prior), settle(ready, "matrix")


def dealt_matrix(matrix: DataFrame, held: DataFrame | None = None, *, target: str = "target", row_id: str = "numero") -> boosting.Dealt:
    numbers = len(CATEGORICAL) + len(NUMERIC) + len(_NULLABLE)
    return boosting.deal(matrix, held, target=target, weight="peso", row_id=row_id, numbers=numbers)


def fit_trees(
    matrix: DataFrame, *, target: str = "target", row_id: str = "numero", seed: int = 42, leafPenalty: float | None = None, **params
) -> GBTClassificationModel | boosting.SymmetricTrees:
    """Boosted trees of the library, or symmetric ones where leaves are penalised."""
    options = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 1.0, **params}
    if leafPenalty is None:
        return GBTClassifier(labelCol=target, weightCol="peso", seed=seed, **options).fit(matrix)
    dealt = dealt_matrix(matrix, target=target, row_id=row_id)
    try:
        trees, _ = boosting.fit(
            dealt, rounds=options["maxIter"], depth=options["maxDepth"], step=options["stepSize"],
            penalty=leafPenalty, share=options["subsamplingRate"], seed=seed,
        )
    finally:
        dealt.release()
    return trees


@dataclass
class BoostedRiskModel:
    """Trees with the inputs they were fitted on; it needs no training row to score, and can be saved."""

    inputs: TreeInputs
    trees: GBTClassificationModel | boosting.SymmetricTrees
    row_id: str = "numero"

    def score(self, df: DataFrame, keep: list[str]) -> DataFrame:
        return self.trees.transform(self.inputs.features(df, self.row_id)).select(
            self.row_id, *keep, positive_probability().alias("score")
        )

    def importance(self) -> list[tuple[str, float]]:
        """Importance per source column; the slots of the text add up."""
        total: dict[str, float] = {}
        for name, value in zip(self.inputs.slots, self.trees.featureImportances.toArray()):
            total[name] = total.get(name, 0.0) + float(value)
        return sorted(total.items(), key=lambda kv: (-kv[1], kv[0]))

    def save(self, path: str) -> None:
        """Trees, preparation, category totals and the prior, below one folder that must not exist."""
        self.trees.save(f"{path}/trees")
        self.inputs.prep.save(f"{path}/prep")
        self.inputs.totals.write.parquet(f"{path}/totals")
        self.inputs.totals.sparkSession.createDataFrame(
            [(self.inputs.prior, self.row_id, type(self.trees).__name__)], "prior double, row_id string, learner string"
        ).write.parquet(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedRiskModel:
        about = spark.read.parquet(f"{path}/about").first()
        inputs = TreeInputs(PipelineModel.load(f"{path}/prep"), spark.read.parquet(f"{path}/totals"), about["prior"])
        learner = {kind.__name__: kind for kind in (GBTClassificationModel, boosting.SymmetricTrees)}[about["learner"]]
        return cls(inputs, learner.load(f"{path}/trees"), about["row_id"])


def fit_boosted(
    train: DataFrame,
    *,
    target: str = "target",
    row_id: str = "numero",
    time: str = "aberto",
    vocabulary: int = 200,
    seed: int = 42,
    **params,
) -> BoostedRiskModel:
    """Balanced boosted trees over ordered category rates, a bag of words and numbers."""
    inputs, matrix = tree_matrix(train, target=target, row_id=row_id, time=time, vocabulary=vocabulary)
    return BoostedRiskModel(inputs, fit_trees(matrix, target=target, row_id=row_id, seed=seed, **params), row_id)


# --- tuning: every prefix of an ensemble is an ensemble ------------------------------------------

_SPLIT = re.compile(r"^ *If \(feature (\d+) <= ([^)]+)\)$")


def tree_nodes(tree) -> list[tuple[int, float, int, int, float]]:
    """(feature, threshold, left, right, value) per node of a fitted tree, the root first; a leaf has feature -1."""
    nodes: list[tuple[int, float, int, int, float]] = []
    lines = iter(tree.toDebugString.splitlines()[1:])

    def read() -> int:
        line, at = next(lines), len(nodes)
        nodes.append((-1, 0.0, 0, 0, 0.0))
        split = _SPLIT.match(line)
        if split:
            left = read()
            next(lines)  # Else
            nodes[at] = (int(split[1]), float(split[2]), left, read(), 0.0)
        else:
            nodes[at] = (-1, 0.0, at, at, float(line.split("Predict:")[1]))
        return at

    read()
    return nodes


def packed_trees(model: GBTClassificationModel | boosting.SymmetricTrees) -> list[tuple]:
    """(weight, feature, threshold, left, right, value) of every tree, arrays over its nodes."""
    if isinstance(model, boosting.SymmetricTrees):
        return model.nodes()
    return [(weight, *(np.array(c) for c in zip(*tree_nodes(tree)))) for tree, weight in zip(model.trees, model.treeWeights)]


def staged_scores(
    rows: DataFrame,
    models: dict[int, GBTClassificationModel | boosting.SymmetricTrees],
    stages: list[int] | dict[int, list[int]],
    keep: list[str],
    features: str = "x",
) -> DataFrame:
    """(trial, iterations, keep, score) of all models after each number of trees, in one pass over the rows.

    ``stages`` holds for all models, or names those of each.
    """
    packed = {trial: packed_trees(model) for trial, model in models.items()}
    wanted = stages if isinstance(stages, dict) else dict.fromkeys(models, stages)
    kinds = dict(rows.dtypes)
    schema = "trial int, iterations int, " + "".join(f"`{c}` {kinds[c]}, " for c in keep) + "score double"

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = np.stack(batch[features].to_numpy())
            every = np.arange(len(x))
            for trial, trees in packed.items():
                margin = np.zeros(len(x))
                for n, (weight, feature, threshold, left, right, value) in enumerate(trees, 1):
                    at = np.zeros(len(x), dtype=int)
                    while (inner := feature[at] >= 0).any():
                        down = np.where(x[every, np.maximum(feature[at], 0)] <= threshold[at], left[at], right[at])
                        at = np.where(inner, down, at)
                    margin += weight * value[at]
                    if n in wanted[trial]:
                        yield batch[keep].assign(trial=trial, iterations=n, score=margin)

    return rows.select(*keep, features).mapInPandas(score, schema).select("trial", "iterations", *keep, "score")


TRIALS = "trial int, depth int, step double, subsample double, penalty double, rounds int, iterations int, average_precision double"


def tune_boosted(
    train: DataFrame,
    keep: float = 1 / 3,
    *,
    trials: int = 25,
    target: str = "target",
    row_id: str = "numero",
    time: str = "aberto",
    seed: int = 42,
    threads: int = 6,
    max_iter: tuple[int, int] = (200, 800),
    depth: tuple[int, int] = (3, 8),
    step: tuple[float, float] = (0.01, 0.2),
    penalty: tuple[float, float] = (1.0, 10.0),
    patience: int = 30,
) -> DataFrame:
    """(trial, depth, step, subsample, penalty, rounds, iterations, average_precision): a search inside a fold.

    The last fifth by time validates. Encoding and matrices are written once. The first ten trials are drawn at random
    and fitted side by side; each later one is suggested by Parzen estimators over all trials before it. ``rounds`` is
    how many trees a trial may have, ``iterations`` how many were best; a fit stops after ``patience`` trees without a gain.

    With ``keep`` of 1 every trial may have as many trees as it was suggested. A smaller share prunes: trials may
    have the least number of trees first, and that share of them goes on with three times as many, up to the most.
    """
    marked = settle(temporal_split(train, time=time, tiebreak=row_id), "tuning")
    check = marked.where("part = 'validation'")
    if not check.where(F.col(target) == 1).take(1):
        raise ValueError("the validation part holds no positive row")
    inputs, matrix = tree_matrix(marked.where("part = 'fit'"), target=target, row_id=row_id, time=time)
    held = settle(inputs.features(check, row_id).select(row_id, target, "features"), "held")
    dealt = dealt_matrix(matrix, held, target=target, row_id=row_id)
    space = {
        "rounds": search.Setting(*max_iter, whole=True),
        "step": search.Setting(*step, log=True),
        "depth": search.Setting(*depth, whole=True),
        "penalty": search.Setting(*penalty, log=True),
        "share": search.Setting(0.6, 1.0),
    }
    draw = np.random.default_rng(seed)
    settings: dict[int, dict] = {}
    models: dict[int, boosting.SymmetricTrees] = {}
    tried: list[tuple[dict, float]] = []

    def fit(trial: int, most: int | None) -> float:
        given = settings[trial] | ({"rounds": most} if most else {})
        trees, curve = boosting.fit(dealt, **given, patience=patience, seed=seed)
        models[trial] = trees.first(int(np.argmax(curve)) + 1)
        return max(curve)

    def fit_all(group: list[int], most: int | None) -> None:
        # Fits whose every level is a job of many tasks gain little from company, and it costs workers memory.
        with ThreadPoolExecutor(threads if dealt.tasks == 1 else 2) as pool:
            tried.extend(zip([settings[t] for t in group], pool.map(lambda t: fit(t, most), group)))

    found: dict[int, tuple] = {}
    most = max_iter[0] if keep < 1 else None
    going = list(range(1, trials + 1))
    try:
        for trial in going:
            settings[trial] = search.suggest(space, tried, draw)
            if trial >= min(trials, search.STARTUP):
                fit_all([t for t in settings if t not in models], most)
        while True:
            stages = {t: [len(models[t].trees)] for t in going}
            scored = settle(staged_scores(held.withColumn("x", vector_to_array("features")), {t: models[t] for t in going}, stages, [row_id, target]), "stages")
            for r in average_precision(scored, ["trial", "iterations"], y=target).collect():
                t, given = r["trial"], settings[r["trial"]]
                # More trees begin with the same ones, so what was found with fewer still counts.
                value, n = max((r["average_precision"], -r["iterations"]), found[t][-1:] + (-found[t][-2],) if t in found else (-1.0, 0))
                found[t] = (t, given["depth"], given["step"], given["share"], given["penalty"], most or given["rounds"], -n, value)
            if not most or most >= max_iter[1]:
                break
            going = sorted(sorted(going, key=lambda t: (-found[t][-1], t))[: math.ceil(len(going) * keep)])
            most = min(max_iter[1], 3 * most)
            fit_all(going, most)
    finally:
        dealt.release()
    return train.sparkSession.createDataFrame([found[t] for t in sorted(found)], TRIALS)


def best_settings(tuned: DataFrame, trees: str = "iterations") -> dict:
    """What ``fit_boosted`` takes: the trial of the highest average precision, of equal ones that with the most trees.

    ``trees`` names the column of their number: ``iterations``, the best, or ``rounds``, as many as the trial might have.
    """
    row = tuned.orderBy(F.desc("average_precision"), F.desc("rounds"), "trial").first()
    return {
        "maxDepth": row["depth"],
        "stepSize": row["step"],
        "subsamplingRate": row["subsample"],
        "leafPenalty": row["penalty"],
        "maxIter": row[trees],
    }


# --- text clusters -------------------------------------------------------------------------------


def term_weights(
    df: DataFrame, *, row_id: str, tokens: Column, vocabulary: int = 200, min_docs: int = 2
) -> DataFrame:
    """(row_id, term, weight): unit-length tf-idf over the most frequent terms, idf = ln((1+n)/(1+df)) + 1."""
    size = df.agg(F.count(F.lit(1))).scalar()
    words = df.select(row_id, F.explode(tokens).alias("term"))
    tf = words.groupBy(row_id, "term").agg(F.count(F.lit(1)).alias("tf"))
    terms = (
        tf.groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
        .where(F.col("df") >= min_docs)
        .orderBy(F.desc("total"), "term")
        .limit(vocabulary)
    )
    idf = terms.select("term", (F.log((1 + size) / (1 + F.col("df"))) + 1).alias("idf"))
    # The vocabulary has a fixed number of rows, so every task can hold it.
    raw = tf.join(F.broadcast(idf), "term").withColumn("_w", F.col("tf") * F.col("idf"))
    # A row meets at most the vocabulary, so its length is a small window.
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(row_id)))
    return raw.select(row_id, "term", (F.col("_w") / length).alias("weight"))


@dataclass
class TextClusters:
    vectors: PipelineModel
    kmeans: KMeansModel
    silhouette: float | None

    def assign(self, df: DataFrame, text: str = TEXT) -> DataFrame:
        ready = self.vectors.transform(df.withColumn(text, F.coalesce(text, F.lit(""))))
        return self.kmeans.transform(ready).select(*df.columns, "cluster")


def fit_text_clusters(
    train: DataFrame,
    *,
    text: str = TEXT,
    row_id: str = "numero",
    clusters: int = 5,
    starts: int = 10,
    seed: int = 42,
    vocabulary: int = 200,
    sample: int = 2000,
) -> TextClusters:
    """K-means over tf-idf of the training rows: the best of several starts, silhouette on a sample."""
    ready = train.withColumn(text, F.coalesce(text, F.lit("")))
    vectors = Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="tokens", pattern="\\w\\w+", gaps=False),
            CountVectorizer(inputCol="tokens", outputCol="tf", vocabSize=vocabulary, minDF=2),
            IDF(inputCol="tf", outputCol="tfidf"),
            Normalizer(inputCol="tfidf", outputCol="unit"),
        ]
    ).fit(ready)
    data = vectors.transform(ready).select(row_id, "unit").persist()
    try:
        best: KMeansModel | None = None
        for start in range(starts):
            model = KMeans(
                featuresCol="unit", predictionCol="cluster", k=clusters, seed=seed + start
            ).fit(data)
            if best is None or model.summary.trainingCost < best.summary.trainingCost:
                best = model
        best = stored(best, "clusters")
        probe = best.transform(sample_rows(data, row_id, sample, seed))
        several = len(probe.select("cluster").distinct().take(2)) == 2
        silhouette = (
            ClusteringEvaluator(featuresCol="unit", predictionCol="cluster").evaluate(probe)
            if several
            else None
        )
    finally:
        data.unpersist()
    return TextClusters(vectors, best, silhouette)


# --- perceptron ----------------------------------------------------------------------------------


def positive_copies(df: DataFrame, target: str) -> int:
    """How often a positive row counts, so that both classes weigh about the same; 1 at least."""
    size = df.agg(F.count(F.lit(1)).alias("all"), F.coalesce(F.sum(target), F.lit(0)).alias("pos"))
    share = F.round((F.col("all") - F.col("pos")) / F.greatest(F.lit(1), F.col("pos")))
    return size.select(F.greatest(F.lit(1), share).cast("int")).first()[0]


def repeat_positives(df: DataFrame, target: str) -> DataFrame:
    """Repeat positive rows so that both classes weigh about the same, for learners that take no weights."""
    copies = F.when(F.col(target) == 1, positive_copies(df, target)).otherwise(F.lit(1))
    return df.withColumn("_c", F.explode(F.sequence(F.lit(1), copies))).drop("_c")


PERCEPTRON_GRID = [
    {"hidden": [64, 32], "maxIter": 40},
    {"hidden": [64, 32], "maxIter": 100},
    {"hidden": [32, 16], "maxIter": 40},
    {"hidden": [32, 16], "maxIter": 100},
]


def fit_perceptrons(train: DataFrame, options: list[dict], *, target: str = "target", seed: int = 42) -> list[PipelineModel]:
    """One stored model per option, all trained in the same passes over one matrix.

    Options that differ in ``maxIter`` only are one network, read after so many steps.
    """
    ready = filled(train, CATEGORICAL, NUMERIC)
    prep = Pipeline(stages=linear_stages(CATEGORICAL, NUMERIC, ready.count())).fit(ready)
    data = prep.transform(ready).select(target, "features")
    one = data.limit(1)
    width = one.first()["features"].size
    weight = F.when(F.col(target) == 1, positive_copies(ready, target)).otherwise(F.lit(1))
    stored_rows = perceptron.blocks(data.withColumn("x", vector_to_array("features")), target, "x", weight)
    plain = MultilayerPerceptronClassifier(labelCol=target, maxIter=0, seed=seed)

    def layers(option: dict) -> list[int]:
        return [width, *option["hidden"], 2]

    steps: dict[tuple, int] = {}
    for option in options:
        key = tuple(option["hidden"])
        steps[key] = max(steps.get(key, 0), option["maxIter"])
    # Without steps the learner returns the weights it starts from, or is given.
    starts = {key: plain.copy({plain.layers: [width, *key, 2]}).fit(one).weights.toArray() for key in steps}
    paths = perceptron.train(
        stored_rows, {i: ([width, *key, 2], starts[key], steps[key]) for i, key in enumerate(steps)}
    )
    models = []
    for option in options:
        path = paths[list(steps).index(tuple(option["hidden"]))]
        weights = Vectors.dense(path[min(option["maxIter"], len(path) - 1)])
        fitted = plain.copy({plain.layers: layers(option), plain.initialWeights: weights}).fit(one)
        models.append(stored(PipelineModel([*prep.stages, fitted])))
    return models


def fit_perceptron(
    train: DataFrame, *, target: str = "target", hidden: list[int], max_iter: int, seed: int = 42
) -> PipelineModel:
    return fit_perceptrons(train, [{"hidden": hidden, "maxIter": max_iter}], target=target, seed=seed)[0]


def tune_perceptron(
    train: DataFrame,
    *,
    target: str = "target",
    row_id: str = "numero",
    time: str = "aberto",
    grid: list[dict] | None = None,
    seed: int = 42,
) -> tuple[dict, list[tuple[dict, float]]]:
    """Best configuration by average precision on the last 15 % of the training rows by time."""
    marked = settle(
        temporal_split(train, time=time, tiebreak=row_id, validation_share=0.15), "grid"
    )
    fit_part, check = marked.where("part = 'fit'"), marked.where("part = 'validation'")
    results = []
    options = grid or PERCEPTRON_GRID
    for option, model in zip(options, fit_perceptrons(fit_part, options, target=target, seed=seed)):
        value = average_precision(score_rows(model, check, row_id, [target]), [], y=target).first()[0]
        results.append((option, value if value is not None else -1.0))
    return max(results, key=lambda r: r[1])[0], results


def score_rows(model: PipelineModel, df: DataFrame, row_id: str, keep: list[str]) -> DataFrame:
    """Probability per row from a stored model; the same call serves one ticket or a whole table."""
    return model.transform(filled(df, CATEGORICAL, NUMERIC)).select(
        row_id, *keep, positive_probability().alias("score")
    )
