"""Estimators and tuning as Spark ML jobs.

Each helper returns a fitted model or a small metrics DataFrame computed by
Spark aggregations over the prediction table; nothing iterates over rows in
Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, MulticlassClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (GBTRegressor, GeneralizedLinearRegression, LinearRegression,
                                   RandomForestRegressor)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators import boosting
from kestrel.session import persist

CLASSIFIERS = {
    "rf": RandomForestClassifier,
    "gbt": GBTClassifier,
    "mlp": MultilayerPerceptronClassifier,
    "logistic": LogisticRegression,
}
REGRESSORS = {
    "linear": LinearRegression,
    "rf": RandomForestRegressor,
    "gbt": GBTRegressor,
    "glm": GeneralizedLinearRegression,
}


def classifier(name: str, label: str = "label", features: str = "features", **params):
    return CLASSIFIERS[name](labelCol=label, featuresCol=features, **params)


def regressor(name: str, label: str = "label", features: str = "features", **params):
    return REGRESSORS[name](labelCol=label, featuresCol=features, **params)


def logistic(family: str = "binomial", reg: float = 0.0, l1: bool = False, label: str = "label",
             features: str = "features", **params) -> LogisticRegression:
    """Binary or multinomial logistic regression with none / L2 / L1 penalty."""
    return LogisticRegression(labelCol=label, featuresCol=features, family=family, regParam=reg,
                              elasticNetParam=1.0 if l1 else 0.0, **params)


def ridge(alpha: float, n_rows: int, label_std: float, label: str = "label",
          features: str = "features") -> LinearRegression:
    """Ridge with the penalty alpha * ||w||^2 of least squares written as a sum
    (G12). Spark minimises 1/(2n) * RSS + regParam/2 * ||w||^2 with the
    penalty scaled by the label's std, so regParam = alpha * std_y / n. The
    normal-equation solver takes 4,096 features at most; wider inputs raise."""
    return LinearRegression(labelCol=label, featuresCol=features, regParam=ridge_penalty(alpha, n_rows, label_std),
                            elasticNetParam=0.0, standardization=False, solver="normal")


def ridge_penalty(alpha: float, n_rows: int, label_std: float) -> float:
    return alpha * label_std / n_rows


def gamma_glm(link: str = "identity", label: str = "label", features: str = "features", **params):
    """Gamma GLM for positive amounts (G15); ``link='log'`` when identity does
    not converge."""
    return GeneralizedLinearRegression(labelCol=label, featuresCol=features, family="gamma", link=link, **params)


class PositiveModel:
    """A linear model whose predictions stay at ``least`` or above."""

    def __init__(self, model, least: float):
        self.model, self.least = model, least

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df).withColumn("prediction", F.greatest("prediction", F.lit(self.least)))


def gamma_identity(df: DataFrame, label: str = "label", features: str = "features", reg: float = 0.0, weight: str | None = None,
                   max_iter: int = 50, tol: float = 1e-3, share: float = 0.01) -> PositiveModel:
    """Gamma regression with identity link over any number of features (G15): iteratively reweighted least squares, where a
    row weighs 1 / mean^2. A linear predictor isn't positive by itself, and a mean near zero would outweigh all other rows, so
    means are held at ``share`` of the average amount or above. Stops when the coefficients have settled.

    ``df`` is read once an iteration: persist it."""
    base = F.col(weight).cast("double") if weight else F.lit(1.0)
    least = share * float(df.agg(F.avg(label)).first()[0])
    mean, before, model, current = F.greatest(F.col(label), F.lit(least)), None, None, df
    for _ in range(max_iter):
        rows = current.withColumn("_w", base / (mean * mean) * F.lit(least * least))
        model = LinearRegression(labelCol=label, featuresCol=features, regParam=reg, weightCol="_w").fit(rows)
        now = [*model.coefficients, model.intercept]
        size = sum(x * x for x in now) ** 0.5
        if before is not None and sum((a - b) ** 2 for a, b in zip(now, before)) ** 0.5 <= tol * max(size, 1e-12):
            break
        before = now
        # one projection over the last model, never a chain over all of them
        mean = F.col("_mean")
        current = PositiveModel(model, least).transform(df).withColumnRenamed("prediction", "_mean")
    return PositiveModel(model, least)


def two_part(cls: str, amount: str):
    """The prediction of a two-part model from the predicted class and amount: classifier says zero -> 0."""
    return F.when(F.col(cls) == 0, F.lit(0.0)).otherwise(F.col(amount))


def two_part_predict(df: DataFrame, cls_model, reg_model, features: str = "features",
                     out: str = "prediction") -> DataFrame:
    """Classifier says zero -> 0, otherwise the regressor's amount (G16), as
    one projection over both models' outputs."""
    c = cls_model.transform(df).withColumnRenamed("prediction", "_cls").drop("rawPrediction", "probability")
    r = reg_model.transform(c).withColumnRenamed("prediction", "_amt")
    return r.withColumn(out, two_part("_cls", "_amt")).drop("_cls", "_amt")


def kmeans(df: DataFrame, k: int, seed: int = 42, features: str = "features"):
    return KMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster").fit(df)


def cross_validate(df: DataFrame, pipeline: Pipeline, grid: list, evaluator, folds: int = 5,
                   seed: int = 42, parallelism: int = 2):
    """k-fold grid search (V1); returns the fitted CrossValidatorModel."""
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds,
                        seed=seed, parallelism=parallelism)
    return cv.fit(df)


def shuffle_split(df: DataFrame, pipeline: Pipeline, grid: list, evaluator, seeds: Sequence[int] = (0, 1, 2, 3, 4),
                  train_ratio: float = 0.9) -> DataFrame:
    """Repeated random train/validation splits (V2): mean metric per grid point."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    rows = []
    for s in seeds:
        tvs = TrainValidationSplit(estimator=pipeline, estimatorParamMaps=grid, evaluator=evaluator,
                                   trainRatio=train_ratio, seed=s).fit(df)
        rows += [(s, i, float(m)) for i, m in enumerate(tvs.validationMetrics)]
    # one row per (seed, grid point): bounded by the grid, not the data
    t = spark.createDataFrame(rows, "seed int, grid_point int, metric double")
    return t.groupBy("grid_point").agg(F.avg("metric").alias("mean_metric"))


def grid(est, **values) -> list:
    """ParamGridBuilder over named parameters of ``est``."""
    b = ParamGridBuilder()
    for k, v in values.items():
        b = b.addGrid(getattr(est, k), list(v))
    return b.build()


def best_params(cv_model, names: Sequence[str]) -> dict:
    best = cv_model.bestModel.stages[-1]
    return {n: best.getOrDefault(getattr(best, n)) for n in names}


#: Rows that are worth a task of an iterative fit, whose jobs are many and short.
TASK_ROWS = 10_000


def few_tasks(df: DataFrame) -> DataFrame:
    """``df`` in no more partitions than it has ``TASK_ROWS`` rows: a fit of hundreds of jobs starts every task of each of them."""
    most = max(1, -(-df.count() // TASK_ROWS))
    return df.coalesce(most)


def folds(df: DataFrame, n: int = 5, seed: int = 42) -> list[tuple[DataFrame, DataFrame]]:
    """(training, validation) parts of a seeded n-fold split of a persisted or written frame."""
    parts = df.randomSplit([1.0] * n, seed)
    rest = lambda i: reduce(DataFrame.unionByName, [p for j, p in enumerate(parts) if j != i])
    return [(rest(i), parts[i]) for i in range(n)]


def with_folds(df: DataFrame, n: int = 5, seed: int = 42) -> DataFrame:
    """The rows of ``folds`` with the number of their part, persisted in no more partitions than the rows are worth."""
    parts = [p.withColumn("_fold", F.lit(i)) for i, p in enumerate(df.randomSplit([1.0] * n, seed))]
    return persist(few_tasks(reduce(DataFrame.unionByName, parts)))


def numbered_folds(df: DataFrame, n: int = 5, seed: int = 42) -> list[tuple[DataFrame, DataFrame]]:
    """The rows of ``folds``, persisted once with their numbers: a training part has no more partitions than its rows are worth."""
    numbered = with_folds(df, n, seed)
    return [(numbered.where(F.col("_fold") != i).drop("_fold"), numbered.where(F.col("_fold") == i).drop("_fold")) for i in range(n)]


def _accuracies(df: DataFrame, columns: Sequence[str], label: str) -> list[float]:
    """Share of rows whose label equals each of several prediction columns, in one pass."""
    hit = lambda c: F.avg((F.col(c) == F.col(label)).cast("double"))
    return [float(x or 0.0) for x in df.agg(*[hit(c) for c in columns]).first()]


def first_iterations(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The boosted model as it was after ``n`` iterations: its first trees with their weights."""
    from pyspark import SparkContext

    sc, java = SparkContext._active_spark_context, model._java_obj
    every, weights = java.trees(), java.treeWeights()
    n = min(n, len(every))
    trees = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    own = sc._gateway.new_array(sc._jvm.double, n)
    for i in range(n):
        trees[i], own[i] = every[i], weights[i]
    short = GBTClassificationModel(sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, own))
    return short.setFeaturesCol(model.getFeaturesCol())


def gbt_grid(df: DataFrame, depths: Sequence[int], iterations: Sequence[int], subsets: Sequence[str], n_folds: int = 5, label: str = "label",
             features: str = "features", seed: int = 42, parallelism: int = 4) -> list[tuple[dict, float]]:
    """(parameters, mean accuracy over folds) for every point of the grid of boosted trees.

    Boosting adds one tree after another, so the model of fewer iterations is the beginning of the longer one: each
    depth, subset strategy and fold is fitted once, with the most iterations, and scored at all of them. A fit whose rows
    one task can hold is done there (``boosting``); a larger one is Spark's."""
    marks, numbered = sorted(iterations), with_folds(df, n_folds, seed)
    jobs = [(i, d, s) for i in range(n_folds) for d in depths for s in subsets]
    first = numbered.select(F.size(vector_to_array(features)).alias("n")).first()
    if first is not None and numbered.count() * max(1, first.n) <= boosting.MOST_CELLS:
        rows = numbered.select("_fold", F.col(label).cast("double"), vector_to_array(features))
        hits = boosting.grid_hits(rows, jobs, marks, seed)
        scored = {job: [x / n if n else 0.0 for x in own] for job, (n, own) in hits.items()}
    else:
        scored = _boosted_by_spark(numbered, jobs, marks, label, features, seed, parallelism)
    return [({"maxDepth": d, "maxIter": i, "featureSubsetStrategy": s}, sum(scored[f, d, s][k] for f in range(n_folds)) / n_folds)
            for d, s in sorted({(d, s) for _, d, s in jobs}) for k, i in enumerate(marks)]


def _boosted_by_spark(numbered: DataFrame, jobs: Sequence[tuple[int, int, str]], marks: Sequence[int], label: str, features: str, seed: int,
                      parallelism: int) -> dict[tuple[int, int, str], list[float]]:
    """Accuracies at ``marks`` of each (fold, depth, subset strategy), each a Spark fit over all rows of the other folds."""

    def one(job):
        fold, depth, subset = job
        train, held = (numbered.where(c).drop("_fold") for c in (F.col("_fold") != fold, F.col("_fold") == fold))
        model = GBTClassifier(labelCol=label, featuresCol=features, maxDepth=depth, maxIter=marks[-1], featureSubsetStrategy=subset, seed=seed).fit(train)
        out = held.select(label, features)
        for n in marks:
            out = first_iterations(model, n).setPredictionCol(f"_at{n}").setRawPredictionCol("").setProbabilityCol("").transform(out)
        return job, _accuracies(out, [f"_at{n}" for n in marks], label)

    with ThreadPool(parallelism) as pool:
        return dict(pool.imap_unordered(one, jobs))


def mlp_grid(df: DataFrame, layers: Sequence[int], iterations: Sequence[int], blocks: Sequence[int], steps: Sequence[float], n_folds: int = 5,
             label: str = "label", features: str = "features", seed: int = 42, parallelism: int = 4) -> list[tuple[dict, float]]:
    """(parameters, mean accuracy over folds) for every point of the grid of perceptrons.

    The solver is L-BFGS, by default: it has no step size, and the size of the blocks that rows are stacked
    in changes the speed only. Points that differ in these alone are one fit for each fold."""

    def one(job):
        (train, held), n = job
        model = MultilayerPerceptronClassifier(labelCol=label, featuresCol=features, layers=list(layers), maxIter=n, blockSize=max(blocks), seed=seed).fit(train)
        return n, _accuracies(model.transform(held), ["prediction"], label)[0]

    found: dict[int, list] = {}
    with ThreadPool(parallelism) as pool:
        for n, score in pool.imap_unordered(one, [(part, n) for part in folds(df, n_folds, seed) for n in iterations]):
            found.setdefault(n, []).append(score)
    return [({"maxIter": n, "blockSize": b, "stepSize": s}, sum(scores) / len(scores)) for n, scores in sorted(found.items()) for b in blocks for s in steps]


def best_point(points: list[tuple[dict, float]]) -> dict:
    """The parameters of the first point with the highest score."""
    return max(points, key=lambda p: p[1])[0]


def classification_scores(pred: DataFrame, label: str = "label") -> DataFrame:
    """One row: accuracy (aggregation) and area under PR (evaluator) of the
    SAME predictions (V5, V6)."""
    from pyspark.sql import SparkSession

    acc = pred.agg(F.avg((F.col(label).cast("double") == F.col("prediction")).cast("double")).alias("accuracy"))
    aupr = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderPR").evaluate(pred)
    spark = SparkSession.getActiveSession()
    return acc.withColumn("area_under_pr", F.lit(float(aupr))) if spark else acc


EVALUATORS = {
    "aupr": lambda label: BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderPR"),
    "accuracy": lambda label: MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy"),
    "f1": lambda label: MulticlassClassificationEvaluator(labelCol=label, metricName="f1"),
    "rmse": lambda label: RegressionEvaluator(labelCol=label, metricName="rmse"),
    "mae": lambda label: RegressionEvaluator(labelCol=label, metricName="mae"),
}
