"""Evaluation metrics (V4-V11, B7) as single aggregations over prediction
tables; Spark ML evaluators only where a curve is needed (area under PR)."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: rmse, mse, mae -- one pass instead of one evaluator job each (V4)."""
    err = F.col(prediction).cast("double") - F.col(label).cast("double")
    m = pred.agg(F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"))
    return m.select(F.sqrt("mse").alias("rmse"), "mse", "mae")


def regression_metrics_each(pred: DataFrame, named: Sequence[tuple[dict, str]], label: str = "label") -> DataFrame:
    """``regression_metrics`` of several prediction columns in one pass: a row for each ({column: literal}, prediction)."""
    err = [F.col(p).cast("double") - F.col(label).cast("double") for _, p in named]
    m = pred.agg(*[a for i, e in enumerate(err) for a in (F.avg(e * e).alias(f"mse{i}"), F.avg(F.abs(e)).alias(f"mae{i}"))])
    rows = [F.struct(*[F.lit(v).alias(k) for k, v in own.items()], F.sqrt(f"mse{i}").alias("rmse"), F.col(f"mse{i}").alias("mse"),
                     F.col(f"mae{i}").alias("mae")) for i, (own, _) in enumerate(named)]
    return m.select(F.inline(F.array(*rows)))


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: share of correct predictions (V5)."""
    return pred.agg(F.avg((F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double"))
                    .alias("accuracy"))


def area_under_pr(pred: DataFrame, label: str = "label", raw: str = "rawPrediction") -> float:
    """Area under the precision-recall curve of the given predictions (V6)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, metricName="areaUnderPR")
    return ev.evaluate(pred)


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n) long form (V8); pivot for display if wanted."""
    return pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def _class_counts(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    """(class, support, n_pred, tp) from one count of the confusion cells."""
    cells = confusion_matrix(pred, label, prediction)
    n, zero = F.col("n"), F.lit(0).cast("long")
    same = F.when(F.col("label").cast("double") == F.col("prediction").cast("double"), n).otherwise(zero)
    sides = F.array(
        F.struct(F.col("label").cast("double").alias("class"), n.alias("support"), zero.alias("n_pred"), same.alias("tp")),
        F.struct(F.col("prediction").cast("double").alias("class"), zero.alias("support"), n.alias("n_pred"), zero.alias("tp")))
    return cells.select(F.inline(sides)).groupBy("class").agg(*(F.sum(c).alias(c) for c in ("support", "n_pred", "tp")))


def prf_per_class(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(class, precision, recall, f1, support, tp) from confusion counts."""
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    j = _class_counts(pred, label, prediction).select(
        "class", ratio(F.col("tp"), F.col("n_pred")).alias("precision"), ratio(F.col("tp"), F.col("support")).alias("recall"), "support", "tp")
    return j.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def prf_macro(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy and macro precision / recall / F1 (V7), one pass over the predictions."""
    return prf_per_class(pred, label, prediction).agg(
        F.try_divide(F.sum("tp").cast("double"), F.sum("support").cast("double")).alias("accuracy"),
        F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"), F.avg("f1").alias("macro_f1"))


def log_loss(df: DataFrame, p_true: str, eps: float = 1e-15) -> DataFrame:
    """One row: mean cross entropy -ln p(true class), p clipped to [eps, 1-eps] (V9)."""
    p = F.least(F.greatest(F.col(p_true).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    return df.agg(F.avg(-F.log(p)).alias("log_loss"))


def top_features(spark: SparkSession, weights: Sequence[float], names: Sequence[str], k: int = 3,
                 group: str | None = None) -> DataFrame:
    """(feature, weight, rank) of the k largest absolute weights or importances
    (V10). A model's weight vector has one entry per feature, so it is a
    schema-sized table."""
    from pyspark.sql import Window

    df = spark.createDataFrame([(n, float(w)) for n, w in zip(names, weights)], "feature string, weight double")
    order = [F.desc(F.abs("weight")), F.asc("feature")]
    # a top-k plan; only the k rows are numbered
    out = df.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    return out.withColumn("group", F.lit(group)) if group else out


class StageTimer:
    """Wall time of named stages (V11): ``with timer("fit"): model = est.fit(df)``."""

    def __init__(self):
        self.rows: list[tuple[str, float]] = []

    def __call__(self, name: str):
        timer = self

        class _Ctx:
            def __enter__(self):
                self.t0 = time.perf_counter()

            def __exit__(self, *exc):
                timer.rows.append((name, (time.perf_counter() - self.t0) / 60.0))

        return _Ctx()

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "stage string, minutes double")
