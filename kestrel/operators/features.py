"""ML feature stages (M1-M8): vector assembly, category indexing and one-hot
encoding, standardisation, reusable pipelines, PCA projection and
reconstruction error, class filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (PCA, CountVectorizerModel, ElementwiseProduct, OneHotEncoder, StandardScaler, StringIndexer,
                                VectorAssembler)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def assemble_vector(df: DataFrame, cols: Sequence[str], out: str = "features",
                    handle_invalid: str = "error") -> DataFrame:
    """Columns -> one vector column (M1)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid).transform(df)


def string_indexer(cols: Sequence[str], suffix: str = "_idx", handle_invalid: str = "keep") -> StringIndexer:
    """One multi-column indexer: index 0 = most frequent value, ties alphabetical (M2)."""
    return StringIndexer(inputCols=list(cols), outputCols=[c + suffix for c in cols],
                         stringOrderType="frequencyDesc", handleInvalid=handle_invalid)


def category_index(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, index): index 0 = most frequent value of its column, ties alphabetical (M2), as a table.

    The categories are ranked by the distributed ordinal and stay in Spark, however many there are; a pipeline's
    ``string_indexer`` holds its labels on the driver and suits columns of few values."""
    from kestrel.operators.splits import ordinal_by

    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    counts = df.select(F.explode(pairs).alias("p")).select("p.*").where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    placed = ordinal_by(counts.withColumn("_neg", -F.col("n")), ["column", "_neg", "value"], "_place")
    first = placed.groupBy("column").agg(F.min("_place").alias("_first"))  # one row for each column
    return placed.join(F.broadcast(first), "column").select("column", "value", (F.col("_place") - F.col("_first")).alias("index"))


def index_categories(df: DataFrame, index: DataFrame, cols: Sequence[str], suffix: str = "_idx") -> DataFrame:
    """``df`` with the index of each column's value; null for values that ``category_index`` didn't see."""
    for c in cols:
        own = index.where(F.col("column") == c).select(F.col("value").alias(f"_{c}"), F.col("index").cast("double").alias(c + suffix))
        df = df.join(own, F.col(c).cast("string") == F.col(f"_{c}"), "left").drop(f"_{c}")
    return df


def encode_categories(df: DataFrame, index: DataFrame, cols: Sequence[str], suffix: str = "_ohe") -> DataFrame:
    """``df`` with a sparse one-hot vector for each column, as long as the column has indexed values; unseen values
    and nulls are all zeros (M3). The encoder is fitted on the number of values alone."""
    sizes = {r["column"]: r.n for r in index.groupBy("column").agg(F.max("index").alias("n")).collect()}  # one row for each column
    cols = [c for c in cols if c in sizes]
    spark = df.sparkSession
    most = spark.createDataFrame([[float(sizes[c]) for c in cols]], ", ".join(f"`{c}_idx` double" for c in cols))
    model = OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[c + suffix for c in cols], handleInvalid="keep", dropLast=True).fit(most)
    indexed = index_categories(df, index, cols)
    # one more than the last index is the place of what wasn't seen, which the encoder drops
    known = indexed.withColumns({f"{c}_idx": F.coalesce(f"{c}_idx", F.lit(float(sizes[c] + 1))) for c in cols})
    return model.transform(known).drop(*[f"{c}_idx" for c in cols])


def one_hot_stages(cols: Sequence[str]) -> list:
    """Indexer (unseen -> extra index) + encoder with the last slot dropped, so
    an unseen category encodes as all zeros (M3)."""
    idx = string_indexer(cols, "_idx", "keep")
    enc = OneHotEncoder(inputCols=[c + "_idx" for c in cols], outputCols=[c + "_ohe" for c in cols],
                        dropLast=True)
    return [idx, enc]


def standardize(df: DataFrame, cols: Sequence[str], ddof: int = 0, suffix: str = "") -> DataFrame:
    """(x - mean) / std per column, std with ``ddof`` 0 (population) or 1
    (sample) (M4). Means and deviations come from one aggregation (two numbers
    per column)."""
    std = F.stddev_pop if ddof == 0 else F.stddev_samp
    stats = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[std(c).alias(f"s_{c}") for c in cols]).first()
    out = [F.col(c) for c in df.columns if not (suffix == "" and c in cols)]
    for c in cols:
        m, s = stats[f"m_{c}"], stats[f"s_{c}"]
        out.append(F.try_divide(F.col(c) - F.lit(m), F.lit(s)).alias(c + suffix))
    return df.select(*out)


def feature_pipeline(cat_cols: Sequence[str], num_cols: Sequence[str], out: str = "features",
                     scale: bool = True) -> Pipeline:
    """Index + encode categories, scale the numeric columns, assemble both (M5).
    Only the numeric columns are centred: the encoded ones stay sparse. The
    fitted PipelineModel is what scoring re-applies to new data."""
    stages = one_hot_stages(cat_cols) if cat_cols else []
    encoded = [c + "_ohe" for c in cat_cols]
    if not scale or not num_cols:
        return Pipeline(stages=[*stages, VectorAssembler(inputCols=[*num_cols, *encoded], outputCol=out, handleInvalid="keep")])
    return Pipeline(stages=[
        *stages, VectorAssembler(inputCols=list(num_cols), outputCol=out + "_raw", handleInvalid="keep"),
        StandardScaler(inputCol=out + "_raw", outputCol=out + "_scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=[out + "_scaled", *encoded], outputCol=out, handleInvalid="keep")])


def tfidf_stages(vocabulary: Sequence[str], idf: Sequence[float], tokens: str, out: str) -> list:
    """Array of features -> sparse tf-idf vector over a bounded vocabulary (F9-F11): counts by position in ``vocabulary``,
    times ``idf``. Rows stay rows: nothing is exploded, and the vectors hold a document's own features only."""
    return [CountVectorizerModel.from_vocabulary(list(vocabulary), inputCol=tokens, outputCol=out + "_counts"),
            ElementwiseProduct(scalingVec=Vectors.dense(list(idf)), inputCol=out + "_counts", outputCol=out)]


def pca_fit(df: DataFrame, k: int, features: str = "features") -> PipelineModel:
    """Centre + PCA(k) (M6)."""
    sc = StandardScaler(inputCol=features, outputCol="_centred", withMean=True, withStd=False)
    pca = PCA(k=k, inputCol="_centred", outputCol="pca")
    return Pipeline(stages=[sc, pca]).fit(df)


def pca_components(spark: SparkSession, model: PipelineModel, total_variance: float | None = None) -> DataFrame:
    """(component, explained_ratio, eigenvalue) -- eigenvalue = ratio x total
    variance when the total is given."""
    pca = model.stages[-1]
    ratios = [float(x) for x in pca.explainedVariance]
    rows = [(i, r, r * total_variance if total_variance is not None else None) for i, r in enumerate(ratios)]
    return spark.createDataFrame(rows, "component int, explained_ratio double, eigenvalue double")


def total_variance(df: DataFrame, features: str = "features") -> float:
    """Sum of the per-dimension sample variances (one aggregation)."""
    v = df.agg(Summarizer.variance(F.col(features)).alias("v")).first().v
    return float(v.toArray().sum())


def pca_reconstruct_mse(df: DataFrame, model: PipelineModel, features: str = "features") -> DataFrame:
    """One row: mean squared error between the centred vectors and their
    back-projection from k components (M7). Each component (a column of the
    d x k matrix) enters the plan as a literal array, so the expression size is
    fixed by d and k, and the work stays in array functions per row."""
    pca = model.stages[-1]
    pc = pca.pc.toArray()  # d x k
    d, k = pc.shape
    t = model.transform(df).select(vector_to_array("_centred").alias("x"), vector_to_array("pca").alias("z"))
    rec = F.array_repeat(F.lit(0.0), d)
    for i in range(k):
        comp = F.array(*[F.lit(float(v)) for v in pc[:, i]])
        rec = F.zip_with(rec, comp, _axpy(F.col("z")[i]))
    sq = F.zip_with(F.col("x"), rec, lambda a, b: (a - b) * (a - b))
    err = F.aggregate(sq, F.lit(0.0), lambda acc, v: acc + v)
    return t.agg(F.avg(err / F.lit(float(d))).alias("mse"))


def _axpy(scale):
    def f(acc, c):
        return acc + scale * c

    return f


def filter_two_classes(df: DataFrame, a: int, b: int, label: str = "label") -> DataFrame:
    """Rows of two classes (M8)."""
    return df.where(F.col(label).isin(a, b))


def with_vector(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    """array<float> column -> ML vector column."""
    return df.withColumn(out, array_to_vector(F.col(array_col)))
