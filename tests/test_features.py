"""Category tables against the pipeline's indexer, sparse text spaces, and shared fits of grids."""

import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SMALL, rows
from kestrel.operators import features as fe
from kestrel.operators import models as mo


def test_category_index_equals_the_indexer(spark):
    df = spark.createDataFrame([("b", "x"), ("b", "y"), ("a", "y"), ("c", None), ("a", "z"), (None, "z")] * 3, "p string, q string")
    index = fe.category_index(df, ["p", "q"])
    model = fe.string_indexer(["p", "q"], handle_invalid="skip").fit(df)
    want = sorted((c, v, i) for c, labels in zip(["p", "q"], model.labelsArray) for i, v in enumerate(labels))
    assert rows(index, "column", "value", "index") == want


def test_encoded_categories_are_sparse_and_unseen_ones_empty(spark):
    train = spark.createDataFrame([("b",), ("b",), ("a",), ("c",)], "p string")
    seen = fe.category_index(train, ["p"])
    got = fe.encode_categories(spark.createDataFrame([(1, "a"), (2, "b"), (3, "new"), (4, None)], "id int, p string"), seen, ["p"])
    assert {r.id: (r.v.size, list(r.v.indices)) for r in got.select("id", F.col("p_ohe").alias("v")).collect()} == {1: (3, [1]), 2: (3, [0]), 3: (3, []), 4: (3, [])}


def test_many_categories_stay_in_tables(spark):
    df = spark.range(300_000).select("id", F.concat(F.lit("c"), F.col("id").cast("string")).alias("c"))
    index = fe.category_index(df, ["c"])
    got = fe.encode_categories(df.where("id % 100000 = 7"), index, ["c"]).collect()
    place = {v: i for i, v in enumerate(sorted(f"c{i}" for i in range(300_000)))}
    assert len(got) == 3
    for r in got:
        assert r.c_ohe.size == 300_000 and list(r.c_ohe.indices) == [place[r.c]]


def test_tfidf_stages(spark):
    from pyspark.ml import Pipeline

    df = spark.createDataFrame([(["a", "b", "a", "z"],), ([],)], "toks array<string>")
    stages = fe.tfidf_stages(["b", "a"], [0.5, 2.0], "toks", "v")
    got = Pipeline(stages=stages).fit(df).transform(df).select(vector_to_array("v")).collect()
    assert sorted(r[0] for r in got) == [[0.0, 0.0], [0.5, 4.0]]


def _points(spark, n=300):
    df = spark.range(n).select("id", (F.col("id") % 17 / 17.0).alias("a"), (F.col("id") * 7 % 23 / 23.0).alias("b"))
    df = df.withColumn("label", ((F.col("a") > 0.4) != (F.col("b") > 0.6)).cast("double"))
    return fe.assemble_vector(df, ["a", "b"]).cache()


def test_boosting_grid_scores_equal_separate_fits(spark):
    df = _points(spark)
    points = dict((tuple(sorted(p.items())), a) for p, a in mo.gbt_grid(df, [1, 3], [2, 4], ["all"], n_folds=2, seed=3))
    assert len(points) == 4
    for depth, n in ((1, 2), (3, 4), (3, 2)):
        scores = []
        for train, held in mo.folds(df, 2, 3):
            model = mo.classifier("gbt", maxDepth=depth, maxIter=n, featureSubsetStrategy="all", seed=3).fit(train)
            scores.append(model.transform(held).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0])
        assert points[(("featureSubsetStrategy", "all"), ("maxDepth", depth), ("maxIter", n))] == pytest.approx(sum(scores) / 2)
    df.unpersist()


def test_perceptron_grid_has_every_point(spark):
    df = _points(spark, 120)
    points = mo.mlp_grid(df, [2, 3, 2], [3, 6], [64, 128], [0.01, 0.03], n_folds=2)
    assert len(points) == 8 and len({tuple(sorted(p.items())) for p, _ in points}) == 8 and all(0 <= a <= 1 for _, a in points)
    best = mo.best_point(points)
    assert max(a for _, a in points) == dict((tuple(p.items()), a) for p, a in points)[tuple(best.items())]
    df.unpersist()


def test_gamma_identity_recovers_a_line(spark):
    df = spark.range(400).select((F.col("id") % 20 / 2.0).alias("x"), (F.col("id") % 7 / 7.0).alias("z"))
    df = fe.assemble_vector(df.withColumn("y", 3.0 + 2.0 * F.col("x") + 5.0 * F.col("z")), ["x", "z"]).cache()
    model = mo.gamma_identity(df, "y")
    assert [round(float(c), 3) for c in model.model.coefficients] == [2.0, 5.0] and model.model.intercept == pytest.approx(3.0, abs=1e-3)
    # a line that would go below zero stays positive
    low = fe.assemble_vector(df.select("x", "z").withColumn("y", F.greatest(F.lit(0.01), 4 - F.col("x"))), ["x", "z"]).cache()
    pred = mo.gamma_identity(low, "y").transform(low).agg(F.min("prediction"), F.max("prediction")).first()
    assert pred[0] > 0 and math.isfinite(pred[1])
    df.unpersist()
    low.unpersist()


def test_text_spaces(spark):
    from kestrel.plans import ml

    docs = ml._topic_docs(spark, SMALL)
    vectors, vocabularies = ml._text_spaces(docs)
    r = vectors.first()
    assert r.both.size == r.words.size + r.characters.size == len(vocabularies["words"]) + len(vocabularies["characters"])
    # values of one document against the formula
    train = {x.doc_id: x.toks for x in docs.where("split = 'train'").collect()}
    one = vectors.where("split = 'train'").orderBy("doc_id").first()

    grams = {d: [" ".join(t[i:i + n]) for n in (1, 2, 3) for i in range(len(t) - n + 1)] for d, t in train.items()}
    sets = {d: set(g) for d, g in grams.items()}
    for i in one.words.indices[:20]:
        word = vocabularies["words"][int(i)]
        df = sum(word in s for s in sets.values())
        assert one.words[int(i)] == pytest.approx(grams[one.doc_id].count(word) * math.log10(len(train) / df))


def test_folds_have_few_tasks(spark):
    from kestrel.operators import models as mo

    df = spark.range(400).selectExpr("id", "id % 2 as label").repartition(16).cache()
    for (train, held), (plain, own) in zip(mo.numbered_folds(df, 5, 3), mo.folds(df, 5, 3)):
        assert train.rdd.getNumPartitions() == 1 < plain.rdd.getNumPartitions()
        assert rows(held) == rows(own) and rows(train) == rows(plain)
    df.unpersist()
