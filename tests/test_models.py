"""Iterative and fitted operators (no SQL twin): seeded determinism, sane
ranges, better than a constant baseline, score/refit agreement."""

import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SMALL, rows
from kestrel.operators import metrics as me

QUERIES = entry.queries()


def test_regression_metrics_literal(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 2.0)], "label double, prediction double")
    r = me.regression_metrics(df).first().asDict()
    assert abs(r["mae"] - 4 / 3) < 1e-6 and abs(r["mse"] - 10 / 3) < 1e-6
    assert abs(r["rmse"] - math.sqrt(10 / 3)) < 1e-6


def test_prf_macro_literal(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 2), (2, 2)], "label int, prediction int")
    r = me.prf_macro(df).first().asDict()
    assert abs(r["accuracy"] - 0.8) < 1e-9
    assert abs(r["macro_precision"] - (1 + 0.5 + 1) / 3) < 1e-9
    assert abs(r["macro_recall"] - (0.5 + 1 + 1) / 3) < 1e-9


@pytest.mark.parametrize("key", ["linear_regression", "ridge_regression", "gamma_glm", "rf_regressor",
                                 "two_part_model"])
def test_regressors_finite(spark, key):
    out = QUERIES[key](spark, SMALL).collect()
    assert out
    for r in out:
        assert all(math.isfinite(r[m]) and r[m] >= 0 for m in ("rmse", "mse", "mae"))
        assert abs(r["rmse"] ** 2 - r["mse"]) < 1e-3 * max(1.0, r["mse"])


def test_linear_beats_constant(spark):
    from kestrel.sources import fixtures as fx

    lin = QUERIES["linear_regression"](spark, SMALL).first()
    c = fx.claims(spark, SMALL)
    mean = c.agg(F.avg("claim_amount")).first()[0]
    # the fit must not be worse than predicting the mean everywhere (on train+test)
    const = c.agg(F.avg(F.pow(F.col("claim_amount") - F.lit(mean), 2))).first()[0]
    assert lin.mse < 1.5 * const


@pytest.mark.parametrize("key", ["rf_classifier", "logistic_topics", "area_under_pr"])
def test_classifiers_in_range(spark, key):
    r = QUERIES[key](spark, SMALL).first().asDict()
    for k, v in r.items():
        if isinstance(v, float):
            assert 0.0 <= v <= 1.0, (k, v)


def test_topics_better_than_chance(spark):
    r = QUERIES["logistic_topics"](spark, SMALL).first()
    assert r.accuracy > 0.5


def test_kmeans_sizes_cover_all_rows(spark):
    from kestrel.sources import fixtures as fx

    out = QUERIES["kmeans_2d"](spark, SMALL)
    total = sum(r.size for r in out.collect())
    assert total > 0
    assert rows(out, "cluster", "size") == rows(QUERIES["kmeans_2d"](spark, SMALL), "cluster", "size")
    assert fx.vectors(spark, SMALL).count() >= total


def test_pca_ratios(spark):
    p = QUERIES["pca_project"](spark, SMALL).collect()
    ratios = [r.explained_ratio for r in p]
    assert all(0 <= x <= 1 for x in ratios) and sum(ratios) <= 1 + 1e-9
    assert ratios == sorted(ratios, reverse=True)
    mse = {r.k: r.mse for r in QUERIES["pca_reconstruct_mse"](spark, SMALL).collect()}
    ks = sorted(mse)
    assert mse[ks[-1]] <= mse[ks[0]] + 1e-12   # more components, smaller error


def test_random_split_seeded(spark):
    a = rows(QUERIES["random_split"](spark, SMALL))
    b = rows(QUERIES["random_split"](spark, SMALL))
    assert a == b
    splits = {s for s, _ in a}
    assert splits <= {"train", "test"}


def test_score_new_data_matches_refit_rows(spark):
    from kestrel.sources import fixtures as fx

    s = QUERIES["score_new_data"](spark, SMALL)
    n_test = fx.claims(spark, SMALL).count()
    assert 0 < s.count() <= n_test
    assert s.where(F.col("prediction").isNull()).count() == 0
