"""The boosted grid: what it learns from, and its trees against Spark's."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors

from conftest import SMALL, rows
from kestrel.operators import boosting
from kestrel.operators import metrics as me
from kestrel.operators import models as mo
from kestrel.plans import ml
from kestrel.session import reuse


def test_boosted_grid_learns_from_all_training_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(mo, "gbt_grid", lambda df, **_: seen.extend(rows(df, "vec_id")) or [({"maxDepth": 1}, 0.5)])
    ml.q_gbt_grid(spark, SMALL)
    assert seen == rows(ml._wide(spark, SMALL).where("split = 'train'"), "vec_id")


def _wide_points(spark, n=700, width=12):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, width)).astype(np.float32).astype(float)
    x[:, 3] = np.round(x[:, 3])                       # few values
    x[:, 4] = 1.0                                     # no split at all
    y = ((x[:, 0] * x[:, 1] > 0) ^ (x[:, 2] + 0.5 * x[:, 3] > 0.4)).astype(float)
    return spark.createDataFrame([(float(a), Vectors.dense(b)) for a, b in zip(y, x)], ["label", "features"]).coalesce(1).cache()


@pytest.mark.parametrize("subset", ["all", "sqrt", "log2"])
def test_trees_in_a_task_are_sparks(spark, subset):
    df = _wide_points(spark)
    numbered = mo.with_folds(df, 3, 7)
    jobs = [(1, 1, subset), (2, 4, subset), (0, 12, subset)]
    want = mo._boosted_by_spark(numbered, jobs, [1, 5, 9], "label", "features", 7, 4)
    hits = boosting.grid_hits(numbered.select("_fold", "label", vector_to_array("features")), jobs, [1, 5, 9], 7)
    got = {job: [x / n for x in own] for job, (n, own) in hits.items()}
    assert {job: got[job] for job in jobs[:2]} == {job: want[job] for job in jobs[:2]}
    # nodes of a few rows have splits that are equally good, between which the last bit decides
    assert got[jobs[2]] == pytest.approx(want[jobs[2]], abs=0.06)
    df.unpersist()


def test_boosted_grid_starts_few_jobs(spark):
    df = _wide_points(spark, 200)
    group = "boosted-grid-jobs"
    spark.sparkContext.setJobGroup(group, group)
    got = mo.gbt_grid(df, [1, 5], [3, 6], ["all", "sqrt"], n_folds=2, seed=3)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(got) == 8 and all(0 <= a <= 1 for _, a in got)
    assert 0 < len(jobs) < 15
    df.unpersist()


def test_more_rows_than_a_task_holds_go_to_spark(spark, monkeypatch):
    df = _wide_points(spark, 200)
    want = mo.gbt_grid(df, [2], [2, 3], ["all"], n_folds=2, seed=3)
    monkeypatch.setattr(boosting, "MOST_CELLS", 100)
    assert mo.gbt_grid(df, [2], [2, 3], ["all"], n_folds=2, seed=3) == want
    df.unpersist()


def test_metrics_of_several_predictions(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (3.0, 3.0, None), (5.0, 2.0, 4.0)], "y double, p double, q double")
    got = {r.name: r[1:] for r in me.regression_metrics_each(df, [({"name": "p"}, "p"), ({"name": "q"}, "q")], "y").collect()}
    assert got == {c: tuple(me.regression_metrics(df, "y", c).first()) for c in ("p", "q")}


@pytest.mark.parametrize("query, n", [(ml.q_ridge_regression, 4), (ml.q_two_part_grid, 8)])
def test_claims_are_scored_in_one_pass(spark, query, n):
    with reuse(spark):
        out = query(spark, SMALL)
        assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [l_orderkey") == 1
        assert out.count() == n
