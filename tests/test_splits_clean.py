from pyspark.sql import functions as F

from conftest import rows
from kestrel.operators import clean as cl
from kestrel.operators import splits as sp


def test_ordinal_matches_row_number_with_hot_key(spark):
    # a third of the rows share one timestamp: the tie-breaker spreads them
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 101).alias("ts"), F.col("id"))
    o = sp.ordinal_by(df, ["ts", "id"], partitions=8)
    want = [(ts, i) for ts, i in sorted((r.ts, r.id) for r in df.collect())]
    got = [(r.ts, r.id) for r in o.orderBy("ordinal").collect()]
    assert got == want
    assert rows(o.agg(F.min("ordinal"), F.max("ordinal"), F.count_distinct("ordinal"))) == [(1, 3000, 3000)]


def test_sequential_split_sizes(spark):
    df = spark.range(101).withColumn("ts", F.col("id") * 2)
    for frac in (0.5, 0.65, 0.8):
        s = sp.sequential_split(df, ["ts", "id"], frac)
        n_train = s.where("split = 'train'").count()
        assert n_train == int(101 * frac)
        assert s.count() == 101
        # every train row precedes every test row
        mx = s.where("split = 'train'").agg(F.max("ts")).first()[0]
        mn = s.where("split = 'test'").agg(F.min("ts")).first()[0]
        assert mx < mn


def _check_selection(df, cols, positions):
    """``row_at`` and ``up_to`` against a full sort."""
    key = [F.unix_micros(c).alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes if c in cols]
    order = df.select(*key).orderBy(*[F.col(c).asc_nulls_first() for c in cols]).collect()
    for p in positions:
        got = sp.row_at(df, cols, p)
        assert repr(tuple(got[c] for c in cols)) == repr(tuple(order[p - 1][c] for c in cols)), p
        last = max(i for i, r in enumerate(order, 1) if repr(r) == repr(order[p - 1]))
        assert df.where(sp.up_to(df, cols, got)).count() == last


def test_selection_with_nulls_nan_and_instants(spark, monkeypatch):
    monkeypatch.setattr(sp, "FEW", 20)
    monkeypatch.setattr(sp, "SAMPLE", 100)
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 != 0, (F.col("id") * 7919) % 500).alias("k"),
                                  F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).when(F.col("id") % 7 != 0, F.rand(1)).alias("x"),
                                  F.timestamp_seconds(F.col("id") % 37 * 86400).alias("ts"), F.md5(F.col("id").cast("string")).alias("s"))
    for cols in (["k", "id"], ["x", "id"], ["ts", "s"], ["s"]):
        _check_selection(df, cols, [1, 2, 666, 667, 1000, 1999, 2000])
    assert sp.row_at(df, ["id"], 0) is None and sp.row_at(df, ["id"], 2001) is None and sp.row_at(df.limit(0), ["id"], 1) is None


def test_selection_with_one_key(spark, monkeypatch):
    monkeypatch.setattr(sp, "FEW", 20)
    monkeypatch.setattr(sp, "SAMPLE", 100)
    df = spark.range(1500).select(F.lit(5).alias("k"), "id", F.lit(None).cast("int").alias("nothing"))
    _check_selection(df, ["k", "id"], [1, 750, 1500])
    _check_selection(df, ["k"], [1, 1500])
    _check_selection(df, ["nothing"], [700])
    _check_selection(df, ["nothing", "id"], [700])


def test_selection_sorts_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(sp, "FEW", 50)
    monkeypatch.setattr(sp, "SAMPLE", 400)
    df = spark.range(200_000).select((F.col("id") * 48271 % 2147483647).alias("k"))
    assert sp.row_at(df, ["k"], 123_456).k == sorted(i * 48271 % 2147483647 for i in range(200_000))[123_455]


def test_split_ends_with_missing_keys(spark):
    df = spark.createDataFrame([(i, None if i < 5 else i) for i in range(10)], "id int, ts int")
    got = {r.id: r.split for r in sp.sequential_split(df, ["ts", "id"], 0.8).collect()}
    assert [i for i, x in got.items() if x == "test"] == [8, 9]
    assert sp.sequential_split(df.withColumn("ts", F.lit(None).cast("int")), ["ts", "id"], 0.5).where("split = 'train'").count() == 5


def test_time_splits(spark):
    from kestrel.operators.recsys import time_splits

    df = spark.range(100).select(F.timestamp_seconds(F.col("id") % 10).alias("ts"), F.col("id").alias("event_id"))
    for name, (train, test) in time_splits(df).items():
        assert (train.count(), test.count()) == (int(100 * float(name)), 100 - int(100 * float(name)))
        assert train.agg(F.max("ts")).first()[0] <= test.agg(F.min("ts")).first()[0]


def test_hash_split_is_deterministic(spark):
    df = spark.range(2000)
    a = sp.hash_split(df, "id", [0.8, 0.2], ["train", "test"])
    b = sp.hash_split(df, "id", [0.8, 0.2], ["train", "test"])
    assert rows(a) == rows(b)
    n = a.where("split = 'train'").count()
    assert 1450 < n < 1750


def test_token_to_null_and_profile(spark):
    df = spark.createDataFrame([("?", "a", 1), ("x", "", 2), ("y", "b", None), ("?", "c", 4)],
                               "c1 string, c2 string, n int")
    t = cl.token_to_null(df)
    assert t.where("c1 is null").count() == 2 and t.where("c2 is null").count() == 1
    prof = {r.column_name: r for r in cl.null_profile(t).collect()}
    assert set(prof) == {"c1", "c2", "n"}
    assert abs(prof["c1"].null_pct - 50.0) < 1e-9


def test_oversample_ratio_and_undersample_exact(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    over = cl.oversample(df, F.col("y") == 1)
    assert over.where("y = 1").count() == 100 * 9 and over.where("y = 0").count() == 900
    under = cl.undersample(df, F.col("y") == 1, "id", seed=3)
    assert under.where("y = 1").count() == 100 and under.where("y = 0").count() == 100
    again = cl.undersample(df, F.col("y") == 1, "id", seed=3)
    assert rows(under) == rows(again)


def test_replicate_and_multivalue(spark):
    df = spark.createDataFrame([("a|b||c",)], "g string")
    assert df.select(cl.split_multivalue("g")).first()[0] == ["a", "b", "", "c"]
    assert cl.replicate_rows(df, 3).count() == 3


def test_class_balance(spark):
    df = spark.createDataFrame([(0.0,)] * 7 + [(2.5,)] * 2, "t double")
    r = cl.class_balance(df, "t").first()
    assert (r.n_zero, r.n_nonzero, r.replicate) == (7, 2, 3)


def test_oversample_weights_equal_replicated_fit(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    df = spark.range(400).select(
        F.col("id"), (F.col("id") % 10 == 0).cast("double").alias("y"),
        (F.col("id") % 7).cast("double").alias("x1"), (F.col("id") % 13).cast("double").alias("x2"))
    df = VectorAssembler(inputCols=["x1", "x2"], outputCol="features").transform(df)
    is_minor = F.col("y") == 1
    rep = cl.oversample(df, is_minor)
    wtd = cl.oversample_weights(df, is_minor)
    assert wtd.agg(F.sum("weight")).first()[0] == rep.count()
    lr = LogisticRegression(labelCol="y", regParam=0.01, tol=1e-10, maxIter=200)
    a = lr.fit(rep)
    b = lr.copy().setWeightCol("weight").fit(wtd)
    assert all(abs(u - v) < 1e-4 for u, v in zip(a.coefficients, b.coefficients))
    assert abs(a.intercept - b.intercept) < 1e-4


def test_cut_by_counting_equals_cut_by_sorting(spark):
    import random

    rng = random.Random(4)
    data = [(i, rng.choice([1, 1, 1, 2, 3, rng.randrange(1000)])) for i in range(500)]  # many ties on the key
    df = spark.createDataFrame(data, "id long, t long")
    order = [i for i, _ in sorted(data, key=lambda r: (r[1], r[0]))]
    for fraction in (0.0, 0.001, 0.3, 0.5, 0.999, 1.0):
        got = {r.id for r in sp.sequential_split(df, ["t", "id"], fraction).where("split = 'train'").collect()}
        assert got == set(order[:int(fraction * 500)])


def test_undersample_edge_cases(spark):
    df = spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(100)], "id long, y int")
    got = cl.undersample(df, F.col("y") == 1, "id", seed=3).groupBy("y").count().collect()
    assert {r.y: r["count"] for r in got} == {0: 15, 1: 15}
    assert cl.undersample(df.where("y = 0"), F.col("y") == 1, "id").count() == 0
    assert cl.undersample(df.where("y = 1"), F.col("y") == 1, "id").count() == 15
