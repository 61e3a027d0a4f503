"""ML feature, estimator, tuning and metric plans.

Feature stages and metrics over deterministic predictions are SQL-checked;
fitted models (iterative numerics) are rows-only and return small metric
tables computed by Spark aggregations.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from kestrel.functions import alpha_tokens, hash_bucket, round6, word_tokens
from kestrel.operators import clean as cl
from kestrel.operators import features as fe
from kestrel.operators import metrics as me
from kestrel.operators import models as mo
from kestrel.operators import networks as nw
from kestrel.operators import splits as sp
from kestrel.operators import text as tx
from kestrel.plans import sentiment as sent_plans
from kestrel.plans.registry import register
from kestrel.plans.text import TOPIC_MIN_DF, TOPIC_VOCAB_N
from kestrel.session import materialise, scratch_path
from kestrel.sources import files as fs
from kestrel.sources import fixtures as fx

CATS = ["o_orderpriority", "p_brand", "p_type", "l_linestatus", "o_orderstatus"]
NUMS = ["p_size", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_retailprice", "o_totalprice"]
SEED = 42


def _r6(df, cols=None):
    cols = cols or [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.select(*[round6(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ claims features

def _claims(spark, sf):
    """Cleaned claims: '?' -> NULL -> own category '0'; 80/20 md5 split on row_id."""
    c = cl.fill_missing(cl.token_to_null(fx.claims(spark, sf)), "0", CATS)
    return sp.hash_split(c, "row_id", [0.8, 0.2], ["train", "test"])


_CLAIMS_SQL = ("SELECT *, CASE WHEN ('0x' || substr(md5(CAST(row_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 80 "
               "THEN 'train' ELSE 'test' END AS split FROM (SELECT * REPLACE ("
               + ", ".join(f"coalesce(CASE WHEN trim({c}) IN ('?', '') THEN NULL ELSE {c} END, '0') AS {c}"
                           for c in CATS) + ") FROM claims)")

_RANKS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column, {c} AS value, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS INTEGER) "
    f"AS index FROM cc WHERE split = 'train' GROUP BY {c}" for c in CATS)


def _csql(body: str, extra=None) -> str:
    return fx.with_views(["claims"], body, [("cc", _CLAIMS_SQL), ("ranks", _RANKS_SQL)] + (extra or []))


@register("string_index", _csql("SELECT * FROM ranks"))
def q_string_index(spark, sf):
    train = _claims(spark, sf).where("split = 'train'")
    return fe.category_index(train, CATS).withColumn("index", F.col("index").cast("int"))


@register("one_hot", _csql(" UNION ALL ".join(
    f"SELECT row_id, '{c}' AS column, r.index AS active FROM cc LEFT JOIN ranks r "
    f"ON r.column = '{c}' AND r.value = cc.{c}" for c in ("p_type", "o_orderpriority"))))
def q_one_hot(spark, sf):
    c = _claims(spark, sf)
    cols = ["p_type", "o_orderpriority"]
    t = fe.encode_categories(c, materialise(fe.category_index(c.where("split = 'train'"), cols), "categories"), cols)
    parts = []
    for col in cols:
        arr = vector_to_array(F.col(col + "_ohe"))
        pos = F.array_position(arr, F.lit(1.0))
        parts.append(t.select("row_id", F.lit(col).alias("column"),
                              F.when(pos > 0, (pos - 1).cast("int")).alias("active")))
    return parts[0].unionByName(parts[1])


@register("assemble_vector", _csql(
    "SELECT row_id, CAST(u.j - 1 AS INTEGER) AS j, u.value FROM cc, "
    "unnest([" + ", ".join(f"CAST({c} AS DOUBLE)" for c in NUMS) + "]) WITH ORDINALITY AS u(value, j)"))
def q_assemble_vector(spark, sf):
    v = fe.assemble_vector(_claims(spark, sf), NUMS)
    return v.select("row_id", F.posexplode(vector_to_array("features")).alias("j", "value"))


@register("standardize", _csql(
    "SELECT row_id, " + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in ("l_quantity", "l_extendedprice"))
    + " FROM cc"))
def q_standardize(spark, sf):
    z = fe.standardize(_claims(spark, sf).select("row_id", "l_quantity", "l_extendedprice"),
                       ["l_quantity", "l_extendedprice"], ddof=0)
    return _r6(z, ["l_quantity", "l_extendedprice"])


@register("regression_metrics", _csql(
    """SELECT round(sqrt(avg(e * e)), 6) AS rmse, round(avg(e * e), 6) AS mse, round(avg(abs(e)), 6) AS mae
       FROM (SELECT 0.01 * l_extendedprice - claim_amount AS e FROM cc)"""))
def q_regression_metrics(spark, sf):
    c = _claims(spark, sf).withColumn("prediction", F.lit(0.01) * F.col("l_extendedprice"))
    return _r6(me.regression_metrics(c, "claim_amount", "prediction"))


def _claims_pipeline(scale: bool = True):
    return fe.feature_pipeline(CATS, NUMS, scale=scale)


@register("feature_pipeline")
def q_feature_pipeline(spark, sf):
    """Fit the cleaning-side pipeline on train, save it, load it back and
    apply it to the test rows (M5, G18's first half)."""
    c = _claims(spark, sf)
    model = _claims_pipeline().fit(c.where("split = 'train'"))
    path = scratch_path(spark, "claims-pipeline")
    model.write().overwrite().save(path)
    t = PipelineModel.load(path).transform(c.where("split = 'test'"))
    return t.select("row_id", F.size(vector_to_array("features")).alias("n_features"))


def _claims_fitted(spark, sf, balanced: bool = False):
    """Encoded claims, train part persisted: the iterative solvers pass over
    it many times. (The linear models standardise internally, so the encoded
    vectors stay sparse: no mean-centring stage.)"""
    c = _claims(spark, sf)
    fp = _claims_pipeline(scale=False).fit(c.where("split = 'train'"))
    t = fp.transform(c).select("row_id", "features", "claim_amount", "split")
    train = t.where("split = 'train'")
    return fs.cached_scan(_balanced(train) if balanced else train), t.where("split = 'test'")


@register("linear_regression")
def q_linear_regression(spark, sf):
    train, test = _claims_fitted(spark, sf)
    m = mo.regressor("linear", "claim_amount", regParam=0.0).fit(train)
    return _r6(me.regression_metrics(m.transform(test), "claim_amount"))


@register("ridge_regression")
def q_ridge_regression(spark, sf):
    train, test = _claims_fitted(spark, sf)
    st = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("claim_amount").alias("s")).first()
    # the test rows are joined, encoded and scored once for all penalties
    named = [({"alpha": a}, f"_at{i}") for i, a in enumerate((0.1, 1.0, 5.0, 10.0))]
    for own, column in named:
        test = mo.ridge(own["alpha"], st.n, st.s, "claim_amount").fit(train).setPredictionCol(column).transform(test)
    return _r6(me.regression_metrics_each(test, named, "claim_amount"))


@register("rf_regressor")
def q_rf_regressor(spark, sf):
    train, test = _claims_fitted(spark, sf)
    m = mo.regressor("rf", "claim_amount", numTrees=50, maxDepth=5, seed=SEED).fit(train)
    return _r6(me.regression_metrics(m.transform(test), "claim_amount"))


@register("gbt_regressor")
def q_gbt_regressor(spark, sf):
    train, test = _claims_fitted(spark, sf)
    m = mo.regressor("gbt", "claim_amount", maxIter=3, maxDepth=3, seed=SEED).fit(train)
    return _r6(me.regression_metrics(m.transform(test), "claim_amount"))


@register("gamma_glm")
def q_gamma_glm(spark, sf):
    train, test = _claims_fitted(spark, sf)
    pos = train.where("claim_amount > 0")
    m = mo.gamma_glm("log", "claim_amount", maxIter=50, regParam=0.01).fit(pos)
    return _r6(me.regression_metrics(m.transform(test.where("claim_amount > 0")), "claim_amount"))


def _balanced(train):
    """Balanced training set as instance weights (claims weighted by the
    no-claim / claim ratio): the same fits as on replicated claim rows,
    without multiplying the rows the solvers pass over."""
    return cl.oversample_weights(train, F.col("claim_amount") != 0).withColumn(
        "is_claim", (F.col("claim_amount") != 0).cast("double"))


@register("logistic_binary")
def q_logistic_binary(spark, sf):
    """Claim / no claim on the oversampled training rows."""
    bal, test = _claims_fitted(spark, sf, balanced=True)
    m = mo.logistic("binomial", reg=0.01, label="is_claim", maxIter=50, weightCol="weight").fit(bal)
    pred = m.transform(test.withColumn("is_claim", (F.col("claim_amount") != 0).cast("double")))
    return _r6(me.prf_macro(pred, "is_claim"))


@register("two_part_model")
def q_two_part_model(spark, sf):
    """Logistic (claim?) then gamma GLM with identity link (amount) on all features of the oversampled train rows; scored in
    one projection over both models (G16)."""
    bal, test = _claims_fitted(spark, sf, balanced=True)
    cls = mo.logistic("binomial", reg=0.01, label="is_claim", maxIter=50, tol=1.0, weightCol="weight").fit(bal)
    reg = mo.gamma_identity(bal.where("claim_amount > 0"), "claim_amount", reg=0.01, weight="weight")
    return _r6(me.regression_metrics(mo.two_part_predict(test, cls, reg), "claim_amount"))


@register("gamma_glm_identity")
def q_gamma_glm_identity(spark, sf):
    """Gamma GLM with identity link on the non-zero claims, on all features."""
    train, test = _claims_fitted(spark, sf)
    m = mo.gamma_identity(train.where("claim_amount > 0"), "claim_amount", reg=0.01)
    return _r6(me.regression_metrics(m.transform(test.where("claim_amount > 0")), "claim_amount"))


@register("two_part_grid")
def q_two_part_grid(spark, sf):
    """Two classifiers x four regressors, trained on the undersampled claims (G16): test metrics of the eight pairs."""
    c = _claims(spark, sf)
    fp = _claims_pipeline(scale=False).fit(c.where("split = 'train'"))
    t = fp.transform(c).select("row_id", "features", "claim_amount", (F.col("claim_amount") != 0).cast("double").alias("is_claim"), "split")
    few = fs.cached_scan(cl.undersample(t.where("split = 'train'"), F.col("claim_amount") != 0, "row_id", seed=SEED))
    some, test = few.where("claim_amount > 0"), t.where("split = 'test'")
    classifiers = {"logistic": mo.logistic("binomial", reg=0.01, label="is_claim", maxIter=50).fit(few),
                   "rf": mo.classifier("rf", "is_claim", numTrees=20, maxDepth=5, seed=SEED).fit(few)}
    regressors = {"linear": mo.regressor("linear", "claim_amount", regParam=0.1).fit(some),
                  "gamma": mo.gamma_glm("log", "claim_amount", maxIter=50, regParam=0.01).fit(some),
                  "rf": mo.regressor("rf", "claim_amount", numTrees=20, maxDepth=5, seed=SEED).fit(some),
                  "gbt": mo.regressor("gbt", "claim_amount", maxIter=5, maxDepth=3, seed=SEED).fit(some)}
    # the test rows are joined, encoded and scored once for all pairs
    for name, model in {**{f"_c_{n}": m for n, m in classifiers.items()}, **{f"_r_{n}": m for n, m in regressors.items()}}.items():
        test = model.setPredictionCol(name).transform(test).drop("rawPrediction", "probability")
    named = [({"classifier": c, "regressor": r}, f"_p_{c}_{r}") for c in classifiers for r in regressors]
    test = test.select("claim_amount", *[mo.two_part(f"_c_{n['classifier']}", f"_r_{n['regressor']}").alias(p) for n, p in named])
    return _r6(me.regression_metrics_each(test, named, "claim_amount"))


@register("score_new_data")
def q_score_new_data(spark, sf):
    """Save the cleaning + model pipeline, load it, score unseen rows."""
    c = _claims(spark, sf)
    pipe = Pipeline(stages=_claims_pipeline().getStages() + [mo.regressor("linear", "claim_amount")])
    model = pipe.fit(c.where("split = 'train'"))
    path = scratch_path(spark, "claims-model")
    model.write().overwrite().save(path)
    pred = PipelineModel.load(path).transform(c.where("split = 'test'"))
    return pred.select("row_id", round6(F.col("prediction")).alias("prediction"))


@register("training_time_table")
def q_training_time_table(spark, sf):
    """Wall minutes of the fit stages of the two-part model."""
    timer = me.StageTimer()
    bal, _ = _claims_fitted(spark, sf, balanced=True)
    with timer("linear_fit"):
        mo.regressor("linear", "claim_amount", weightCol="weight").fit(bal)
    with timer("logistic_fit"):
        mo.logistic("binomial", reg=0.01, label="is_claim", maxIter=50, weightCol="weight").fit(bal)
    with timer("gamma_fit"):
        mo.gamma_glm("log", "claim_amount", maxIter=50, weightCol="weight").fit(bal.where("claim_amount > 0"))
    return timer.table(spark)


@register("shuffle_split_grid")
def q_shuffle_split_grid(spark, sf):
    """Five random 90/10 splits over the ridge penalties 0.1, 1, 5 and 10 (V2)."""
    train, _ = _claims_fitted(spark, sf)
    st = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("claim_amount").alias("s")).first()
    alphas = (0.1, 1.0, 5.0, 10.0)
    lr = mo.ridge(alphas[0], st.n, st.s, "claim_amount")
    g = mo.grid(lr, regParam=[mo.ridge_penalty(a, st.n, st.s) for a in alphas])
    scores = mo.shuffle_split(train, Pipeline(stages=[lr]), g, mo.EVALUATORS["rmse"]("claim_amount"))
    return _r6(scores.withColumn("alpha", F.element_at(F.array(*map(F.lit, alphas)), F.col("grid_point") + 1)))


# ------------------------------------------------------------------ wide numeric classification

def _wide(spark, sf):
    w = fe.with_vector(fx.wide(spark, sf), "features", "fv").drop("features").withColumnRenamed("fv", "features")
    return sp.hash_split(w, "vec_id", [0.8, 0.2], ["train", "test"])


def _clf_scores(name, model, test):
    pred = model.transform(test)
    return _r6(mo.classification_scores(pred).select(F.lit(name).alias("model"), "*"))


@register("rf_classifier")
def q_rf_classifier(spark, sf):
    w = _wide(spark, sf)
    m = mo.classifier("rf", numTrees=20, maxDepth=5, seed=SEED).fit(w.where("split = 'train'"))
    return _clf_scores("rf", m, w.where("split = 'test'"))


@register("gbt_classifier")
def q_gbt_classifier(spark, sf):
    w = _wide(spark, sf)
    m = mo.classifier("gbt", maxIter=10, maxDepth=3, featureSubsetStrategy="sqrt", seed=SEED).fit(
        w.where("split = 'train'"))
    return _clf_scores("gbt", m, w.where("split = 'test'"))


@register("mlp_classifier")
def q_mlp_classifier(spark, sf):
    w = _wide(spark, sf)
    m = mo.classifier("mlp", layers=[64, 20, 5, 2], maxIter=50, blockSize=64, seed=SEED).fit(
        w.where("split = 'train'"))
    return _clf_scores("mlp", m, w.where("split = 'test'"))


@register("area_under_pr")
def q_area_under_pr(spark, sf):
    w = _wide(spark, sf)
    m = mo.logistic("binomial", maxIter=50).fit(w.where("split = 'train'"))
    aupr = me.area_under_pr(m.transform(w.where("split = 'test'")))
    return spark.range(1).select(F.round(F.lit(aupr), 6).alias("area_under_pr"))


def _rf_pipeline():
    rf = mo.classifier("rf", seed=SEED)
    return rf, Pipeline(stages=[rf])


# The search grids: every point is compared by the mean accuracy of five folds.
RF_GRID = {"featureSubsetStrategy": ["all", "sqrt", "log2"], "maxDepth": [1, 10, 15], "numTrees": [1, 10, 20]}
GBT_GRID = {"depths": [1, 10, 15], "iterations": [10, 20, 30], "subsets": ["all", "sqrt", "log2"]}
MLP_GRID = {"iterations": [30, 50, 100], "blocks": [64, 128, 256], "steps": [0.01, 0.03, 0.05]}
MLP_LAYERS = [64, 20, 5, 2]
#: The searches of forests and perceptrons and those in front of the refits run on this share of the training rows; the best
#: points of the latter are fitted again on all of them.
TUNE_SHARE = 0.5
#: Folds of the searches in front of the refits; the grids themselves are compared with five.
REFIT_FOLDS = 2


def _tuning_rows(spark, sf):
    """A hashed share of the training rows, persisted: a grid passes over them hundreds of times."""
    train = _wide(spark, sf).where("split = 'train'")
    return fs.cached_scan(train.where(hash_bucket("vec_id", 1000) < int(1000 * TUNE_SHARE)))


def _points(spark, points):
    """A table of grid points: (model, parameters, accuracy)."""
    # one row for each point of the grid
    return spark.createDataFrame([(name, ", ".join(f"{k}={v}" for k, v in sorted(p.items())), float(a)) for name, ps in points for p, a in ps],
                                 "model string, parameters string, accuracy double")


def _rf_points(rows, folds: int = 5):
    rf, pipe = _rf_pipeline()
    cv = mo.cross_validate(rows, pipe, mo.grid(rf, **RF_GRID), mo.EVALUATORS["accuracy"]("label"), folds=folds, parallelism=8)
    return [({p.name: v for p, v in point.items()}, m) for point, m in zip(cv.getEstimatorParamMaps(), cv.avgMetrics)]


@register("cross_validate_grid")
def q_cross_validate_grid(spark, sf):
    """Mean accuracy over 5 folds of the 27 forests of the grid: subset strategy x depth x trees."""
    return _r6(_points(spark, [("rf", _rf_points(_tuning_rows(spark, sf)))]))


@register("gbt_grid")
def q_gbt_grid(spark, sf):
    """Mean accuracy over 5 folds of all training rows of the 27 boosted models of the grid: depth x iterations x subset
    strategy (V1, G7)."""
    train = fs.cached_scan(_wide(spark, sf).where("split = 'train'"))
    return _r6(_points(spark, [("gbt", mo.gbt_grid(train, **GBT_GRID, seed=SEED, parallelism=8))]))


@register("mlp_grid")
def q_mlp_grid(spark, sf):
    """Mean accuracy over 5 folds of the 27 perceptrons of the grid: iterations x block size x step size."""
    return _r6(_points(spark, [("mlp", mo.mlp_grid(_tuning_rows(spark, sf), MLP_LAYERS, **MLP_GRID, seed=SEED))]))


@register("scale_up_refit")
def q_scale_up_refit(spark, sf):
    """Forest, boosting and perceptron: searched on a share of the training rows, the best point of each fitted again on
    all of them and scored on the test rows (G19)."""
    few, w = _tuning_rows(spark, sf), _wide(spark, sf)
    train, test = fs.cached_scan(w.where("split = 'train'")), w.where("split = 'test'")
    best = {"rf": mo.best_point(_rf_points(few, REFIT_FOLDS)),
            "gbt": mo.best_point(mo.gbt_grid(few, **GBT_GRID, n_folds=REFIT_FOLDS, seed=SEED, parallelism=8)),
            "mlp": mo.best_point(mo.mlp_grid(few, MLP_LAYERS, **MLP_GRID, n_folds=REFIT_FOLDS, seed=SEED)) | {"layers": MLP_LAYERS}}
    out = None
    for name, params in best.items():
        r = _clf_scores(name, mo.classifier(name, seed=SEED, **params).fit(train), test).withColumn(
            "parameters", F.lit(", ".join(f"{k}={v}" for k, v in sorted(params.items()))))
        out = r if out is None else out.unionByName(r)
    return out


@register("feature_importance_topk")
def q_feature_importance_topk(spark, sf):
    w = _wide(spark, sf)
    m = mo.classifier("rf", numTrees=20, maxDepth=5, seed=SEED).fit(w.where("split = 'train'"))
    imp = m.featureImportances.toArray()
    return _r6(me.top_features(spark, imp, [f"f{i}" for i in range(len(imp))], k=3))


# ------------------------------------------------------------------ images / vectors

def _vectors(spark, sf):
    v = fe.with_vector(fx.vectors(spark, sf), "embedding")
    return sp.hash_split(v, "vec_id", [0.8, 0.2], ["train", "test"])


@register("filter_two_classes", "SELECT vec_id, label FROM embeddings WHERE label IN (0, 1)")
def q_filter_two_classes(spark, sf):
    return fe.filter_two_classes(fx.vectors(spark, sf), 0, 1).select("vec_id", "label")


@register("scan_images_as_vectors", "SELECT vec_id, label, len(embedding) AS dim FROM embeddings")
def q_scan_images_as_vectors(spark, sf):
    from kestrel.sources.files import scan_images_as_vectors

    v = scan_images_as_vectors(fx.vectors(spark, sf))
    return v.select("vec_id", "label", F.size(vector_to_array("features")).alias("dim"))


@register("pca_project")
def q_pca_project(spark, sf):
    v = _vectors(spark, sf)
    model = fe.pca_fit(v, 24)
    return _r6(fe.pca_components(spark, model, fe.total_variance(v)))


@register("pca_reconstruct_mse")
def q_pca_reconstruct_mse(spark, sf):
    two = fe.filter_two_classes(_vectors(spark, sf), 0, 1)
    out = None
    for k in (2, 24):
        model = fe.pca_fit(two, k)
        r = fe.pca_reconstruct_mse(two, model).select(F.lit(k).alias("k"), "mse")
        out = r if out is None else out.unionByName(r)
    return _r6(out)


@register("kmeans_2d")
def q_kmeans_2d(spark, sf):
    two = fe.filter_two_classes(_vectors(spark, sf), 0, 1)
    p = fe.pca_fit(two, 2).transform(two).select("label", F.col("pca").alias("features"))
    km = mo.kmeans(p, 2)
    sizes = km.transform(p).groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    cents = spark.createDataFrame([(i, float(c[0]), float(c[1])) for i, c in enumerate(km.clusterCenters())],
                                  "cluster int, cx double, cy double")
    return _r6(sizes.join(cents, "cluster"))


@register("logistic_multinomial")
def q_logistic_multinomial(spark, sf):
    """10-class vectors with no / L2 / L1 penalty."""
    v = _vectors(spark, sf)
    out = None
    for name, reg, l1 in (("none", 0.0, False), ("l2", 0.01, False), ("l1", 0.01, True)):
        m = mo.logistic("multinomial", reg=reg, l1=l1, maxIter=50).fit(v.where("split = 'train'"))
        r = me.prf_macro(m.transform(v.where("split = 'test'"))).select(F.lit(name).alias("penalty"), "*")
        out = r if out is None else out.unionByName(r)
    return _r6(out)


# ------------------------------------------------------------------ text models

SPACES = {"words": ["words"], "characters": ["characters"], "both": ["words", "characters"]}
SPACE_N = 5000  # features of each space
WORD_GRAMS, CHAR_GRAMS = (1, 3), (4, 7)


def _text_spaces(docs):
    """(vectors, vocabularies) of (doc_id, split, label, toks): sparse tf-idf vectors over word n-grams, over character
    n-grams and over both side by side (F9-F12). Vocabularies and log10 idf come from the training part."""
    kept = materialise(docs.select("doc_id", "split", "label", "toks"), "texts")
    train = kept.where("split = 'train'")
    n_docs = max(1, train.count())
    words = train.select("doc_id", F.explode(tx.word_ngrams("toks", *WORD_GRAMS)).alias("feature"))
    # the vocabulary is cut before anything is counted per document: n-grams outside it never form a row of a document
    totals = words.groupBy("feature").agg(F.count(F.lit(1)).alias("count"))
    word_ids = materialise(tx.vocab_ids(tx.vocab_of_totals(totals, keep_top_n=SPACE_N)), "word-ids")
    known = tx.filter_to_vocab(words, word_ids, vocab_bound=SPACE_N)
    terms = materialise(tx.term_frequency(train.select("doc_id", F.explode("toks").alias("term")), feature="term"), "term-counts")
    grams = materialise(tx.gram_dictionary(terms, *CHAR_GRAMS), "grams")
    char_ids = materialise(tx.vocab_ids(tx.vocab_of_totals(tx.gram_totals(terms, grams), keep_top_n=SPACE_N)), "char-ids")
    counts = {"words": (word_ids, tx.count_vectors(known, word_ids, vocab_bound=SPACE_N)),
              "characters": (char_ids, tx.gram_counts(terms, grams, char_ids, "doc_id", vocab_bound=SPACE_N))}
    stages, vocabularies = [], {}
    for name, (ids, tf) in counts.items():
        # at most SPACE_N rows
        rows = ids.join(tx.idf_log10(tf, n_docs), "term_id", "left").orderBy("term_id").select("feature", F.coalesce("idf", F.lit(0.0)).alias("idf")).collect()
        rows = rows or [("", 0.0)]
        vocabularies[name] = [r[0] for r in rows]
        stages += fe.tfidf_stages(vocabularies[name], [r[1] for r in rows], f"{name}_grams", name)
    grams_of = kept.select("doc_id", "split", "label", tx.word_ngrams("toks", *WORD_GRAMS).alias("words_grams"),
                           tx.char_ngrams("toks", *CHAR_GRAMS).alias("characters_grams"))
    vectors = Pipeline(stages=stages).fit(grams_of).transform(grams_of).select("doc_id", "split", "label", *counts)
    return materialise(fe.assemble_vector(vectors, ["words", "characters"], "both"), "vectors"), vocabularies


def _space_scores(vectors, model):
    out = None
    for name in SPACES:
        own = vectors.select("label", "split", F.col(name).alias("features"))
        m = model.fit(fs.cached_scan(own.where("split = 'train'")))
        r = me.prf_macro(m.transform(own.where("split = 'test'"))).select(F.lit(name).alias("space"), "*")
        out = r if out is None else out.unionByName(r)
    return _r6(out)


def _topic_docs(spark, sf):
    toks = tx.remove_stopwords(alpha_tokens("text", lower=True), tx.STOPWORDS_NLP1)
    return fx.topics(spark, sf).select("doc_id", "split", (F.col("label") - 1).cast("double").alias("label"), toks.alias("toks"))


@register("logistic_topics")
def q_logistic_topics(spark, sf):
    """Topics on the tf-idf spaces of words, characters and both: one row for each."""
    return _space_scores(_text_spaces(_topic_docs(spark, sf))[0], mo.logistic("multinomial", reg=0.01, maxIter=50))


@register("topic_top_weights")
def q_topic_top_weights(spark, sf):
    """Top 10 weights per class of the topic model on words."""
    vectors, vocabularies = _text_spaces(_topic_docs(spark, sf))
    own = vectors.where("split = 'train'").select("label", F.col("words").alias("features"))
    coef = mo.logistic("multinomial", reg=0.01, maxIter=50).fit(fs.cached_scan(own)).coefficientMatrix.toArray()
    out = None
    for cls in range(coef.shape[0]):
        part = me.top_features(spark, coef[cls], vocabularies["words"], k=10, group=str(cls + 1))
        out = part if out is None else out.unionByName(part)
    return _r6(out)


def _mean_embedding_docs(spark, sf):
    t = fx.topics(spark, sf).select("doc_id", F.explode(word_tokens("text", lower=True)).alias("token"))
    e = tx.mean_embedding(t, fx.word_vectors(spark, sf))
    vec = e.groupBy("doc_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "value"))), lambda s: s["value"]).alias("v"))
    lab = fx.topics(spark, sf).select("doc_id", "split", (F.col("label") - 1).cast("double").alias("label"))
    return fe.with_vector(vec.join(lab, "doc_id"), "v")


def _bag_docs(spark, sf):
    """(vectors, width): documents as the mean of the one-hot vectors of their vocabulary words. The first layer of a network
    on them is a table of word vectors whose mean is the document, learned with the labels like every other layer."""
    toks = tx.remove_stopwords(alpha_tokens("text", lower=True), tx.STOPWORDS_NLP2)
    docs = fx.topics(spark, sf).select("doc_id", "split", (F.col("label") - 1).cast("double").alias("label"), toks.alias("toks"))
    feats = docs.where("split = 'train'").select("doc_id", F.explode("toks").alias("feature"))
    vocab = tx.build_vocab(feats, min_df=TOPIC_MIN_DF, keep_top_n=TOPIC_VOCAB_N, mode="docfreq")
    words = [r.feature for r in vocab.orderBy("rank").select("feature").collect()] or [""]  # TOPIC_VOCAB_N at most
    stages = [CountVectorizerModel.from_vocabulary(words, inputCol="toks", outputCol="counts"), Normalizer(p=1.0, inputCol="counts", outputCol="features")]
    out = Pipeline(stages=stages).fit(docs).transform(docs).select("doc_id", "split", "label", "features")
    return materialise(out, "bags"), len(words)


@register("embedding_classifier")
def q_embedding_classifier(spark, sf):
    """Mean word vector per document -> hidden layers -> softmax (G17): given vectors with one hidden layer and with
    two, and vectors learned with the labels as the network's first layer."""
    given, (learned, width) = _mean_embedding_docs(spark, sf), _bag_docs(spark, sf)
    out = None
    for name, layers in (("given", [8, 16, 4]), ("given, two hidden layers", [8, 16, 16, 4])):
        m = mo.classifier("mlp", layers=layers, maxIter=100, seed=SEED).fit(given.where("split = 'train'"))
        r = me.prf_macro(m.transform(given.where("split = 'test'"))).select(F.lit(name).alias("variant"), "*")
        out = r if out is None else out.unionByName(r)
    layers = [width, 16, 4]
    weights = nw.fit_lbfgs(nw.sparse_rows(learned.where("split = 'train'")), layers, 100, SEED)
    pred = nw.predicted(nw.sparse_rows(learned.where("split = 'test'")), layers, weights)
    return _r6(out.unionByName(me.prf_macro(pred).select(F.lit("learned with the labels").alias("variant"), "*")))


@register("manual_grid")
def q_manual_grid(spark, sf):
    """Embedding size x hidden size x step size grid of the embedding classifier (V3), word vectors learned with the labels."""
    docs, width = _bag_docs(spark, sf)
    train, test = nw.sparse_rows(docs.where("split = 'train'")), nw.sparse_rows(docs.where("split = 'test'"))
    grid = [(size, hidden, step) for size in (8, 16) for hidden in (None, 16) for step in (0.03, 0.3)]
    shapes = [[width, size, *([hidden] if hidden else []), 4] for size, hidden, _ in grid]
    fitted = nw.fit_descent(train, shapes, [step for *_, step in grid], 30, SEED)
    points = [(*point, float(me.accuracy(nw.predicted(test, layers, weights)).first().accuracy or 0.0))
              for point, layers, weights in zip(grid, shapes, fitted)]
    return _r6(spark.createDataFrame(points, "embedding int, hidden int, step double, accuracy double"))


@register("logistic_sentiment")
def q_logistic_sentiment(spark, sf):
    """Binary sentiment on the tf-idf spaces of words, characters and both: one row for each."""
    toks = tx.remove_stopwords(alpha_tokens("text"), tx.STOPWORDS_NLP1)
    docs = fx.texts(spark, sf).select("doc_id", "split", F.col("label").cast("double").alias("label"), toks.alias("toks"))
    return _space_scores(_text_spaces(docs)[0], mo.logistic("binomial", reg=0.01, maxIter=50))


# ------------------------------------------------------------------ metrics on deterministic predictions

_TOPIC_PRED = ("CASE WHEN contains(text, ' the ') THEN 1 WHEN contains(text, ' le ') OR contains(text, ' la ') "
               "THEN 2 ELSE 3 END")


def _topic_pred(spark, sf):
    t = fx.topics(spark, sf)
    pred = (F.when(F.col("text").contains(" the "), 1)
            .when(F.col("text").contains(" le ") | F.col("text").contains(" la "), 2).otherwise(3))
    return t.select("doc_id", "label", pred.alias("prediction"))


def _topsql(body: str) -> str:
    return fx.with_views(["topics"], body, [("tp", f"SELECT doc_id, label, {_TOPIC_PRED} AS prediction FROM topics")])


@register("accuracy", _topsql("SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy "
                              "FROM tp"))
def q_accuracy(spark, sf):
    return _r6(me.accuracy(_topic_pred(spark, sf)))


@register("confusion_matrix", _topsql("SELECT label, prediction, count(*) AS n FROM tp GROUP BY ALL"))
def q_confusion_matrix(spark, sf):
    return me.confusion_matrix(_topic_pred(spark, sf))


@register("prf_macro", _topsql("""
    SELECT round((SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) FROM tp), 6) AS accuracy,
           round(avg(p), 6) AS macro_precision, round(avg(r), 6) AS macro_recall, round(avg(f), 6) AS macro_f1
    FROM (SELECT p, r, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f
          FROM (SELECT coalesce(tp / nullif(n_pred, 0), 0) AS p, coalesce(tp / nullif(support, 0), 0) AS r
                FROM (SELECT coalesce(a.class, b.class) AS class, coalesce(support, 0) AS support,
                             coalesce(tp, 0) AS tp, coalesce(n_pred, 0) AS n_pred
                      FROM (SELECT label AS class, count(*) AS support,
                                   count(*) FILTER (WHERE label = prediction) AS tp FROM tp GROUP BY label) a
                      FULL OUTER JOIN (SELECT prediction AS class, count(*) AS n_pred FROM tp GROUP BY prediction) b
                      ON a.class = b.class)))"""))
def q_prf_macro(spark, sf):
    return _r6(me.prf_macro(_topic_pred(spark, sf)))


@register("log_loss", sent_plans._sql(
    """SELECT round(avg(-ln(least(greatest(CASE WHEN label = 1 THEN prob ELSE 1 - prob END, 1e-15), 1 - 1e-15))), 6)
              AS log_loss
       FROM scored JOIN tdocs USING (doc_id)"""))
def q_log_loss(spark, sf):
    s = sent_plans._scored(spark, sf).join(sent_plans._test_docs(spark, sf), "doc_id")
    s = s.withColumn("p_true", F.when(F.col("label") == 1, F.col("prob")).otherwise(1 - F.col("prob")))
    return _r6(me.log_loss(s, "p_true"))

