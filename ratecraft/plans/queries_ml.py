"""Registered queries: factorisation / iterative models, feature regressors,
text models, stacking, cross-validation and searches, file round trips.

Randomised or iterative results (M7–M9, M11, M14–M17, M20, M22, M24, M25, M27,
M29, M32, M33) have no exact SQL form and are registered without an oracle; the
exact ones (M1 by its hash, M26 and M28 with unrolled epochs, J3, J7, the M21
averaging rule, the file formats) are registered with one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ratecraft.operators.columns import SCALED_COLS, beer_context, consumer_context
from ratecraft.operators.corpus import prepare_text
from ratecraft.operators.joins import ensemble_frame, join_predictions
from ratecraft.plans import cocluster as cc
from ratecraft.plans import factors
from ratecraft.plans import onepass as op
from ratecraft.plans import oracle_sql as q
from ratecraft.plans.base import clip
from ratecraft.plans.baseline import fit_baseline
from ratecraft.plans.catalog import query
from ratecraft.plans.cocluster import fit_coclustering
from ratecraft.plans.ensemble import long_predictions, model_report as report, run_concurrently, stack
from ratecraft.plans.evaluate import mae_value
from ratecraft.plans.factorization import als_folds, fit_implicit, fit_nmf, fit_normal, fit_svd, fit_svdpp
from ratecraft.plans.features import encoded_features
from ratecraft.plans.neighbours import fit_knn, fit_slope_one
from ratecraft.plans.queries_core import _baseline_sql, r6
from ratecraft.plans.queries_models import _BASE
from ratecraft.plans.gram import cross_products, cross_validated_path, fit_lasso, fit_linear
from ratecraft.plans.regression import fit_gbt
from ratecraft.plans.text_models import (doc_vectors, fit_text_classifier, fit_word2vec,
                                         predict_text_classifier)
from ratecraft.plans.tuning import ablation, random_search, with_folds
from ratecraft.session import cut_lineage, drop_snapshot, handed_on, scratch_path
from ratecraft.sources import files as fs
from ratecraft.sources import ratings as rt
from ratecraft.sources.tables import read_table


def _split(df, s):
    return df.where(F.col("split") == s)


def _targets(t):
    return t.where(F.col("split") != "train").select("RowID", "split", "BeerID", "ReviewerID", "rating")


def _pred_out(p):
    return p.select("RowID", "split", r6("est").alias("est"), "was_impossible")


# ---------------------------------------------------------------- M1 / M7 / M8 / M9 / M11 / M32
@query("normal_predict", sql=q.with_ctes(*_BASE) + """, h AS (
  SELECT RowID, split, md5('42|' || u || '|' || i) AS h FROM tg),
n AS (SELECT RowID, split, (('0x' || substr(h, 1, 12))::bigint + 1) / 281474976710656.0::double AS u1,
             ('0x' || substr(h, 13, 12))::bigint / 281474976710656.0::double AS u2 FROM h)
SELECT RowID, split, round(least(greatest(mu + sd * (sqrt(-2.0 * ln(u1)) * cos(2.0 * pi() * u2)), 0.0), 5.0) + 1e-10, 6) AS est,
       false AS was_impossible FROM n, gs""")
def normal_predict(spark, sf):
    t = rt.stored_triples(spark, sf)
    return _pred_out(fit_normal(_split(t, "train")).predict(_targets(t)))


@query("svd_predict", bench=True)
def svd_predict(spark, sf):
    t = rt.stored_triples(spark, sf)
    return _pred_out(fit_svd(_split(t, "train")).predict(_targets(t)))


@query("svdpp_predict")
def svdpp_predict(spark, sf):
    t = rt.stored_triples(spark, sf)
    return _pred_out(fit_svdpp(_split(t, "train"), n_epochs=20, reg=0.2).predict(_targets(t)))


@query("nmf_predict")
def nmf_predict(spark, sf):
    t = rt.stored_triples(spark, sf)
    return _pred_out(fit_nmf(_split(t, "train")).predict(_targets(t)))


@query("coclustering_predict", sql=q.with_ctes(q.RATINGS_CTE, *q.cocluster_ctes(20)) + """
SELECT t.RowID, t.split, round(least(greatest(CASE WHEN u.u IS NOT NULL AND i.i IS NOT NULL
         THEN coalesce(co20.m, mu) + um.mu_u - coalesce(au20.m, mu) + im.mu_i - coalesce(ai20.m, mu)
         ELSE coalesce(um.mu_u, im.mu_i, mu) END, 0.0), 5.0) + 1e-10, 6) AS est, false AS was_impossible
FROM ratings t CROSS JOIN cmu LEFT JOIN cu20 u ON u.u = t.BeerID LEFT JOIN ci20 i ON i.i = t.ReviewerID
LEFT JOIN cum um ON um.u = t.BeerID LEFT JOIN cim im ON im.i = t.ReviewerID LEFT JOIN co20 ON co20.cu = u.cu AND co20.ci = i.ci
LEFT JOIN au20 ON au20.cu = u.cu LEFT JOIN ai20 ON ai20.ci = i.ci WHERE t.split <> 'train'""")
def coclustering_predict(spark, sf):
    """20 epochs from clusters by id modulo 3."""
    t = rt.stored_triples(spark, sf)
    return _pred_out(fit_coclustering(_split(t, "train"), seed=None).predict(_targets(t)))


@query("implicit_scores")
def implicit_scores(spark, sf):
    """M31 + M32: interaction strength = line items per (customer, part) pair."""
    p = rt.with_keys(rt.pair_lines(spark, sf))
    model = fit_implicit(_split(p, "train"), weight="n_lines")
    s = model.predict(p.where(F.col("split") != "train").select("RowID", "BeerID", "ReviewerID"))
    return s.select("RowID", r6("est").alias("score"))


# ---------------------------------------------------------------- M14–M17, M25, M33
def _feature_cols(df):
    return [c for c in df.columns if c in SCALED_COLS or c.startswith("BeerType_")
            or c.startswith("Gender_")]


#: Rows of a file of the feature table: boosting keeps a task's rows as vectors, many times their packed size.
_ENG_ROWS = 50_000


def _eng(spark, sf):
    return handed_on(encoded_features(spark, sf).drop("BeerName"), _ENG_ROWS)


@query("gbt_predict", bench=True)
def gbt_predict(spark, sf):
    e = _eng(spark, sf)
    model = fit_gbt(_split(e, "train"), _feature_cols(e), max_iter=30, max_depth=5)
    p = model.predict(e.where(F.col("split") != "train").select("RowID", "split", "rating", *_feature_cols(e)))
    return p.select("RowID", "split", r6("est").alias("est"))


@query("gbt_importances")
def gbt_importances(spark, sf):
    e = _eng(spark, sf)
    return fit_gbt(_split(e, "train"), _feature_cols(e), max_iter=20, max_depth=4).importances()


_LINEAR_SQL = q.with_ctes(q.ENGINEERED_CTE, *q.least_squares_ctes(q.SCALED, ["BeerType", "Gender"])).replace("WITH ", "WITH RECURSIVE ", 1)


@query("linreg_predict", sql=_LINEAR_SQL + """
SELECT e.RowID, e.split, round(least(greatest(p.est, 0.0), 5.0) + 1e-10, 6) AS est
FROM eng e JOIN lm_p p ON p.RowID = e.RowID WHERE e.split <> 'train'""")
def linreg_predict(spark, sf):
    """Least squares by cross products over the numeric and category columns."""
    e = _eng(spark, sf)
    model = fit_linear(_split(e, "train"), _feature_cols(e))
    p = model.predict(e.where(F.col("split") != "train").select("RowID", "split", "rating", *_feature_cols(e)))
    return p.select("RowID", "split", r6("est").alias("est"))


@query("lasso_predict")
def lasso_predict(spark, sf):
    """The lasso by coordinate descent on the cross products."""
    e = _eng(spark, sf)
    model = fit_lasso(_split(e, "train"), _feature_cols(e), alpha=0.01)
    p = model.predict(e.where(F.col("split") != "train").select("RowID", "split", "rating", *_feature_cols(e)))
    return p.select("RowID", "split", r6("est").alias("est"))


@query("lasso_path_cv")
def lasso_path_cv(spark, sf):
    """A penalty path of the lasso, 5-fold CV from the folds' cross products (the rows are read once)."""
    e = with_folds(_split(_eng(spark, sf), "train"), 5)
    path = cross_validated_path(cross_products(e, _feature_cols(e), fold="fold"), [10.0 ** k for k in range(-4, 2)])
    return spark.createDataFrame(path, "alpha double, mean_mse double, std_mse double, n_used int").select(
        "alpha", r6("mean_mse").alias("mean_mse"), r6("std_mse").alias("std_mse"), "n_used")


@query("feature_ablation")
def feature_ablation(spark, sf):
    e = _eng(spark, sf)
    all_cols = _feature_cols(e)
    sets = {"all": all_cols,
            "beer_context": _feature_cols(beer_context(e.select(*all_cols))),
            "consumer_context": _feature_cols(consumer_context(e.select(*all_cols))),
            "counts_only": ["ReviewerReviewCount", "BeerReviewCount"]}
    return ablation(_split(e, "train"), _split(e, "val"), sets,
                    lambda cols: (lambda tr: fit_gbt(tr, cols, max_iter=15, max_depth=4)))


# ---------------------------------------------------------------- M20 / M21 / M22
#: Rows of a file of the cleaned names, which the classifier keeps as vectors.
_NAME_ROWS = 200_000


def _clean_names(named):
    """The cleaned names, written once: a fit reads them in each of its passes, and the scoring again."""
    return handed_on(prepare_text(named.select("RowID", "BeerName"), "BeerName"))


@query("beername_docvec")
def beername_docvec(spark, sf):
    clean = _clean_names(cut_lineage(rt.ratings(spark, sf).select("RowID", "BeerName")))
    model = fit_word2vec(clean, "BeerName", dim=100, min_count=1)
    return doc_vectors(model, clean, "BeerName", expand=True)


@query("embedding_mean_by_label", sql="""
WITH e AS (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS dim
           FROM embeddings)
SELECT label, CAST(dim AS INTEGER) AS dim, round((avg(v)) + 1e-10, 6) AS value
FROM e GROUP BY label, dim""")
def embedding_mean_by_label(spark, sf):
    """M21 averaging rule: a group's vector is the mean of its members' vectors."""
    emb = read_table(spark, sf, "embeddings", "label", "embedding")
    long = emb.select("label", F.posexplode("embedding").alias("dim", "v"))
    return long.groupBy("label", "dim").agg(r6(F.avg("v")).alias("value"))


@query("beername_text_classifier")
def beername_text_classifier(spark, sf):
    named = cut_lineage(rt.ratings(spark, sf).select(
        "RowID", "split", (F.round(F.col("rating") * 2) / 2).alias("rating"), "BeerName"))  # labels on the half-point scale
    clean = prepare_text(named.select("RowID", "BeerName"), "BeerName")
    j = cut_lineage(clean.join(named.select("RowID", "split", "rating"), "RowID"), _NAME_ROWS)  # read by both fits and the scoring
    model = fit_text_classifier(_split(j, "train"), "BeerName", max_iter=20)
    p = predict_text_classifier(model, j.where(F.col("split") != "train"), "BeerName")
    return p.select("RowID", r6("est").alias("est"))


# ---------------------------------------------------------------- J3 / J7 / M24 / A26
@query("prediction_fanout", sql=_baseline_sql("") + """,
li AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey AS BeerID, o.o_custkey AS ReviewerID
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT li.l_orderkey, li.l_linenumber, li.BeerID, li.ReviewerID, round((p.est) + 1e-10, 6) AS est
FROM li JOIN (SELECT pr.est, r.BeerID AS uid, r.ReviewerID AS iid FROM pred pr
              JOIN ratings r ON pr.RowID = r.RowID) p
  ON li.BeerID = p.uid AND li.ReviewerID = p.iid""")
def prediction_fanout(spark, sf):
    """Raw line items (pairs repeat) ⋈ predictions on (uid, iid) — fans out."""
    t = rt.stored_triples(spark, sf)
    model = fit_baseline(_split(t, "train"))
    preds = model.predict(_targets(t)).select(F.col("BeerID").alias("uid"),
                                             F.col("ReviewerID").alias("iid"), "est")
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    orders = read_table(spark, sf, "orders", "o_orderkey", "o_custkey")
    ids = li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("BeerID"),
        F.col("o_custkey").alias("ReviewerID"))
    j = join_predictions(ids, preds, "BeerID", "ReviewerID", "uid", "iid")
    return j.select("l_orderkey", "l_linenumber", "BeerID", "ReviewerID", r6("est").alias("est"))


def _slope_baseline_sql() -> str:
    ctes, bu, bi = q.baseline_ctes(10, 15.0, 10.0, prefix="b_")
    return q.with_ctes(*_BASE, *ctes, """hist AS (
  SELECT tg.RowID, tg.u, tg.i, t.i AS j FROM tg JOIN tr t ON t.u = tg.u)""",
        "np AS (SELECT DISTINCT i AS x, j AS y FROM hist)",
        "dev AS (SELECT p.x AS i, p.y AS j, avg(a.r - b.r) AS dev FROM np p JOIN tr a ON a.i = p.x "
        "JOIN tr b ON b.i = p.y AND b.u = a.u GROUP BY p.x, p.y)",
        "agg AS (SELECT h.RowID, avg(d.dev) AS mean_dev FROM hist h JOIN dev d ON d.i = h.i AND d.j = h.j "
        "GROUP BY h.RowID)",
        "so AS (SELECT tg.RowID, least(greatest(coalesce(CASE WHEN us.mean_u IS NOT NULL AND ki.i IS NOT NULL "
        "THEN us.mean_u + coalesce(a.mean_dev, 0) END, gs.mu), 0.0), 5.0) AS est FROM tg "
        "LEFT JOIN agg a ON tg.RowID = a.RowID LEFT JOIN us ON us.u = tg.u LEFT JOIN ki ON ki.i = tg.i, gs)",
        f"bl AS (SELECT tg.RowID, least(greatest(m.mu + coalesce(bu.bu, 0) + coalesce(bi.bi, 0), 0.0), 5.0) AS est "
        f"FROM tg LEFT JOIN {bu} bu ON bu.u = tg.u LEFT JOIN {bi} bi ON bi.i = tg.i, b_mu m)") + """
SELECT r.RowID, r.split, round((r.rating) + 1e-10, 6) AS rating,
       round((bl.est) + 1e-10, 6) AS baseline, round((so.est) + 1e-10, 6) AS slope_one
FROM ratings r JOIN bl ON r.RowID = bl.RowID JOIN so ON r.RowID = so.RowID"""


@query("ensemble_frame", sql=_slope_baseline_sql())
def ensemble_frame_q(spark, sf):
    """Two models' predictions pivoted next to (RowID, split, rating)."""
    t = rt.stored_triples(spark, sf)
    tr, tg = _split(t, "train"), _targets(t)
    preds = {name: cut_lineage(fit(tr).predict(tg).select("RowID", "est"))  # one after another
             for name, fit in (("baseline", fit_baseline), ("slope_one", fit_slope_one))}
    long = long_predictions(preds)
    for p in preds.values():
        drop_snapshot(p)
    wide = ensemble_frame(tg.select("RowID", "split", "rating"), long, ["baseline", "slope_one"])
    return wide.select("RowID", "split", *[r6(c).alias(c) for c in ("rating", "baseline", "slope_one")])


def stacked_run(spark, sf, base_models=None):
    """Base models on train → predictions for val and test → one long table
    → pivot → meta-model fitted on val → report."""
    t = rt.stored_triples(spark, sf)
    tr, tg = _split(t, "train"), _targets(t)
    if base_models is None:
        bsl = fit_baseline(tr)
        base_models = {
            "baseline": lambda d: bsl, "slope_one": fit_slope_one,
            "knn_means": lambda d: fit_knn(d, "means", k=80),
            "svd": lambda d: fit_svd(d, baseline=bsl)}  # the same biases, fitted once
    def fit_predict(fit):
        return cut_lineage(fit(tr).predict(tg).select("RowID", "est"))

    def gbt_features():
        e = _eng(spark, sf)
        cols = _feature_cols(e)
        gbt = fit_gbt(_split(e, "train"), cols, max_iter=20, max_depth=5)
        return handed_on(gbt.predict(e.where(F.col("split") != "train").select("RowID", *cols)).select("RowID", "est"))

    tasks = {name: (lambda fit=fit: fit_predict(fit)) for name, fit in base_models.items()}
    tasks["gbt_features"] = gbt_features
    preds = run_concurrently(tasks, max_workers=1)  # the tables of two models are never on disk together
    long = long_predictions(preds)
    for p in preds.values():
        drop_snapshot(p)
    models = list(preds)
    base = tg.select("RowID", "split", "rating")
    stacked = stack(long, base, models, kind="gbt", max_iter=20, max_depth=3)
    return long, base, stacked


@query("model_report", bench=True)
def model_report(spark, sf):
    """Per-model validation MAE plus the stacked ensemble rows."""
    long, base, stacked = stacked_run(spark, sf)
    return report(long, base, stacked).select("model", r6("mae").alias("mae"), "n")


@query("ensemble_test_run")
def ensemble_test_run(spark, sf):
    """E3 output: the stacked score for every test row (RowID, Score)."""
    _, _, stacked = stacked_run(spark, sf)
    return stacked["scored"].where(F.col("split") == "test").select("RowID", r6("est").alias("Score"))


# ---------------------------------------------------------------- M26–M29
def _train(spark, sf):
    return _split(rt.rating_triples(spark, sf), "train")


@query("baseline_cv", sql=q.with_ctes(q.RATINGS_CTE, *q.cv_baseline_ctes(5, 10, 15.0, 10.0)) + """
SELECT fold::int AS fold, round(mae + 1e-10, 6) AS mae, n FROM cv""")
def baseline_cv(spark, sf):
    """5-fold CV of the baseline, all folds in the same jobs."""
    d = op.fold_rows(_train(spark, sf), 5)
    return op.scores(d, {"baseline": op.baselines(d).estimates()}).select("fold", r6("mae").alias("mae"), "n")


_KINDS = ("basic", "means", "zscore", "baseline")


def _exact_scores(d, bias):
    """(algorithm, fold, mae) of the algorithms without a start by chance, one after another."""
    out = op.scores(d, {"normal": op.normal(d), "baseline": bias.estimates()})
    out = out.unionByName(op.scores(d, {"slope_one": op.slope_one(d)}))
    near = op.fold_scores(d, op.knn_estimates(d, op.knn_top(d), _KINDS, bias=bias), ["kind"])
    return out.unionByName(near.select(F.concat(F.lit("knn_"), "kind").alias("algorithm"), "fold", "mae", "n"))


def bake_off_scores(d):
    """The scores (algorithm, fold, mae) of all eleven algorithms, one after another; what an algorithm wrote is
    deleted when it is scored, and those whose rows are stacked by fold take as many folds at once as ``op.STACKED`` allows."""
    bias = op.baselines(d)
    r, tests = op.stacked(d), op.tests(d)

    def coclustering(folds):
        return cc.estimates(op.batch(tests, folds), cc.cocluster(op.batch(r, folds), 3, 3, 20, 42), 3, 3)

    def svdpp(folds):
        users, items, mu = factors.descend(op.batch(r, folds), 10, 20, reg=0.2)
        return factors.estimates(op.batch(tests, folds), users, items, mu, 10)

    def als(*settings):
        some = lambda t, folds: t.where(F.col("g").between(folds[0], folds[-1]))
        return lambda folds: als_folds(d, some(r, folds), some(tests, folds), *settings)

    out = _exact_scores(d, bias)
    for name, estimates in {"coclustering": coclustering, "svdpp": svdpp, "svd": als(30, 0.1, 10, bias), "nmf": als(15, 0.06, 15, None)}.items():
        for folds in op.in_batches(d):
            e = estimates(folds)
            out = out.unionByName(op.scores(d, {name: e.select("row", "fold", "r", clip(F.col("est")).alias("est"))}))
            drop_snapshot(e, keep=(d.rows, bias.bu, bias.bi))
    return out


@query("algorithm_bake_off")
def algorithm_bake_off(spark, sf):
    """The eleven algorithms under the same 5 folds, each fitted for all folds at once."""
    d = op.fold_rows(_train(spark, sf), 5)
    return op.summary(bake_off_scores(d)).select(
        "algorithm", r6("mean_mae").alias("mean_mae"), r6("std_mae").alias("std_mae"))


@query("exact_bake_off", sql=q.with_ctes(q.RATINGS_CTE, *q.cv_baseline_ctes(5, 10, 15.0, 10.0), *q.cv_bake_off_ctes(5)) + """
SELECT algorithm, round(avg(mae) + 1e-10, 6) AS mean_mae, round(stddev_pop(mae) + 1e-10, 6) AS std_mae FROM maes GROUP BY algorithm""")
def exact_bake_off(spark, sf):
    """The algorithms of the bake-off without a start by chance (M1 to M6, M10) under its 5 folds."""
    d = op.fold_rows(_train(spark, sf), 5)
    return op.summary(_exact_scores(d, op.baselines(d))).select(
        "algorithm", r6("mean_mae").alias("mean_mae"), r6("std_mae").alias("std_mae"))


_GRID = {"reg_u": [4.0, 15.0], "reg_i": [8.0, 10.0], "n_epochs": [5, 10]}


def _grid_scores(d, estimates, settings):
    """(params, mean_mae) of estimates (row, setting, est)."""
    return _grid_means(op.fold_scores(d, estimates, ["setting"]), settings)


def _grid_means(per_fold, settings):
    """(params, mean_mae) of the folds' scores (setting, fold, mae)."""
    text = F.element_at(F.array(*[F.lit(op.params_text(s)) for s in settings]), F.col("setting") + 1)
    return per_fold.groupBy("setting").agg(F.avg("mae").alias("mean_mae")).select(text.alias("params"), r6("mean_mae").alias("mean_mae"))


@query("baseline_grid_search", sql=q.with_ctes(q.RATINGS_CTE, *[c for s in op.combinations(_GRID) for c in q.cv_baseline_ctes(
    3, s["n_epochs"], s["reg_u"], s["reg_i"], q.setting_prefix(s))]) + " UNION ALL ".join(
    f"SELECT '{op.params_text(s)}' AS params, round(avg(mae) + 1e-10, 6) AS mean_mae FROM {q.setting_prefix(s)}cv"
    for s in op.combinations(_GRID)))
def baseline_grid_search(spark, sf):
    """Grid over the ALS baseline's epochs and regularisation, 3-fold CV, all models in the same jobs."""
    d, settings = op.fold_rows(_train(spark, sf), 3), op.combinations(_GRID)
    return _grid_scores(d, op.baselines(d, settings).estimates(), settings)


#: The neighbour grid that is searched.
_KNN_GRID = {"k": [10, 20, 40, 60], "min_k": [1, 2], "min_support": [1, 2]}


@query("knn_grid_search", sql=q.with_ctes(q.RATINGS_CTE, *q.cv_knn_ctes(5, _KNN_GRID["min_support"], 60)) + " UNION ALL ".join(
    f"SELECT '{op.params_text(s)}' AS params, round(avg(mae) + 1e-10, 6) AS mean_mae FROM ({q.cv_knn_mae('means', **s)})"
    for s in op.combinations(_KNN_GRID)))
def knn_grid_search(spark, sf):
    """Grid over k, min_k and min_support of the neighbour model with means, 5-fold CV, one table of neighbours."""
    d, settings = op.fold_rows(_train(spark, sf), 5), op.combinations(_KNN_GRID)
    top = op.knn_top(d, k=max(_KNN_GRID["k"]), min_supports=_KNN_GRID["min_support"])
    return _grid_scores(d, op.knn_estimates(d, top, ("means",), settings), settings)


#: The factor grid that is searched.
_SVD_GRID = {"lr": [0.01, 0.05, 0.005], "reg": [0.4, 0.2, 0.01]}
_SVD_EPOCHS = (5, 10)


@query("svd_grid_search")
def svd_grid_search(spark, sf):
    """Grid over epochs, learning rate and penalty of the biased factor model, 3-fold CV; the models of as many settings
    and folds as ``op.STACKED`` allows move in the same jobs, those of fewer epochs are the states on the way."""
    d, settings = op.fold_rows(_train(spark, sf), 3), op.combinations(_SVD_GRID)
    runs = op.in_batches(d)
    at_once = max(1, min(len(settings), op.STACKED // max(sum(d.sizes) * (d.k - 1), 1))) if len(runs) == 1 else 1
    scored = []
    for first in range(0, len(settings), at_once):
        some = settings[first:first + at_once]
        n, names = len(some), ["lr", "reg"]
        for folds in runs:
            held = lambda t: t.where(F.col("g").between(folds[0] * n, (folds[-1] + 1) * n - 1)).withColumn("g", F.col("g") - folds[0] * n)  # noqa: E731, B023
            lr, reg = ([s[c] for s in some] * len(folds) for c in names)
            states = []
            factors.descend(held(op.stacked(d, n)), 10, max(_SVD_EPOCHS), lr=lr, reg=reg, implicit=False,
                                      each=lambda e, users, items: states.append((e, users, items)) if e in _SVD_EPOCHS else False)  # noqa: B023
            for epoch, users, items in states:
                est = factors.estimates(held(op.tests(d, n)), users, items, [d.mu[f] for f in folds for _ in some], 10)
                at = F.col("g") % n + _SVD_EPOCHS.index(epoch) * len(settings) + first
                scored.append(op.fold_scores(d, est.select("row", "fold", "r", at.alias("setting"), clip(F.col("est")).alias("est")), ["setting"]))
            for _, users, _ in states:
                drop_snapshot(users)
    named = [{"n_epochs": e} | s for e in _SVD_EPOCHS for s in settings]
    return _grid_means(reduce(lambda a, b: a.unionByName(b), scored), named)


@query("gbt_random_search")
def gbt_random_search(spark, sf):
    """Seeded random search over boosting parameters, scored on validation."""
    e = _eng(spark, sf)
    cols = _feature_cols(e)
    tr, va = _split(e, "train"), _split(e, "val")

    def objective(p):
        m = fit_gbt(tr, cols, max_iter=int(p["max_iter"]), max_depth=int(p["max_depth"]),
                    step_size=p["step_size"])
        return mae_value(m.predict(va))

    space = {"max_iter": (5, 20, "int"), "max_depth": (2, 6, "int"), "step_size": (0.05, 0.3, "log")}
    return random_search(objective, space, n_trials=3).select("trial", "params", r6("value").alias("value"))


# ---------------------------------------------------------------- S1–S5 / K1–K6 round trips
@query("tsv_roundtrip", sql=q.with_ctes(q.NAMED_RATINGS_CTE) + """
SELECT RowID, BeerID, ReviewerID, BeerName, BeerType, round((rating) + 1e-10, 6) AS rating FROM named""")
def tsv_roundtrip(spark, sf):
    """K2-style headerless TSV written to the shared scratch folder, read back by S1."""
    path = scratch_path(spark, "ratings-tsv")
    named = rt.ratings(spark, sf).drop("split")
    named.write.mode("overwrite").option("sep", "\t").option("header", False).csv(path)
    back = fs.read_ratings(spark, path, "string")
    return back.withColumn("rating", r6("rating"))


@query("run_file_roundtrip", sql=_baseline_sql("SELECT RowID, round((est) + 1e-10, 6) AS Score FROM pred"))
def run_file_roundtrip(spark, sf):
    """K1 subrun CSV → K3 conversion → K2 run TSV → read back."""
    t = rt.stored_triples(spark, sf)
    model = fit_baseline(_split(t, "train"))
    p = model.predict(_targets(t))
    sub, run = scratch_path(spark, "subrun"), scratch_path(spark, "run")
    fs.write_subrun(p, sub)
    fs.subrun_to_run(spark, sub, run, "string")
    return fs.read_run(spark, run, "string").select("RowID", r6("Score").alias("Score"))


# ---------------------------------------------------------------- streaming (M23 on a stream)
@query("stream_scored_lines", sql=_baseline_sql("") + """,
li AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey AS BeerID, o.o_custkey AS ReviewerID
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT li.l_orderkey, li.l_linenumber, li.BeerID, li.ReviewerID, round((p.est) + 1e-10, 6) AS est
FROM li JOIN (SELECT pr.est, r.BeerID, r.ReviewerID FROM pred pr JOIN ratings r ON pr.RowID = r.RowID) p
  ON li.BeerID = p.BeerID AND li.ReviewerID = p.ReviewerID""")
def stream_scored_lines(spark, sf):
    """Line items arriving as a file stream, scored by a baseline fitted on train."""
    from ratecraft.streaming.scoring import run_scoring
    t = rt.stored_triples(spark, sf)
    model = fit_baseline(_split(t, "train"))
    preds = cut_lineage(model.predict(_targets(t)).select("BeerID", "ReviewerID", "est"))
    out = run_scoring(spark, sf, preds)
    return out.select("l_orderkey", "l_linenumber", "BeerID", "ReviewerID", r6("est").alias("est"))


# ---------------------------------------------------------------- E2 / E1 end to end
@query("collaborative_run", sql=_baseline_sql(
    "SELECT split, round((avg(abs(rating - est))) + 1e-10, 6) AS mae, count(*) AS n FROM pred GROUP BY split"))
def collaborative_run(spark, sf):
    """Fit (K7), load what was saved (K7) → predict → subrun file (K1) → ids ⋈ subrun on the pair (J3,
    deduplicated) → MAE per split (A13)."""
    t = rt.stored_triples(spark, sf)
    saved_at = scratch_path(spark, "model-baseline")
    fs.fit_or_load_baseline(_split(t, "train"), saved_at)
    model = fs.fit_or_load_baseline(_split(t, "train"), saved_at)
    sub = scratch_path(spark, "subrun-baseline")
    fs.write_subrun(model.predict(_targets(t)), sub)
    preds = fs.read_csv_header(spark, sub, fs.with_row_id(fs.SUBRUN_SCHEMA, "string")).select(
        F.col("BeerID").alias("uid"), F.col("ReviewerID").alias("iid"), F.col("Predict").alias("est"))
    j = join_predictions(_targets(t), preds, dedupe=True)
    return (j.groupBy("split").agg(F.avg(F.abs(F.col("rating") - F.col("est"))).alias("mae"),
                                   F.count(F.lit(1)).alias("n"))
            .select("split", r6("mae").alias("mae"), "n"))


@query("feature_table_build")
def feature_table_build(spark, sf):
    """Encoded features + BeerName document vectors (M18 → M20 → M21), written
    once partitioned by split (K6) and read back."""
    e = _eng(spark, sf)
    clean = _clean_names(cut_lineage(rt.ratings(spark, sf).select("RowID", "BeerName")))
    # the names meet the features before they become vectors: 200 numbers a row are never shuffled
    table = e.drop("BeerName").join(clean, "RowID")
    table = doc_vectors(fit_word2vec(clean, "BeerName", dim=200), table, "BeerName", expand=True,
                        keep=[c for c in e.columns if c not in ("RowID", "BeerName")])
    path = scratch_path(spark, "features-by-split")
    fs.write_split_tables(table, path)
    return spark.read.parquet(path)
