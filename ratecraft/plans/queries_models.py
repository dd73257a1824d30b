"""Registered queries: neighbourhood recommenders (M3–M6, M10) with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratecraft.plans import oracle_sql as q
from ratecraft.plans.catalog import query
from ratecraft.plans.neighbours import fit_knn, fit_slope_one
from ratecraft.plans.queries_core import r6
from ratecraft.session import handed_on
from ratecraft.sources import ratings as rt

_BASE = [
    q.RATINGS_CTE,
    "tr AS (SELECT BeerID AS u, ReviewerID AS i, rating AS r FROM ratings WHERE split = 'train')",
    "tg AS (SELECT RowID, split, BeerID AS u, ReviewerID AS i FROM ratings WHERE split <> 'train')",
    "gs AS (SELECT avg(r) AS mu, stddev_pop(r) AS sd FROM tr)",
    "us AS (SELECT u, avg(r) AS mean_u, stddev_pop(r) AS sd_u FROM tr GROUP BY u)",
    "ki AS (SELECT DISTINCT i FROM tr)",
]

_SIM = {
    "msd": "1.0 / (s_d2 / n + 1)",
    "cosine": "CASE WHEN sqrt(s_xx * s_yy) = 0 THEN 0.0 ELSE s_xy / sqrt(s_xx * s_yy) END",
}

_FINAL = """
SELECT tg.RowID, tg.split,
       round((least(greatest(coalesce(p.est, gs.mu), 0.0), 5.0)) + 1e-10, 6) AS est,
       p.est IS NULL AS was_impossible
FROM tg JOIN pred p ON tg.RowID = p.RowID, gs"""


def knn_sql(kind: str, sim: str = "msd", k: int = 40, min_k: int = 1, min_support: int = 1) -> str:
    ctes = list(_BASE) + [
        "cand AS (SELECT tg.RowID, tg.u, tg.i, t.u AS v, t.r AS rv FROM tg JOIN tr t ON t.i = tg.i)",
        "np AS (SELECT DISTINCT least(u, v) AS x, greatest(u, v) AS y FROM cand)",
        "st AS (SELECT p.x, p.y, count(*) AS n, sum((a.r - b.r) * (a.r - b.r)) AS s_d2, "
        "sum(a.r * b.r) AS s_xy, sum(a.r * a.r) AS s_xx, sum(b.r * b.r) AS s_yy "
        "FROM np p JOIN tr a ON a.u = p.x JOIN tr b ON b.u = p.y AND b.i = a.i GROUP BY p.x, p.y)",
        f"sims AS (SELECT x, y, round(CASE WHEN n < {min_support} THEN 0.0 ELSE {_SIM[sim]} END, 12) AS sim FROM st)",
        "c2 AS (SELECT c.*, coalesce(s.sim, 0.0) AS sim FROM cand c LEFT JOIN sims s "
        "ON s.x = least(c.u, c.v) AND s.y = greatest(c.u, c.v))",
        f"top AS (SELECT * FROM (SELECT c2.*, row_number() OVER (PARTITION BY RowID ORDER BY sim DESC, v) AS rk "
        f"FROM c2) WHERE rk <= {k} AND sim > 0)",
    ]
    enough = f"coalesce(a.ak, 0) >= {min_k}"
    ratio = f"CASE WHEN {enough} AND a.ss > 0 THEN a.sdev / a.ss ELSE 0 END"
    if kind == "basic":
        ctes.append("agg AS (SELECT RowID, sum(sim) AS ss, sum(sim * rv) AS sdev, count(*) AS ak FROM top GROUP BY RowID)")
        ctes.append(f"pred AS (SELECT tg.RowID, CASE WHEN {enough} THEN a.sdev / a.ss END AS est "
                    "FROM tg LEFT JOIN agg a ON tg.RowID = a.RowID)")
    elif kind in ("means", "zscore"):
        if kind == "means":
            dev = "t.rv - m.mean_u"
            adj = ratio
        else:
            dev = "(t.rv - m.mean_u) / CASE WHEN m.sd_u = 0 THEN gs.sd ELSE m.sd_u END"
            adj = f"({ratio}) * CASE WHEN us.sd_u = 0 THEN gs.sd ELSE us.sd_u END"
        ctes.append(f"agg AS (SELECT t.RowID, sum(t.sim) AS ss, sum(t.sim * ({dev})) AS sdev, count(*) AS ak "
                    "FROM top t JOIN us m ON m.u = t.v, gs GROUP BY t.RowID)")
        ctes.append(f"pred AS (SELECT tg.RowID, CASE WHEN ki.i IS NOT NULL AND us.mean_u IS NOT NULL "
                    f"THEN us.mean_u + {adj} END AS est FROM tg LEFT JOIN agg a ON tg.RowID = a.RowID "
                    "LEFT JOIN us ON us.u = tg.u LEFT JOIN ki ON ki.i = tg.i, gs)")
    elif kind == "baseline":
        bctes, bu, bi = q.baseline_ctes(10, 15.0, 10.0, prefix="b_")
        ctes += bctes
        ctes.append(f"agg AS (SELECT t.RowID, sum(t.sim) AS ss, "
                    f"sum(t.sim * (t.rv - (m.mu + coalesce(bv.bu, 0) + coalesce(bi.bi, 0)))) AS sdev, "
                    f"count(*) AS ak FROM top t LEFT JOIN {bu} bv ON bv.u = t.v "
                    f"LEFT JOIN {bi} bi ON bi.i = t.i, b_mu m GROUP BY t.RowID)")
        ctes.append(f"pred AS (SELECT tg.RowID, m.mu + coalesce(bu.bu, 0) + coalesce(bi.bi, 0) + "
                    f"CASE WHEN bu.u IS NOT NULL AND bi.i IS NOT NULL THEN {ratio} ELSE 0 END AS est "
                    f"FROM tg LEFT JOIN agg a ON tg.RowID = a.RowID LEFT JOIN {bu} bu ON bu.u = tg.u "
                    f"LEFT JOIN {bi} bi ON bi.i = tg.i, b_mu m)")
    return q.with_ctes(*ctes) + _FINAL


def _predict(spark, sf, fit):
    t = rt.stored_triples(spark, sf)
    model = fit(t.where(F.col("split") == "train"))
    p = model.predict(t.where(F.col("split") != "train").select("RowID", "split", "BeerID", "ReviewerID"))
    return p.select("RowID", "split", r6("est").alias("est"), "was_impossible")


@query("knn_basic_msd", sql=knn_sql("basic", "msd"))
def knn_basic_msd(spark, sf):
    return _predict(spark, sf, lambda tr: fit_knn(tr, "basic", sim="msd"))


@query("knn_basic_cosine", sql=knn_sql("basic", "cosine"))
def knn_basic_cosine(spark, sf):
    return _predict(spark, sf, lambda tr: fit_knn(tr, "basic", sim="cosine"))


@query("knn_means", sql=knn_sql("means", "msd", k=80), bench=True)
def knn_means(spark, sf):
    return _predict(spark, sf, lambda tr: fit_knn(tr, "means", k=80))


@query("knn_zscore", sql=knn_sql("zscore", "msd"))
def knn_zscore(spark, sf):
    return _predict(spark, sf, lambda tr: fit_knn(tr, "zscore"))


@query("knn_baseline", sql=knn_sql("baseline", "msd"))
def knn_baseline(spark, sf):
    return _predict(spark, sf, lambda tr: fit_knn(tr, "baseline"))


@query("slope_one", sql=q.with_ctes(*_BASE, """hist AS (
  SELECT tg.RowID, tg.u, tg.i, t.i AS j FROM tg JOIN tr t ON t.u = tg.u)""",
    "np AS (SELECT DISTINCT i AS x, j AS y FROM hist)",
    "dev AS (SELECT p.x AS i, p.y AS j, avg(a.r - b.r) AS dev FROM np p JOIN tr a ON a.i = p.x "
    "JOIN tr b ON b.i = p.y AND b.u = a.u GROUP BY p.x, p.y)",
    "agg AS (SELECT h.RowID, avg(d.dev) AS mean_dev FROM hist h JOIN dev d ON d.i = h.i AND d.j = h.j "
    "GROUP BY h.RowID)",
    "pred AS (SELECT tg.RowID, CASE WHEN us.mean_u IS NOT NULL AND ki.i IS NOT NULL "
    "THEN us.mean_u + coalesce(a.mean_dev, 0) END AS est FROM tg LEFT JOIN agg a ON tg.RowID = a.RowID "
    "LEFT JOIN us ON us.u = tg.u LEFT JOIN ki ON ki.i = tg.i)") + _FINAL, bench=True)
def slope_one(spark, sf):
    return _predict(spark, sf, fit_slope_one)


# ---------------------------------------------------------------- M12 / M13 content kNN
from ratecraft.plans.content_knn import (CONTENT_COLS, fit_content_knn,  # noqa: E402
                                         item_count_vectors, item_features_mean)
from ratecraft.plans.features import engineered_features  # noqa: E402

_ENG_BASE = [
    q.ENGINEERED_CTE,
    "tr AS (SELECT BeerID AS u, ReviewerID AS i, rating AS r FROM eng WHERE split = 'train')",
    "tg AS (SELECT RowID, split, BeerID AS u, ReviewerID AS i FROM eng WHERE split <> 'train')",
    "gs AS (SELECT avg(r) AS mu FROM tr)",
    "hist AS (SELECT tg.RowID, tg.u, tg.i, t.i AS j, t.r AS rj FROM tg JOIN tr t ON t.u = tg.u)",
]
_CONTENT_TAIL = [
    "top AS (SELECT * FROM (SELECT h.*, row_number() OVER (PARTITION BY RowID ORDER BY sim DESC, j) AS rk "
    "FROM h) WHERE rk <= 40 AND sim > 0)",
    "agg AS (SELECT RowID, sum(sim * rj) / sum(sim) AS est FROM top GROUP BY RowID)",
]


def _closeness_sql() -> str:
    feats = ", ".join(f"avg({c}) AS {c}" for c in CONTENT_COLS)
    prod = " * ".join(
        f"CASE WHEN fi.{c} IS NULL OR fj.{c} IS NULL THEN 0.0 ELSE exp(-abs(fi.{c} - fj.{c}) / 10.0) END"
        for c in CONTENT_COLS)
    return q.with_ctes(*_ENG_BASE,
                       f"ft AS (SELECT ReviewerID AS i, {feats} FROM eng WHERE split = 'train' GROUP BY ReviewerID)",
                       f"h AS (SELECT hist.*, round({prod}, 12) AS sim FROM hist "
                       "LEFT JOIN ft fi ON fi.i = hist.i LEFT JOIN ft fj ON fj.i = hist.j)",
                       *_CONTENT_TAIL,
                       "pred AS (SELECT tg.RowID, CASE WHEN ki.i IS NOT NULL THEN a.est END AS est FROM tg "
                       "LEFT JOIN agg a ON tg.RowID = a.RowID LEFT JOIN ft ki ON ki.i = tg.i)") + _FINAL


def _cosine_sql() -> str:
    return q.with_ctes(
        *_ENG_BASE,
        "tc AS (SELECT ReviewerID AS i, BeerType AS t, count(*) AS c FROM eng WHERE split = 'train' "
        "GROUP BY ReviewerID, BeerType)",
        "nm AS (SELECT i, sqrt(sum(c * c)) AS nrm FROM tc GROUP BY i)",
        "hp AS (SELECT DISTINCT i, j FROM hist)",
        "dotp AS (SELECT hp.i, hp.j, sum(a.c * b.c) AS dot FROM hp JOIN tc a ON a.i = hp.i "
        "JOIN tc b ON b.i = hp.j AND b.t = a.t GROUP BY hp.i, hp.j)",
        "h AS (SELECT hist.*, round(coalesce(CASE WHEN na.nrm * nb.nrm = 0 THEN 0.0 "
        "ELSE coalesce(d.dot, 0) / (na.nrm * nb.nrm) END, 0.0), 12) AS sim FROM hist "
        "LEFT JOIN dotp d ON d.i = hist.i AND d.j = hist.j LEFT JOIN nm na ON na.i = hist.i "
        "LEFT JOIN nm nb ON nb.i = hist.j)",
        *_CONTENT_TAIL,
        "pred AS (SELECT tg.RowID, CASE WHEN ki.i IS NOT NULL THEN a.est END AS est FROM tg "
        "LEFT JOIN agg a ON tg.RowID = a.RowID LEFT JOIN nm ki ON ki.i = tg.i)") + _FINAL


def _content_predict(spark, sf, kind):
    eng = handed_on(engineered_features(spark, sf).select(
        "RowID", "split", "BeerID", "ReviewerID", "rating", *(CONTENT_COLS if kind == "closeness" else ["BeerType"])))
    train = eng.where(F.col("split") == "train")
    if kind == "closeness":
        feats = item_features_mean(train, "ReviewerID", CONTENT_COLS)
    else:
        feats = item_count_vectors(train, "ReviewerID", "BeerType")
    model = fit_content_knn(train, feats, kind=kind)
    p = model.predict(eng.where(F.col("split") != "train").select("RowID", "split", "BeerID", "ReviewerID"))
    return p.select("RowID", "split", r6("est").alias("est"), "was_impossible")


@query("content_knn", sql=_closeness_sql())
def content_knn(spark, sf):
    return _content_predict(spark, sf, "closeness")


@query("content_knn_cosine", sql=_cosine_sql())
def content_knn_cosine(spark, sf):
    return _content_predict(spark, sf, "cosine")
