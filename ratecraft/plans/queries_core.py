"""Registered queries: data model and collaborative baselines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratecraft.plans import oracle_sql as q
from ratecraft.plans.baseline import fit_baseline
from ratecraft.plans.catalog import query
from ratecraft.plans.evaluate import mae
from ratecraft.sources import ratings as rt


def r6(c):
    """Round to 6 places after a 1e-10 nudge, identically on the Spark and SQL
    sides: engines round a double whose shortest decimal ends in 5 differently
    (decimal half-up vs binary value), the nudge moves it off the tie."""
    return F.round((F.col(c) if isinstance(c, str) else c) + F.lit(1e-10), 6)


def _targets(t):
    return t.where(F.col("split") != "train")


# ---------------------------------------------------------------- data model
@query("ratings_triples", sql=q.with_ctes(q.RATINGS_CTE) + """
SELECT RowID, BeerID, ReviewerID, round((rating) + 1e-10, 6) AS rating, split FROM ratings""")
def ratings_triples(spark, sf):
    t = rt.rating_triples(spark, sf)
    return t.select("RowID", "BeerID", "ReviewerID", r6("rating").alias("rating"), "split")


@query("ratings_named", sql=q.with_ctes(q.NAMED_RATINGS_CTE) + """
SELECT RowID, BeerID, ReviewerID, BeerName, BeerType, round((rating) + 1e-10, 6) AS rating, split FROM named""")
def ratings_named(spark, sf):
    t = rt.ratings(spark, sf)
    return t.withColumn("rating", r6("rating"))


@query("features_table", sql=q.with_ctes(q.FEATURES_CTE) + """
SELECT RowID, BrewerID, ABV, DayofWeek, Month, DayofMonth, Year, TimeOfDay, Gender,
       Birthday, split FROM feat""")
def features_table(spark, sf):
    return rt.features(spark, sf)


# ---------------------------------------------------------------- M2 baseline
def _baseline_sql(select_tail: str) -> str:
    ctes, bu, bi = q.baseline_ctes(10, 15.0, 10.0)
    return q.with_ctes(q.RATINGS_CTE, *ctes, f"""pred AS (
  SELECT r.RowID, r.split, r.rating,
         least(greatest(m.mu + coalesce(bu.bu, 0) + coalesce(bi.bi, 0), 0.0), 5.0) AS est
  FROM ratings r LEFT JOIN {bu} bu ON r.BeerID = bu.u LEFT JOIN {bi} bi ON r.ReviewerID = bi.i,
       mu m
  WHERE r.split <> 'train')""") + select_tail


@query("baseline_predict", sql=_baseline_sql(
    "SELECT RowID, split, round((est) + 1e-10, 6) AS est FROM pred"), bench=True)
def baseline_predict(spark, sf):
    t = rt.stored_triples(spark, sf)
    model = fit_baseline(t.where(F.col("split") == "train"))
    p = model.predict(_targets(t).select("RowID", "BeerID", "ReviewerID", "split"))
    return p.select("RowID", "split", r6("est").alias("est"))


@query("baseline_mae", sql=_baseline_sql(
    "SELECT split, round((avg(abs(rating - est))) + 1e-10, 6) AS mae, count(*) AS n FROM pred GROUP BY split"))
def baseline_mae(spark, sf):
    t = rt.stored_triples(spark, sf)
    model = fit_baseline(t.where(F.col("split") == "train"))
    p = model.predict(_targets(t).select("RowID", "BeerID", "ReviewerID", "split", "rating"))
    return mae(p, by=("split",)).select("split", r6("mae").alias("mae"), "n")
