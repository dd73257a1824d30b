"""Registered queries: aggregates, joins, sorts, sets, date / numeric functions,
encoding and scaling over the ratings data model."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratecraft.functions import dates as dt
from ratecraft.functions import encode as enc
from ratecraft.functions import numeric as num
from ratecraft.operators import aggregates as agg
from ratecraft.operators import columns as cols
from ratecraft.operators import joins as jn
from ratecraft.operators import ranking as rk
from ratecraft.operators import stats as st
from ratecraft.plans import oracle_sql as q
from ratecraft.plans.catalog import query
from ratecraft.plans.features import engineered_features
from ratecraft.plans.queries_core import r6
from ratecraft.session import handed_on
from ratecraft.sources import ratings as rt
from ratecraft.sources.tables import read_table

W = q.with_ctes


def _train(t):
    return t.where(F.col("split") == "train")


# ---------------------------------------------------------------- A1 / A2 / W1
@query("review_counts", sql=W(q.RATINGS_CTE) + """
SELECT r.RowID, r.split, rc.n AS ReviewerReviewCount, bc.n AS BeerReviewCount
FROM ratings r
JOIN (SELECT split, ReviewerID, count(*) AS n FROM ratings GROUP BY split, ReviewerID) rc
  ON r.split = rc.split AND r.ReviewerID = rc.ReviewerID
JOIN (SELECT split, BeerID, count(*) AS n FROM ratings GROUP BY split, BeerID) bc
  ON r.split = bc.split AND r.BeerID = bc.BeerID""")
def review_counts(spark, sf):
    t = agg.add_review_counts(rt.rating_triples(spark, sf))
    return t.select("RowID", "split", "ReviewerReviewCount", "BeerReviewCount")


# ---------------------------------------------------------------- A3 / A4 / A5
@query("type_mean_rating", sql=W(q.NAMED_RATINGS_CTE) + """
SELECT BeerType, round((avg(rating)) + 1e-10, 6) AS mean_rating FROM named WHERE split = 'train' GROUP BY BeerType""")
def type_mean_rating(spark, sf):
    g = agg.group_mean(_train(rt.ratings(spark, sf)), "BeerType")
    return g.select("BeerType", r6("mean_rating").alias("mean_rating"))


@query("type_reviewer_count", sql=W(q.NAMED_RATINGS_CTE) + """
SELECT BeerType, count(ReviewerID) AS n FROM named GROUP BY BeerType""")
def type_reviewer_count(spark, sf):
    return agg.group_count(rt.ratings(spark, sf), "BeerType", "ReviewerID")


@query("type_value_counts", sql=W(q.NAMED_RATINGS_CTE) + """
SELECT BeerType, count(*) AS n FROM named GROUP BY BeerType ORDER BY n DESC, BeerType""")
def type_value_counts(spark, sf):
    return agg.value_counts(rt.ratings(spark, sf), "BeerType")


# ---------------------------------------------------------------- A6 / A7 / A11 / A12
@query("rating_describe", sql=W(q.RATINGS_CTE) + """
SELECT split, count(rating) AS count, round((avg(rating)) + 1e-10, 6) AS mean,
       round((stddev_samp(rating)) + 1e-10, 6) AS std, round((min(rating)) + 1e-10, 6) AS min,
       round((quantile_cont(rating, 0.25)) + 1e-10, 6) AS q25, round((quantile_cont(rating, 0.5)) + 1e-10, 6) AS q50,
       round((quantile_cont(rating, 0.75)) + 1e-10, 6) AS q75, round((max(rating)) + 1e-10, 6) AS max
FROM ratings GROUP BY split""")
def rating_describe(spark, sf):
    d = st.describe(rt.rating_triples(spark, sf), "rating", by="split")
    return d.select("split", "count", *[r6(c).alias(c) for c in
                                        ("mean", "std", "min", "q25", "q50", "q75", "max")])


_FEATURE_COLS = ["RowID", "BrewerID", "ABV", "DayofWeek", "Month", "DayofMonth", "Year",
                 "TimeOfDay", "Gender", "Birthday", "split"]


@query("feature_null_report", sql=W(q.FEATURES_CTE) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS col_name, count(*) - count({c}) AS nulls FROM feat" for c in _FEATURE_COLS))
def feature_null_report(spark, sf):
    return st.null_counts(rt.features(spark, sf)).withColumnRenamed("column", "col_name")


@query("abv_report", sql=W(q.FEATURES_CTE, """qs AS (
  SELECT quantile_cont(ABV, 0.25) AS q1, quantile_cont(ABV, 0.5) AS med,
         quantile_cont(ABV, 0.75) AS q3 FROM feat)""") + """
SELECT count(*) AS records, count(*) - count(ABV) AS nulls, CAST(count_if(ABV = 0) AS BIGINT) AS zeros,
  round((min(ABV)) + 1e-10, 6) AS min, round((max(ABV)) + 1e-10, 6) AS max, round((avg(ABV)) + 1e-10, 6) AS mean,
  round((any_value(med)) + 1e-10, 6) AS median, round((stddev_pop(ABV)) + 1e-10, 6) AS sd,
  round((any_value(q1)) + 1e-10, 6) AS q1, round((any_value(q3)) + 1e-10, 6) AS q3,
  round((any_value(q3 - q1)) + 1e-10, 6) AS iqr,
  round((any_value(q1 - 1.5 * (q3 - q1))) + 1e-10, 6) AS lower_fence,
  round((any_value(q3 + 1.5 * (q3 - q1))) + 1e-10, 6) AS upper_fence,
  CAST(count_if(ABV < q1 - 1.5 * (q3 - q1)) AS BIGINT) AS lower_outliers,
  CAST(count_if(ABV > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS upper_outliers,
  CAST(count_if(ABV < q1 - 1.5 * (q3 - q1)) + count_if(ABV > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS total_outliers
FROM feat, qs""")
def abv_report(spark, sf):
    rep = st.column_report(rt.features(spark, sf), "ABV")
    dbl = ["min", "max", "mean", "median", "sd", "q1", "q3", "iqr", "lower_fence", "upper_fence"]
    return rep.select(*[r6(c).alias(c) if c in dbl else F.col(c) for c in rep.columns])


def _hist_sql(src: str, col: str, bins: int, where: str) -> str:
    return f"""
, src AS (SELECT {col} AS v FROM {src} WHERE {col} IS NOT NULL {where}),
mm AS (SELECT min(v) AS lo, max(v) AS hi FROM src),
w AS (SELECT lo, CASE WHEN hi > lo THEN hi - lo ELSE 1.0 END AS width FROM mm),
b AS (SELECT CAST(least(floor((v - w.lo) / w.width * {bins}) + 1, {bins}) AS INTEGER) AS bin
      FROM src, w),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin),
e AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, {bins} + 1))
SELECT e.bin, round((w.lo + (e.bin - 1) * (w.width / {bins})) + 1e-10, 6) AS bin_lo,
       round((w.lo + e.bin * (w.width / {bins})) + 1e-10, 6) AS bin_hi, coalesce(c.n, 0) AS n
FROM e LEFT JOIN c ON e.bin = c.bin, w"""


@query("rating_histogram", sql="WITH " + q.RATINGS_CTE + _hist_sql("ratings", "rating", 20,
                                                                  "AND split = 'train'"))
def rating_histogram(spark, sf):
    h = st.histogram(_train(rt.rating_triples(spark, sf)), "rating", 20)
    return h.select("bin", r6("bin_lo").alias("bin_lo"), r6("bin_hi").alias("bin_hi"), "n")


@query("abv_histogram_positive", sql="WITH " + q.FEATURES_CTE + _hist_sql("feat", "ABV", 10, "AND ABV > 0"))
def abv_histogram_positive(spark, sf):
    h = st.histogram(rt.features(spark, sf), "ABV", 10, positive_only=True)
    return h.select("bin", r6("bin_lo").alias("bin_lo"), r6("bin_hi").alias("bin_hi"), "n")


# ---------------------------------------------------------------- A8 / A9 / A10
@query("distinct_beer_types", sql=W(q.NAMED_RATINGS_CTE) + """
SELECT DISTINCT BeerID, BeerType FROM named""")
def distinct_beer_types(spark, sf):
    return rt.ratings(spark, sf).select("BeerID", "BeerType").distinct()


@query("beer_profile", sql=W(q.NAMED_RATINGS_CTE) + """
SELECT BeerID, BeerType, round((coalesce(avg(rating), 0)) + 1e-10, 6) AS mean_rating,
       count(ReviewerID) AS n_reviewers
FROM named WHERE split = 'train' GROUP BY BeerID, BeerType""")
def beer_profile(spark, sf):
    p = agg.item_profile(_train(rt.ratings(spark, sf)))
    return p.withColumn("mean_rating", r6("mean_rating"))


@query("reviewer_profile", sql=W(q.RATINGS_CTE) + """
SELECT ReviewerID, count(*) AS n_reviews, round((avg(rating)) + 1e-10, 6) AS mean_rating
FROM ratings WHERE split = 'train' GROUP BY ReviewerID ORDER BY n_reviews DESC, ReviewerID""")
def reviewer_profile(spark, sf):
    p = agg.user_profile(_train(rt.rating_triples(spark, sf)))
    return p.withColumn("mean_rating", r6("mean_rating"))


# ---------------------------------------------------------------- A21–A23 (NDCG)
_REL_CTE = """rel AS (
  SELECT d.source AS query_id, l.quality AS label, d.doc_id AS pos
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

_NDCG_CTES = [_REL_CTE, """g AS (
  SELECT query_id, label, row_number() OVER (PARTITION BY query_id ORDER BY pos) AS rk,
         row_number() OVER (PARTITION BY query_id ORDER BY label DESC, pos) AS irk FROM rel)""",
              """nd AS (
  SELECT query_id,
    sum(CASE WHEN rk <= 10 THEN (pow(2.0, label) - 1) / log2(rk + 1) ELSE 0 END) AS dcg,
    sum(CASE WHEN irk <= 10 THEN (pow(2.0, label) - 1) / log2(irk + 1) ELSE 0 END) AS idcg
  FROM g GROUP BY query_id)"""]


def _relevance(spark, sf):
    lab = read_table(spark, sf, "labels", "doc_id", "quality")
    docs = read_table(spark, sf, "documents", "doc_id", "source")
    return lab.join(docs, "doc_id").select(F.col("source").alias("query_id"),
                                           F.col("quality").alias("label"),
                                           F.col("doc_id").alias("pos"))


@query("ndcg_by_source", sql=W(*_NDCG_CTES) + """
SELECT query_id, round((dcg) + 1e-10, 6) AS dcg, round((idcg) + 1e-10, 6) AS idcg,
       round((CASE WHEN idcg = 0 THEN 1.0 ELSE dcg / idcg END) + 1e-10, 6) AS ndcg FROM nd""")
def ndcg_by_source(spark, sf):
    n = rk.ndcg_at_k(_relevance(spark, sf), "query_id", "label", "pos", 10)
    return n.select("query_id", *[r6(c).alias(c) for c in ("dcg", "idcg", "ndcg")])


@query("mean_ndcg", sql=W(*_NDCG_CTES) + """
SELECT round((avg(CASE WHEN idcg = 0 THEN 1.0 ELSE dcg / idcg END)) + 1e-10, 6) AS mean_ndcg,
       count(*) AS n_queries FROM nd""")
def mean_ndcg(spark, sf):
    m = rk.mean_ndcg(_relevance(spark, sf), "query_id", "label", "pos", 10)
    return m.select(r6("mean_ndcg").alias("mean_ndcg"), "n_queries")


# ---------------------------------------------------------------- J1 / J4 / J5 / P7 / P8
@query("features_joined", sql=W(q.FEATURES_CTE) + """
SELECT r.RowID, round((r.rating) + 1e-10, 6) AS rating, r.split, f.ABV, f.Year, f.Gender
FROM ratings r JOIN feat f ON r.RowID = f.RowID""")
def features_joined(spark, sf):
    j = jn.join_features(rt.rating_triples(spark, sf), rt.features(spark, sf),
                         ["ABV", "Year", "Gender"])
    return j.select("RowID", r6("rating").alias("rating"), "split", "ABV", "Year", "Gender")


@query("beer_context_columns", sql=W(q.FEATURES_CTE) + """
SELECT r.RowID, r.BeerID, r.ReviewerID, round((r.rating) + 1e-10, 6) AS rating, r.split, f.BrewerID, f.ABV
FROM ratings r JOIN feat f ON r.RowID = f.RowID""")
def beer_context_columns(spark, sf):
    j = jn.join_features(rt.rating_triples(spark, sf), rt.features(spark, sf))
    return cols.beer_context(j).withColumn("rating", r6("rating"))


@query("consumer_context_columns", sql=W(q.FEATURES_CTE) + """
SELECT r.RowID, r.BeerID, r.ReviewerID, round((r.rating) + 1e-10, 6) AS rating, r.split,
       f.DayofWeek, f.Month, f.DayofMonth, f.Year, f.TimeOfDay, f.Gender, f.Birthday
FROM ratings r JOIN feat f ON r.RowID = f.RowID""")
def consumer_context_columns(spark, sf):
    j = jn.join_features(rt.rating_triples(spark, sf), rt.features(spark, sf))
    return cols.consumer_context(j).withColumn("rating", r6("rating"))


@query("beer_outer_profile", sql=W(q.RATINGS_CTE) + """
SELECT BeerID, round((a.mean_rating) + 1e-10, 6) AS mean_rating, coalesce(b.n_val, 0) AS n_val
FROM (SELECT BeerID, avg(rating) AS mean_rating FROM ratings WHERE split = 'train' GROUP BY BeerID) a
FULL OUTER JOIN (SELECT BeerID, count(*) AS n_val FROM ratings WHERE split = 'val' GROUP BY BeerID) b
USING (BeerID)""")
def beer_outer_profile(spark, sf):
    t = rt.rating_triples(spark, sf)
    a = agg.group_mean(_train(t), "BeerID")
    b = t.where(F.col("split") == "val").groupBy("BeerID").agg(F.count(F.lit(1)).alias("n_val"))
    return jn.full_outer(a, b, "BeerID").select("BeerID", r6("mean_rating").alias("mean_rating"),
                                                F.coalesce("n_val", F.lit(0)).alias("n_val"))


# ---------------------------------------------------------------- O1–O5
@query("top_reviewers", sql=W(q.RATINGS_CTE) + """
SELECT ReviewerID, count(*) AS n_reviews FROM ratings
GROUP BY ReviewerID ORDER BY n_reviews DESC, ReviewerID LIMIT 20""")
def top_reviewers(spark, sf):
    c = rt.rating_triples(spark, sf).groupBy("ReviewerID").agg(F.count(F.lit(1)).alias("n_reviews"))
    return cols.first_n(c, 20, F.desc("n_reviews"), F.asc("ReviewerID"))


@query("top_rated_rows", sql=W(q.RATINGS_CTE) + """
SELECT RowID, BeerID, round((rating) + 1e-10, 6) AS rating FROM ratings
ORDER BY BeerID DESC, rating DESC, RowID DESC LIMIT 50""")
def top_rated_rows(spark, sf):
    t = rt.rating_triples(spark, sf)
    top = cols.first_n(t, 50, F.desc("BeerID"), F.desc("rating"), F.desc("RowID"))
    return top.select("RowID", "BeerID", r6("rating").alias("rating"))


@query("first_beer_types", sql=W(q.NAMED_RATINGS_CTE) + """
SELECT DISTINCT BeerType FROM named ORDER BY BeerType LIMIT 3""")
def first_beer_types(spark, sf):
    return rt.ratings(spark, sf).select("BeerType").distinct().orderBy("BeerType").limit(3)


# ---------------------------------------------------------------- U1 / U2 / U3
@query("union_splits", sql=W(q.RATINGS_CTE) + """
SELECT RowID, round((rating) + 1e-10, 6) AS rating, 'train' AS source FROM ratings WHERE split = 'train'
UNION ALL SELECT RowID, round((rating) + 1e-10, 6), 'val' FROM ratings WHERE split = 'val'
UNION ALL SELECT RowID, NULL, 'test' FROM ratings WHERE split = 'test'""")
def union_splits(spark, sf):
    t = rt.rating_triples(spark, sf)
    frames = {s: t.where(F.col("split") == s).select("RowID", r6("rating").alias("rating"))
              for s in ("train", "val")}
    frames["test"] = t.where(F.col("split") == "test").select("RowID")  # no rating column (S3/S4)
    return agg.tag_union(frames, "source")




# ---------------------------------------------------------------- C1–C4
@query("date_parts", sql=W(q.FEATURES_CTE) + f"""
SELECT RowID, {q.DAY_CASE.format(c='DayofWeek')} AS DayofWeek,
       {q.MONTH_CASE.format(c='Month')} AS Month,
       {q.time_sql('TimeOfDay')} AS TimeOfDay, {q.age_sql('Birthday')} AS Birthday
FROM feat""")
def date_parts(spark, sf):
    from ratecraft.plans.features import AS_OF_YEAR, date_parts as parts
    f = rt.features(spark, sf).select("RowID", "DayofWeek", "Month", "TimeOfDay", "Birthday")
    return parts(f, AS_OF_YEAR)


@query("event_time_seconds", sql=f"""
SELECT event_id, strftime(ts, '%H:%M:%S') AS tod, {q.time_sql("strftime(ts, '%H:%M:%S')")} AS seconds
FROM events""")
def event_time_seconds(spark, sf):
    ev = read_table(spark, sf, "events", "event_id", "ts")
    tod = F.date_format("ts", "HH:mm:ss")
    return ev.select("event_id", tod.alias("tod"), dt.time_to_seconds(tod).alias("seconds"))


# ---------------------------------------------------------------- C5–C9
@query("abv_transforms", sql=W(q.FEATURES_CTE, """qs AS (
  SELECT quantile_cont(ABV, 0.25) AS q1, quantile_cont(ABV, 0.75) AS q3 FROM feat)""") + """
SELECT RowID, split,
  round((coalesce(ABV, avg(ABV) OVER (PARTITION BY split))) + 1e-10, 6) AS abv_imputed,
  coalesce(ABV, 4.0) AS abv_filled,
  CASE WHEN ABV > q3 + 1.5 * (q3 - q1) OR ABV < q1 - 1.5 * (q3 - q1) THEN NULL ELSE ABV END AS abv_no_outliers,
  round((CASE WHEN ABV IS NULL THEN NULL WHEN ABV = 0 THEN 0.0 WHEN ABV > 0 THEN log10(ABV) END) + 1e-10, 6) AS abv_log10,
  CASE WHEN coalesce(ABV, 0) = 0 THEN NULL ELSE coalesce(ABV, 0) END AS abv_zero_null
FROM feat, qs""")
def abv_transforms(spark, sf):
    f = rt.features(spark, sf).select("RowID", "split", "ABV")
    f = f.withColumns({"abv_imputed": F.col("ABV"), "abv_no_outliers": F.col("ABV")})
    f = num.impute_mean(f, "abv_imputed", fit_on="each")
    f = num.remove_outliers(f, "abv_no_outliers")
    return f.select(
        "RowID", "split", r6("abv_imputed").alias("abv_imputed"),
        F.coalesce(F.col("ABV"), F.lit(4.0)).alias("abv_filled"),   # C6
        "abv_no_outliers",
        r6(num.log10_or_zero(F.col("ABV"))).alias("abv_log10"),
        num.nullif_zero(F.coalesce(F.col("ABV"), F.lit(0.0))).alias("abv_zero_null"))


# ---------------------------------------------------------------- C27–C29 + P11
_CLEAN = "regexp_replace({c}, '[ /\\-:;''\"&$@,.?!]', '', 'g')"


@query("onehot_long", sql=W(q.ENGINEERED_CTE) + f"""
SELECT RowID, 'BeerType_' || {_CLEAN.format(c='BeerType')} AS feature FROM eng
UNION ALL SELECT RowID, 'Gender_' || {_CLEAN.format(c='Gender')} FROM eng""")
def onehot_long(spark, sf):
    e = handed_on(engineered_features(spark, sf).select("RowID", "BeerType", "Gender"))  # read for each category list and the rows
    wide = enc.one_hot(enc.one_hot(e, "BeerType"), "Gender")
    hot = [c for c in wide.columns if c != "RowID"]
    return (wide.unpivot("RowID", hot, "feature", "value")
            .where(F.col("value") == 1).select("RowID", "feature"))


# ---------------------------------------------------------------- C30 / C31
def _scaled_sql(kind: str) -> str:
    if kind == "zscore":
        expr = ("CASE WHEN stddev_pop({c}) OVER (PARTITION BY split) = 0 THEN {c} - avg({c}) OVER (PARTITION BY split) "
                "ELSE ({c} - avg({c}) OVER (PARTITION BY split)) / stddev_pop({c}) OVER (PARTITION BY split) END")
    else:
        expr = ("CASE WHEN max({c}) OVER (PARTITION BY split) = min({c}) OVER (PARTITION BY split) "
                "THEN {c} - min({c}) OVER (PARTITION BY split) "
                "ELSE ({c} - min({c}) OVER (PARTITION BY split)) / "
                "(max({c}) OVER (PARTITION BY split) - min({c}) OVER (PARTITION BY split)) END")
    body = ",\n  ".join(f"round((CAST({expr.format(c=c)} AS DOUBLE)) + 1e-10, 6) AS {c}" for c in q.SCALED)
    return W(q.ENGINEERED_CTE) + f"SELECT RowID, split,\n  {body}\nFROM eng"


def _scaled(spark, sf, kind):
    from ratecraft.operators.columns import SCALED_COLS
    e = handed_on(engineered_features(spark, sf).select("RowID", "split", *SCALED_COLS))  # read for the statistics and the rows
    s = num.zscore(e, SCALED_COLS, fit_on="each") if kind == "zscore" else \
        num.minmax(e, SCALED_COLS, fit_on="each")
    return s.select("RowID", "split", *[r6(c).alias(c) for c in SCALED_COLS])


@query("scaled_features", sql=_scaled_sql("zscore"))
def scaled_features(spark, sf):
    return _scaled(spark, sf, "zscore")


@query("minmax_features", sql=_scaled_sql("minmax"))
def minmax_features(spark, sf):
    return _scaled(spark, sf, "minmax")


# ---------------------------------------------------------------- C25 / M31
@query("numeric_feature_tokens", sql=W(q.FEATURES_CTE) + """
SELECT RowID, concat_ws(',', CAST(ABV AS VARCHAR), CAST(Year AS VARCHAR),
                        CAST(DayofMonth AS VARCHAR)) AS tokens FROM feat""")
def numeric_feature_tokens(spark, sf):
    f = rt.features(spark, sf)
    return f.select("RowID", enc.comma_join(["ABV", "Year", "DayofMonth"]).alias("tokens"))


@query("interactions", sql=W(q.RATINGS_CTE) + """
SELECT DISTINCT r.ReviewerID, r.BeerID,
       concat_ws(',', CAST(p.p_size AS VARCHAR), CAST(p.p_retailprice AS VARCHAR)) AS item_tokens
FROM ratings r JOIN part p ON r.BeerID = p.p_partkey WHERE r.split = 'train'""")
def interactions(spark, sf):
    t = _train(rt.rating_triples(spark, sf)).select("ReviewerID", "BeerID").distinct()
    part = read_table(spark, sf, "part", "p_partkey", "p_size", "p_retailprice")
    j = t.join(part, t.BeerID == part.p_partkey)
    return j.select("ReviewerID", "BeerID",
                    enc.comma_join(["p_size", "p_retailprice"]).alias("item_tokens"))


# ---------------------------------------------------------------- F2 / F4 / F5 / A27
@query("abv_not_five", sql=W(q.FEATURES_CTE) + """
SELECT RowID, ABV FROM feat WHERE ABV IS DISTINCT FROM 5.0""")
def abv_not_five(spark, sf):
    """F2 with pandas semantics: ``df[df.ABV != 5]`` keeps the rows whose ABV is null."""
    f = rt.features(spark, sf).select("RowID", "ABV")
    return f.where(cols.not_equal_keep_null(F.col("ABV"), 5.0))


@query("targets_with_known_beer", sql=W(q.RATINGS_CTE) + """
SELECT RowID, split FROM ratings t
WHERE t.split <> 'train'
  AND EXISTS (SELECT 1 FROM ratings r WHERE r.split = 'train' AND r.BeerID = t.BeerID)""")
def targets_with_known_beer(spark, sf):
    """key-exists test as a left-semi join (never a per-row lookup)."""
    t = rt.rating_triples(spark, sf)
    known = t.where(F.col("split") == "train").select("BeerID")
    return cols.keys_present(known, t.where(F.col("split") != "train").select("RowID", "split", "BeerID"),
                             "BeerID").select("RowID", "split")


@query("target_abv_lookup", sql=W(q.FEATURES_CTE) + """
SELECT r.RowID, f.ABV FROM ratings r LEFT JOIN feat f ON r.RowID = f.RowID WHERE r.split = 'val'""")
def target_abv_lookup(spark, sf):
    """scalar lookup by key as an equi-join."""
    t = rt.rating_triples(spark, sf).where(F.col("split") == "val").select("RowID")
    return cols.lookup(rt.features(spark, sf), t, "RowID", "ABV")


@query("feature_table_shape", sql=W(q.FEATURES_CTE) + """
SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_cols FROM feat""")
def feature_table_shape(spark, sf):
    """(rows, columns) of the features table as a one-row result."""
    f = rt.features(spark, sf)
    return f.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(f.columns)).cast("long"))
