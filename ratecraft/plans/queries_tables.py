"""Registered queries: file forms, column switches, reports, saved models, phrases, user aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ratecraft.functions import phrases
from ratecraft.operators import aggregates as ag
from ratecraft.operators import columns as cols
from ratecraft.operators import corpus as cp
from ratecraft.operators import mergeable as mg
from ratecraft.operators import stats as st
from ratecraft.operators.joins import anti_filter_long
from ratecraft.plans import oracle_sql as q
from ratecraft.plans.catalog import query
from ratecraft.plans.cocluster import CoClusterModel, fit_coclustering
from ratecraft.plans.factorization import FactorModel, fit_biased_mf, fit_svdpp
from ratecraft.plans.features import engineered_features
from ratecraft.plans.neighbours import KnnModel, SlopeOneModel, fit_knn, fit_slope_one
from ratecraft.plans.queries_core import r6
from ratecraft.plans.queries_relational import _NDCG_CTES, _relevance
from ratecraft.plans.queries_text import _DOC, _doc_tokens
from ratecraft.session import cut_lineage, drop_snapshot, scratch_path, shuffles_dropped
from ratecraft.sources import files as fs
from ratecraft.sources import ratings as rt
from ratecraft.sources.tables import read_table


@query("features_file_roundtrip", sql=q.with_ctes(q.FEATURES_CTE) + """
SELECT RowID, BrewerID, ABV, DayofWeek, Month, DayofMonth, Year, TimeOfDay, Gender, Birthday FROM feat""")
def features_file_roundtrip(spark, sf):
    """The thirteen-column features file, written headerless and read back."""
    path = scratch_path(spark, "features-tsv")
    feats = rt.features(spark, sf).drop("split")
    for name in ("Text", "Lemmatized", "POS_Tag"):
        feats = cols.with_constant(feats, name, None).withColumn(name, F.col(name).cast("string"))
    feats.write.option("sep", "\t").option("header", False).csv(path)
    return fs.read_features(spark, path, "string").drop("Text", "Lemmatized", "POS_Tag")


@query("test_file_forms", sql=q.with_ctes(q.NAMED_RATINGS_CTE) + """
SELECT RowID, BeerID AS uid, ReviewerID AS iid, BeerName, BeerType, f.rating::double AS rating, f.form FROM named,
  (VALUES ('placeholder', 0.0), ('empty', NULL)) f(form, rating) WHERE split = 'test'""")
def test_file_forms(spark, sf):
    """The test file read with a placeholder rating and with none, under the estimate's id names."""
    path = scratch_path(spark, "test-tsv")
    test = ag.split_back(rt.ratings(spark, sf), ["test"])["test"].drop("rating")
    test.write.option("sep", "\t").option("header", False).csv(path)
    both = ag.tag_union({"placeholder": fs.read_test(spark, path, 0.0, "string"), "empty": fs.read_test(spark, path, None, "string")}, "form")
    return cols.rename_map(both, {"BeerID": "uid", "ReviewerID": "iid"})


@query("feature_switches", sql=q.with_ctes(q.ENGINEERED_CTE) + """
SELECT RowID, round(ABV * 2 + 1e-10, 6) AS ABV, Year - 1990 AS Year, ReviewerReviewCount, BeerReviewCount, Gender FROM eng""")
def feature_switches(spark, sf):
    """Column lists, and one switch and transform a column."""
    eng = engineered_features(spark, sf)
    counts = [*cols.prefix_columns(eng, "ReviewerReview"), *cols.prefix_columns(eng, "BeerReview")]
    kept = [c for c in cols.feature_columns(eng) if c in ("ABV", "Year", "Gender", *counts)]
    off = {c: False for c in ag.column_difference(eng, ["RowID", *kept])}
    return cols.FeatureSpec(off, {"ABV": lambda c: r6(c * 2), "Year": lambda c: c - 1990}).apply(eng)


_REPORTED = {"RowID": "string", "BrewerID": "bigint", "ABV": "double", "DayofWeek": "string", "Year": "int", "Birthday": "string"}


@query("feature_schema_report", sql=q.with_ctes(q.FEATURES_CTE) + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(*) - count({c}) AS nulls FROM feat" for c, t in _REPORTED.items()))
def feature_schema_report(spark, sf):
    """Name, type and null count of every column."""
    return st.schema_report(rt.features(spark, sf).select(*_REPORTED))


@query("tokens_without_hapaxes", sql=q.with_ctes(*_DOC) + """
SELECT RowID, count(*) AS n FROM lg WHERE tok NOT IN (SELECT term FROM tf WHERE n = 1) GROUP BY RowID""")
def tokens_without_hapaxes(spark, sf):
    """J8 with an unbounded word table: the tokens of each document that occur elsewhere."""
    long = cut_lineage(cp.explode_tokens(_doc_tokens(spark, sf)))
    return anti_filter_long(long, cp.hapaxes(cp.term_frequency(long))).groupBy("RowID").agg(F.count(F.lit(1)).alias("n"))


_PHRASES = 40


@query("phrases_merged", sql=f"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z]+') AS t FROM documents),
b AS (SELECT t[i] AS a, t[i + 1] AS b, count(*) AS n FROM (SELECT t, unnest(range(1, len(t))) AS i FROM w) GROUP BY 1, 2),
top AS (SELECT list(a || ' ' || b ORDER BY n DESC, a, b) AS p FROM (SELECT * FROM b ORDER BY n DESC, a, b LIMIT {_PHRASES}))
SELECT doc_id, list_reduce(list_prepend(array_to_string(t, ' '), p),
  lambda acc, x: regexp_replace(acc, '\\b' || x || '\\b', replace(x, ' ', '_'), 'g')) AS merged FROM w, top""")
def phrases_merged(spark, sf):
    """C20: the most frequent word pairs of whole documents merged in one pass."""
    docs = read_table(spark, sf, "documents", "doc_id", "text")
    words = docs.select("doc_id", F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z]+"), F.lit(0)).alias("tokens"))
    words = cut_lineage(words)
    top = cp.bigram_frequency(words).orderBy(F.desc("n"), "a", "b").limit(_PHRASES).collect()
    joined = words.select("doc_id", F.array_join("tokens", " ").alias("merged"))
    return phrases.merge_phrases(joined, "merged", [(r["a"], r["b"]) for r in top])


@query("user_aggregates", sql=q.with_ctes(*_NDCG_CTES) + """
SELECT nd.query_id, round((CASE WHEN idcg = 0 THEN 1.0 ELSE dcg / idcg END) + 1e-10, 6) AS ndcg,
       round(m.g + 1e-10, 6) AS geometric FROM nd JOIN (SELECT query_id, exp(avg(ln(1 + label))) AS g FROM rel GROUP BY query_id) m
  ON m.query_id = nd.query_id""")
def user_aggregates(spark, sf):
    """D3: NDCG and a metric of the user's own as mergeable states, partial in every task."""
    import math
    rel = cut_lineage(_relevance(spark, sf))
    geo = mg.Aggregate(lambda: (0.0, 0), lambda s, row: (s[0] + math.log1p(row[0]), s[1] + 1),
                       lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda s: math.exp(s[0] / s[1]))
    n = mg.aggregate(rel, "query_id", ["label", "pos"], mg.ndcg(10), "ndcg")
    g = mg.aggregate(rel, "query_id", ["label"], geo, "geometric")
    return n.join(g, "query_id").select("query_id", r6("ndcg").alias("ndcg"), r6("geometric").alias("geometric"))


_SAVED = {"knn_means": (lambda tr: fit_knn(tr, "means"), KnnModel), "knn_baseline": (lambda tr: fit_knn(tr, "baseline"), KnnModel),
          "slope_one": (fit_slope_one, SlopeOneModel), "svdpp": (lambda tr: fit_svdpp(tr, n_factors=4, n_epochs=3, reg=0.2), FactorModel),
          "biased_mf": (lambda tr: fit_biased_mf(tr, n_factors=4, n_epochs=3), FactorModel),
          "coclustering": (lambda tr: fit_coclustering(tr, n_epochs=2), CoClusterModel)}


@query("models_reloaded", sql=q.with_ctes(q.RATINGS_CTE) + " UNION ALL ".join(
    f"SELECT '{name}' AS model, count(*) AS n, 0.0::double AS largest_change FROM ratings WHERE split <> 'train'" for name in _SAVED))
def models_reloaded(spark, sf):
    """K7: each model fitted, saved and loaded; the loaded one must predict what the fitted one does.

    One model after another, each estimate written on its own: the pairings of two models, or of the fitted and the
    loaded one, are never on disk together.
    """
    t = rt.stored_triples(spark, sf)
    train, targets = t.where("split = 'train'"), t.where("split <> 'train'").select("RowID", "BeerID", "ReviewerID")
    out = []
    for name, (fit, kind) in _SAVED.items():
        with shuffles_dropped(spark):
            path, fitted = scratch_path(spark, f"model-{name}"), fit(train)
            fs.save_model(fitted, path)
            again = fs.fit_or_load(None, train, path, kind)  # nothing is fitted: the saved model is there
            first, then = (cut_lineage(m.predict(targets).select("RowID", F.col("est").alias(est)))
                           for m, est in ((fitted, "est"), (again, "again")))
            change = r6(F.max(F.abs(F.col("est") - F.col("again")))).alias("largest_change")
            out.append(cut_lineage(first.join(then, "RowID").agg(F.count(F.lit(1)).alias("n"), change)
                                   .select(F.lit(name).alias("model"), "n", "largest_change")))
        for table in (first, then, *fitted.tables().values()):
            drop_snapshot(table)
    return reduce(lambda a, b: a.unionByName(b), out)


@query("biased_mf_predict")
def biased_mf_predict(spark, sf):
    """M7 with the biases inside the objective, no block for a hot id."""
    t = rt.stored_triples(spark, sf)
    p = fit_biased_mf(t.where("split = 'train'"), lr=0.005, reg=0.4, n_epochs=10).predict(
        t.where("split <> 'train'").select("RowID", "split", "BeerID", "ReviewerID", "rating"))
    return p.select("RowID", "split", r6("est").alias("est"), "was_impossible")
