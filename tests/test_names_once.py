"""Names are prepared once, vectors are made after the join."""
from pyspark.sql import functions as F

from ratecraft.plans import queries_ml as ml
from ratecraft.plans.text_models import doc_vectors, fit_word2vec
from ratecraft.session import cut_lineage
from ratecraft.sources import ratings as rt


def test_names_are_prepared_once(spark, monkeypatch):
    made = []
    names = spark.createDataFrame([(f"{n}", "train" if n % 3 else "val", 1.0 + n % 3, f"pale ale {n % 3}") for n in range(30)],
                                  "RowID string, split string, rating double, BeerName string")
    monkeypatch.setattr(rt, "ratings", lambda spark, sf: names)
    monkeypatch.setattr(ml, "cut_lineage", lambda df, *a: made.append(df.columns) or cut_lineage(df, *a))
    assert ml.beername_text_classifier(spark, "").count() == 10
    assert made == [["RowID", "split", "rating", "BeerName"], ["RowID", "BeerName", "split", "rating"]]


def test_vectors_come_after_the_join_with_the_same_values(spark):
    text = spark.createDataFrame([("a", "pale ale"), ("b", "dark stout ale"), ("c", "")], "RowID string, t string")
    model = fit_word2vec(text, "t", dim=3, min_count=1)
    plain = {r["RowID"]: tuple(r)[1:] for r in doc_vectors(model, text, "t", expand=True).collect()}
    kept = doc_vectors(model, text.withColumn("x", F.lit(7)), "t", expand=True, keep=["x"])
    assert kept.columns == ["RowID", "x", "t_DocVec_0", "t_DocVec_1", "t_DocVec_2"]
    assert {r["RowID"]: tuple(r)[2:] for r in kept.collect()} == plain
