"""A13, A21–A23, J3, J7, C27–C29, P3, P11, quantiles, histograms."""
import numpy as np
import pytest

from ratecraft.functions import encode as enc
from ratecraft.operators import columns as cols
from ratecraft.operators import joins as jn
from ratecraft.operators import ranking as rk
from ratecraft.operators import stats as st
from ratecraft.plans.evaluate import mae_value


def test_x14_x15_x16_ndcg(spark):
    labels = [3, 2, 3, 0, 1, 2]
    rows = [("q", l, p) for p, l in enumerate(labels)] + [("z", 0, p) for p in range(3)]
    df = spark.createDataFrame(rows, "query string, label int, pos int")
    k6 = {r["query"]: r for r in rk.ndcg_at_k(df, "query", "label", "pos", 6).collect()}
    assert k6["q"]["dcg"] == pytest.approx(13.848264, abs=1e-6)
    assert k6["q"]["idcg"] == pytest.approx(14.595391, abs=1e-6)
    assert k6["q"]["ndcg"] == pytest.approx(0.948811, abs=1e-6)
    assert k6["z"]["ndcg"] == 1.0
    k3 = {r["query"]: r["ndcg"] for r in rk.ndcg_at_k(df, "query", "label", "pos", 3).collect()}
    assert k3["q"] == pytest.approx(0.959454, abs=1e-6)


def test_x18_mae(spark):
    df = spark.createDataFrame([(4.0, 3.5), (3.0, 3.25)], "rating double, est double")
    assert mae_value(df) == pytest.approx(0.375)


def test_x25_fanout(spark):
    ids = spark.createDataFrame([(1, 10, 20), (2, 10, 20)], "RowID long, BeerID long, ReviewerID long")
    preds = spark.createDataFrame([(10, 20, 3.0), (10, 20, 4.0)], "uid long, iid long, est double")
    assert jn.join_predictions(ids, preds).count() == 4
    assert jn.join_predictions(ids, preds, dedupe=True).count() == 2


def test_x26_ensemble_join(spark):
    base = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "RowID long, rating double")
    long = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (3, "a", 3.0), (1, "b", 1.0), (2, "b", 2.0)],
                                 "RowID long, model string, est double")
    wide = jn.ensemble_frame(base, long, ["a", "b"])
    assert sorted(r["RowID"] for r in wide.collect()) == [1, 2]
    assert wide.columns == ["RowID", "rating", "a", "b"]


def test_x21_one_hot_union(spark):
    t1 = spark.createDataFrame([(1, "Male"), (2, "unknown"), (3, None)], "RowID long, Gender string")
    t2 = spark.createDataFrame([(4, "Female")], "RowID long, Gender string")
    a, b = enc.one_hot_union([t1, t2], "Gender")
    expect = ["RowID", "Gender_Female", "Gender_Male", "Gender_unknown"]
    assert a.columns == expect and b.columns == expect
    rows = {r["RowID"]: (r["Gender_Female"], r["Gender_Male"], r["Gender_unknown"]) for r in a.collect()}
    assert rows == {1: (0, 1, 0), 2: (0, 0, 1), 3: (0, 0, 0)}


def test_x12_name_cleanup_and_collision(spark):
    assert enc.clean_name("BeerType_American IPA / Imperial") == "BeerType_AmericanIPAImperial"
    df = spark.createDataFrame([(1, 2)], "`A/B` int, AB int")
    assert enc.clean_column_names(df).columns == ["AB", "AB_2"]
    with pytest.raises(ValueError):
        enc.clean_column_names(df, strict=True)


def test_p3_drop_checked(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert cols.drop_checked(df, ["a"]).columns == ["b"]
    with pytest.raises(KeyError):
        cols.drop_checked(df, ["zz"])


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.round(rng.normal(size=997), 3).tolist() + [None] * 5
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = st.exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.75, 1.0])
    clean = np.array([v for v in vals if v is not None])
    want = np.quantile(clean, [0.0, 0.25, 0.5, 0.75, 1.0])
    assert got == pytest.approx(list(want), abs=1e-12)


def test_x6_column_report(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]] + [(None,)], "v double")
    r = st.column_report(df, "v").first()
    assert (r["q1"], r["q3"], r["lower_fence"], r["upper_fence"]) == (2.0, 4.0, -1.0, 7.0)
    assert (r["records"], r["nulls"], r["upper_outliers"], r["total_outliers"]) == (6, 1, 1, 1)


def test_histogram_last_edge_inclusive(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 10]], "v double")
    h = {r["bin"]: r["n"] for r in st.histogram(df, "v", 5).collect()}
    assert h == {1: 2, 2: 2, 3: 1, 4: 0, 5: 1}
