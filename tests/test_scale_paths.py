"""Paths that only trigger at scale: 64-bit ids for ALS, grouped exact quantiles,
SVD++ epochs, the stream scorer."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecraft.operators import stats as st
from ratecraft.plans.base import Roles


def test_int_ids_fallback_for_64bit_ids(spark):
    from ratecraft.plans.factorization import int_ids
    big = 1 << 40
    df = spark.createDataFrame([(big + 5,), (big + 1,), (7,), (big + 5,)], "u long")
    m = {r["u"]: r["u_idx"] for r in int_ids(df, "u").collect()}
    assert set(m) == {big + 5, big + 1, 7}
    assert sorted(m.values()) == [0, 1, 2]          # dense, distinct, 32-bit
    small = spark.createDataFrame([(3,), (9,)], "u long")
    assert {r["u"]: r["u_idx"] for r in int_ids(small, "u").collect()} == {3: 3, 9: 9}


def test_als_with_64bit_ids(spark):
    from ratecraft.plans.factorization import fit_nmf
    big = 1 << 40
    rows = [(n, big + u, big + 100 + i, float((u + i) % 5 + 1)) for n, (u, i) in
            enumerate((u, i) for u in range(6) for i in range(5))]
    df = spark.createDataFrame(rows, "RowID long, user long, item long, rating double")
    m = fit_nmf(df, Roles("user", "item", "rating"), rank=2, max_iter=3)
    p = m.predict(df.select("RowID", "user", "item")).collect()
    assert len(p) == 30 and all(0.0 <= r["est"] <= 5.0 for r in p)


def test_grouped_exact_quantiles(spark):
    rng = np.random.default_rng(5)
    data = [("a", float(v)) for v in rng.integers(0, 50, 301)] + [("b", float(v)) for v in rng.normal(size=40)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: [r["q0"], r["q1"], r["q2"]] for r in st.quantile_table(df, "v", [0.25, 0.5, 0.9], "g").collect()}
    for g in ("a", "b"):
        want = np.quantile([v for k, v in data if k == g], [0.25, 0.5, 0.9])
        assert got[g] == pytest.approx(list(want), abs=1e-12)


def test_svdpp_properties(spark):
    from ratecraft.plans.factorization import fit_svdpp
    from ratecraft.sources.ratings import rating_triples
    t = rating_triples(spark, "/root/testdata/sf0.001")
    tr, tg = t.where(F.col("split") == "train"), t.where(F.col("split") != "train")
    m = fit_svdpp(tr, n_factors=3, n_epochs=2)
    p = m.predict(tg)
    agg = p.agg(F.count("*").alias("n"), F.min("est").alias("lo"), F.max("est").alias("hi")).first()
    assert agg["n"] == tg.count() and 0.0 <= agg["lo"] <= agg["hi"] <= 5.0
