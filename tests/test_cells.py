"""Epochs over ratings in cells: what moves, how large a cell is, and results when cells are many."""
import pytest
from pyspark.sql import functions as F

from ratecraft.plans import baseline, cells, cocluster, factors
from ratecraft.plans.base import Roles
from ratecraft.session import cut_lineage

ROLES = Roles("u", "i", "rating")


@pytest.fixture(scope="module")
def ratings(spark):
    """One item holds a third of all ratings, one user rates every item; ids are no small numbers."""
    pairs = {(u, 0) for u in range(60)} | {(7, i) for i in range(25)} | {(u, 1 + (u * 7 + k * k) % 24) for u in range(60) for k in range(2)}
    rows = [(f"{u}-{i}", u * 10 ** 10, i - 5, float((u * 3 + i) % 5) + 0.5) for u, i in sorted(pairs)]
    return cut_lineage(spark.createDataFrame(rows, "RowID string, u long, i long, rating double"))


def plans_of(monkeypatch, module):
    """The plans of all tables that a module writes."""
    seen = []

    def write(df):
        seen.append(df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple"))
        return cut_lineage(df)

    monkeypatch.setattr(module, "cut_lineage", write)
    return seen


def grouped(ratings):
    return ratings.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("g"), "u", "i", F.col("rating").alias("r"))


def test_cells_are_bounded_and_whole(ratings):
    r = grouped(ratings)
    with cells.Cells(r, 10) as dealt:
        assert dealt.rows.drop("cell").exceptAll(r).isEmpty() and r.exceptAll(dealt.rows.drop("cell")).isEmpty()
        assert max(x["count"] for x in dealt.rows.groupBy("cell").count().collect()) <= 25
        for c in ("u", "i"):  # a state goes to every cell with a rating of its id, once
            sent = r.select("g", c).distinct().withColumn("cell", F.explode(dealt.state_cells(c)))
            assert dealt.rows.select("g", c, "cell").distinct().exceptAll(sent).isEmpty()
            assert sent.count() == sent.distinct().count()


def test_baseline_moves_no_ratings_by_joins(ratings, monkeypatch):
    seen = plans_of(monkeypatch, baseline)
    monkeypatch.setattr(cells, "CELL", 10)
    got = baseline.fit_baseline(ratings, ROLES, 3, 2.0, 3.0)
    assert all("Join" not in p for p in seen)
    rows = ratings.collect()
    mu = sum(x["rating"] for x in rows) / len(rows)
    bu, bi = {}, {}
    for _ in range(3):
        for key, other, out, reg in (("i", bu, bi, 3.0), ("u", bi, bu, 2.0)):
            held = {}
            for x in rows:
                held.setdefault(x[key], []).append(x["rating"] - mu - other.get(x["u" if key == "i" else "i"], 0.0))
            out.update({k: sum(v) / (reg + len(v)) for k, v in held.items()})
    assert {x["u"]: x["bu"] for x in got.bu.collect()} == pytest.approx(bu)
    assert {x["i"]: x["bi"] for x in got.bi.collect()} == pytest.approx(bi)


def test_factor_epoch_is_one_job_without_a_join(ratings, monkeypatch):
    seen = plans_of(monkeypatch, factors)
    factors.descend(grouped(ratings), 2, 2, lr=[0.05, 0.01], implicit=False)
    assert len(seen) == 2 + 2 and all("Join" not in p for p in seen)


@pytest.mark.parametrize("implicit", [False, True])
def test_factors_of_many_cells_equal_those_of_one(ratings, monkeypatch, implicit):
    def states():
        users, items, _ = factors.descend(grouped(ratings), 2, 2, lr=[0.05, 0.01], implicit=implicit)
        return [{(x["g"], x[1]): tuple(x)[2:] for x in t.collect()} for t in (users, items)]

    one = states()
    monkeypatch.setattr(factors, "CELL", 10)
    for a, b in zip(one, states()):
        assert a.keys() == b.keys()
        assert all(a[k] == pytest.approx(b[k], abs=1e-12) for k in a)


def test_clusters_are_never_broadcast(ratings, monkeypatch):
    def clusters():
        users, items, averages, _ = cocluster.cocluster(grouped(ratings), 2, 3, 2, 42)
        return [sorted(map(tuple, users.select("g", "u", "cu").collect())), sorted(map(tuple, items.select("g", "i", "ci").collect()))], averages

    seen = plans_of(monkeypatch, cocluster)
    one, averages = clusters()
    assert seen and all("Broadcast" not in p for p in seen)
    monkeypatch.setattr(cells, "CELL", 10)
    many, again = clusters()
    assert one == many
    assert all(a == pytest.approx(b) for a, b in zip(averages, again))
