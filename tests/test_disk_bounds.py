"""What lies on disk at the same time: shuffles end with their job, lists and stacked folds come in parts, tables are handed on."""
import os

import pytest
from pyspark.sql import functions as F

from ratecraft.plans import cells, meeting, onepass
from ratecraft.plans.base import Roles
from ratecraft.plans.neighbours import fit_knn, fit_slope_one
from ratecraft.plans.queries_relational import scaled_features
from ratecraft.session import cut_lineage, handed_on
from tests.conftest import SF001

ROLES = Roles("u", "i", "rating")


@pytest.fixture(scope="module")
def ratings(spark):
    pairs = sorted({(u, (u * 7 + k * k) % 11) for u in range(14) for k in range(6)})
    return cut_lineage(spark.createDataFrame([(f"{u}-{i}", u, i, float((u * 3 + i) % 5) + 0.5) for u, i in pairs],
                                             "RowID string, u long, i long, rating double"))


def shuffle_files(spark) -> int:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return sum(blocks.apply(n).isShuffle() for n in range(blocks.size()))


def test_snapshot_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    t = cut_lineage(spark.range(1000).repartition(5, "id"))
    assert shuffle_files(spark) <= before and t.count() == 1000


def test_cells_leave_no_shuffle_of_the_ratings_and_are_not_sorted_again(spark, ratings):
    rows = ratings.select("u", "i", F.col("rating").alias("r"))
    with cells.Cells(rows, 10) as dealt:
        states = ratings.select("u").distinct().withColumn("cell", F.explode(dealt.state_cells("u")))
        out = dealt.meet(states, lambda r, s: r.select(["u"]), "u long")
        plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
        ours = plan[plan.index("InMemoryTableScan"):]
        assert plan[:plan.index("InMemoryTableScan")].count("Sort") == 0  # the ratings come sorted
        assert "isFinalPlan=true" in ours and out.count() == ratings.count()


def test_handed_on_table_is_the_only_one_left(spark):
    first = cut_lineage(spark.range(10))
    folder = first.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:").replace("///", "/")
    assert os.path.isdir(folder)
    assert handed_on(first.where("id > 3")).count() == 6 and not os.path.exists(folder)


def test_neighbours_in_parts_are_those_of_one(ratings, monkeypatch):
    fits = [lambda: fit_knn(ratings, "means", ROLES, k=3), lambda: fit_slope_one(ratings, ROLES)]
    got = lambda: [{r["RowID"]: r["est"] for r in fit().predict(ratings).collect()} for fit in fits]
    whole = got()
    monkeypatch.setattr(meeting, "FEW", 1 << 8)
    monkeypatch.setattr(meeting, "DENSE", 0)
    rows = ratings.select("u", F.col("i").alias("w"), F.col("rating").alias("r"))
    assert meeting.parts(rows) > 1
    for one, many in zip(whole, got()):
        assert many == pytest.approx(one) and len(one) == ratings.count()


def test_folds_in_batches(ratings, monkeypatch):
    d = onepass.fold_rows(ratings, 3, roles=ROLES)
    assert onepass.in_batches(d) == [range(3)]
    monkeypatch.setattr(onepass, "STACKED", 1)
    assert onepass.in_batches(d) == [range(0, 1), range(1, 2), range(2, 3)]
    for f, folds in enumerate(onepass.in_batches(d)):
        r, tests = (onepass.batch(t, folds) for t in (onepass.stacked(d), onepass.tests(d)))
        assert {x["g"] for x in r.collect()} == {0}
        assert r.count() == ratings.count() - d.sizes[f] and tests.count() == d.sizes[f]


def test_scaled_rows_are_read_from_one_table(spark):
    out = scaled_features(spark, SF001)
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
    assert "Join" not in plan and "Exchange" not in plan and out.count() > 0
