"""models_reloaded: one model after another, nothing of a model's pairing is left when the next one starts."""
from ratecraft.plans.queries_tables import models_reloaded
from ratecraft.session import shuffles_dropped
from tests.conftest import SF001


def test_result_reads_written_sums_only(spark):
    out = models_reloaded(spark, SF001)
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
    assert "Join" not in plan and "Exchange" not in plan
    rows = out.collect()
    n = {r["n"] for r in rows}
    assert len(rows) == 6 and len(n) == 1 and n.pop() > 0 and all(r["largest_change"] == 0.0 for r in rows)


def test_setting_is_put_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) == before
