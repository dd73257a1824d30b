"""A task that reads the feature table gets a bounded number of rows."""
from pyspark.sql import functions as F

from ratecraft.plans import queries_ml as ml
from ratecraft.session import cut_lineage


def test_rows_of_a_task_are_bounded_however_well_they_pack(spark):
    same = spark.range(0, 100_000, 1, 1).select(F.lit(1.0).alias("x"))
    most = lambda t: t.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most(cut_lineage(same)) == 100_000
    bounded = cut_lineage(same, 1_000)
    assert bounded.count() == 100_000 and most(bounded) <= 32_000


def test_feature_table_is_written_in_bounded_files(spark, monkeypatch):
    monkeypatch.setattr(ml, "_ENG_ROWS", 10)
    monkeypatch.setattr(ml, "encoded_features", lambda spark, sf: spark.range(0, 95, 1, 1).toDF("RowID"))
    assert len(ml._eng(spark, "").inputFiles()) == 10
