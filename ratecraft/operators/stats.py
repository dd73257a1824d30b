"""Descriptive statistics (A6, A7, A11, A12, A27, A28) and exact quantiles.

``exact_quantiles`` is exact (linear interpolation between order statistics,
like numpy's default) and distributed: values are first reduced to
``(value, count)`` with a partial aggregation, range-partitioned, and each
range partition computes running counts locally; per-partition totals join
back as a table and each group's wanted ranks are picked by an aggregation.
Nothing but the final numbers of one column reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.session import cut_lineage

def quantile_table(df: DataFrame, col: str, probs: list[float], by: str | None = None) -> DataFrame:
    """(g, q0, q1, …): exact quantiles of each group (``g`` is '' without ``by``)."""
    g = F.col(by).cast("string") if by else F.lit("")
    vals = df.select(g.alias("g"), F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
    vc = vals.groupBy("g", "v").agg(F.count(F.lit(1)).alias("c"))
    n_part = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(vc.repartitionByRange(n_part, "g", "v").withColumn("pid", F.spark_partition_id()))
    by_pid = Window.partitionBy("g").orderBy("pid")
    parts = ranged.groupBy("g", "pid").agg(F.sum("c").alias("t")).select(
        F.col("g").alias("pg"), F.col("pid").alias("pp"), F.coalesce(F.sum("t").over(by_pid.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("t").over(Window.partitionBy("g")).alias("n"))
    inside = Window.partitionBy("g", "pid").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    cum = ranged.withColumn("run", F.sum("c").over(inside)).join(
        parts, F.col("g").eqNullSafe(F.col("pg")) & (F.col("pid") == F.col("pp"))).select(
        "g", "v", "n", (F.col("run") + F.col("before")).alias("end"), "c")
    start = F.col("end") - F.col("c")
    aggs = []
    for k, p in enumerate(probs):
        h = (F.col("n") - 1) * F.lit(float(p))
        low = F.floor(h)
        high = F.least(low + 1, F.col("n") - 1)
        aggs += [F.max(F.when((start <= low) & (F.col("end") > low), F.col("v"))).alias(f"lo{k}"),
                 F.max(F.when((start <= high) & (F.col("end") > high), F.col("v"))).alias(f"hi{k}"),
                 F.max(h - low).alias(f"f{k}")]
    found = cum.groupBy("g").agg(*aggs)
    return found.select("g", *[(F.col(f"lo{k}") + F.col(f"f{k}") * (F.col(f"hi{k}") - F.col(f"lo{k}"))).alias(f"q{k}")
                               for k in range(len(probs))])


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> list[float | None]:
    row = quantile_table(df, col, probs).first()
    return [row[f"q{k}"] if row else None for k in range(len(probs))]


def describe(df: DataFrame, col: str, by: str | None = None) -> DataFrame:
    """Count, mean, sample sd, min, quartiles, max (exact quartiles)."""
    base = df.groupBy(*([by] if by else [])).agg(
        F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
        F.min(F.col(col).cast("double")).alias("min"), F.max(F.col(col).cast("double")).alias("max"))
    qdf = quantile_table(df, col, [0.25, 0.5, 0.75], by).toDF("__g", "q25", "q50", "q75")
    key = F.col(by).cast("string") if by else F.lit("")
    return base.join(qdf, key.eqNullSafe(F.col("__g")), "left").drop("__g")


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row per column with its null count (single pass)."""
    cols = cols or df.columns
    wide = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "nulls") if cols else wide


def schema_report(df: DataFrame) -> DataFrame:
    """Column, Spark type and null count."""
    spark = df.sparkSession
    types = spark.createDataFrame([(c, t) for c, t in df.dtypes], "column string, dtype string")
    return types.join(null_counts(df), "column")


def column_report(df: DataFrame, col: str) -> DataFrame:
    """Records, nulls, zeros, min, max, mean, median, population sd, Q1, Q3,
    IQR, fences at 1.5·IQR and outlier counts — nulls skipped everywhere."""
    q1, med, q3 = exact_quantiles(df, col, [0.25, 0.5, 0.75])
    c = F.col(col)
    if q1 is None:
        iqr = lo = hi = None
    else:
        iqr = q3 - q1
        lo, hi = q1 - 1.5 * iqr, q3 + 1.5 * iqr
    lo_c = F.lit(lo).cast("double")
    hi_c = F.lit(hi).cast("double")
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(c.isNull().cast("long")).alias("nulls"),
        F.count_if(c == 0).alias("zeros"),
        F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
        F.avg(c).alias("mean"), F.lit(med).cast("double").alias("median"),
        F.stddev_pop(c).alias("sd"),
        F.lit(q1).cast("double").alias("q1"), F.lit(q3).cast("double").alias("q3"),
        F.lit(iqr).cast("double").alias("iqr"),
        lo_c.alias("lower_fence"), hi_c.alias("upper_fence"),
        F.count_if(c < lo_c).alias("lower_outliers"),
        F.count_if(c > hi_c).alias("upper_outliers"),
    ).withColumn("total_outliers", F.col("lower_outliers") + F.col("upper_outliers"))


def histogram(df: DataFrame, col: str, bins: int = 20, positive_only: bool = False) -> DataFrame:
    """Equal-width bins over [min, max], last edge inclusive; empty bins kept."""
    spark = df.sparkSession
    c = F.col(col).cast("double")
    src = df.where(c.isNotNull() & (c > 0)) if positive_only else df.where(c.isNotNull())
    lo_hi = src.agg(F.min(c).alias("lo"), F.max(c).alias("hi")).first()
    lo, hi = lo_hi["lo"], lo_hi["hi"]
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, n long")
    width = (hi - lo) if hi > lo else 1.0
    b = F.least(F.floor((c - F.lit(lo)) / F.lit(width) * F.lit(bins)) + 1, F.lit(bins)).cast("int")
    counts = src.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    step = F.lit(width) / F.lit(bins)
    return (edges.join(counts, "bin", "left")
            .select("bin", (F.lit(lo) + (F.col("bin") - 1) * step).alias("bin_lo"),
                    (F.lit(lo) + F.col("bin") * step).alias("bin_hi"),
                    F.coalesce(F.col("n"), F.lit(0)).alias("n")))
