"""Shared helpers: written tables, global order without a single task, components.

Every lineage cut is a Parquet table in the shared folder the session names in
``spark.checkpoint.dir`` (``ratecraft.session.scratch_path``); no helper uses a
machine-local folder, a local checkpoint or a driver-side collection of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratecraft.session import scratch_path

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back (cuts the lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


def by_batch(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with ``fn(batch) -> dict of columns`` for each record batch.

    ``fn`` gets a ``pyarrow.RecordBatch`` and returns a dict with the columns of
    ``schema`` (or None for no rows); batches without rows are skipped.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[f.name], type=f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def pieces(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def ordered_parts(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` range-partitioned by ``order`` and written, with its part number.

    Column ``__part`` rises with the order, so a window over ``__part`` ordered
    by ``order`` together with per-part totals gives any global running value;
    no task ever holds more than one range.
    """
    cut = df.repartitionByRange(pieces(df), *order).withColumn("__part", F.spark_partition_id())
    return saved(cut, name)


def part_offsets(parts: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Per ``__part`` the sum of each value over all earlier parts.

    One row per range (as many as shuffle partitions), so the window without a
    partition key is bounded by that setting, not by the data.
    """
    totals = parts.groupBy("__part").agg(*[c.alias(f"__t_{k}") for k, c in sums.items()])
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("__part", *[
        F.coalesce(F.sum(f"__t_{k}").over(before), F.lit(0)).alias(k) for k in sums])


def running(parts: DataFrame, order: Sequence[Column], sums: dict[str, str]) -> DataFrame:
    """Adds, for each new column -> summed column, the global inclusive prefix sum."""
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    offsets = part_offsets(parts, {f"__o_{k}": F.sum(v) for k, v in sums.items()})
    out = parts.withColumns({k: F.sum(v).over(inside) for k, v in sums.items()})
    out = out.join(offsets, "__part")
    out = out.withColumns({k: F.col(k) + F.col(f"__o_{k}") for k in sums})
    return out.drop(*[f"__o_{k}" for k in sums])


def hex_number(text: Column, start: int, digits: int) -> Column:
    """``digits`` hex digits of the MD5 of ``text``, from ``start`` (1-based), as a long."""
    return F.conv(F.substring(F.md5(text), start, digits), 16, 10).cast("long")


def components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """Distributed union-find: rows (``node``, ``root``) for every node of ``edges``.

    ``edges`` has columns ``a`` and ``b`` of one orderable type; ``root`` is the
    smallest node of the component.  Alternates the two star contractions
    (large-star: neighbours above a node are hung on its smallest neighbour;
    small-star: neighbours below it are hung on the smallest), each a partial
    aggregation and an equi-join, until the forest is a set of stars.  A round
    is written to the shared folder, so a lost executor repeats one round.
    Null ends and self-loops are ignored; an empty table gives an empty table.
    """
    e = saved(edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        lows = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lows, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
            F.col("m").alias("b")).where("a <> b").distinct()
        e = saved(small, name)
        # a set of stars: no node hangs on two roots, and no root hangs on another node
        once = e.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        if once.where("n > 1").isEmpty() and e.join(
                e.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty():
            break
    else:
        raise RuntimeError(f"components: no fixed point after {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
