"""Scoring arriving line items with a fitted model (M23 over a stream).

The reference has no streaming operator.  The one streaming use of its work
is to score rating events as they arrive: a file stream of line items is
joined to the static orders table (stream-static join), then to a static
table of predictions keyed by (user, item) — the same fan-out as J3.  Output
goes through ``foreachBatch`` to Parquet, one folder per batch id (a replayed
batch replaces itself), with the stream's checkpoint in the shared checkpoint
folder so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.session import scratch_path
from ratecraft.sources.files import read_if_there
from ratecraft.sources.tables import read_table

LINEITEM_STREAM_SCHEMA = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                          "l_quantity double, l_extendedprice double, l_discount double, "
                          "l_tax double, l_returnflag string, l_linestatus string, "
                          "l_shipdate timestamp")


def line_item_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Line-item files of ``sf_dir`` as a stream (explicit schema, no inference)."""
    return (spark.readStream.schema(LINEITEM_STREAM_SCHEMA)
            .option("pathGlobFilter", "lineitem*.parquet")
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(sf_dir))


def score_stream(lines: DataFrame, orders: DataFrame, preds: DataFrame) -> DataFrame:
    """Stream of (l_orderkey, l_linenumber, BeerID, ReviewerID, est)."""
    keyed = (lines.join(orders, lines.l_orderkey == orders.o_orderkey)
             .select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("BeerID"),
                     F.col("o_custkey").alias("ReviewerID")))
    return keyed.join(preds, ["BeerID", "ReviewerID"])


def run_scoring(spark: SparkSession, sf_dir: str, preds: DataFrame, out_path: str | None = None,
                checkpoint: str | None = None) -> DataFrame:
    """Process every available file once (``availableNow``) and return the output table."""
    out_path = out_path or scratch_path(spark, "stream-scores")
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    scored = score_stream(line_item_stream(spark, sf_dir), orders, preds)

    def sink(batch: DataFrame, epoch_id: int) -> None:
        # one folder a batch, overwritten when a batch is replayed
        batch.write.mode("overwrite").parquet(f"{out_path}/batch={epoch_id}")

    q = (scored.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    schema = "l_orderkey long, l_linenumber int, BeerID long, ReviewerID long, est double"
    out = read_if_there(spark, out_path, f"{schema}, batch long")
    return spark.createDataFrame([], schema) if out is None else out.drop("batch")
