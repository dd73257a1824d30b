"""The rating data model over the driver tables.

A (reviewer, beer) rating is one (customer, part) pair of line items:

* ``ReviewerID`` = ``o_custkey``, ``BeerID`` = ``l_partkey``
* ``rating``     = ``avg(l_quantity) / 10`` over the pair's line items (0.1 – 5.0)
* ``RowID``      = ``ReviewerID-BeerID`` as text (unique per pair for any ids)
* ``split``      = ``(ReviewerID + BeerID) % 10``: 0 → test, 1–2 → val, else train

Per-row features come from the same pair (first ship date, smallest
discount) and from ``customer`` / ``part``.  Line items are aggregated once
per pair: at scale this is lineitem ⋈ orders (sort-merge on the order key)
followed by a partial + final aggregation on the pair key.  Callers that use
the table more than once should snapshot it (``session.cut_lineage``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.session import cut_lineage
from ratecraft.sources.tables import read_table

ID_COLS = ("RowID", "BeerID", "ReviewerID")
RATING_SCALE = (0.0, 5.0)
# Driver-table split rule: bucket of (ReviewerID + BeerID) % 10.
SPLIT_TEST_BUCKETS = (0,)
SPLIT_VAL_BUCKETS = (1, 2)


def split_expr(reviewer: Column, beer: Column) -> Column:
    bucket = F.pmod(reviewer + beer, F.lit(10))
    return (F.when(bucket.isin(*SPLIT_TEST_BUCKETS), F.lit("test"))
            .when(bucket.isin(*SPLIT_VAL_BUCKETS), F.lit("val"))
            .otherwise(F.lit("train")))


def pair_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (customer, part) pair with its line-item aggregates."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity",
                    "l_discount", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    return (li.join(orders, li.l_orderkey == orders.o_orderkey)
            .groupBy(F.col("o_custkey").alias("ReviewerID"), F.col("l_partkey").alias("BeerID"))
            .agg((F.avg("l_quantity") / F.lit(10.0)).alias("rating"),
                 F.min("l_discount").alias("min_discount"),
                 F.min("l_shipdate").alias("first_ship"),
                 F.min("l_orderkey").alias("first_order"),
                 F.count(F.lit(1)).alias("n_lines")))


def with_keys(df: DataFrame) -> DataFrame:
    return (df.withColumn("RowID", F.concat(
        F.col("ReviewerID").cast("string"), F.lit("-"), F.col("BeerID").cast("string")))
            .withColumn("split", split_expr(F.col("ReviewerID"), F.col("BeerID"))))


def rating_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``RowID, BeerID, ReviewerID, rating, split`` — the collaborative-filter input."""
    return with_keys(pair_lines(spark, sf_dir)).select(
        "RowID", "BeerID", "ReviewerID", "rating", "split")


def stored_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rating_triples`` over a snapshot of ids and rating; the keys are made of the ids again when it is read."""
    pairs = cut_lineage(pair_lines(spark, sf_dir).select("ReviewerID", "BeerID", "rating"))
    return with_keys(pairs).select("RowID", "BeerID", "ReviewerID", "rating", "split")


def pair_attributes(pairs: DataFrame, sf_dir: str) -> DataFrame:
    """``pair_lines`` with the customer's and then the part's attributes: the longer texts are moved by no other join."""
    spark = pairs.sparkSession
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_brand")
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    return (pairs.join(cust, F.col("ReviewerID") == cust.c_custkey)
            .join(part, F.col("BeerID") == part.p_partkey))


def pair_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (customer, part) pair with keys, rating and every attribute
    the ratings and features tables are projected from."""
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_brand")
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    p = with_keys(pair_lines(spark, sf_dir))
    return (p.join(part, p.BeerID == part.p_partkey)
            .join(cust, F.col("ReviewerID") == cust.c_custkey))


def rating_projection() -> list:
    return ["BeerID", "ReviewerID", F.col("p_name").alias("BeerName"),
            F.col("p_type").alias("BeerType"), "rating"]


def ratings_from(pt: DataFrame) -> DataFrame:
    return pt.select("RowID", *rating_projection(), "split")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six-column ratings table plus ``split``."""
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type")
    t = rating_triples(spark, sf_dir)
    return (t.join(part, t.BeerID == part.p_partkey)
            .select("RowID", "BeerID", "ReviewerID",
                    F.col("p_name").alias("BeerName"), F.col("p_type").alias("BeerType"),
                    "rating", "split"))


# Month names used to build the Birthday text.
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December"]


def _birthday(custkey: Column, nationkey: Column) -> Column:
    month = F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]),
                         (F.pmod(nationkey, F.lit(12)) + 1).cast("int"))
    day = (F.pmod(custkey, F.lit(28)) + 1).cast("string")
    year = (F.lit(1950) + F.pmod(custkey, F.lit(60))).cast("string")
    return (F.when(F.pmod(custkey, F.lit(5)) == 0, F.lit("unknown"))
            .when(F.pmod(custkey, F.lit(7)) == 0, F.concat_ws(" ", month, day))
            .otherwise(F.concat(month, F.lit(" "), day, F.lit(", "), year)))


def features_from(pt: DataFrame, keep=()) -> DataFrame:
    """Per-RowID features projected from ``pair_table`` (see ``features``),
    plus any ``keep`` columns / expressions."""
    upper = F.pmod(F.col("ReviewerID"), F.lit(3)) == 0
    dow = F.date_format("first_ship", "EEE")
    mon = F.date_format("first_ship", "MMM")
    secs = F.pmod(F.col("first_order") * F.lit(7919) + F.col("BeerID"), F.lit(86400))
    tod = F.format_string("%02d:%02d:%02d", (secs / 3600).cast("int"),
                          (F.pmod(secs, F.lit(3600)) / 60).cast("int"), F.pmod(secs, F.lit(60)))
    return pt.select(
        "RowID", *keep,
        F.regexp_extract("p_brand", r"(\d+)$", 1).cast("long").alias("BrewerID"),
        F.when(F.col("min_discount") * 100 == 0, F.lit(None).cast("double"))
         .otherwise(F.round(F.col("min_discount") * 100, 2)).alias("ABV"),
        F.when(upper, F.upper(dow)).otherwise(dow).alias("DayofWeek"),
        F.when(upper, F.upper(mon)).otherwise(mon).alias("Month"),
        F.dayofmonth("first_ship").alias("DayofMonth"),
        F.year("first_ship").alias("Year"),
        tod.alias("TimeOfDay"),
        F.col("c_mktsegment").alias("Gender"),
        _birthday(F.col("c_custkey"), F.col("c_nationkey")).alias("Birthday"),
        "split")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-RowID features (the thirteen-column features file minus the text columns).

    ``ABV`` is the smallest discount × 100, null when it is 0; day/month names
    are upper-cased for every third reviewer to exercise case folding.
    """
    return features_from(pair_table(spark, sf_dir))
