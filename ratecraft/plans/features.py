"""The engineered feature table, one lazy DataFrame over all splits.

ratings ⋈ features on RowID → review counts within each split (A1/A2) →
date parts to numbers (C1–C4) → ABV mean-imputed (C5) → optional one-hot
(C27–C29, categories from all splits at once) → optional scaling (C30/C31).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.functions import dates as dt
from ratecraft.functions import encode as enc
from ratecraft.functions import numeric as num
from ratecraft.operators import aggregates as agg
from ratecraft.operators.columns import SCALED_COLS
from ratecraft.session import cut_lineage, handed_on
from ratecraft.sources import ratings as rt

# Fixed reference year for the age feature in registered (checked) queries.
AS_OF_YEAR = 2020
_COUNTS = ("ReviewerReviewCount", "BeerReviewCount")


def date_parts(df: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """C1–C4 applied in place to DayofWeek, Month, TimeOfDay and Birthday."""
    return df.withColumns({
        "DayofWeek": dt.day_of_week_number(F.col("DayofWeek")),
        "Month": dt.month_number(F.col("Month")),
        "TimeOfDay": dt.time_to_seconds(F.col("TimeOfDay")),
        "Birthday": dt.birthday_to_age(F.col("Birthday"), as_of_year),
    })


def _stored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pair_table`` over one snapshot without what its ids give: written after the pairs, so the joins of line items
    and those of attributes are never on disk together."""
    pairs = cut_lineage(rt.pair_lines(spark, sf_dir).drop("n_lines"))
    return rt.with_keys(handed_on(rt.pair_attributes(pairs, sf_dir)))


def _engineered(pt: DataFrame, as_of_year: int | None, impute_fit_on: str) -> DataFrame:
    base = rt.features_from(pt, keep=rt.rating_projection())
    # the counts join the stored columns, the texts of keys and features are made after them
    counted = rt.features_from(rt.with_keys(agg.add_review_counts(pt.drop("RowID"))), keep=[*rt.rating_projection(), *_COUNTS])
    first = ["split", "BeerID", "ReviewerID"]
    j = counted.select(*first, *[c for c in base.columns if c not in first], *_COUNTS)
    j = date_parts(j, as_of_year)
    # the means need only two plain columns: take them from the snapshot projection
    return num.impute_mean(j, "ABV", fit_on=impute_fit_on, stats_from=base.select("split", "ABV"))


def engineered_features(spark: SparkSession, sf_dir: str, as_of_year: int | None = AS_OF_YEAR,
                        impute_fit_on: str = "each") -> DataFrame:
    """Ratings and raw features come from one snapshot of the per-pair table, so
    the line-item aggregation runs once and they line up row for row (the
    reference joins two files on RowID; here both are projections of one
    table, and ``join_features`` remains for separately stored inputs)."""
    pt = _stored_pairs(spark, sf_dir)
    return _engineered(pt, as_of_year, impute_fit_on)


def encoded_features(spark: SparkSession, sf_dir: str, scale: str | None = None,
                     fit_on: str = "each", as_of_year: int | None = AS_OF_YEAR) -> DataFrame:
    """E1 without text: numeric features + one-hot BeerType / Gender (+ scaling).
    Category lists are read from the snapshot columns (all splits at once, C29)."""
    pt = _stored_pairs(spark, sf_dir)
    df = _engineered(pt, as_of_year, "each")
    types = enc.categories(pt.select(F.col("p_type").alias("BeerType")), "BeerType")
    genders = enc.categories(pt.select(F.col("c_mktsegment").alias("Gender")), "Gender")
    df = enc.one_hot(df, "BeerType", types)
    df = enc.one_hot(df, "Gender", genders)
    if scale == "zscore":
        df = num.zscore(df, SCALED_COLS, fit_on=fit_on)
    elif scale == "minmax":
        df = num.minmax(df, SCALED_COLS, fit_on=fit_on)
    return df
