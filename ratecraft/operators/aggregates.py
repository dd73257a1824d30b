"""Group aggregates (A1–A5, A8–A10, A25) and set operations.

Counts joined back to rows (A1/A2) use a grouped count plus an equi-join
rather than a window: the aggregation combines map-side, so a reviewer with a
third of all rows never has to sit in one task, and the join back is split by
AQE when one key is skewed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_count(df: DataFrame, key: str, name: str, within=("split",)) -> DataFrame:
    """Number of rows sharing ``key`` (within each split), on every row.
    Rows with a null key are dropped, as the reference's inner merge does (Q5)."""
    within = [c for c in within if c in df.columns]
    counts = (df.where(F.col(key).isNotNull()).groupBy(*within, key)
              .agg(F.count(F.lit(1)).alias(name)))
    return df.join(counts, [*within, key], "inner")


def add_review_counts(df: DataFrame, within=("split",)) -> DataFrame:
    df = add_count(df, "ReviewerID", "ReviewerReviewCount", within)
    return add_count(df, "BeerID", "BeerReviewCount", within)


def group_mean(df: DataFrame, key: str, col: str = "rating", name: str = "mean_rating") -> DataFrame:
    """A3."""
    return df.groupBy(key).agg(F.avg(col).alias(name))


def group_count(df: DataFrame, key: str, col: str, name: str = "n") -> DataFrame:
    """A4: non-null count of ``col`` per key."""
    return df.groupBy(key).agg(F.count(col).alias(name))


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """A5: counts per value, most frequent first (ties by value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), F.asc(col))


def item_profile(df: DataFrame, item: str = "BeerID", type_col: str = "BeerType",
                 rating: str = "rating", rater: str = "ReviewerID") -> DataFrame:
    """Distinct (item, type) with mean rating and rater count in one aggregation."""
    return (df.groupBy(item, type_col)
            .agg(F.coalesce(F.avg(rating), F.lit(0.0)).alias("mean_rating"),
                 F.count(rater).alias("n_reviewers")))


def user_profile(df: DataFrame, user: str = "ReviewerID", rating: str = "rating") -> DataFrame:
    """A10: review count and mean rating per user, most active first."""
    return (df.groupBy(user).agg(F.count(F.lit(1)).alias("n_reviews"),
                                 F.avg(rating).alias("mean_rating"))
            .orderBy(F.desc("n_reviews"), F.asc(user)))


# ---------------------------------------------------------------- sets
def union_all(*frames: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Union all by name; a missing column becomes null when allowed."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def tag_union(frames: dict[str, DataFrame], tag: str = "split") -> DataFrame:
    """One table with a source tag instead of separate frames."""
    return union_all(*[f.withColumn(tag, F.lit(k)) for k, f in frames.items()], allow_missing=True)


def split_back(df: DataFrame, tags: list[str], tag: str = "split") -> dict[str, DataFrame]:
    """One frame per named tag value (only needed when writing separate files)."""
    return {k: df.where(F.col(tag) == k).drop(tag) for k in tags}


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """U4 / A8."""
    return df.select(col).distinct()


def column_difference(df: DataFrame, cols) -> list[str]:
    """U6."""
    return [c for c in df.columns if c not in set(cols)]
