"""Projections, predicates and named feature sets."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID_AND_TARGET = ("RowID", "BeerID", "ReviewerID", "rating")
# The columns the reference's "beer context" set leaves out,
# and those its "consumer context" set leaves out.
PERSON_AND_TIME_COLS = ("DayofWeek", "DayofMonth", "Month", "Year", "TimeOfDay", "Gender",
                        "Birthday")
ITEM_COLS = ("ABV", "BrewerID", "BeerType")
SCALED_COLS = ["ReviewerReviewCount", "BeerReviewCount", "ABV", "DayofWeek", "DayofMonth",
               "Month", "Year", "TimeOfDay", "Birthday"]


def drop_checked(df: DataFrame, cols) -> DataFrame:
    """Drop columns, failing when one is missing (plain ``drop`` ignores it)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def feature_columns(df: DataFrame, exclude=ID_AND_TARGET) -> list[str]:
    """Every column except ids and target."""
    return [c for c in df.columns if c not in set(exclude)]


def prefix_columns(df: DataFrame, prefix: str) -> list[str]:
    """P5."""
    return [c for c in df.columns if c.startswith(prefix)]


def _drop_by_prefix(df: DataFrame, names) -> DataFrame:
    """Drop named columns and any one-hot columns derived from them (``name_*``)."""
    names = set(names)
    keep = [c for c in df.columns
            if c not in names and not any(c.startswith(n + "_") for n in names)]
    return df.select(*keep)


def beer_context(df: DataFrame) -> DataFrame:
    """All columns minus the day / time / person columns."""
    return _drop_by_prefix(df, PERSON_AND_TIME_COLS)


def consumer_context(df: DataFrame) -> DataFrame:
    """All columns minus ABV, brewer and type."""
    return _drop_by_prefix(df, ITEM_COLS)


@dataclass
class FeatureSpec:
    """Per-column switch — a column is dropped when off, else its transform
    (a ``Column`` builder taking the column) is applied."""
    enabled: dict[str, bool] = field(default_factory=dict)
    transforms: dict = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        cols = []
        for c in df.columns:
            if not self.enabled.get(c, True):
                continue
            t = self.transforms.get(c)
            cols.append(t(F.col(c)).alias(c) if t else F.col(c))
        return df.select(*cols)


def rename_map(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P9 (by map)."""
    return df.withColumnsRenamed(mapping)


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    """P10."""
    return df.withColumn(name, F.lit(value))


def first_n(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First n rows under a total order (the caller names the keys)."""
    return df.orderBy(*order).limit(n)


def not_equal_keep_null(c: Column, v) -> Column:
    """F2 with pandas semantics: ``NaN != v`` is true, so null rows are kept."""
    return ~c.eqNullSafe(F.lit(v))


def keys_present(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """rows of ``keys`` whose key exists in ``df`` (left-semi join)."""
    return keys.join(df.select(on), on, "left_semi")


def lookup(df: DataFrame, keys: DataFrame, on: str, value_col: str) -> DataFrame:
    """value by key as an equi-join (never a per-row lookup)."""
    return keys.join(df.select(on, value_col), on, "left")
