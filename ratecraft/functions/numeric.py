"""Numeric column builders and frame-level numeric transforms.

Frame-level statistics (means, quartiles, sd, min/max) are computed with one
distributed aggregation and come back to the driver as a handful of numbers
per group; they are applied as literal expressions, so nothing row-sized
ever passes through the driver or a single task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.operators.stats import exact_quantiles

MAX_STAT_GROUPS = 10_000


def nullif_zero(c: Column) -> Column:
    """0 → null."""
    return F.when(c == 0, F.lit(None)).otherwise(c)


def log10_or_zero(c: Column) -> Column:
    """log10; null → null; 0 → 0; negative → null (numpy gives NaN)."""
    return F.when(c.isNull(), F.lit(None).cast("double")).when(c == 0, F.lit(0.0)) \
        .when(c > 0, F.log10(c)).otherwise(F.lit(None).cast("double"))


def closeness(a: Column, b: Column, scale: float = 10.0) -> Column:
    """exp(−|a − b| / scale); 0 when either side is missing."""
    return F.when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(F.exp(-F.abs(a - b) / F.lit(scale)))


def closeness_product(pairs: list[tuple[Column, Column]], scale: float = 10.0) -> Column:
    """Product of C10 over several columns."""
    return reduce(lambda x, y: x * y, [closeness(a, b, scale) for a, b in pairs])


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(F.transform(a, lambda x: x * x), F.lit(0.0), lambda acc, x: acc + x))


def cosine(a: Column, b: Column) -> Column:
    """C11: cosine similarity of two equal-length numeric arrays; 0 for a zero vector."""
    den = norm(a) * norm(b)
    return F.when(den == 0, F.lit(0.0)).otherwise(dot(a, b) / den)


# ---------------------------------------------------------------- frame transforms
def _group_rows(df: DataFrame, by: str | None, aggs: list[Column]) -> dict:
    """Small per-group statistics → {group: Row}; the group count is checked."""
    if by is None:
        return {None: df.agg(*aggs).first()}
    rows = df.groupBy(by).agg(*aggs).limit(MAX_STAT_GROUPS + 1).collect()
    if len(rows) > MAX_STAT_GROUPS:
        raise ValueError(f"more than {MAX_STAT_GROUPS} groups in {by}; fit on fewer groups")
    return {r[by]: r for r in rows}


def _per_group(by: str | None, stats: dict, build) -> Column:
    """Fold ``build(row)`` over groups into one CASE expression."""
    if by is None:
        return build(stats[None])
    expr = None
    for key, row in stats.items():
        cond = F.col(by).isNull() if key is None else (F.col(by) == F.lit(key))
        expr = F.when(cond, build(row)) if expr is None else expr.when(cond, build(row))
    return expr if expr is not None else F.lit(None)


def _fit_frame(df: DataFrame, fit_on: str, split_col: str) -> tuple[DataFrame, str | None]:
    """fit_on='each' → statistics per split value; 'train' → from train rows only;
    'all' → from the whole frame."""
    if fit_on == "each":
        return df, split_col
    if fit_on == "train":
        return df.where(F.col(split_col) == "train"), None
    return df, None


def impute_mean(df: DataFrame, col: str, fit_on: str = "train", split_col: str = "split",
                stats_from: DataFrame | None = None) -> DataFrame:
    """Null → mean of the column (per split by default, as the reference does).
    ``stats_from`` is a cheaper frame with the same rows to compute the means on."""
    base = stats_from if stats_from is not None else df
    src, by = _fit_frame(base, fit_on, split_col) if split_col in base.columns else (base, None)
    stats = _group_rows(src, by, [F.avg(col).alias("m")])
    fill = _per_group(by, stats, lambda r: F.lit(r["m"]))
    return df.withColumn(col, F.coalesce(F.col(col), fill))


def remove_outliers(df: DataFrame, col: str) -> DataFrame:
    """Values outside [Q1 − 1.5·IQR, Q3 + 1.5·IQR] → null (exact quartiles)."""
    q1, q3 = exact_quantiles(df, col, [0.25, 0.75])
    if q1 is None:
        return df
    iqr = q3 - q1
    lo, hi = q1 - 1.5 * iqr, q3 + 1.5 * iqr
    c = F.col(col)
    return df.withColumn(col, F.when((c > F.lit(hi)) | (c < F.lit(lo)), F.lit(None)).otherwise(c))


def zscore(df: DataFrame, cols: list[str], fit_on: str = "train", split_col: str = "split") -> DataFrame:
    """(x − mean) / population sd; constant column → 0; nulls stay null."""
    src, by = _fit_frame(df, fit_on, split_col) if split_col in df.columns else (df, None)
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    stats = _group_rows(src, by, aggs)
    out = df
    for c in cols:
        def build(r, c=c):
            m, s = r[f"m_{c}"], r[f"s_{c}"]
            if m is None:
                return F.lit(None).cast("double")
            return F.col(c) - F.lit(m) if not s else (F.col(c) - F.lit(m)) / F.lit(s)
        out = out.withColumn(c, _per_group(by, stats, build).cast("double"))
    return out


def minmax(df: DataFrame, cols: list[str], fit_on: str = "train", split_col: str = "split") -> DataFrame:
    """(x − min) / (max − min) into [0, 1]; constant column → 0."""
    src, by = _fit_frame(df, fit_on, split_col) if split_col in df.columns else (df, None)
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}")]
    stats = _group_rows(src, by, aggs)
    out = df
    for c in cols:
        def build(r, c=c):
            lo, hi = r[f"lo_{c}"], r[f"hi_{c}"]
            if lo is None:
                return F.lit(None).cast("double")
            rng = float(hi) - float(lo)
            return (F.col(c) - F.lit(lo)) if rng == 0 else (F.col(c) - F.lit(lo)) / F.lit(rng)
        out = out.withColumn(c, _per_group(by, stats, build).cast("double"))
    return out
