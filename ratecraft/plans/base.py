"""Recommender protocol shared by every collaborative / content model.

A recommender is ``fit(ratings_df) -> model``; a model is
``predict(targets_df) -> DataFrame`` that keeps every target column and adds
``est`` (clipped to the rating scale) and ``was_impossible`` (the model could
not estimate and fell back to the global train mean).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.sources.ratings import RATING_SCALE


@dataclass(frozen=True)
class Roles:
    """Which columns play user / item / rating.  The default follows the
    reference's choice of the beer as the "user" and the reviewer as the "item"."""
    user: str = "BeerID"
    item: str = "ReviewerID"
    rating: str = "rating"


DEFAULT_ROLES = Roles()


def triples(df: DataFrame, roles: Roles) -> DataFrame:
    """(u, i, r) with fixed internal names; rows with a null id or rating dropped."""
    return (df.select(F.col(roles.user).alias("u"), F.col(roles.item).alias("i"),
                      F.col(roles.rating).cast("double").alias("r"))
            .where(F.col("u").isNotNull() & F.col("i").isNotNull() & F.col("r").isNotNull()))


def clip(c: Column, scale=RATING_SCALE) -> Column:
    lo, hi = scale
    return F.least(F.greatest(c, F.lit(float(lo))), F.lit(float(hi)))


def finish(pred: DataFrame, mu: float, scale=RATING_SCALE, est: str = "est") -> DataFrame:
    """Global-mean fallback for impossible estimates (null or NaN), then clip to the scale."""
    impossible = F.col(est).isNull() | F.isnan(est)
    return (pred.withColumn("was_impossible", impossible)
            .withColumn(est, clip(
                F.when(impossible, F.lit(float(mu))).otherwise(F.col(est)), scale)))


def global_stats(r: DataFrame) -> tuple[float, float, int]:
    """(mean, population sd, count) of the rating column ``r`` — one bounded row."""
    row = r.agg(F.avg("r").alias("mu"), F.stddev_pop("r").alias("sd"),
                F.count("r").alias("n")).first()
    return float(row["mu"] or 0.0), float(row["sd"] or 0.0), int(row["n"])


class Model:
    roles: Roles = DEFAULT_ROLES
    mu: float = 0.0
    scale = RATING_SCALE

    def predict(self, targets: DataFrame) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError

    def tables(self) -> dict[str, DataFrame]:
        """The model's state as tables (K7)."""
        raise NotImplementedError(f"{type(self).__name__} has no saved form")

    def params(self) -> dict:
        """The model's numbers and settings, as JSON (K7)."""
        return {"mu": self.mu, "scale": list(self.scale), "roles": [self.roles.user, self.roles.item, self.roles.rating]}

    def spark(self) -> SparkSession:
        return next(iter(self.tables().values())).sparkSession
