"""Content-based kNN (M12, M13) on item-level features.

For a target (u, i) the neighbours are the items j the user rated; the
similarity of i and j comes from item content: either the product of the
exponential closeness of several numeric features (M12, C10) or the cosine
of sparse per-item count vectors (M13, C11).  Item features join in by item
before targets and ratings meet by user, so (target, history item) rows are
built, scored and ranked in one task and never shuffled; the item × item matrix
is not built.  Pairs with a long vector are scored by a join.  Top-k by similarity (ties to the smaller id),
weighted mean over positive similarities, no neighbour → impossible.

The reference keys its features by row id and so never finds them (Q2); this
builds the intended algorithm: features are averaged per item over its train
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratecraft.functions.numeric import closeness
from ratecraft.operators.ranking import top_k_per_group
from ratecraft.plans.base import DEFAULT_ROLES, Model, Roles, finish, global_stats, triples
from ratecraft.plans.neighbours import SIM_DECIMALS
from ratecraft.session import cut_lineage
from ratecraft.sources.ratings import RATING_SCALE

#: Entries up to which an item's count vector travels with its ratings.
SHORT = 64
#: Targets of a user that meet the user's ratings in one part.
SHARE = 1000

# The seven numeric columns the reference's content kNN compares.
CONTENT_COLS = ["ReviewerReviewCount", "BeerReviewCount", "ABV", "DayofWeek", "DayofMonth",
                "Month", "Year"]


def item_features_mean(rows: DataFrame, item: str, cols: list[str]) -> DataFrame:
    """One row per item: the mean of each feature over the item's rows."""
    return rows.groupBy(F.col(item).alias("i")).agg(*[F.avg(c).alias(c) for c in cols])


def item_count_vectors(rows: DataFrame, item: str, category: str) -> DataFrame:
    """Sparse count vectors (i, t, c): how often an item's rows have each category value, however many values there are."""
    return (rows.where(F.col(category).isNotNull()).groupBy(F.col(item).alias("i"), F.col(category).alias("t"))
            .agg(F.count(F.lit(1)).cast("double").alias("c")))


def cosine_of_pairs(vectors: DataFrame, pairs: DataFrame) -> DataFrame:
    """(x, y, sim) of the pairs (x, y, distinct) whose sparse vectors (i, t, c) share a feature.

    A pair is expanded from its vector with fewer features and looks the other's up
    by (item, feature), a key that one row has; the norms are stored once an item.
    """
    sizes = vectors.groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.sum(F.col("c") * F.col("c"))).alias("norm"))
    named = lambda side: sizes.select(*[F.col(c).alias(f"{c}{side}") for c in ("i", "n", "norm")])
    p = (pairs.join(named("x").withColumnRenamed("ix", "x"), "x").join(named("y").withColumnRenamed("iy", "y"), "y")
         .where("normx > 0 and normy > 0"))
    swap = F.col("ny") < F.col("nx")
    p = p.select("x", "y", (F.col("normx") * F.col("normy")).alias("norms"), F.when(swap, F.col("y")).otherwise(F.col("x")).alias("a"),
                 F.when(swap, F.col("x")).otherwise(F.col("y")).alias("b"))
    met = (p.join(vectors.select(F.col("i").alias("a"), "t", F.col("c").alias("ca")), "a")
           .join(vectors.select(F.col("i").alias("b"), "t", F.col("c").alias("cb")), ["b", "t"]))
    return met.groupBy("x", "y").agg(F.round(F.sum(F.col("ca") * F.col("cb")) / F.first("norms"), SIM_DECIMALS).alias("sim"))


def cosine_join(vectors: DataFrame, min_sim: float) -> DataFrame:
    """(x, y, sim) of all pairs ``x < y`` of sparse vectors (i, t, c) with a cosine of ``min_sim`` or more, exact.

    An inverted index over prefixes: features are ranked from rare to common; the
    prefix of a vector ends where the rest of it is shorter than ``min_sim`` times the whole.  Two vectors
    that are similar enough share their first common feature in both prefixes, so only prefixes are joined:
    common features stay out of the index, and every pair found is scored once.
    """
    if not 0 < min_sim <= 1:
        raise ValueError("min_sim must be above 0 and at most 1")
    spread = vectors.groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    v = vectors.where("c > 0").join(spread, "t")
    rare_first = Window.partitionBy("i").orderBy("df", "t")
    rest = F.sum(F.col("c") * F.col("c")).over(rare_first.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    whole = F.sum(F.col("c") * F.col("c")).over(Window.partitionBy("i"))
    prefix = v.select("i", "t", rest.alias("rest"), whole.alias("whole")).where(
        F.col("rest") >= F.lit(min_sim * min_sim * (1 - 1e-9)) * F.col("whole")).select("i", "t")
    found = (prefix.select(F.col("i").alias("x"), "t").join(prefix.select(F.col("i").alias("y"), "t"), "t")
             .where("x < y").select("x", "y").distinct())
    return cosine_of_pairs(vectors, found).where(F.col("sim") >= min_sim - 10.0 ** -SIM_DECIMALS)


class ContentKnnModel(Model):
    def __init__(self, r: DataFrame, feats: DataFrame, roles: Roles, k: int, mu: float,
                 kind: str, cols: list[str] | None, scale=RATING_SCALE):
        self.r, self.feats, self.roles, self.k, self.mu = r, feats, roles, k, mu
        self.kind, self.cols, self.scale = kind, cols, scale
        self.users = r.select("u").distinct()

    def _dealt(self, tg: DataFrame, feats: list[DataFrame]) -> DataFrame:
        """Targets beside the ratings of their user, with the items' features ``feats`` joined in before they meet.

        Rows are dealt by user and ``part``: the targets of a user with over ``SHARE`` are cut into parts, each of which
        meets all of the user's ratings.  What follows per target stays in its task.
        """
        history = self.r.select("u", F.col("i").alias("j"), F.col("r").alias("rj"))
        parts = F.ceil(F.count(F.lit(1)) / F.lit(SHARE)).cast("int")
        many = cut_lineage(tg.groupBy("u").agg(parts.alias("parts")).where("u IS NOT NULL AND parts > 1"))
        for f in feats:
            tg = tg.join(f.select("i", *[F.col(c).alias(f"i_{c}") for c in f.columns if c != "i"]), "i")
            history = history.join(f.select(F.col("i").alias("j"), *[F.col(c).alias(f"j_{c}") for c in f.columns if c != "i"]), "j")
        tg, history = tg.withColumn("part", F.lit(0)), history.withColumn("part", F.lit(0))
        if not many.isEmpty():
            cut = F.coalesce("parts", F.lit(1))
            tg = tg.join(many, "u", "left").withColumn("part", F.pmod(F.xxhash64("RowID", "i"), cut).cast("int")).drop("parts")
            history = history.join(many, "u", "left").withColumn("part", F.explode(F.sequence(F.lit(0), cut - 1))).drop("parts")
        return tg.join(history, ["u", "part"])

    def _closeness(self, tg: DataFrame) -> DataFrame:
        sim = None
        for c in self.cols:
            near = closeness(F.col(f"i_{c}"), F.col(f"j_{c}"))
            sim = near if sim is None else sim * near
        near = self._dealt(tg, [self.feats.select("i", *self.cols)])
        return near.select("RowID", "u", "part", "j", "rj", F.round(sim, SIM_DECIMALS).alias("sim")).where(F.col("sim") > 0)

    def _cosine(self, tg: DataFrame) -> DataFrame:
        """Short vectors are scored where target and rating meet; pairs with a long one by ``cosine_of_pairs``."""
        number = cut_lineage(self.feats.select("t").where(F.col("t").isNotNull()).distinct().withColumn("t_id", F.monotonically_increasing_id()))
        sizes = self.feats.groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.sum(F.col("c") * F.col("c"))).alias("norm"))
        sizes = sizes.where("norm > 0")
        entries = (self.feats.join(sizes.where(F.col("n") <= SHORT).select("i"), "i", "left_semi").join(number, "t")
                   .groupBy("i", "t_id").agg(F.sum("c").alias("c")))
        listed = entries.groupBy("i").agg(F.map_from_entries(F.collect_list(F.struct("t_id", "c"))).alias("vector"))  # SHORT at most
        listed = cut_lineage(sizes.join(listed, "i", "left").select("i", "norm", "vector"))
        near = self._dealt(tg, [listed])
        ours, theirs = F.col("i_vector"), F.col("j_vector")
        dot = F.aggregate(F.map_entries(ours), F.lit(0.0), lambda s, e: s + e["value"] * F.coalesce(F.element_at(theirs, e["key"]), F.lit(0.0)))
        dot = F.when(ours.isNotNull() & theirs.isNotNull(), dot)
        near = near.select("RowID", "u", "i", "part", "j", "rj", F.round(dot / (F.col("i_norm") * F.col("j_norm")), SIM_DECIMALS).alias("sim"))
        scored = near.where(F.col("sim") > 0).drop("i")
        if listed.where("vector IS NULL").isEmpty():
            return scored
        rest = near.where(F.col("sim").isNull()).withColumns({"x": F.least("i", "j"), "y": F.greatest("i", "j")}).drop("sim")
        sims = cosine_of_pairs(self.feats, rest.select("x", "y").distinct())
        return scored.unionByName(rest.join(sims.where(F.col("sim") > 0), ["x", "y"]).select(*scored.columns))

    def predict(self, targets: DataFrame) -> DataFrame:
        u, i = self.roles.user, self.roles.item
        cols = targets.columns
        tg = targets.select("RowID", F.col(u).alias("u"), F.col(i).alias("i"))
        h = self._closeness(tg) if self.kind == "closeness" else self._cosine(tg)
        # positives rank ahead of the rest, so the filter before the top-k is exact
        top = top_k_per_group(h, ["u", "part", "RowID"], [F.desc("sim"), F.asc("j")], self.k)
        agg = top.groupBy("RowID").agg((F.sum(F.col("sim") * F.col("rj")) / F.sum("sim")).alias("est"))
        known_i = self.feats.select("i").distinct().withColumn("known_i", F.lit(True))
        t = tg.join(agg, "RowID", "left").join(known_i, "i", "left")
        t = t.select("RowID", F.when(F.col("known_i"), F.col("est")).alias("est"))
        return finish(targets.select(*cols).join(t, "RowID", "left"), self.mu, self.scale)


def fit_content_knn(train: DataFrame, item_feats: DataFrame, roles: Roles = DEFAULT_ROLES,
                    k: int = 40, kind: str = "closeness", cols: list[str] | None = None,
                    scale=RATING_SCALE) -> ContentKnnModel:
    """M12 (kind='closeness', one row an item ``i`` with the numeric ``cols``) / M13 (kind='cosine', sparse
    vectors i, t, c)."""
    r = cut_lineage(triples(train, roles))
    mu, _, _ = global_stats(r)
    feats = cut_lineage(item_feats)
    return ContentKnnModel(r, feats, roles, k, mu, kind, cols or CONTENT_COLS, scale)
