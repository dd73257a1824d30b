"""Baseline estimates  r̂ = μ + b_u + b_i  fitted by alternating least squares
(Koren 2010, eq. for regularised biases).

Each epoch first sets every item bias to Σ(r − μ − b_u) / (reg_i + n_i), then
every user bias to Σ(r − μ − b_i) / (reg_u + n_u).  The ratings are dealt into
cells once (``plans.cells``); a half-step sends the biases of one side to the
cells and sums the deviations of the other side, so the ratings never move
again.  Many models move together: those of a fold leave out the fold's rows.
An epoch is one job that ends in the small table of user biases, written to the
shared folder: a lost executor costs one epoch at most.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.plans.base import DEFAULT_ROLES, Model, Roles, finish, global_stats, triples
from ratecraft.plans.cells import Cells, coded, matrix, positions, summed
from ratecraft.session import cut_lineage, drop_snapshot
from ratecraft.sources.ratings import RATING_SCALE

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package


class BaselineModel(Model):
    def __init__(self, mu: float, bu: DataFrame, bi: DataFrame, roles: Roles,
                 scale=RATING_SCALE):
        self.mu, self.bu, self.bi, self.roles, self.scale = mu, bu, bi, roles, scale

    def biases(self, targets: DataFrame) -> DataFrame:
        """targets + ``bu``, ``bi`` (0 when unknown) and ``known_u``, ``known_i``."""
        u, i = self.roles.user, self.roles.item
        t = targets.join(self.bu.withColumnRenamed("u", u), u, "left")
        t = t.join(self.bi.withColumnRenamed("i", i), i, "left")
        return (t.withColumn("known_u", F.col("bu").isNotNull())
                .withColumn("known_i", F.col("bi").isNotNull())
                .withColumn("bu", F.coalesce("bu", F.lit(0.0)))
                .withColumn("bi", F.coalesce("bi", F.lit(0.0))))

    def predict(self, targets: DataFrame) -> DataFrame:
        cols = targets.columns
        t = self.biases(targets)
        t = t.withColumn("est", F.lit(self.mu) + F.col("bu") + F.col("bi"))
        return finish(t.select(*cols, "est"), self.mu, self.scale)


def _partial(to: str, other: str, mus: list[float], folds: list[int]):
    """Of a cell: for each id of ``to`` a model's sum of r − μ − bias of ``other``, and the number of rows seen by each fold."""
    def run(ratings: pa.Table, states: pa.Table) -> pa.Table:
        ids, code = coded(ratings[to])
        r, fold = ratings["r"].to_numpy(), ratings["fold"].to_numpy()
        at = positions(ratings[other], states[other])
        bias = matrix(states, [f"b{m}" for m in range(len(folds))])
        seen = {f: fold != f for f in dict.fromkeys(folds)}
        out = [pa.array(summed(code[seen[f]], (r - mus[m] - bias[m][at])[seen[f]], len(ids))) for m, f in enumerate(folds)]
        counts = [pa.array(np.bincount(code[x], minlength=len(ids)).astype(np.int64)) for x in seen.values()]
        return pa.Table.from_arrays([ids, *out, *counts], names=[
            to, *[f"s{m}" for m in range(len(folds))], *[f"n{f}" for f in seen]])

    return run


def alternate(rows: DataFrame, mus: Sequence[float], models: Sequence[tuple[int, float, float]], epochs: Sequence[int]
              ) -> dict[int, tuple[DataFrame, DataFrame]]:
    """The biases (u, b0, b1, ...) and (i, b0, ...) after each number of ``epochs``, one column a model.

    A model is (fold, reg_u, reg_i); it is fitted to the ratings (u, i, r, fold) of the other folds, about ``mus`` of
    its number.  Null is the bias of an id without such ratings.
    """
    folds, out = [m[0] for m in models], {}
    numbers = range(len(models))

    def half(cells: Cells, to: str, other: str, states: DataFrame, reg: int) -> DataFrame:
        sent = states.withColumn("cell", F.explode(cells.state_cells(other)))
        names = [f"s{m}" for m in numbers] + [f"n{f}" for f in dict.fromkeys(folds)]
        types = [f"{to} {cells.ids[to]}"] + [f"{c} {'double' if c[0] == 's' else 'long'}" for c in names]
        sums = cells.meet(sent, _partial(to, other, list(mus), folds), ", ".join(types))
        sums = sums.groupBy(to).agg(*[F.sum(c).alias(c) for c in names])
        return sums.select(to, *[F.when(F.col(f"n{f}") > 0, F.col(f"s{m}") / (F.lit(float(models[m][reg])) + F.col(f"n{f}")))
                                 .alias(f"b{m}") for m, f in enumerate(folds)])

    with Cells(rows) as cells:
        bu = rows.sparkSession.createDataFrame([], f"u {cells.ids['u']}, " + ", ".join(f"b{m} double" for m in numbers))
        for epoch in range(1, max(epochs) + 1):
            last, bi = bu, half(cells, "i", "u", bu, 2)
            if epoch in epochs:
                bi = cut_lineage(bi)
            bu = cut_lineage(half(cells, "u", "i", bi, 1))
            if epoch in epochs:
                out[epoch] = bu, bi
            if epoch > 1 and epoch - 1 not in epochs:
                drop_snapshot(last)
    return out


def fit_baseline(train: DataFrame, roles: Roles = DEFAULT_ROLES, n_epochs: int = 10,
                 reg_u: float = 15.0, reg_i: float = 10.0, scale=RATING_SCALE) -> BaselineModel:
    base = cut_lineage(triples(train, roles))
    mu, _, _ = global_stats(base)
    if n_epochs < 1:  # zero epochs: all biases 0
        bi = cut_lineage(base.select("i").distinct().withColumn("bi", F.lit(0.0)))
        bu = cut_lineage(base.select("u").distinct().withColumn("bu", F.lit(0.0)))
    else:
        fitted = alternate(base.withColumn("fold", F.lit(-1)), [mu], [(0, reg_u, reg_i)], [n_epochs])
        bu, bi = (t.withColumnRenamed("b0", name) for t, name in zip(fitted[n_epochs], ("bu", "bi")))
    drop_snapshot(base)
    return BaselineModel(mu, bu, bi, roles, scale)
