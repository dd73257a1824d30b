"""Ratings dealt into cells, for epochs that move the ids' states and not the ratings.

A cell holds the ratings of one block of users and one block of items (of one
group ``g``, if the rows carry one).  The cells are partitioned and held once;
in each step the state of an id is sent to the cells of its block, numbers meet
the ratings there, and one row of partial sums an id and cell goes back to be
summed.  So a step shuffles (blocks + 1) rows an id, however many ratings it has.

A cell of more than ``CELL`` ratings (an id with a third of all rows makes such)
is dealt again by a hash of its ratings, so no task holds more than about
``CELL`` ratings of one cell and the states of the ids in it.
"""

from __future__ import annotations

import contextlib
import math
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.session import drop_shuffles_behind

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

#: Ratings of a cell, the least number of cells, and the least ratings of these.
CELL, LEAST, FEW = 1 << 20, 16, 1 << 12


class Cells:
    """The ratings (u, i, ..., g if there) by cell; ``state_cells`` are the cells that a state is sent to."""

    def __init__(self, rows: DataFrame, size: int | None = None):
        size = size or CELL
        grouped = "g" in rows.columns
        g = F.col("g") if grouped else F.lit(0)
        seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max(g).alias("g")).first()
        groups = (seen["g"] or 0) + 1
        least = min(LEAST, seen["n"] / FEW)
        self.blocks = math.ceil(math.sqrt(max(least / groups, seen["n"] / groups / size, 1)))
        grid = ((g * self.blocks + self._block("u")) * self.blocks + self._block("i")).cast("int")
        counts = {r["grid"]: r["n"] for r in rows.groupBy(grid.alias("grid")).agg(F.count(F.lit(1)).alias("n")).collect()}
        parts = [math.ceil(counts.get(x, 0) / size) for x in range(groups * self.blocks ** 2)]  # cells of each place of the grid
        first = np.concatenate([[0], np.cumsum(parts)]).tolist()
        at = lambda values: F.element_at(F.array(*[F.lit(int(v)) for v in values]), grid + 1)
        cell = at(first[:-1]) + F.pmod(F.xxhash64(F.lit(7), "u", "i"), at([max(p, 1) for p in parts])).cast("int")
        b, of = self.blocks, lambda x: range(first[x], first[x + 1])
        self._cells = {
            "u": [[c for y in range(b) for c in of((h * b + x) * b + y)] for h in range(groups) for x in range(b)],
            "i": [[c for x in range(b) for c in of((h * b + x) * b + y)] for h in range(groups) for y in range(b)]}
        self._grouped, self.ids = grouped, {c: rows.schema[c].dataType.simpleString() for c in ("u", "i")}
        pieces = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        # sorted once: the steps meet the rows in the order of the cells
        self.rows = rows.withColumn("cell", cell).repartition(min(pieces, max(first[-1], 1)), "cell").sortWithinPartitions("cell").persist(
            StorageLevel.DISK_ONLY)
        self.rows.count()
        drop_shuffles_behind(self.rows)

    def _block(self, id_col: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(3), id_col), F.lit(self.blocks)).cast("int")

    def state_cells(self, id_col: str) -> Column:
        """The cells of an id's block, for ``explode``."""
        g = F.col("g") if self._grouped else F.lit(0)
        lists = F.array(*[F.array(*[F.lit(c) for c in cells]).cast("array<int>") for cells in self._cells[id_col]])
        return F.element_at(lists, (g * self.blocks + self._block(id_col) + 1).cast("int"))

    def meet(self, states: DataFrame, partial, schema: str) -> DataFrame:
        """``partial(ratings, states)`` of every cell, both Arrow tables; ``states`` carries the column ``cell``."""
        return self.rows.groupBy("cell").cogroup(states.groupBy("cell")).applyInArrow(partial, schema)

    def __enter__(self) -> Cells:
        return self

    def __exit__(self, *_) -> None:
        with contextlib.suppress(Exception):
            self.rows.unpersist()


def positions(ids: pa.ChunkedArray, among: pa.ChunkedArray) -> np.ndarray:
    """Where each id stands in ``among``; one that is not there gets the place after its end."""
    return pc.fill_null(pc.index_in(ids, value_set=among), len(among)).to_numpy()


def matrix(table: pa.Table, columns: list[str]) -> np.ndarray:
    """Number columns (columns x rows) with a last row of zeros for ids without a state; null counts as 0."""
    out = np.zeros((len(columns), table.num_rows + 1))
    for k, c in enumerate(columns):
        out[k, :-1] = pc.fill_null(table[c], 0).to_numpy()
    return out


def coded(ids: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The distinct ids and each row's number among them."""
    coded_ids = ids.combine_chunks().dictionary_encode() if len(ids) else pa.array([], ids.type).dictionary_encode()
    if isinstance(coded_ids, pa.ChunkedArray):
        coded_ids = coded_ids.chunk(0)
    return coded_ids.dictionary, coded_ids.indices.to_numpy()


def summed(code: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of the values by their number (numpy counts in whole numbers where there are none)."""
    return np.bincount(code, values, size).astype(np.float64)
