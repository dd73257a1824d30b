"""Grouped aggregation by user-defined mergeable states (D3).

An ``Aggregate`` has four steps: ``init`` an empty state, ``update`` it with a
value, ``merge`` two states, ``finish`` it.  ``aggregate`` runs them as
partial aggregation: every task folds its own rows into one state a group
and sends the states, not the rows; they are merged by group, and where a
group still has many states (a hot group has one from every task), first
by (group, slice), then by group.  No task ever sees a group's rows whole, so
states should stay small: sums, counts, the best k.

States travel pickled; ``update`` gets one tuple of the value columns.  Rows
with a null group form a group of their own; empty tables have no groups.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

#: States of one group that are merged by one task before the last merge.
SLICES = 16
#: Groups a task holds states of before it sends them.
HELD = 100_000


@dataclass(frozen=True)
class Aggregate:
    init: Callable[[], Any]
    update: Callable[[Any, tuple], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], Any]


def aggregate(df: DataFrame, group: str, values: Sequence[str], agg: Aggregate, out: str = "value",
              out_type: str = "double") -> DataFrame:
    """(group, out): ``agg`` over the rows of each group."""
    kind = df.schema[group].dataType.simpleString()

    def states(batches: Iterator[pa.RecordBatch], fold) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def sent():
            return pa.RecordBatch.from_arrays([pa.array(list(held), type=key_type), pa.array(
                [pickle.dumps(s) for s in held.values()], pa.binary())], names=[group, "state"])

        key_type = None
        for batch in batches:
            key_type = batch.schema.field(0).type
            columns = [batch.column(c).to_pylist() for c in range(1, batch.num_columns)]
            for key, *row in zip(batch.column(0).to_pylist(), *columns):
                held[key] = fold(held[key] if key in held else None, row)
            if len(held) > HELD:
                yield sent()
                held.clear()
        if held:
            yield sent()

    def update(batches):
        return states(batches, lambda s, row: agg.update(agg.init() if s is None else s, tuple(row)))

    def merge(batches):
        def fold(state, row):
            new = pickle.loads(row[0])
            return new if state is None else agg.merge(state, new)
        return states(batches, fold)

    def finish(batches):
        """Rows come sorted by group: one state is held at a time."""
        now, state, some = None, None, False
        for batch in batches:
            keys, done = [], []
            for key, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new = pickle.loads(row)
                if some and key == now:
                    state = agg.merge(state, new)
                    continue
                if some:
                    keys.append(now)
                    done.append(agg.finish(state))
                now, state, some = key, new, True
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(0).type), pa.array(done, out_arrow)], names=[group, out])
            key_type = batch.schema.field(0).type
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([now], key_type), pa.array([agg.finish(state)], out_arrow)], names=[group, out])

    out_arrow = to_arrow_type(StructType.fromDDL(f"v {out_type}")["v"].dataType)
    schema = f"`{group}` {kind}, state binary"
    partial = df.select(group, *values).mapInArrow(update, schema)
    sliced = partial.repartition(F.col(group), F.pmod(F.xxhash64("state"), F.lit(SLICES))).mapInArrow(merge, schema)
    return sliced.repartition(group).sortWithinPartitions(group).mapInArrow(finish, f"`{group}` {kind}, `{out}` {out_type}")


def ndcg(k: int) -> Aggregate:
    """A22 of (label, position) rows: the gain of the first ``k`` by position over that of the ``k`` best labels; 1 if that is 0."""
    def gain(labels) -> float:
        return sum((2.0 ** rel - 1) / math.log2(rank + 2) for rank, rel in enumerate(labels))

    def update(state, row):
        label, position = float(row[0]), row[1]
        first, best = state
        # both heaps keep k entries, the worst on top
        (heapq.heappush if len(first) < k else heapq.heappushpop)(first, (-position, label))
        (heapq.heappush if len(best) < k else heapq.heappushpop)(best, label)
        return first, best

    def merge(a, b):
        return heapq.nlargest(k, a[0] + b[0])[::-1], heapq.nlargest(k, a[1] + b[1])[::-1]

    def finish(state):
        ideal = gain(sorted(state[1], reverse=True))
        return 1.0 if ideal == 0 else gain(label for _, label in sorted(state[0], reverse=True)) / ideal

    return Aggregate(lambda: ([], []), update, merge, finish)
