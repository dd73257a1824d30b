"""Filter interaction audit by decision diagrams of failure masks.

Tasks read every whole text once and note which of the filters A to E it fails
(``failure_table``); E compares texts across the table by their SHA-256.  The
rows are then counted by part and failure mask, at most 32 rows a part.  For
each part a ``Diagram`` is built: one level a filter, low branch passed, high
branch failed, equal sub-diagrams shared, every node with the counts below it.
Swapping two neighbouring levels rebuilds only those two; a chain of such swaps
(each order differs from the one before by one neighbouring pair) visits all
orders.  In each order the all-pass path from the root gives the steps: what a
node's high branch holds is removed there, what its low branch holds is kept.

Hot keys: rows with equal (key, text, part) are counted before anything is
joined; the smallest key of a text meets its row by (text, key), which spreads
the copies of one text; rows without a key get their own join key.

Edge cases: a null text is empty; a null part is the part with the empty name;
a null key is never later than another and has no labels; repeated rows count
each and are no copies of one another, equal keys being no smaller ones; several
labels of a key count as one that has each mark if any has it; very long texts
are read whole; empty tables give no parts, hence no rows; only the named
columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import by_batch, saved, table

LETTERS = "ABCDE"
_UPPER, _SIGNS = bytes(range(65, 91)), b"#$%&*|"


def text_filters(text: bytes, min_words: int = 200) -> int:
    """Bits of the failed filters A (few words), B (few distinct words), C (capitals), D (signs)."""
    words = text.split()
    points = len(text) - len(text.translate(None, bytes(set(range(256)) - set(range(128, 192)))))
    capitals = len(text) - len(text.translate(None, _UPPER))
    return ((len(words) < min_words) | (100 * len(set(words)) < 50 * len(words)) << 1
            | (100 * capitals > 2 * points) << 2 | (len(text.translate(None, _SIGNS)) < len(text)) << 3)


def failure_table(docs: DataFrame, check: Callable[[bytes], int] = text_filters, copies_bit: int = 4,
                  key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(key, part, digest, mask, n): the failed filters of all rows, equal rows counted.

    ``check`` gives the bits that a text alone decides; bit ``copies_bit`` is
    set if a row with a smaller key has the same text.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batch):
        digests, bits = [], []
        for value in batch.column(2):
            body = value.as_py() or b""
            digests.append(hashlib.sha256(body).digest())
            bits.append(check(body))
        return {"key": batch.column(0), "part": batch.column(1), "digest": digests, "bits": bits}

    slim = docs.select(F.col(key), F.coalesce(F.col(part).cast("string"), F.lit("")), F.col(text).cast("binary"))
    rows = by_batch(slim, run, f"key {kind}, part string, digest binary, bits int")
    rows = saved(rows.groupBy("key", "digest", "part", "bits").agg(F.count(F.lit(1)).alias("n")), "audit-rows")
    first = rows.groupBy("digest").agg(F.min("key").alias("key")).withColumn("first", F.lit(True))
    later = F.col("first").isNull() & F.col("key").isNotNull()
    return rows.join(first, ["digest", "key"], "left").select(
        "key", "part", "digest", F.when(later, F.col("bits") + (1 << copies_bit)).otherwise(F.col("bits")).alias("mask"), "n")


def mask_counts(failures: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): rows by failure mask, and how many of them are labelled good and toxic."""
    mark = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    marks = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("k")).agg(
        mark("quality").alias("good"), mark("toxic").alias("toxic"))
    named = failures.withColumn("k", F.coalesce(F.col("key").cast("string"), F.concat(F.lit("none "), F.hex("digest"))))
    total = lambda c: F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c)
    return named.join(marks, "k", "left").groupBy("part", "mask").agg(F.sum("n").alias("n"), total("good"), total("toxic"))


class Diagram:
    """Count-weighted decision diagram of failure masks, its levels in any order of the filters."""

    def __init__(self, counts: dict[int, Sequence[int]], filters: int):
        self.order = list(range(filters))
        self.size = len(next(iter(counts.values()), (0,)))
        self.weights: list[tuple[int, ...]] = []  # of each node: the counts below it
        self.levels: list[dict[int, tuple[int, int]]] = [{} for _ in self.order]  # node -> (passed, failed)
        self.unique: list[dict[tuple[int, int], int]] = [{} for _ in self.order]
        self._ends: dict[tuple[int, ...], int] = {}
        self.root = self._build({m: tuple(c) for m, c in counts.items()}, 0)

    def _node(self, weight: tuple[int, ...]) -> int:
        self.weights.append(weight)
        return len(self.weights) - 1

    def _make(self, level: int, passed: int, failed: int) -> int:
        """The node of ``level`` with these branches; one node for equal branches."""
        if (passed, failed) not in self.unique[level]:
            node = self._node(tuple(a + b for a, b in zip(self.weights[passed], self.weights[failed])))
            self.unique[level][passed, failed] = node
            self.levels[level][node] = (passed, failed)
        return self.unique[level][passed, failed]

    def _build(self, counts: dict[int, tuple[int, ...]], level: int) -> int:
        if level == len(self.order):
            end = next(iter(counts.values()), (0,) * self.size)
            if end not in self._ends:
                self._ends[end] = self._node(end)
            return self._ends[end]
        split = [{m: c for m, c in counts.items() if m >> level & 1 == side} for side in (0, 1)]
        return self._make(level, *(self._build(c, level + 1) for c in split))

    def swap(self, level: int) -> None:
        """Exchanges ``level`` with the next one; nodes of the upper level keep their numbers, so no other changes."""
        below = self.levels[level + 1]
        self.levels[level + 1], self.unique[level + 1] = {}, {}
        upper = {}
        for node, (passed, failed) in self.levels[level].items():
            (pp, pf), (fp, ff) = below[passed], below[failed]
            upper[node] = (self._make(level + 1, pp, fp), self._make(level + 1, pf, ff))
        self.levels[level] = upper
        self.unique[level] = {branches: node for node, branches in upper.items()}
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> list[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """(filter, removed, kept) along the all-pass path."""
        node, out = self.root, []
        for level, name in enumerate(self.order):
            passed, failed = self.levels[level][node]
            out.append((name, self.weights[failed], self.weights[passed]))
            node = passed
        return out


def swap_chain(n: int) -> Iterator[int]:
    """Places of the neighbouring swaps that lead through all orders of ``n`` things, each once."""
    if n < 2:
        return
    sweep = list(range(n - 2, -1, -1))  # the last thing wanders through the others
    right = False
    inner = swap_chain(n - 1)
    while True:
        yield from (sweep[::-1] if right else sweep)
        place = next(inner, None)
        if place is None:
            return
        right = not right
        yield place + right


def audit_part(counts: dict[int, Sequence[int]], letters: str) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of every order and step."""
    k = len(letters)
    diagram = Diagram(counts, k)
    orders = []
    chain = swap_chain(k)
    while True:
        orders.append(("".join(letters[f] for f in diagram.order), diagram.steps()))
        place = next(chain, None)
        if place is None:
            break
        diagram.swap(place)
    fails, alone, shapley = [0] * k, [0] * k, [0] * k
    for _, steps in orders:
        first, last = steps[0], steps[-1]
        fails[first[0]] = first[1][0]  # nothing was removed before the first filter
        alone[last[0]] = last[1][0]  # all others passed before the last
        for name, removed, _ in steps:
            shapley[name] += removed[0]
    return [(order, i + 1, kept[0], removed[0], fails[f] - removed[0], alone[f], removed[1], removed[2], shapley[f])
            for order, steps in orders for i, (f, removed, kept) in enumerate(steps)]


def interactions(masks: DataFrame, letters: str = LETTERS) -> DataFrame:
    """The audit of every part from its mask counts, one row an order and step."""
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def run(batch, letters):
        rows = []
        for part, masks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts = {m["mask"]: (m["n"], m["good"], m["toxic"]) for m in masks}
            rows += [(part, *r) for r in audit_part(counts, letters)]
        return dict(zip(names, zip(*rows)))

    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")))  # 2 ** filters at most
    return by_batch(parts, partial(run, letters=letters), "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
                    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint")


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    failures = failure_table(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return interactions(mask_counts(failures, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")))


OP12_SQL = """
with t as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as body from documents),
w as (select *, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') as words, min(doc_id) over (partition by body) as first from t),
f as (select doc_id, part, (len(words) < 200)::int + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::int
  + 4 * (100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 2 * length(body))::int
  + 8 * regexp_matches(body, '[#$%&*|]')::int + 16 * coalesce(doc_id > first, false)::int as mask from w),
l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels where doc_id is not null group by doc_id),
m as (select part, mask, count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic
  from f left join l using (doc_id) group by part, mask),
x as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)),
o as (select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from x a, x b, x c, x d, x e where a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s as (select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[1:step - 1]), 0)::int as before
  from o, (select unnest([1, 2, 3, 4, 5]) as step)),
r as (select part, filter_order, step, bit,
  coalesce(sum(n) filter (where mask & (before | bit) = 0), 0)::bigint as kept,
  coalesce(sum(n) filter (where mask & before = 0 and mask & bit <> 0), 0)::bigint as removed,
  coalesce(sum(n) filter (where mask & before <> 0 and mask & bit <> 0), 0)::bigint as redundant,
  coalesce(sum(n) filter (where mask = bit), 0)::bigint as unique_fails,
  coalesce(sum(good) filter (where mask & before = 0 and mask & bit <> 0), 0)::bigint as good_lost,
  coalesce(sum(toxic) filter (where mask & before = 0 and mask & bit <> 0), 0)::bigint as toxic_lost
  from m, s group by part, filter_order, step, bit)
select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, bit))::bigint as shapley from r
"""
