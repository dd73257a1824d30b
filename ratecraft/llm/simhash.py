"""SimHash near-duplicates through pivot distance tables.

Each distinct fingerprint carries its Hamming distances to ``PIVOTS`` reference
fingerprints.  By the triangle inequality two fingerprints within ``max_bits``
differ by at most that much in every coordinate, so a pair whose largest
coordinate difference is above it is discarded without looking at its bits;
the survivors are verified by the exact distance.

Which pairs are looked at: with the 64 bits cut into ``max_bits + 2`` blocks,
two fingerprints within ``max_bits`` agree in at least two whole blocks, so
every link lies inside some group of equal block pairs, and no pair outside is
formed.  A group is cut into cells of about ``CELL`` fingerprints and compared
cell against cell, so no group is ever held whole; a task returns only links
that join what it has not yet joined (a spanning forest), never all pairs.

Edge cases: null and empty texts have no words and fingerprint zero, which
links like any other; equal texts share one fingerprint (one row of the search);
a null key takes no part in the smallest key of its component but gets the
component's (null if all are null); an empty table gives an empty table.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import by_batch, components, pieces, saved, table

PIVOTS = 32
CELL = 512
#: Rows compared at once in a task.
BLOCK_ROWS = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Majority of the shingles' XXH64 bits; 0 without words."""
    words = (text or "").encode().lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends[:-shingle + 1 or None] - [len(w) + 1 for w in words][:len(words) - shingle + 1]).tolist()
    stops = (ends[shingle - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[a:b], 42) for a, b in zip(starts, stops)], dtype="<u8")
    count = np.zeros(64, np.int64)
    for k in range(0, len(h), BLOCK_ROWS):
        bits = np.unpackbits(h[k:k + BLOCK_ROWS].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * count > len(h)).tolist()))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(key, h, fp): text hash and fingerprint of each row's whole text, as signed longs."""
    def run(batch: pa.RecordBatch) -> dict:
        fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], dtype=np.uint64)
        return {"key": batch.column(0), "h": batch.column(1), "fp": fps.view(np.int64)}

    kind = docs.schema[key].dataType.simpleString()
    return by_batch(docs.select(F.col(key), F.xxhash64(text), F.col(text)), run, f"key {kind}, h bigint, fp bigint")


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: the XXH64 of their numbers."""
    return np.array([xxhash.xxh64_intdigest(str(i), 7) for i in range(n)], dtype=np.uint64)


def distance_table(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """(fingerprints x pivots) Hamming distances."""
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)


def near_pairs(fps: np.ndarray, coords: np.ndarray, group: np.ndarray, side: np.ndarray, max_bits: int):
    """Links (i, j) inside runs of equal ``group``, without those already joined.

    Offset by offset down the sorted runs: coordinates first, bits of the
    survivors second.  Two rows of one cell meet in the cell's own run only
    (``side`` 0 and 1 are the two cells of a run, 2 both).
    """
    n = len(fps)
    root = np.arange(n)
    out: list[tuple[int, int]] = []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    offset, left = 1, np.arange(n)
    while True:
        left = left[left + offset < n]
        left = left[group[left] == group[left + offset]]
        if not len(left):
            return out
        i, j = left, left + offset
        cross = (side[i] == 2) | (side[i] != side[j])
        i, j = i[cross], j[cross]
        for c in range(0, coords.shape[1], 8):  # a few pivots at a time: most pairs go at once
            close = np.abs(coords[i, c:c + 8] - coords[j, c:c + 8]).max(axis=1, initial=0) <= max_bits
            i, j = i[close], j[close]
        near = np.bitwise_count(fps[i] ^ fps[j]) <= max_bits
        for a, b in zip(i[near].tolist(), j[near].tolist()):
            x, y = top(a), top(b)
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((a, b))
        offset += 1


def _links(max_bits: int, refs: list[int], n_pivots: int):
    """Task over rows (g, side, fp, coords) sorted by g: spanning links of each run."""
    def run(batches):
        held: list[pd.DataFrame] = []
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def solve(rows: pd.DataFrame):
            fps = rows["fp"].to_numpy().view(np.uint64)
            coords = np.frombuffer(b"".join(rows["coords"]), dtype=np.int8).reshape(len(rows), n_pivots)
            group = rows["g"].to_numpy()
            links = near_pairs(fps, coords, group, rows["side"].to_numpy(), max_bits)
            signed = fps.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array([int(signed[a]) for a, _ in links], pa.int64()),
                                               pa.array([int(signed[b]) for _, b in links], pa.int64())], schema=schema)

        for batch in batches:
            rows = batch.to_pandas()
            held.append(rows)
            group = rows["g"].to_numpy()
            if len(group) and (held[0]["g"].iloc[0] != group[-1]):
                rows = pd.concat(held, ignore_index=True)
                group = rows["g"].to_numpy()
                cut = int(np.flatnonzero(group != group[-1])[-1]) + 1
                yield solve(rows.iloc[:cut])
                held = [rows.iloc[cut:]]
        if held:
            yield solve(pd.concat(held, ignore_index=True))

    return run


def fingerprint_links(distinct: DataFrame, max_bits: int = 2, n_pivots: int = PIVOTS, cell: int = CELL) -> DataFrame:
    """Links (a, b) that connect the same distinct fingerprints as all pairs within ``max_bits``.

    ``distinct`` has one row per fingerprint, column ``fp``.
    """
    refs = pivots(n_pivots)
    n_blocks = max_bits + 2
    edges = [64 * k // n_blocks for k in range(n_blocks + 1)]
    masks = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(n_blocks)]
    signed = lambda m: m - (1 << 64) if m >= 1 << 63 else m
    keys = [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(signed(masks[a] | masks[b])).cast("long")))
            for i, (a, b) in enumerate(combinations(range(n_blocks), 2))]
    rows = distinct.select("fp", F.explode(F.array(*keys)).alias("k"))
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn(
        "cells", F.ceil(F.col("n") / F.lit(cell)).cast("int"))
    met = rows.join(groups, "k").withColumn("c", F.pmod(F.xxhash64(F.lit(1), "fp"), F.col("cells")).cast("int"))
    met = met.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    met = met.select(
        F.xxhash64("k", F.least("c", "o"), F.greatest("c", "o")).alias("g"),
        F.when(F.col("c") == F.col("o"), 2).when(F.col("c") < F.col("o"), 0).otherwise(1).cast("byte").alias("side"), "fp")

    def coordinates(batch: pa.RecordBatch) -> dict:
        fps = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
        coords = distance_table(fps, refs)
        return {"g": batch.column(0), "side": batch.column(1), "fp": batch.column(2),
                "coords": [x.tobytes() for x in coords]}

    met = by_batch(met, coordinates, "g bigint, side tinyint, fp bigint, coords binary")
    met = met.repartition(pieces(distinct), "g").sortWithinPartitions("g")
    return met.mapInArrow(_links(max_bits, [], n_pivots), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """(key, h, fp, component, root): smallest key reachable by links of ``max_bits`` bits or fewer.

    ``h`` is the text's hash; ``root`` (a fingerprint) names the component.
    """
    rows = saved(fingerprints(docs, key, text, shingle), "simhash")
    distinct = saved(rows.groupBy("fp").agg(F.min("key").alias("first")), "simhash-distinct")
    linked = components(fingerprint_links(distinct.select("fp"), max_bits), "simhash-components")
    named = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("first").alias("component"))
    named = named.join(least, "root").select("fp", "component", "root")
    return rows.join(named, "fp").select("key", "h", "fp", "component", "root")


def without_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                            max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest key (null last), then text hash.

    Rows equal in key and text are one document, of which one row stays.
    """
    last = (1 << 63) - 1
    place = F.struct(F.coalesce(F.col("key").cast("long"), F.lit(last)).alias("k"), F.col("h"))
    stay = near_duplicates(docs, key, text, shingle, max_bits).groupBy("root").agg(F.min(place).alias("p"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce(F.col(key).cast("long"), F.lit(last)).alias("k"), F.xxhash64(text).alias("h"))
    return rows.join(stay.select("p.*"), ["k", "h"]).dropDuplicates(["k", "h"]).select("row.*")


def op5_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))
