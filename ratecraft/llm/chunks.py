"""Substring dedup by content-defined chunking: every passage of ``MIN_WORDS`` words that another document holds.

A gear hash rolls over the words: every step shifts it and adds the number of the next word, so after
``GRAM`` words the oldest has left it.  A text is cut where the smallest gear hash within a stretch of ``MIN_WORDS``
words changes (``cut``; about every 18 words); a chunk is the stretches of one smallest hash, its mark.  Marks depend on
nothing but the stretch's words, so two documents that share a stretch share its mark, and all chunks between its
cuts, at any offset and in any surroundings: insertions shift nothing.

1. Marks that only one document holds are discarded by a grouped aggregation; no
   shared stretch is lost by it.
2. The chunks of the other marks are deduplicated by digest (with their whole
   surroundings), so a chunk's stretches are sent once for all its copies, and the stretches
   are compared exactly, by their own digests.
3. Stretches with two holders or more are repeated.  The document with the
   smallest key keeps a passage, in the others it is removed, up to its real ends.

Digests travel, not texts: they are aggregated with partial sums, then joined
back by equi-joins that may be split when skewed; a passage shared by very many
documents never meets in one task.  Words, stretches and chunks with equal 64-bit
digests count as equal.

Edge cases: null, empty and short texts have no stretches and stay as they are; very long
texts are read whole, by one task each; rows with
equal keys count as one document and keep what they share among each other; all
null keys count as one document that comes last (keys are longs); extra columns
pass through ``without_repeats``, whatever their names (but ``__spans`` and ``__kept``, which it adds); an empty table stays empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.llm.common import table

#: Words of the shortest passage to find, and words the gear hash reaches back (a power of two).
MIN_WORDS, GRAM = 51, 16
#: Most stretches of one chunk (a text that repeats itself keeps one mark for long).
MOST = 64
#: Stands for a null key, after all others.
NO_KEY = (1 << 63) - 1


def _id(key: str) -> Column:
    return F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse (modulo 2 ** 64)."""
    if len(_POWERS["up"]) < n:
        for side, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(max(n, 1 << 14), base, np.uint64)
            p[0] = 1
            _POWERS[side] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix_sums(h: np.ndarray) -> np.ndarray:
    out = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers(len(h))[0], out=out[1:])
    return out


def digests(sums: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Digests of the ranges begins..ends from the prefix sums, the same at any offset."""
    return mix((sums[ends] - sums[begins]) * powers(len(sums))[1][begins])


def words_of(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins, ends and digests of the words (runs of characters other than ASCII white space)."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = (codes != 32) & ((codes < 9) | (codes > 13))
    edges = np.flatnonzero(np.diff(inside))
    begins, ends = edges[::2], edges[1::2]
    return begins, ends, digests(prefix_sums(mix(codes.astype(np.uint64) + np.uint64(_BASE))), begins, ends)


def gear(words: np.ndarray, gram: int) -> np.ndarray:
    """The gear hash at the end of each run of ``gram`` (a power of two) words, from their numbers.

    Step by step it is h = (h << 64 / gram) + word, modulo 2 ** 64; here the reach is doubled 1, 2, 4, ...
    """
    h, width = words, 1
    while width < gram:
        h = (h[:-width] << np.uint64(64 // gram * width)) + h[width:]
        width *= 2
    return h


def marks(words: np.ndarray, min_words: int) -> np.ndarray:
    """The mark of each stretch of ``min_words`` words: the smallest (mixed) gear hash inside it."""
    gram = GRAM
    while gram > min_words:
        gram //= 2
    if len(words) < min_words:
        return np.empty(0, np.uint64)
    low, width, size = mix(gear(words, gram)), 1, min_words - gram + 1
    while 2 * width <= size:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    return np.minimum(low[:len(low) - (size - width)], low[size - width:])


def cut(text: str, min_words: int = MIN_WORDS) -> list[int]:
    """First words of the chunks of a text: the stretches from which on the smallest gear hash is another."""
    own = marks(words_of(text)[2], min_words)
    return np.flatnonzero(np.append(True, own[1:] != own[:-1])[:len(own)]).tolist()


def mark_rows(docs: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """(id, h, mark) of every mark of every text, once a text."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part, owners, found = batch.slice(lo, 512), [], []
                for i, value in enumerate(part.column(1)):
                    words = words_of(value.as_py() or "")[2]
                    if len(words) >= min_words:
                        found.append(np.unique(marks(words, min_words)))
                        owners.append(np.full(len(found[-1]), i, np.int32))
                if found:
                    at = pa.array(np.concatenate(owners))
                    yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(2).take(at), pa.array(
                        np.concatenate(found).view(np.int64))], names=["id", "h", "mark"])

    rows = docs.select(_id(key).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    return rows.mapInArrow(run, "id bigint, h bigint, mark bigint")


def shared_marks(docs: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """Per (id, h): the marks that other documents hold too."""
    rows = mark_rows(docs, key, text, min_words)
    seen = rows.groupBy("mark").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    rows = rows.join(seen.where("first <> last").select("mark"), "mark")
    return rows.groupBy("id", "h").agg(F.collect_list("mark").alias("marks"))


def chunks_of(text: str, shared: np.ndarray, min_words: int):
    """Of the chunks with a shared mark: (digests with surroundings, sizes), and of their stretches one after another
    (digests, begins, ends).  A chunk has ``MOST`` stretches at most, and each begins and ends under 256 characters after the last."""
    begins, ends, words = words_of(text)
    sums = prefix_sums(words)
    own = marks(words, min_words)
    at = np.arange(len(own))
    begins, ends = begins[:len(own)], ends[min_words - 1:]
    fresh = np.ones(len(own), bool)
    fresh[1:] = (own[1:] != own[:-1]) | (np.diff(begins) > 255) | (np.diff(ends) > 255)
    starts = np.flatnonzero((at - np.maximum.accumulate(np.where(fresh, at, 0))) % MOST == 0)
    stops = np.append(starts[1:], len(own))
    inside = np.isin(own, shared.view(np.uint64))
    lo, hi = starts[inside[starts]], stops[inside[starts]]
    whole = mix(digests(sums, lo, hi - 1 + min_words) + (hi - lo).astype(np.uint64))
    at = at[inside]
    return whole.view(np.int64), hi - lo, digests(sums, at, at + min_words).view(np.int64), begins[inside], ends[inside]


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)


def repeated_runs(ids, starts, stops, at, begin_steps, end_steps, counts, found, firsts):
    """(row, start, stop, drop, first) of the runs of stretches of one decision in each row's chunk.

    The chunk of a row has stretches ``at[row]..at[row + 1]``; the steps lead from one to the
    next.  ``counts[row]`` of them are repeated: their numbers in the chunk and first holders.
    """
    row = np.repeat(np.arange(len(ids)), np.diff(at))
    places = []
    for base, steps in ((starts, begin_steps), (stops, end_steps)):
        run = np.cumsum(steps.astype(np.int64))
        places.append(base[row] + run - run[at[:-1]][row])
    first = np.zeros(len(row), np.int64)
    state = np.zeros(len(row), np.int8)  # 1: keeps, 2: drops
    hit = np.repeat(at[:-1], counts) + found
    first[hit] = firsts
    state[hit] = 1 + (firsts != ids[row[hit]])
    edge = np.flatnonzero(np.append(True, (state[1:] != state[:-1]) | (row[1:] != row[:-1]))[:len(row)])
    if not len(edge):
        return [np.zeros(0, np.int64)] * 5
    last, low, kept = np.append(edge[1:], len(row)) - 1, np.minimum.reduceat(first, edge), state[edge] > 0
    edge, last = edge[kept], last[kept]
    return row[edge], places[0][edge], places[1][last], state[edge] == 2, low[kept]


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Per (id, h): sorted spans ``(start, stop, drop, first)`` of passages other documents hold, disjoint for each decision."""
    def chunks(of_places: bool):
        def run(batches):
            for batch in batches:
                for lo in range(0, batch.num_rows, 256):
                    part = batch.slice(lo, 256)
                    rows = [chunks_of(body.as_py(), shared.values.to_numpy(), min_words)
                            for body, shared in zip(part.column(2), part.column(3))]
                    at = pa.array(np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows]))
                    whole, sizes, stretches, begins, ends = (np.concatenate([r[k] for r in rows]) for k in range(5))
                    offsets = _offsets(sizes)
                    cols = {"chunk": pa.array(whole), "id": part.column(0).take(at)}
                    if of_places:
                        cols["h"] = part.column(1).take(at)
                        for name, places in (("start", begins), ("stop", ends)):
                            cols[name] = pa.array(places[offsets[:-1]].astype(np.int32))
                            steps = np.diff(places, prepend=0)
                            steps[offsets[:-1]] = 0
                            cols[name + "_steps"] = pa.Array.from_buffers(pa.binary(), len(whole), [
                                None, pa.py_buffer(offsets), pa.py_buffer(steps.astype(np.uint8))])
                    else:
                        cols["stretches"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(stretches))
                    yield pa.RecordBatch.from_pydict(cols)
        return run

    def runs(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            c = {n: batch.column(n) for n in batch.schema.names}
            at, steps = None, []
            for n in ("start_steps", "stop_steps"):
                values = c[n].to_pylist()
                at = _offsets(np.array([len(v) for v in values]))
                steps.append(np.frombuffer(b"".join(values), np.uint8))
            hits = c["found"].flatten()
            row, *out = repeated_runs(
                c["id"].to_numpy(), c["start"].to_numpy(), c["stop"].to_numpy(), at, *steps,
                np.diff(c["found"].offsets.to_numpy()), hits.field(0).to_numpy(), hits.field(1).to_numpy())
            row, kinds = pa.array(row), (pa.int32(), pa.int32(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([c["id"].take(row), c["h"].take(row), *[pa.array(x).cast(t) for x, t in zip(out, kinds)]],
                                             names=["id", "h", "start", "stop", "drop", "first"])

    held_by = shared_marks(docs, key, text, min_words)
    # "rest" is not read here: with the same columns both joins of the texts share one shuffle
    found = packed(docs, key, text).join(held_by, ["id", "h"]).select("id", "h", "text", "marks", "rest")
    held = found.mapInArrow(chunks(False), "chunk bigint, id bigint, stretches array<bigint>").where("chunk is not null")
    held = held.groupBy("chunk").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.first("stretches").alias("stretches"))
    # always so, as is the filter above, which a later join adds for one use: with both, the two uses of the chunks share one shuffle
    held = held.where("first <= last")
    sent = held.select("chunk", "first", "last", F.posexplode("stretches").alias("i", "digest"))
    holders = sent.groupBy("digest").agg(F.min("first").alias("first"), F.max("last").alias("last")).where("first <> last")
    firsts = sent.select("chunk", "i", "digest").join(holders.drop("last"), "digest")
    firsts = firsts.groupBy("chunk").agg(F.collect_list(F.struct("i", "first")).alias("found"))
    places = found.mapInArrow(chunks(True), "chunk bigint, id bigint, h bigint, start int, start_steps binary, stop int, stop_steps binary")
    rows = places.join(firsts, "chunk").drop("chunk").mapInArrow(
        runs, "id bigint, h bigint, start int, stop int, drop boolean, first bigint")
    # spans of one decision that touch are joined into one
    of = Window.partitionBy("id", "h", "drop").orderBy("start", "stop")
    fresh = F.coalesce(F.col("start") > F.max("stop").over(of.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    rows = rows.withColumn("fresh", fresh.cast("int")).withColumn(
        "island", F.sum("fresh").over(of.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.groupBy("id", "h", "drop", "island").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("first").alias("first"))
    return rows.groupBy("id", "h").agg(F.sort_array(F.collect_list(F.struct("start", "stop", "drop", "first"))).alias("spans"))


def packed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, h, text, rest): the caller's other columns as one struct, so their names can't meet the ones used here."""
    return docs.select(_id(key).alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("text"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("rest"))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``__spans`` (start, stop, drop, first of its repeated passages) and ``__kept`` (the text without the dropped ones)."""
    joined = packed(docs, key, text).join(repeated_spans(docs, key, text, min_words), ["id", "h"], "left")
    spans = F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int,drop:boolean,first:bigint>>"))
    joined = joined.withColumn("spans", spans)
    dropped = F.filter("spans", lambda s: s["drop"])
    stops = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda s: s["stop"]))
    starts = F.concat(F.transform(dropped, lambda s: s["start"]), F.array(F.length("text")))
    kept = F.array_join(F.zip_with(stops, starts, lambda a, b: F.col("text").substr(a + 1, b - a)), "")
    own = [F.col("text").alias(c) if c == text else F.col("rest").getField(c).alias(c) for c in docs.columns
           if c not in ("__spans", "__kept")]
    return joined.select(*own, F.col("spans").alias("__spans"), F.when(F.size(dropped) > 0, kept).otherwise(F.col("text")).alias("__kept"))


def op9_chunk_dedup(spark, sf_dir: str) -> DataFrame:
    rows = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    dropped = F.filter("__spans", lambda s: s["drop"])
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), (F.size("__spans") > 0).alias("has_repeat"),
        (F.size(dropped) > 0).alias("repeat_removed"), F.size("__spans").alias("n_repeats"),
        (F.length("text") - F.length("__kept")).cast("long").alias("removed_chars"),
        F.array_sort(F.array_distinct(F.transform(dropped, lambda s: s["first"]))).alias("holder_doc_ids"),
        F.sha2("__kept", 256).alias("kept_sha256"))
