"""Periodic runs of words by online dyadic square catching.

A run is a stretch of words with smallest period p that no neighbouring word
extends.  ``RunCatcher`` takes the words as they come.  For every block length
L = 1, 2, 4, ... the aligned blocks completed so far are its catchers: a run of
period p in [2L, 4L) holds a whole aligned block in its first p words, and that
block comes again p words later.  Every appended word moves the suffixes ahead
that are compared with the catchers in reach (two a length); what agrees is
compared on, block by block, over the repetitions asked for.  A square caught
that way is extended word by word to both sides and merged into its run: runs
that reach the end grow with the next words, and blocks inside a run with a
divisor of the period report nothing.  Block digests only choose what to
compare; the words themselves decide.

``find_runs`` applies it to whole texts in tasks.  Nothing is shuffled; memory
is that of one text's words.  Words are appended in pieces of ``PIECE``.

Edge cases: null and empty texts, and texts without a word, have no runs and an
empty rest; very long texts are read whole, in pieces; one text is one task's
work; repeated rows and null keys are judged row by row; of runs with the same
stretch the smallest period is kept, runs are listed by start, then period;
empty tables give empty tables; only the named columns are read, so others may
have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import WORD, by_batch, table

#: Words appended at a time.
PIECE = 1 << 16
_A, _B, _C = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_R = np.uint64(29)


def _digests(words: np.ndarray, length: int) -> np.ndarray:
    """Digest of every stretch of ``length`` (a power of two) words."""
    h = (words.astype(np.uint64) + _B) * _A
    h ^= h >> _R
    size = 1
    while size < length:
        h = (h[:-size] * _C + h[size:]) * _A
        h ^= h >> _R
        size *= 2
    return h


class RunCatcher:
    """Runs of at least ``min_exponent`` periods and ``min_length`` words, found while words are appended."""

    def __init__(self, min_exponent: int = 4, min_length: int = 0):
        if min_exponent < 2:
            raise ValueError("a run has at least two periods")
        self.times, self.min_length = int(min_exponent), min_length
        self.words = np.empty(256, np.int64)
        self.n = 0
        self.seen: dict[int, int] = {}  # block length -> words its catchers have been compared with
        self.found: dict[tuple[int, int], int] = {}  # (start, period) -> end

    def append(self, ids: np.ndarray) -> None:
        """The next words, as numbers; equal words have equal numbers."""
        old, self.n = self.n, self.n + len(ids)
        if self.n > len(self.words):
            self.words = np.concatenate([self.words[:old], np.empty(max(self.n, 2 * old) - old, np.int64)])
        self.words[old:self.n] = ids
        for (start, period), end in list(self.found.items()):
            if end == old:
                end = self.found[start, period] = end + self._ahead(end - period, end)
                if end < self.n and end - start < self.times * period:
                    del self.found[start, period]
        self._advance(finish=False)

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs in the words so far."""
        self._advance(finish=True)
        least: dict[tuple[int, int], int] = {}
        for (start, period), end in self.found.items():
            least[start, end] = min(period, least.get((start, end), period))
        return sorted((a, b - a, p) for (a, b), p in least.items()
                      if b - a >= max(self.min_length, self.times * p))

    def _advance(self, finish: bool) -> None:
        if self.n - self.seen.get(0, 0) >= 1:
            self._neighbours()
        length = 1
        while length + (self.times - 1) * 2 * length <= self.n:
            new = self.n - self.seen.get(length, 0)
            if new >= length or (finish and new > 0):
                self._catch(length)
            length *= 2

    def _neighbours(self) -> None:
        """Period 1: stretches of one repeated word."""
        lo = max(0, self.seen.get(0, 0) - self.times + 1)
        same = self.words[lo:self.n - 1] == self.words[lo + 1:self.n]
        self.seen[0] = self.n
        if same.any():
            edge = np.diff(np.concatenate([[0], same.astype(np.int8), [0]]))
            starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            for s in starts[ends - starts >= self.times - 1]:
                self._merge(lo + int(s), 1)

    def _catch(self, length: int) -> None:
        """Compares the new suffixes of ``length`` words with the completed blocks two to four lengths back."""
        n, seen, more = self.n, self.seen.get(length, 0), self.times - 1
        self.seen[length] = n
        lo = max(0, (seen - length - more * (4 * length - 1)) // length * length)
        h = _digests(self.words[lo:n], length)
        blocks = (len(h) - 1) // length + 1
        h = np.concatenate([h, np.zeros(4 * length + blocks * length - len(h), np.uint64)])
        ahead = np.lib.stride_tricks.as_strided(h[2 * length:], (blocks, 2 * length), (8 * length, 8), writeable=False)
        block, shift = np.nonzero(ahead == h[:blocks * length:length, None])
        if not len(block):
            return
        s, p = block * length, shift + 2 * length
        end = lo + s + length + more * p
        fits = (end <= n) & (end > seen)
        s, p = s[fits], p[fits]
        for k in range(1, 4 * (more - 1) + 1):  # the rest of the repetitions, a block at a time
            if not len(s):
                return
            inside = np.minimum(k * length, (more - 1) * p)
            same = h[s + inside] == h[s + inside + p]
            s, p = s[same], p[same]
        s += lo
        if len(s) and self.found:
            s, p = self._outside(s, p, length)
        last = (-1, 0, 0)
        for k in np.lexsort((s, p)):
            at, period = int(s[k]), int(p[k])
            if period != last[0] or at < last[1] or at + period + length > last[2]:
                last = (period, *self._merge(at, period))

    def _outside(self, s: np.ndarray, p: np.ndarray, length: int):
        """The hits that no known run with a divisor of their period covers."""
        known = np.array([(a, b, q) for (a, q), b in self.found.items() if b - a >= 3 * length], np.int64)
        if not len(known):
            return s, p
        known = known[np.argsort(known[:, 0], kind="stable")]
        far = np.maximum.accumulate(known[:, 1])
        owner = np.maximum.accumulate(np.where(known[:, 1] == far, np.arange(len(known)), 0))
        before = np.searchsorted(known[:, 0], s, side="right") - 1
        run = known[owner[np.maximum(before, 0)]]
        out = (before < 0) | (s + p + length > run[:, 1]) | (p % run[:, 2] != 0)
        return s[out], p[out]

    def _merge(self, s: int, p: int) -> tuple[int, int]:
        """The stretch around ``s`` that repeats at distance ``p``; kept if it is long enough or may still grow."""
        start, end = s - self._behind(s, s + p), s + p + self._ahead(s, s + p)
        if end == self.n or end - start >= self.times * p:
            self.found[start, p] = end
        return start, end

    def _ahead(self, i: int, j: int) -> int:
        """Number of equal words from ``i`` and ``j > i`` on."""
        w, k, step = self.words, 0, 64
        while j + k < self.n:
            m = min(step, self.n - j - k)
            differ = w[i + k:i + k + m] != w[j + k:j + k + m]
            at = int(differ.argmax())
            if differ[at]:
                return k + at
            k, step = k + m, 2 * step
        return k

    def _behind(self, i: int, j: int) -> int:
        """Number of equal words before ``i`` and ``j > i``."""
        w, k, step = self.words, 0, 64
        while i - k > 0:
            m = min(step, i - k)
            differ = (w[i - k - m:i - k] != w[j - k - m:j - k])[::-1]
            at = int(differ.argmax())
            if differ[at]:
                return k + at
            k, step = k + m, 2 * step
        return k


class _Numbers(dict):
    """Number of each distinct word, given out as words are met."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def text_runs(words: list[bytes], min_exponent: int, min_length: int) -> list[tuple[int, int, int]]:
    """Runs of a list of words."""
    catcher, numbers = RunCatcher(min_exponent, min_length), _Numbers()
    for lo in range(0, len(words), PIECE):
        piece = words[lo:lo + PIECE]
        catcher.append(np.fromiter(map(numbers.__getitem__, piece), np.int64, len(piece)))
    return catcher.runs()


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    cover = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0)]


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_exponent: int = 4,
              min_length: int = 6) -> DataFrame:
    """(key, n_words, runs, rest) of each row: its runs by start, then period, and the words they don't repeat."""
    kind = docs.schema[key].dataType.simpleString()
    spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batch):
        n, runs, rest = [], [], []
        for value in batch.column(1):
            words = (value.as_py() or b"").split()
            found = text_runs(words, min_exponent, min_length)
            n.append(len(words))
            runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
            rest.append(b" ".join(without_repeats(words, found)))
        return {key: batch.column(0), "n_words": n, "runs": pa.array(runs, spans),
                "rest": pa.array(rest, pa.binary()).cast(pa.string())}

    slim = docs.select(F.col(key), F.col(text).cast("binary").alias("__text"))
    return by_batch(slim, run, f"`{key}` {kind}, n_words bigint, "
                               "runs array<struct<start: bigint, length: bigint, period: bigint>>, rest string")


def planted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text): a tenth of the texts, by the key's CRC, repeat a stretch of their words to the end."""
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))
    n, g = F.size(words), F.floor(h / 10).cast("long")
    rows = docs.select(F.col(key), F.col(text).alias("text"), F.when((h % 10 == 0) & F.col(text).rlike(WORD), words)
                       .alias("__w"), g.alias("__g"))
    n = F.size("__w")
    rows = rows.withColumn("__a", (F.col("__g") % n).cast("int"))
    rows = rows.withColumn("__p", (1 + F.floor((n - F.col("__a")) / (3 + F.col("__g") % 8))).cast("int"))
    motif = F.slice("__w", F.col("__a") + 1, F.col("__p"))
    times = F.ceil((n - F.col("__a")) / F.col("__p")).cast("int")
    again = F.slice(F.flatten(F.array_repeat(motif, times)), F.lit(1), n - F.col("__a"))
    text_of = F.array_join(F.concat(F.slice("__w", F.lit(1), F.col("__a")), again), " ")
    return rows.select(F.col(key), F.when(F.col("__w").isNotNull(), text_of).otherwise(F.col("text")).alias("text"))


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; ties go to the first."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    better = lambda a, b: b.length * a.period > a.length * b.period
    return F.reduce(runs, none, lambda a, b: F.when(a.isNull() | better(a, b), b).otherwise(a))


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = find_runs(planted(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    best = found.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("rest").cast("binary"), 256).alias("collapsed_sha256"))
