"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Inputs of a step are a word (hashed embedding) and its characters (largest of
the hashed embeddings of its 3- to 5-grams, word ends marked, by dimension).  Two gated
recurrent layers read a window of ``WINDOW`` words forwards and backwards, an
attention pool weighs their states, a logistic unit gives the window's logit.
Windows overlap by half and cover the whole text; a document's score is that of
its highest window, calibrated.  Everything is trained here in numpy.

Training fits on a bounded sample: at most ``SAMPLE_PER_CLASS`` documents a
class (the smallest hashes of their keys), of each the ``SAMPLE_WINDOWS`` best
windows of its whole text.  Which window of a toxic
document is the toxic one is not labelled: the first choice follows the log
odds of its words and n-grams, the second the network's own scores.  Log odds are
taken from counts by hashed row (a fixed number of rows) and windows are
chosen in tasks; only the chosen windows are collected, as word numbers.  Scoring
reads every window of every text.

Edge cases: null and empty texts (no word) get score 0; a null key is not held
out and has no label; repeated rows are scored each; without labels of both
classes all scores are 0; an empty table gives an empty table; other columns
pass through ``score_documents``.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import saved, table

WINDOW, STRIDE = 32, 16
SAMPLE_PER_CLASS = 1500
SAMPLE_WINDOWS = 64
#: Rows of the words' log odds.
ODDS_ROWS = 1 << 18
WORD_ROWS, WORD_DIM = 1 << 15, 8
GRAM_ROWS, GRAM_DIM = 1 << 16, 12
HIDDEN, ATTENTION = 12, 8
#: Passes over the chosen windows in the two turns, and gradient steps at least.
EPOCHS, STEPS, BATCH, RATE = (8, 4), (280, 140), 256, 0.01
#: Windows scored at once, and distinct words a task keeps at hand.
BLOCK, MEMO_WORDS = 1024, 150_000
THRESHOLD = 0.3
_TOKEN = re.compile(r"[^\W_]+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def gram_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the character n-grams of the words, one after another, and where each word's begin."""
    marked = [f"^{w}$" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(m) for m in marked])
    owner = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(len(codes))
    left = np.repeat(np.cumsum(sizes), sizes) - at  # characters up to the word's end
    rows, owners = [], []
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, 6):
        h = h * np.uint64(0x100000001B3)
        h[:max(0, len(codes) - n + 1)] += codes[n - 1:]
        if n >= 3:
            fits = left >= n
            x = (h[fits] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            rows.append((x >> np.uint64(48)).astype(np.int64) & (GRAM_ROWS - 1))
            owners.append(owner[fits])
    rows, owners = np.concatenate(rows), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return rows[order], np.searchsorted(owners[order], np.arange(len(words)))


def word_row(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORD_ROWS


def windows(n: int) -> list[int]:
    """Starts of the overlapping windows over n words (the last ends with the text)."""
    if n <= WINDOW:
        return [0] if n else []
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Network:
    """Parameters, forward pass and gradients."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        d = WORD_DIM + GRAM_DIM
        draw = lambda *shape, s=0.1: (rng.standard_normal(shape) * s).astype(np.float32)
        self.p = {"words": draw(WORD_ROWS, WORD_DIM, s=0.05), "grams": draw(GRAM_ROWS, GRAM_DIM, s=0.05)}
        for side in "fb":
            self.p |= {f"W{side}": draw(d, 3 * HIDDEN, s=0.4), f"U{side}": draw(HIDDEN, 3 * HIDDEN, s=0.25),
                       f"c{side}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"A": draw(2 * HIDDEN, ATTENTION, s=0.3), "a": np.zeros(ATTENTION, np.float32),
                   "v": draw(ATTENTION, s=0.3), "w": draw(2 * HIDDEN, s=0.3), "b": np.zeros(1, np.float32)}

    def inputs(self, words: list[str]) -> np.ndarray:
        """Input vector of each word."""
        rows, starts = gram_rows(words)
        chars = np.maximum.reduceat(self.p["grams"][rows], starts, axis=0)
        return np.concatenate([self.p["words"][[word_row(w) for w in words]], chars], axis=1).astype(np.float32)

    def layer(self, side: str, px, mask, keep):
        """States (T, B, h) of one direction; ``px(t)`` gives the projected inputs of the gates and the candidate."""
        U, k = self.p[f"U{side}"], HIDDEN
        gates, candidate = np.ascontiguousarray(U[:, :2 * k]), np.ascontiguousarray(U[:, 2 * k:])
        T, h = mask.shape[0], np.zeros((mask.shape[1], k), np.float32)
        out, saved = np.empty((T, mask.shape[1], k), np.float32), []
        full = bool(mask.all())
        for t in range(T) if side == "f" else range(T - 1, -1, -1):
            g, n = px(t)
            g += h @ gates
            np.negative(g, out=g)
            np.exp(np.minimum(g, 60, out=g), out=g)
            g += 1
            np.reciprocal(g, out=g)
            z, r = g[:, :k], g[:, k:]
            u = h @ candidate
            n += r * u
            np.tanh(n, out=n)
            new = n + z * (h - n)
            if not full:
                m = mask[t][:, None]
                new = m * new + (1 - m) * h
            if keep:
                saved.append((t, h, z, r, n, u))
            h = new
            out[t] = h
        return out, saved

    def pool(self, H, mask):
        """Logits and attention parts from states H (T, B, 2h)."""
        e = np.tanh(H @ self.p["A"] + self.p["a"])
        s = np.where(mask > 0, e @ self.p["v"], -1e9)
        s = np.exp(s - s.max(axis=0))
        alpha = s / s.sum(axis=0)
        c = (alpha[:, :, None] * H).sum(axis=0)
        return c @ self.p["w"] + self.p["b"][0], (e, alpha, c)

    def logits(self, ids: np.ndarray, mask: np.ndarray, table: dict[str, np.ndarray]) -> np.ndarray:
        """Logits of windows ids (B, T) over the projected inputs of the words."""
        m = mask.T.astype(np.float32)
        order = np.ascontiguousarray(ids.T)
        sides = [self.layer(s, lambda t, s=s: (table[s + "g"][order[t]], table[s + "n"][order[t]]), m, False)[0] for s in "fb"]
        return self.pool(np.concatenate(sides, axis=2), m)[0]

    def projected(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """Projected inputs of the words: of the gates ("fg", "bg") and the candidate ("fn", "bn")."""
        out = {}
        for s in "fb":
            y = (x @ self.p[f"W{s}"] + self.p[f"c{s}"]).astype(np.float32)
            out[s + "g"], out[s + "n"] = np.ascontiguousarray(y[:, :2 * HIDDEN]), np.ascontiguousarray(y[:, 2 * HIDDEN:])
        return out

    def gradients(self, ids, mask, words, rows, starts, y, weight):
        """Loss and gradients of a batch of windows over the words with n-gram rows."""
        p, k = self.p, HIDDEN
        counts = np.diff(np.append(starts, len(rows)))
        grams = p["grams"][rows]
        chars = np.maximum.reduceat(grams, starts, axis=0)
        x = np.concatenate([p["words"][words], chars], axis=1)
        table, m = self.projected(x), mask.T.astype(np.float32)
        outs, kept = {}, {}
        for s in "fb":
            outs[s], kept[s] = self.layer(s, lambda t, s=s: (table[s + "g"][ids[:, t]], table[s + "n"][ids[:, t]]), m, True)
        H = np.concatenate([outs["f"], outs["b"]], axis=2)
        logit, (e, alpha, c) = self.pool(H, m)
        prob = sigmoid(logit)
        loss = float((weight * (np.logaddexp(0, logit) - y * logit)).sum() / weight.sum())
        d = (weight * (prob - y) / weight.sum()).astype(np.float32)
        g = {"w": c.T @ d, "b": np.array([d.sum()], np.float32)}
        dc = d[:, None] * p["w"]
        dalpha = (H * dc).sum(axis=2)
        ds = alpha * (dalpha - (alpha * dalpha).sum(axis=0))
        de = ds[:, :, None] * p["v"] * (1 - e * e)
        g["v"] = np.tensordot(ds, e, axes=([0, 1], [0, 1]))
        g["A"], g["a"] = np.tensordot(H, de, axes=([0, 1], [0, 1])), de.sum(axis=(0, 1))
        dH = alpha[:, :, None] * dc + de @ p["A"].T
        dx = np.zeros_like(x)
        for i, s in enumerate("fb"):
            U, dh, dU = p[f"U{s}"], np.zeros((len(y), k), np.float32), np.zeros_like(p[f"U{s}"])
            dtable = np.zeros((len(x), 3 * k), np.float32)
            for t, h, z, r, n, un in reversed(kept[s]):
                dh = dh + dH[t][:, i * k:(i + 1) * k]
                mt = m[t][:, None]
                back, dh = (1 - mt) * dh, mt * dh
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (h - n) * z * (1 - z)
                dr = dn * un * r * (1 - r)
                du = np.concatenate([dz, dr, dn * r], axis=1)
                dU += h.T @ du
                np.add.at(dtable, ids[:, t], np.concatenate([dz, dr, dn], axis=1))
                dh = back + dh * z + du @ U.T
            g[f"U{s}"], g[f"c{s}"] = dU, dtable.sum(axis=0)
            g[f"W{s}"] = x.T @ dtable
            dx += dtable @ p[f"W{s}"].T
        g["words"], g["grams"] = np.zeros_like(p["words"]), np.zeros_like(p["grams"])
        np.add.at(g["words"], words, dx[:, :WORD_DIM])
        top = grams == np.repeat(chars, counts, axis=0)
        np.add.at(g["grams"], rows, np.where(top, np.repeat(dx[:, WORD_DIM:], counts, axis=0), 0))
        return loss, g


class Windows:
    """Windows of words of many documents, as numbers of words in one list.

    ``words[cuts[k]:cuts[k + 1]]`` are the word numbers of window ``k``; document ``d`` has the windows
    ``ends[d - 1]..ends[d]``, ``value[k]`` is what window ``k`` was chosen by.
    """

    def __init__(self, vocabulary: list[str], words: np.ndarray, sizes: np.ndarray, counts: np.ndarray, value: np.ndarray):
        self.vocabulary, self.words, self.value = vocabulary, words.astype(np.int32), value
        self.cuts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.ends = np.cumsum(counts).astype(np.int64)
        self.counts = np.asarray(counts, np.int64)

    @classmethod
    def of(cls, docs: list[list[list[str]]], value: list[list[float]] | None = None) -> Windows:
        numbers: dict[str, int] = {}
        words = [numbers.setdefault(w, len(numbers)) for found in docs for ws in found for w in ws]
        sizes = [len(ws) for found in docs for ws in found]
        flat = [v for found in value for v in found] if value else np.zeros(len(sizes))
        return cls(list(numbers), np.array(words, np.int32), np.array(sizes, np.int64), np.array([len(f) for f in docs], np.int64),
                   np.array(flat, np.float64))

    def filled(self, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers and mask of some windows, a row each."""
        at = self.cuts[picks][:, None] + np.arange(WINDOW)
        mask = at < self.cuts[np.asarray(picks) + 1][:, None]
        return np.where(mask, self.words[np.minimum(at, len(self.words) - 1)], 0).astype(np.int64), mask.astype(np.float32)

    def batch(self, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Ids, mask and the distinct words of some windows."""
        ids, mask = self.filled(picks)
        found, within = np.unique(ids[mask > 0], return_inverse=True)
        ids[mask > 0] = within
        return ids, mask, [self.vocabulary[i] for i in found]


def _fit(net: Network, windows_: Windows, chosen: np.ndarray, y, weight, steps: int, rng, moments: dict) -> None:
    while steps > 0:
        order = rng.permutation(len(chosen))
        for lo in range(0, min(len(order), steps * BATCH), BATCH):
            steps -= 1
            pick = order[lo:lo + BATCH]
            ids, mask, words = windows_.batch(chosen[pick])
            rows, starts = gram_rows(words)
            _, g = net.gradients(ids, mask, np.array([word_row(w) for w in words]), rows, starts, y[pick], weight[pick])
            moments["t"] = moments.get("t", 0) + 1
            t = moments["t"]
            for name, grad in g.items():
                m1, m2 = moments.setdefault(name, (np.zeros_like(grad), np.zeros_like(grad)))
                m1 += 0.1 * (grad - m1)
                m2 += 0.01 * (grad * grad - m2)
                net.p[name] -= (RATE / (1 - 0.9 ** t)) * m1 / (np.sqrt(m2 / (1 - 0.99 ** t)) + 1e-6)


def odds_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-odds rows of distinct words (n-grams follow the words' ``ODDS_ROWS``) and where each word's n-grams begin."""
    grams, starts = gram_rows(words)
    return np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) % ODDS_ROWS for w in words], np.int64), grams + ODDS_ROWS, starts


def seen_rows(words: list[str]) -> np.ndarray:
    """Distinct log-odds rows of a document."""
    if not words:
        return np.zeros(0, np.int64)
    own, grams, _ = odds_rows(list(dict.fromkeys(words)))
    return np.unique(np.concatenate([own, grams]))


def log_odds(seen: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of each row, from the documents that hold it by class (2, rows) and the documents by class."""
    return np.diff(np.log((seen + 2) / (n[:, None] + 4)), axis=0)[0]


def best_windows(words: list[str], odds: np.ndarray) -> tuple[list[int], list[float]]:
    """Starts and values of the ``SAMPLE_WINDOWS`` windows with the highest log odds, in the text's order."""
    if not words:
        return [], []
    at = {w: i for i, w in enumerate(dict.fromkeys(words))}
    own, grams, starts = odds_rows(list(at))
    best = np.maximum(odds[own], np.maximum.reduceat(odds[grams], starts))[[at[w] for w in words]]
    begins = np.array(windows(len(words)))
    value = np.array([best[a:a + WINDOW].max() for a in begins])
    kept = np.sort(np.argsort(-value, kind="stable")[:SAMPLE_WINDOWS])
    return begins[kept].tolist(), value[kept].tolist()


def train(texts: list[str], labels: list[int], seed: int = 1) -> dict | None:
    """The fitted model (parameters and calibration) of whole texts, None without both classes."""
    docs, y = [tokens(t) for t in texts], np.array(labels)
    seen = np.zeros((2, ODDS_ROWS + GRAM_ROWS))
    for words, label in zip(docs, y):
        seen[label, seen_rows(words)] += 1
    odds = log_odds(seen, np.array([(y == 0).sum(), (y == 1).sum()]))
    chosen = [best_windows(words, odds) for words in docs]
    return train_windows(Windows.of([[d[a:a + WINDOW] for a in starts] for d, (starts, _) in zip(docs, chosen)], [v for _, v in chosen]),
                         labels, seed)


def train_windows(found: Windows, labels: list[int], seed: int = 1) -> dict | None:
    """The model fitted to the chosen windows of each document with their first values, None without both classes."""
    y = np.array(labels)
    if not (y == 1).any() or not (y == 0).any() or not len(found.words):
        return None
    rng = np.random.default_rng(seed)
    net, moments, value = Network(seed), {}, found.value
    for turn in range(2):
        chosen, target = [], []
        for end, n, label in zip(found.ends, found.counts, y):
            if not n:
                continue
            picked = {int(np.argmax(value[end - n:end]))}
            if label == 0:
                picked |= set(rng.integers(0, n, 2).tolist())
            chosen += [end - n + i for i in sorted(picked)]
            target += [label] * len(picked)
        target = np.array(target, np.float32)
        even = max(1.0, (target == 0).sum() / max(1, (target > 0).sum()) / 2)
        steps = max(STEPS[turn], EPOCHS[turn] * -(-len(chosen) // BATCH))
        _fit(net, found, np.array(chosen), target, np.where(target > 0, even, 1.0).astype(np.float32), steps, rng, moments)
        value = _score_windows(net, found)
    top = np.array([value[end - n:end].max() if n else -20.0 for end, n in zip(found.ends, found.counts)])
    a, b = 1.0, 0.0
    for _ in range(200):  # calibration: logistic regression on the document's highest logit
        p = sigmoid(a * top + b)
        e, s = p - y, p * (1 - p) + 1e-6
        h = np.array([[(s * top * top).sum() + 1e-3, (s * top).sum()], [(s * top).sum(), s.sum()]])
        step = np.linalg.solve(h, [(e * top).sum() + 1e-3 * (a - 1), e.sum()])
        a, b = a - 0.5 * float(step[0]), b - 0.5 * float(step[1])
    return {"p": {k: v.astype(np.float32) for k, v in net.p.items()}, "a": max(a, 0.1), "b": b}


def _score_windows(net: Network, found: Windows) -> np.ndarray:
    """The network's logit of every window."""
    words = found.vocabulary
    table = net.projected(np.concatenate([net.inputs(words[i:i + 20_000]) for i in range(0, len(words), 20_000)]))
    out = np.empty(len(found.cuts) - 1)
    for lo in range(0, len(out), BLOCK):
        ids, mask = found.filled(np.arange(lo, min(lo + BLOCK, len(out))))
        out[lo:lo + BLOCK] = net.logits(ids, mask, table)
    return out


class Scorer:
    """Scores texts in a task; projected inputs of words seen are kept at hand."""

    def __init__(self, model: dict):
        self.net, self.a, self.b = Network(), model["a"], model["b"]
        self.net.p = model["p"]
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.table = {s + part: np.empty((0, n * HIDDEN), np.float32) for s in "fb" for part, n in (("g", 2), ("n", 1))}
        self.size = 0

    def learn(self, words: list[str]) -> None:
        """Rows for words not seen before."""
        new = self.net.projected(self.net.inputs(words))
        need = self.size + len(words)
        for s in self.table:
            if need > len(self.table[s]):
                grown = np.empty((max(need, 2 * len(self.table[s])), self.table[s].shape[1]), np.float32)
                grown[:self.size] = self.table[s][:self.size]
                self.table[s] = grown
            self.table[s][self.size:need] = new[s]
        for w in words:
            self.known[w] = len(self.known)
        self.size = need

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Score of each text: its highest window, calibrated (0 without words)."""
        top = np.full(len(texts), -np.inf)
        if len(self.known) > MEMO_WORDS:
            self.clear()
        whole, short, owner, short_owner = [], [], [], []
        split = [tokens(text) for text in texts]
        fresh = [w for w in dict.fromkeys(chain.from_iterable(split)) if w not in self.known]
        for lo in range(0, len(fresh), 4096):
            self.learn(fresh[lo:lo + 4096])
        for i, words in enumerate(split):
            ids = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            if len(ids) >= WINDOW:
                starts = np.array(windows(len(ids)))
                whole.append(ids[starts[:, None] + np.arange(WINDOW)])
                owner.append(np.full(len(starts), i))
            elif len(ids):
                short.append(ids)
                short_owner.append(i)
        if whole:
            ids, owner = np.concatenate(whole), np.concatenate(owner)
            mask = np.ones((BLOCK, WINDOW), np.float32)
            for lo in range(0, len(ids), BLOCK):
                part = ids[lo:lo + BLOCK]
                np.maximum.at(top, owner[lo:lo + BLOCK], self.net.logits(part, mask[:len(part)], self.table))
        if short:
            ids, mask = np.zeros((len(short), WINDOW), np.int64), np.zeros((len(short), WINDOW), np.float32)
            for k, x in enumerate(short):
                ids[k, :len(x)], mask[k, :len(x)] = x, 1
            np.maximum.at(top, short_owner, self.net.logits(ids, mask, self.table))
        return np.where(np.isfinite(top), sigmoid(self.a * top + self.b), 0.0)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> dict | None:
    """Trains on the labelled rows that are not held out (a bounded sample of them)."""
    known = labels.where(F.col("toxic").isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
    known = known.groupBy(F.col(key).alias("__id")).agg(F.max("toxic").alias("__toxic"))
    order = F.xxhash64(F.lit("sample"), F.col("__id"))
    picked = [known.where(F.col("__toxic") == c).orderBy(order, "__id").limit(SAMPLE_PER_CLASS * (2 - c)) for c in (0, 1)]
    sample = picked[0].unionByName(picked[1])  # 3 * SAMPLE_PER_CLASS rows at most
    rows = docs.select(F.col(key).alias("__id"), F.col(text).alias("text")).join(F.broadcast(sample), "__id")
    rows = saved(rows.dropDuplicates(["__id"]).where("text is not null").select(
        F.col("__id").cast("string").alias("id"), F.col("__toxic").cast("int").alias("toxic"), "text"), "toxicity-sample")

    def count(batches):
        for batch in batches:
            for toxic, body in zip(batch.column(1).to_pylist(), batch.column(2)):
                held = np.append(seen_rows(tokens(body.as_py())), ODDS_ROWS + GRAM_ROWS)  # the last row counts documents
                yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(np.full(len(held), toxic, np.int32))], names=["row", "toxic"])

    counted = rows.mapInArrow(count, "row bigint, toxic int").groupBy("row", "toxic").count().toArrow()
    seen = np.zeros((2, ODDS_ROWS + GRAM_ROWS + 1))
    seen[counted["toxic"].to_numpy(), counted["row"].to_numpy()] = counted["count"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(log_odds(seen[:, :-1], seen[:, -1]))  # about 2.6 MB, fixed

    def choose(batches):
        """Of each text its distinct words in the chosen windows, and the windows as numbers of these."""
        for batch in batches:
            for i, body in enumerate(batch.column(2)):
                words = tokens(body.as_py())
                starts, value = best_windows(words, shared.value)
                numbers: dict[str, int] = {}
                ids = [numbers.setdefault(w, len(numbers)) for a in starts for w in words[a:a + WINDOW]]
                sizes = [len(words[a:a + WINDOW]) for a in starts]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([value], pa.list_(pa.float64())),
                    pa.array([list(numbers)], pa.list_(pa.string())), pa.array([ids], pa.list_(pa.int32())),
                    pa.array([sizes], pa.list_(pa.int32()))], names=["id", "toxic", "value", "words", "ids", "sizes"])

    found = rows.mapInArrow(choose, "id string, toxic int, value array<double>, words array<string>, ids array<int>, sizes array<int>").toArrow()
    ids = found.column("id").to_pylist()
    found = found.take(pa.array(sorted(range(len(ids)), key=lambda i: (zlib.crc32(ids[i].encode()), ids[i])), pa.int64())).combine_chunks()
    labels = found.column("toxic").to_pylist()
    windows_ = gathered(found)
    del found, ids
    return train_windows(windows_, labels)


def gathered(found: pa.Table) -> Windows:
    """The windows of collected rows (value, words, ids, sizes): every distinct word once, all else as numbers."""
    lists = {c: pa.concat_arrays(found.column(c).chunks) if found.num_rows else pa.array([], found.schema.field(c).type)
             for c in ("value", "words", "ids", "sizes")}
    flat = {c: x.flatten() for c, x in lists.items()}
    lengths = {c: x.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) for c, x in lists.items()}
    coded = flat["words"].dictionary_encode()
    of_words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    begins = np.cumsum(lengths["words"]) - lengths["words"]  # of each document's words
    words = of_words[np.repeat(begins, lengths["ids"]) + flat["ids"].to_numpy(zero_copy_only=False)]
    return Windows(coded.dictionary.to_pylist(), words, flat["sizes"].to_numpy(zero_copy_only=False), lengths["sizes"],
                   flat["value"].to_numpy(zero_copy_only=False).astype(np.float64))


def score_documents(docs: DataFrame, model: dict | None, text: str = "text", out: str = "__score") -> DataFrame:
    """``docs`` with the score of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # about 4 MB, fixed
    rest = [c for c in docs.columns if c != out]
    schema = docs.select(rest).withColumn(out, F.lit(0.0)).schema

    def run(batches):
        scorer = Scorer(shared.value) if shared.value else None
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                scores = scorer.scores(texts) if scorer else np.zeros(len(texts))
                kept = [part.column(part.schema.get_field_index(c)) for c in rest]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64())], names=[*rest, out])

    return docs.select(rest).mapInArrow(run, schema)


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score_documents(docs, model).drop("text")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"),
                         (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"))
