"""Quality rules: a linear-chain conditional random field over a document's lines.

Each line is described by a few language-independent features; Viterbi decoding
marks every line content or boilerplate, and the share of words in content
lines decides whether the document is kept.  The field's weights are trained
here by gradient ascent on the exact log likelihood (forward-backward), on a
bounded sample: ``SAMPLE_PER_CLASS`` documents a quality class (smallest hashes
of their keys), of each ``SAMPLE_RUNS`` runs of ``SAMPLE_LINES`` lines at places that a
hash of its key draws from the whole text (all lines of a shorter one).  Training labels of lines: boilerplate in documents of
quality 0, else content.

Base rules are exact counts over the whole text: see ``base_counts``.

Edge cases: null and empty texts have no words (all counts 0, base rule failed,
content share 0); without labels every line is content; repeated rows are judged
each, and of several texts of a labelled key the one with the smallest hash trains;
very long texts are read whole; an empty table gives an empty table; other columns pass
through ``judge_documents``.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import table

SAMPLE_PER_CLASS, SAMPLE_RUNS, SAMPLE_LINES = 1500, 2, 20
STEPS = 200
#: Smallest share of words in content lines of a kept document.
MIN_CONTENT = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8
_SPACES, _SYMBOLS = "\x20\x09\x0a\x0b\x0c\x0d", "#*$%&|<>"


def repeat_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more."""
    n = len(words)
    if n <= window:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    if len(ids) == n:
        return 0
    width = 1
    while width < window:  # exact numbers of windows of doubled width
        codes = codes[:-width] * np.int64(n + 1) + codes[width:]
        codes = np.unique(codes, return_inverse=True)[1]
        width *= 2
    counts = np.bincount(codes)
    twice = counts[codes] > 1
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.add.at(edge, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(edge)[:n] > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    words = text.encode().split()  # bytes: ASCII white space only
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in _SPACES)
    symbols = sum(text.count(c) for c in _SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    repeats = repeat_words(words)
    return n, chars, symbols, len(lines) - len(set(lines)), repeats, n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n


FEATURES = 15


def line_features(lines: list[str]) -> np.ndarray:
    """(lines x FEATURES); lines without a word get the features of an empty line."""
    out = np.zeros((len(lines), FEATURES), np.float64)
    seen: set[str] = set()
    for i, line in enumerate(lines):
        words, chars = line.split(), max(1, len(line))
        n = len(words)
        m = max(1, n)
        letters = line.replace(" ", "")
        upper = sum(map(str.isupper, words))
        mark = line.rstrip()[-1:]
        out[i] = (
            1.0, n == 0, n < 4, 4 <= n < 10, np.log1p(n) / 4, len(letters) / m / 10,
            sum(line.count(c) for c in _SYMBOLS) / m, sum(map(str.isdigit, words)) / m, upper / m,
            line.count("!") / m, len(set(words)) / m, sum(len(w) <= 3 for w in words) / m,
            mark in ".!?:;", line[:1].isupper(), line in seen)
        seen.add(line)
    return out


def _log_sum(a, axis):
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def train(sequences: list[np.ndarray], labels: list[np.ndarray]) -> dict:
    """Weights (2 x FEATURES), transitions (2 x 2) by ascent on the mean log likelihood; label 1: boilerplate."""
    model = {"w": np.zeros((2, FEATURES)), "t": np.zeros((2, 2))}
    if not sequences:
        return model
    T, B = max(map(len, sequences)), len(sequences)
    X, Y, M = np.zeros((T, B, FEATURES)), np.zeros((T, B), np.int64), np.zeros((T, B))
    for b, (x, y) in enumerate(zip(sequences, labels)):
        X[:len(x), b], Y[:len(y), b], M[:len(x), b] = x, y, 1
    hot = np.eye(2)[Y] * M[:, :, None]
    pairs = np.einsum("tbi,tbj->ij", hot[:-1], hot[1:])
    total = M.sum()
    m1 = {k: np.zeros_like(v) for k, v in model.items()}
    m2 = {k: np.zeros_like(v) for k, v in model.items()}
    for step in range(1, STEPS + 1):
        E, tr = X @ model["w"].T, model["t"]
        fwd, bwd = np.empty((T, B, 2)), np.zeros((T, B, 2))
        fwd[0] = E[0]
        for t in range(1, T):
            new = E[t] + _log_sum(fwd[t - 1][:, :, None] + tr, 1)
            fwd[t] = np.where(M[t][:, None] > 0, new, fwd[t - 1])
        for t in range(T - 2, -1, -1):
            new = _log_sum(tr + (E[t + 1] + bwd[t + 1])[:, None, :], 2)
            bwd[t] = np.where(M[t + 1][:, None] > 0, new, 0.0)
        z = _log_sum(fwd[-1], 1)
        post = np.exp(fwd + bwd - z[:, None]) * M[:, :, None]
        joint = np.exp(fwd[:-1][:, :, :, None] + tr + (E[1:] + bwd[1:])[:, :, None, :] - z[:, None, None])
        grad = {"w": np.einsum("tbk,tbf->kf", hot - post, X) / total - 1e-4 * model["w"],
                "t": (pairs - np.einsum("tbij,tb->ij", joint, M[1:])) / total - 1e-4 * tr}
        for k, g in grad.items():
            m1[k] += 0.1 * (g - m1[k])
            m2[k] += 0.01 * (g * g - m2[k])
            model[k] = model[k] + 0.1 * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-8)
    return model


def viterbi(model: dict, features: np.ndarray) -> np.ndarray:
    """Most likely labels of the lines (0 content, 1 boilerplate; ties go to content)."""
    emit = (features @ model["w"].T).tolist()
    (t00, t01), (t10, t11) = model["t"].tolist()
    a, b, back = 0.0, 0.0, []
    for i, (e0, e1) in enumerate(emit):
        if i == 0:
            a, b = e0, e1
            continue
        from0, from1 = a + t00 < b + t10, a + t01 < b + t11
        back.append((from0, from1))
        a, b = (b + t10 if from0 else a + t00) + e0, (b + t11 if from1 else a + t01) + e1
    out = np.zeros(len(emit), np.int8)
    if emit:
        out[-1] = b > a
        for i in range(len(back) - 1, -1, -1):
            out[i] = back[i][out[i + 1]]
    return out


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> dict:
    """Trains the field on a bounded sample of the labelled documents."""
    known = labels.where(F.col("quality").isNotNull() & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("__id")).agg(F.min("quality").alias("__quality"))
    order = F.xxhash64(F.lit("sample"), F.col("__id"))
    picked = [known.where(F.col("__quality") == c).orderBy(order, "__id").limit(SAMPLE_PER_CLASS) for c in (0, 1)]
    sample = picked[0].unionByName(picked[1])  # 2 * SAMPLE_PER_CLASS rows at most
    rows = docs.select(F.col(key).alias("__id"), F.col(text).alias("text")).where("text is not null").join(F.broadcast(sample), "__id")
    rows = rows.groupBy("__id", "__quality").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = rows.select(F.col("__id").cast("string").alias("id"), F.col("__quality").cast("int").alias("quality"), "text")

    def draw(batches):
        """Features of the drawn runs of lines, a row each."""
        for batch in batches:
            for name, quality, body in zip(*(batch.column(c).to_pylist() for c in range(3))):
                features = line_features(body.split("\n"))
                for n, (a, b) in enumerate(drawn_runs(name, len(features))):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name]), pa.array([n], pa.int32()), pa.array([quality], pa.int32()),
                        pa.array([features[a:b].ravel().tolist()], pa.list_(pa.float64()))], names=["id", "run", "quality", "features"])

    found = rows.mapInArrow(draw, "id string, run int, quality int, features array<double>").toArrow().to_pylist()
    width = line_features(["x"]).shape[1]
    sequences, targets = [], []
    for row in sorted(found, key=lambda r: (r["id"], r["run"])):
        x = np.array(row["features"], np.float64).reshape(-1, width)
        sequences.append(x)
        targets.append(np.full(len(x), 1 - row["quality"], np.int64))
    return train(sequences, targets)


def drawn_runs(name: str, lines: int) -> list[tuple[int, int]]:
    """The runs of lines of a document that train the field: all, or ``SAMPLE_RUNS`` at hashed places, one in each equal part."""
    if lines <= SAMPLE_RUNS * SAMPLE_LINES:
        return [(0, lines)]
    out = []
    for r in range(SAMPLE_RUNS):
        lo, hi = lines * r // SAMPLE_RUNS, lines * (r + 1) // SAMPLE_RUNS - SAMPLE_LINES
        start = lo + zlib.crc32(f"{r}:{name}".encode()) % (hi - lo + 1)
        out.append((start, start + SAMPLE_LINES))
    return out


def judge_documents(docs: DataFrame, model: dict, text: str = "text", min_content: float = MIN_CONTENT) -> DataFrame:
    """``docs`` with ``__base`` (counts), ``__boilerplate`` (label of every line), ``__content`` and ``__keep``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    base = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,base_failed:boolean>"
    added = {"__base": F.lit(None).cast(base), "__boilerplate": F.array().cast("array<tinyint>"),
             "__content": F.lit(0.0), "__keep": F.lit(True)}
    rest = [c for c in docs.columns if c not in added]
    schema = docs.select(rest).withColumns(added).schema
    columns = [*rest, *added]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]

    def run(batches):
        for batch in batches:
            counts, marks, shares = [], [], []
            for value in batch.column(batch.schema.get_field_index(text)):
                body = value.as_py() or ""
                row = base_counts(body)
                lines = body.split("\n")
                mark = viterbi(shared.value, line_features(lines))
                words = np.array([len(x.split()) for x in lines])
                counts.append(dict(zip(names, row)))
                marks.append(mark.tolist())
                shares.append(float(words[mark == 0].sum() / words.sum()) if words.sum() else 0.0)
            keep = [not c["base_failed"] and s >= min_content for c, s in zip(counts, shares)]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in rest]
            kinds = pa.struct([*[(n, pa.int64()) for n in names[:-1]], (names[-1], pa.bool_())])
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(counts, kinds), pa.array(marks, pa.list_(pa.int8())), pa.array(shares, pa.float64()),
                 pa.array(keep)], names=columns)

    return docs.select(rest).mapInArrow(run, schema)


def op6_line_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = judge_documents(docs, fit(docs, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", "__base.n_words", "__base.word_chars", "__base.n_symbols", "__base.n_dup_lines",
                         "__base.n_repeat_words", "__base.base_failed", F.col("__keep").alias("kept"),
                         F.col("__content").alias("content_share"))
