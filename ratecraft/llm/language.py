"""Language identification of web pages by Bayesian evidence fusion.

log posterior = TEMPER * log P(text | language) + log P(declared | language)
+ log P(language | host):

* text: hashed character trigrams of the visible text, multinomial with additive
  smoothing, fitted on a bounded sample of labelled documents
  (``SAMPLE_PER_LANGUAGE`` whole texts a language by smallest hash); tasks count
  the trigrams, only counts by hashed row reach the driver;
  ``TEMPER`` discounts overlapping trigrams;
* declared markup language (``lang`` of ``<html>``, else a content-language
  ``<meta>``): its confusion with the text's posterior, summed over all pages;
* host: soft counts summed over all pages by grouped aggregation and smoothed
  down the address: all pages -> suffix -> domain -> host, each level with
  ``ALPHA`` pseudo-pages of the level above; a page's own count is left out.

The aggregates are partial sums of one number a language, so a host with a third
of all pages is no hot key.

Edge cases: null or empty html has no text evidence, a null url the empty host;
a declared language outside the known ones is an evidence class of its own, a
missing one too; repeated rows are judged each; ties go to the first language in
code point order; without labelled documents the language is null; very long
pages are read whole; an empty table gives an empty table; extra columns of the
inputs are not read, whatever their names.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.llm.common import saved, table

GRAMS = 1 << 14
TEMPER, SMOOTH, ALPHA, BETA = 0.2, 0.5, 8.0, 1.0
SAMPLE_PER_LANGUAGE = 400
#: More languages are an error: the model takes 64 KB each in every task.
MAX_LANGUAGES = 4000
_HIDDEN = re.compile(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>", re.S | re.I)
_TAG = re.compile(r"<[^>]*>")
_SPACE = re.compile(r"\s+")


def visible(page: str | None) -> str:
    """Text of a page without scripts, styles, comments and tags."""
    return entities.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", page or "")))


def grams(text: str) -> np.ndarray:
    """Hashed trigrams of the lower-cased text with white space collapsed."""
    body = f" {_SPACE.sub(' ', text.lower()).strip()} "
    codes = np.frombuffer(body.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(codes) < 3 or len(body) == 2:
        return np.empty(0, np.int64)
    h = (codes[:-2] * np.uint64(0x100000001B3) + codes[1:-1]) * np.uint64(0x100000001B3) + codes[2:]
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(50)).astype(np.int64) & (GRAMS - 1)


def sample_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, o, h, text): ``SAMPLE_PER_LANGUAGE`` distinct labelled rows a language, by the smallest hashes of key and text.

    Hashes are ranked first (each task sends no more than that many a language), then the texts of the chosen ones are fetched.
    """
    rows = docs.where(F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.xxhash64(F.lit("sample"), F.col(key)).alias("o"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    first = Window.partitionBy("lang").orderBy("o", "h")
    ranked = rows.select("lang", "o", "h").distinct().withColumn("n", F.row_number().over(first))
    picked = ranked.where(F.col("n") <= SAMPLE_PER_LANGUAGE).drop("n")
    picked = F.broadcast(picked)  # SAMPLE_PER_LANGUAGE rows of a few numbers for each of MAX_LANGUAGES at most
    return rows.join(picked, ["lang", "o", "h"]).groupBy("lang", "o", "h").agg(F.first("text").alias("text"))


def fit_text(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> dict:
    """Languages and log probabilities (GRAMS x languages) from a bounded sample of labelled documents, all languages in one pass."""
    def count(batches):
        """Trigrams of whole texts by language; row -1 stands for the language."""
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen = np.bincount(grams(body.as_py() or ""), minlength=1)
                at = np.flatnonzero(seen)
                yield pa.RecordBatch.from_arrays([
                    pa.array([name] * (len(at) + 1)), pa.array(np.append(at, -1)), pa.array(np.append(seen[at], 1))], names=["lang", "gram", "n"])

    sample = sample_texts(docs, key, text, lang).select("lang", "text")
    counted = sample.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(counted["lang"].to_pylist()))
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"{len(names)} languages; a model of more than {MAX_LANGUAGES} is no longer small enough to send to every task")
    at = {name: i for i, name in enumerate(names)}
    counts = np.zeros((GRAMS, len(names)))
    for name, gram, n in zip(*(counted[c].to_pylist() for c in ("lang", "gram", "n"))):
        if gram >= 0:
            counts[gram, at[name]] = n
    logs = np.log((counts + SMOOTH) / (counts.sum(axis=0) + SMOOTH * GRAMS))
    return {"names": names, "logs": logs.astype(np.float32)}


def text_evidence(pages: DataFrame, model: dict, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, url, declared, n_grams, ll): tempered log likelihoods of the whole visible text."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # GRAMS x MAX_LANGUAGES floats at most
    kind = pages.schema[key].dataType.simpleString()
    declared = F.lower(F.coalesce(
        F.nullif(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]+)", 1), F.lit("")),
        F.nullif(F.regexp_extract(html, r"(?i)<meta\b[^>]*content-language[^>]*content\s*=\s*[\"']?([a-zA-Z]+)", 1), F.lit("")),
        F.lit("")))

    def run(batches):
        logs = shared.value["logs"]
        for batch in batches:
            n, ll = [], []
            for value in batch.column(3):
                rows = grams(visible(value.as_py()))
                total = np.zeros(logs.shape[1])
                for lo in range(0, len(rows), 1 << 16):
                    total += logs[rows[lo:lo + (1 << 16)]].sum(axis=0, dtype=np.float64)
                n.append(len(rows))
                ll.append((TEMPER * total).tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(n, pa.int64()),
                                              pa.array(ll, pa.list_(pa.float64()))],
                                             names=["key", "url", "declared", "n_grams", "ll"])

    rows = pages.select(F.col(key), F.col("url"), declared, F.col(html))
    return rows.mapInArrow(run, f"key {kind}, url string, declared string, n_grams bigint, ll array<double>")


def softmax(scores: list[Column]) -> list[Column]:
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    parts = [F.exp(s - top) for s in scores]
    total = sum(parts[1:], parts[0])
    return [p / total for p in parts]


def fuse(evidence: DataFrame, names: list[str]) -> DataFrame:
    """Posterior of each page from its text evidence and what all pages say of hosts and declarations."""
    k = range(len(names))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]+)", 1))
    rows = evidence.withColumn("host", host).withColumns({
        "domain": F.substring_index("host", ".", -2), "suffix": F.substring_index("host", ".", -1)})
    rows = rows.withColumns({f"p{i}": p for i, p in enumerate(softmax([F.col("ll")[i] for i in k]))})
    sums = lambda df, by: df.groupBy(*by).agg(*[F.sum(f"p{i}").alias(f"c{i}") for i in k])
    # two small tables: the address tree with its soft counts, and the declarations
    hosts = saved(sums(rows, ["host", "domain", "suffix"]), "language-hosts")
    up = lambda by: hosts.groupBy(*by).agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in k])

    def smoothed(level: DataFrame, above: list[str], out: str) -> DataFrame:
        n = sum((F.col(f"c{i}") for i in k), F.lit(0.0))
        return level.withColumns({f"{out}{i}": (F.col(f"c{i}") + ALPHA * F.col(above[i])) / (n + ALPHA) for i in k})

    everywhere = hosts.agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in k])
    total = sum((F.col(f"c{i}") for i in k), F.lit(0.0))
    base = everywhere.select(F.array(*[(F.col(f"c{i}") + 1) / (total + len(names)) for i in k]).alias("g"))
    suffixes = up(["suffix"]).withColumn("g", base.scalar())
    suffixes = suffixes.withColumns({f"g{i}": F.col("g")[i] for i in k})
    suffixes = smoothed(suffixes, [f"g{i}" for i in k], "s").select("suffix", *[f"s{i}" for i in k])
    domains = up(["domain", "suffix"]).join(suffixes, "suffix")
    domains = smoothed(domains, [f"s{i}" for i in k], "d").select("domain", "suffix", *[f"d{i}" for i in k])
    hosts = hosts.join(domains, ["domain", "suffix"]).drop("domain", "suffix")
    said = sums(rows, ["declared"])
    by_language = F.struct(*[F.sum(f"c{i}").alias(f"t{i}") for i in k], F.count(F.lit(1)).alias("n"))
    said = said.withColumn("t", said.agg(by_language.alias("t")).scalar())
    said = said.select("declared", *[F.log((F.col(f"c{i}") + BETA / F.col("t.n")) / (F.col(f"t.t{i}") + BETA)).alias(f"m{i}") for i in k])
    rows = rows.join(hosts, "host").join(said, "declared")
    own = sum((F.col(f"c{i}") for i in k), F.lit(0.0))
    prior = [F.log((F.greatest(F.col(f"c{i}") - F.col(f"p{i}"), F.lit(0.0)) + ALPHA * F.col(f"d{i}")) / (own - 1 + ALPHA)) for i in k]
    scores = [F.col("ll")[i] + F.col(f"m{i}") + prior[i] for i in k]
    rows = rows.withColumn("post", F.array(*softmax(scores)))
    name = F.array(*[F.lit(n) for n in names])
    best = lambda a: F.get(name, F.array_position(a, F.array_max(a)).cast("int") - 1)
    return rows.select("key", "host", "suffix", "declared", "n_grams", best(F.col("post")).alias("language"),
                       F.array_max("post").alias("confidence"),
                       best(F.array(*[F.col(f"p{i}") for i in k])).alias("text_language"))


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """(page_id, language, confidence, text_language, declared, host, suffix, n_grams) of every page."""
    model = fit_text(docs.select("doc_id", "text", "lang"))
    if not model["names"]:
        return pages.select("page_id", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("language", "string"), ("confidence", "double"), ("text_language", "string"), ("declared", "string"),
            ("host", "string"), ("suffix", "string"), ("n_grams", "bigint"))])
    evidence = saved(text_evidence(pages.select("page_id", "url", "html"), model), "language-evidence")
    return fuse(evidence, model["names"]).select(
        F.col("key").alias("page_id"), "language", "confidence", "text_language", "declared", "host", "suffix", "n_grams")


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))
