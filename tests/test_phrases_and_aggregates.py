"""Phrase merging against one replacement after the other; user aggregates against SQL; sparse cosine against all pairs."""
import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from ratecraft.functions import phrases
from ratecraft.functions.text import merge_bigrams
from ratecraft.operators.mergeable import Aggregate, aggregate, ndcg
from ratecraft.operators.ranking import ndcg_at_k
from ratecraft.plans import content_knn


def test_one_pass_equals_one_replacement_after_the_other():
    rng = random.Random(3)
    for _ in range(3000):
        pairs = list(dict.fromkeys((rng.choice("abc") * rng.choice([1, 1, 2]), rng.choice("abc")) for _ in range(rng.randrange(1, 5))))
        text = " ".join(rng.choice(["a", "b", "c", "aa", "bb", "ca"]) for _ in range(rng.randrange(0, 12)))
        words = exact = text
        for a, b in pairs:
            words = re.sub(rf"\b{a} {b}\b", f"{a}_{b}", words)
            exact = exact.replace(f"{a} {b}", f"{a}_{b}")
        assert phrases.merge_words(phrases.PhraseAutomaton(pairs), text) == words
        assert phrases.merge_substrings(phrases.PhraseAutomaton([tuple(" ".join(p)) for p in pairs]), text) == exact


def test_phrases_of_a_column_match_the_column_form(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("ale hop malt stale pale oak".split()) for _ in range(rng.randrange(0, 30)))) for i in range(200)]
    df = spark.createDataFrame(rows + [(900, None), (901, "")], "RowID long, text string")
    pairs = [("pale", "ale"), ("ale", "ale"), ("hop", "malt"), ("malt", "hop"), ("oak", "oak")]
    for exact in (False, True):
        want = df.withColumn("text", merge_bigrams(F.col("text"), pairs, exact)).collect()
        assert sorted(phrases.merge_phrases(df, "text", pairs, exact).collect()) == sorted(want)
    longer = phrases.merge_phrases(df, "text", [("pale", "ale", "hop")]).where("text like '%pale_ale_hop%'").count()
    assert longer == sum(bool(re.search(r"\bpale ale hop\b", t)) for _, t in rows) > 0


def test_ten_thousand_phrases_in_one_pass(spark):
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(300)}"
    pairs = list({(word(), word()) for _ in range(12_000)})[:10_000]
    rows = [(i, " ".join(word() for _ in range(200))) for i in range(50)]
    start = time.time()
    got = phrases.merge_phrases(spark.createDataFrame(rows, "RowID long, text string"), "text", pairs).collect()
    assert time.time() - start < 60
    rank = {p: n for n, p in enumerate(pairs)}
    for (i, text), row in zip(rows, sorted(got)):
        tokens, used = text.split(" "), set()
        hits = sorted((rank[tuple(tokens[k:k + 2])], k) for k in range(len(tokens) - 1) if tuple(tokens[k:k + 2]) in rank)
        joined = set()
        for _, k in hits:
            if not {k, k + 1} & used:
                used |= {k, k + 1}
                joined.add(k + 1)
        assert row["text"] == "".join(("" if k == 0 else "_" if k in joined else " ") + t for k, t in enumerate(tokens))


def test_user_aggregates_equal_the_sql_form(spark):
    rng = random.Random(4)
    rows = [("hot" if rng.random() < .4 else rng.choice(["a", "b", None]), float(rng.randrange(5)), k) for k in range(3000)]
    df = spark.createDataFrame(rows, "q string, label double, position long").repartition(7)
    got = {r["q"]: r["value"] for r in aggregate(df, "q", ["label", "position"], ndcg(10)).collect()}
    want = {r["q"]: r["ndcg"] for r in ndcg_at_k(df.where("q is not null"), "q", "label", "position", 10).collect()}
    assert got.keys() == want.keys() | {None}
    assert all(got[q] == pytest.approx(want[q], abs=1e-12) for q in want)
    # a metric of the user's own: the geometric mean of 1 + label
    geo = Aggregate(lambda: (0.0, 0), lambda s, row: (s[0] + math.log1p(row[0]), s[1] + 1),
                    lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda s: math.exp(s[0] / s[1]))
    got = {r["q"]: r["geo"] for r in aggregate(df, "q", ["label"], geo, "geo").collect()}
    want = {r["q"]: r["geo"] for r in df.groupBy("q").agg(F.exp(F.avg(F.log1p("label"))).alias("geo")).collect()}
    assert got.keys() == want.keys() and all(got[q] == pytest.approx(want[q], rel=1e-12) for q in want)
    assert aggregate(df.limit(0), "q", ["label"], geo).count() == 0


def plain_cosines(vectors):
    out = {}
    for a in vectors:
        for b in vectors:
            if a < b:
                dot = sum(c * vectors[b].get(t, 0.0) for t, c in vectors[a].items())
                norms = math.sqrt(sum(c * c for c in vectors[a].values()) * sum(c * c for c in vectors[b].values()))
                if dot:
                    out[a, b] = dot / norms
    return out


def test_sparse_cosine_with_a_hundred_thousand_categories(spark):
    rng = random.Random(6)
    vectors = {i: {f"c{rng.randrange(100_000)}": float(rng.randrange(1, 4)) for _ in range(40)} | {f"top{rng.randrange(3)}": 2.0}
               for i in range(60)}
    for i in range(60, 75):  # near copies
        vectors[i] = dict(list(vectors[i - 60].items())[:30 + i % 10])
    df = spark.createDataFrame([(i, t, c) for i, v in vectors.items() for t, c in v.items()], "i long, t string, c double")
    want = plain_cosines(vectors)
    pairs = spark.createDataFrame([(a, b) for a in vectors for b in vectors if a < b], "x long, y long")
    got = {(r["x"], r["y"]): r["sim"] for r in content_knn.cosine_of_pairs(df, pairs).collect()}
    assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p], abs=1e-11) for p in want)
    for least in (0.9, 0.5, 0.05):
        got = {(r["x"], r["y"]) for r in content_knn.cosine_join(df, least).collect()}
        assert got == {p for p, s in want.items() if s >= least} and (least > .5 or got)
    with pytest.raises(ValueError):
        content_knn.cosine_join(df, 0.0)
