"""op1, op4, op6: gradients, decoding and fusion against brute force; held-out accuracy; odd rows."""
import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecraft.llm import language, quality, toxicity

RNG = random.Random(21)
CLEAN = ["".join(RNG.choice("aeioulmnrst") for _ in range(RNG.randint(2, 8))) for _ in range(400)]


# ------------------------------------------------------------------ op1
def plain_logit(net, words):
    """The logit of one window, step by step."""
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = []
    for w in words:
        rows, _ = toxicity.gram_rows([w])
        x.append(np.concatenate([p["words"][toxicity.word_row(w)], p["grams"][rows].max(axis=0)]))
    states = []
    for side, order in (("f", range(len(x))), ("b", range(len(x) - 1, -1, -1))):
        h, seen = np.zeros(toxicity.HIDDEN), {}
        for t in order:
            wz, wr, wn = np.split(x[t] @ p[f"W{side}"] + p[f"c{side}"], 3)
            uz, ur, un = np.split(h @ p[f"U{side}"], 3)
            z, r = 1 / (1 + np.exp(-wz - uz)), 1 / (1 + np.exp(-wr - ur))
            h = z * h + (1 - z) * np.tanh(wn + r * un)
            seen[t] = h
        states.append([seen[t] for t in range(len(x))])
    both = [np.concatenate(pair) for pair in zip(*states)]
    pull = np.array([np.tanh(h @ p["A"] + p["a"]) @ p["v"] for h in both])
    share = np.exp(pull - pull.max())
    return float(sum(s * h for s, h in zip(share / share.sum(), both)) @ p["w"] + p["b"][0])


def test_logits_match_a_plain_forward_pass():
    net = toxicity.Network(5)
    docs = [[["one", "two", "three", "two"], ["four"]], [], [["five"] * 5 + ["é"] * 27]]
    found = toxicity.Windows.of(docs)
    got = toxicity._score_windows(net, found)
    assert found.counts.tolist() == [2, 0, 1]
    assert got == pytest.approx([plain_logit(net, w) for d in docs for w in d], abs=1e-4)


def labelled(rng, n, share=.3):
    out = []
    for i in range(n):
        toxic = int(rng.random() < share)
        words = [rng.choice(CLEAN) for _ in range(rng.randint(3, 150))]
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), "zgub" + rng.choice(CLEAN))
        out.append((" ".join(words), toxic))
    return out


def test_learns_marked_words_and_scores_whole_texts(spark, docs_of):
    rng = random.Random(5)
    sample = labelled(rng, 500)
    model = toxicity.train([t for t, _ in sample], [y for _, y in sample])
    scorer = toxicity.Scorer(model)
    held = labelled(rng, 300)
    scores = scorer.scores([t for t, _ in held])
    y = np.array([y for _, y in held])
    assert ((scores >= toxicity.THRESHOLD) == (y == 1)).mean() > .95
    far = " ".join(["rain"] * 70_000 + ["zgubrain"] * 3)  # only the last of many windows is toxic
    one = " ".join(["rain"] * 29 + ["zgubrain"] * 3)
    assert scorer.scores([far])[0] == pytest.approx(scorer.scores([one])[0], abs=.05)
    assert toxicity.Scorer(model).scores(["a"])[0] >= 0  # one short word in the whole batch
    rows = [(1, None), (2, ""), (3, " !? "), (None, one), (4, one), (4, one)]
    df = docs_of(rows).withColumn("__known", F.lit(1))
    out = toxicity.score_documents(df, model).collect()
    assert [r["__score"] for r in out[:3]] == [0.0] * 3 and all(0 <= r["__score"] <= 1 for r in out)
    assert out[4]["__score"] == out[5]["__score"] and set(df.columns) < set(out[0].asDict())
    assert toxicity.score_documents(docs_of([]), model).count() == 0
    assert [r["__score"] for r in toxicity.score_documents(docs_of([(1, "a")]), None).collect()] == [0.0]
    assert toxicity.train(["a b"], [0]) is None and toxicity.train([], []) is None


def test_windows_overlap_and_cover():
    for n in (0, 1, 31, 32, 33, 57, 1000):
        starts = toxicity.windows(n)
        covered = sorted({k for a in starts for k in range(a, min(a + toxicity.WINDOW, n))})
        assert covered == list(range(n)) and all(b - a < toxicity.WINDOW for a, b in zip(starts, starts[1:]))


def test_gradients_match_small_differences():
    """Steps of 1e-3: a step of 2e-2 can move an n-gram past another, where the largest has a kink."""
    net, rng = toxicity.Network(3), np.random.default_rng(0)
    windows = toxicity.Windows.of([[["one", "two", "three"], ["four", "two"]], [["five"] * 5]])
    ids, mask, found = windows.batch(np.arange(3))
    rows, starts = toxicity.gram_rows(found)
    net.p = {k: (v.astype(np.float64) + rng.normal(0, .05, v.shape)) for k, v in net.p.items()}
    at = np.array([toxicity.word_row(w) for w in found])
    loss = lambda: net.gradients(ids, mask, at, rows, starts, np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 1.0]))
    for name, grad in loss()[1].items():
        for k in np.argsort(-np.abs(grad).ravel())[:3]:
            place = np.unravel_index(k, grad.shape)
            old, sides = net.p[name][place], []
            for step in (1e-3, -1e-3):
                net.p[name][place] = old + step
                sides.append(loss()[0])
            net.p[name][place] = old
            assert (sides[0] - sides[1]) / 2e-3 == pytest.approx(grad[place], rel=.02, abs=1e-4), name


def test_half_a_window_lies_whole_in_some_window():
    half = toxicity.WINDOW // 2
    for n in (33, 57, 400):
        starts = toxicity.windows(n)
        assert all(any(a <= k and k + half <= a + toxicity.WINDOW for a in starts) for k in range(n - half + 1))
    assert toxicity.HIDDEN >= 12 and toxicity.ATTENTION >= 8


def test_trains_on_passages_far_inside_long_texts(spark, docs_of):
    rng = random.Random(31)

    def far(toxic):  # clean for more than 20,000 characters, then marked words
        words = [rng.choice(CLEAN) for _ in range(4600)]
        return " ".join(words + toxic * ["zgub" + rng.choice(CLEAN) for _ in range(4)] + words[:40])
    rows = [(i, far(i % 2)) for i in range(160)]
    assert all(t.index("zgub") > 20_000 for i, t in rows if i % 2)
    model = toxicity.fit(docs_of(rows), spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int"))
    scores = toxicity.Scorer(model).scores([far(i % 2) for i in range(40)])
    assert (scores[1::2, None] > scores[None, ::2]).mean() > .8


def test_held_out_rows_are_never_trained_on(spark, docs_of):
    import zlib
    ids = range(200)
    rows = spark.range(200).select(F.col("id"), toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)
    held = [i for i in ids if zlib.crc32(str(i).encode()) % 4 == 2]
    docs = docs_of([(i, f"w{i} word") for i in ids])
    labels = spark.createDataFrame([(i, 1) for i in held] + [(i, 0) for i in ids if i not in held], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels) is None  # the only toxic labels are held out


# ------------------------------------------------------------------ op6
def plain_counts(text):
    words, lines = (text or "").encode().split(), [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    seen = Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
    covered = {j for k in range(len(words) - 7) if seen[tuple(words[k:k + 8])] > 1 for j in range(k, k + 8)}
    n = len(words)
    return (n, sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n)


ODD = [None, "", " \n ", "a|b # c", "x\nx\n \nx", "the cat " * 40, " ".join(CLEAN[:30]) + " é\x85y",
       " ".join(CLEAN[:8] + CLEAN[50:70] + CLEAN[:8]), "w " * 5000, "\n".join(CLEAN[:40] + CLEAN[:5])]


def test_base_counts_match_plain_python():
    rng = random.Random(8)
    texts = ODD + [" ".join(rng.choice(CLEAN[:k]) for _ in range(rng.randint(0, 90))) for k in (1, 2, 3, 5, 40) for _ in range(12)]
    for t in texts:
        assert quality.base_counts(t or "") == plain_counts(t), t


def test_viterbi_is_the_best_of_all_labelings():
    rng = np.random.default_rng(4)
    for n in (1, 2, 5, 8):
        model = {"w": rng.normal(size=(2, quality.FEATURES)), "t": rng.normal(size=(2, 2))}
        x = rng.normal(size=(n, quality.FEATURES))
        def score(y):
            return sum(x[i] @ model["w"][k] for i, k in enumerate(y)) + sum(model["t"][a, b] for a, b in zip(y, y[1:]))
        best = max(itertools.product((0, 1), repeat=n), key=score)
        assert tuple(quality.viterbi(model, x)) == best
    assert len(quality.viterbi({"w": np.zeros((2, quality.FEATURES)), "t": np.zeros((2, 2))}, np.zeros((0, quality.FEATURES)))) == 0


def test_field_separates_junk_lines_and_keeps_prose(spark, docs_of):
    rng = random.Random(6)
    good = lambda: "\n".join(" ".join(rng.choice(CLEAN) for _ in range(rng.randint(8, 30))).capitalize() + "." for _ in range(5))
    junk = lambda: "\n".join(" | ".join(rng.choice(CLEAN) for _ in range(9)) + " |" for _ in range(5))
    rows = [(i, good() if i % 3 else junk()) for i in range(300)]
    docs = docs_of(rows)
    labels = spark.createDataFrame([(i, int(bool(i % 3))) for i in range(200)] + [(None, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    out = quality.judge_documents(docs, model).where("doc_id >= 200").collect()
    assert all(r["__keep"] == bool(r["doc_id"] % 3) for r in out)
    odd = quality.judge_documents(docs_of([(i, t) for i, t in enumerate(ODD)] + [(1, "")]), model).collect()
    assert [tuple(r["__base"]) for r in odd[:len(ODD)]] == [plain_counts(t) for t in ODD]
    assert not any(r["__keep"] for r in odd if r["__base"]["base_failed"])
    assert all(len(r["__boilerplate"]) == len((t or "").split("\n")) for r, t in zip(odd, ODD))
    assert quality.judge_documents(docs_of([]), quality.train([], [])).count() == 0


# ------------------------------------------------------------------ op4
def test_fusion_matches_plain_python(spark):
    names = ["de", "en"]
    pages = [(1, "http://a.x.de/1", "de", [-1.0, -3.0]), (2, "http://a.x.de/2", "de", [-2.0, -2.1]),
             (3, "https://b.x.de/", "en", [-1.0, -1.0]), (4, "http://n.com", "en", [-5.0, -1.0]), (5, None, "", [0.0, 0.0]),
             (5, None, "", [0.0, 0.0]), (6, "weird", "tlh", [-1.0, -1.5]), (7, "http://user@N.com:80/x", "en", [-3.0, -2.0])]
    df = spark.createDataFrame([(k, u, d, 3, ll) for k, u, d, ll in pages], "key long, url string, declared string, n_grams long, ll array<double>")
    got = sorted(((r["key"], r["host"], r["language"], round(r["confidence"], 9)) for r in language.fuse(df, names).collect()))
    host = {1: "a.x.de", 2: "a.x.de", 3: "b.x.de", 4: "n.com", 5: "", 6: "", 7: "n.com"}
    soft = []
    for k, u, d, ll in pages:
        e = [math.exp(x - max(ll)) for x in ll]
        soft.append((host[k], d, [x / sum(e) for x in e]))
    def total(keep):
        return [sum(p[i] for h, d, p in soft if keep(h, d)) for i in range(2)]
    cut = lambda h, n: ".".join(h.split(".")[-n:])
    everywhere = total(lambda h, d: True)
    base = [(c + 1) / (sum(everywhere) + 2) for c in everywhere]
    def smooth(c, above):
        return [(c[i] + language.ALPHA * above[i]) / (sum(c) + language.ALPHA) for i in range(2)]
    want = []
    for (k, _, _, ll), (h, d, p) in zip(pages, soft):
        suffix = smooth(total(lambda x, _: cut(x, 1) == cut(h, 1)), base)
        domain = smooth(total(lambda x, _: cut(x, 2) == cut(h, 2)), suffix)
        own = total(lambda x, _: x == h)
        prior = [math.log((max(own[i] - p[i], 0) + language.ALPHA * domain[i]) / (sum(own) - 1 + language.ALPHA)) for i in range(2)]
        said = total(lambda _, x: x == d)
        kinds = len({x for _, x, _ in soft})
        mark = [math.log((said[i] + language.BETA / kinds) / (everywhere[i] + language.BETA)) for i in range(2)]
        s = [ll[i] + prior[i] + mark[i] for i in range(2)]
        e = [math.exp(x - max(s)) for x in s]
        want.append((k, h, names[e.index(max(e))], round(max(e) / sum(e), 9)))
    assert got == sorted(want)


def test_pages_of_the_given_table(spark):
    out = language.op4_language_id(spark, "/root/testdata/sf0.001")
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert out.count() == pages.count()
    assert out.where("language = declared").count() >= .97 * out.count()
    empty = language.identify(pages.limit(0), spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert empty.count() == 0
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(1, None, None), (2, "http://h.org", ""), (2, "http://h.org", "")], "page_id long, url string, html string")
    assert odd.count() == language.identify(odd, docs).count()
    assert {r["language"] for r in language.identify(odd, docs.limit(0)).collect()} == {None}


def test_text_model_names_the_language_of_documents_outside_its_sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang").where("length(text) > 40")
    model = language.fit_text(docs)
    assert model["names"] == sorted(r[0] for r in docs.select("lang").distinct().collect())
    held = language.sample_texts(docs).select("o", "h")
    outside = docs.withColumns({"o": F.xxhash64(F.lit("sample"), "doc_id"), "h": F.xxhash64("text")}).join(held, ["o", "h"], "left_anti")
    judged = language.text_evidence(outside.select(F.struct("doc_id", "lang").alias("page_id"), F.lit("").alias("url"),
                                                   F.col("text").alias("html")), model)
    best = judged.select("key.lang", F.get(F.lit(model["names"]), F.array_position("ll", F.array_max("ll")).cast("int") - 1).alias("got"))
    right, n = best.agg(F.avg((F.col("lang") == F.col("got")).cast("int")), F.count("*")).first()
    assert n > 3000 and right > .97


def test_language_sample_is_bounded_and_whole(docs_of, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_PER_LANGUAGE", 5)
    rows = [(i, f"text {i} " + "x" * 50_000) for i in range(20)] + [(3, "text 3 again")] * 40 + [(None, None), (7, "")]
    got = language.sample_texts(docs_of(rows)).collect()
    assert len(got) == 5 and len({(r["o"], r["h"]) for r in got}) == 5
    assert all(r["text"] is None or len(r["text"]) < 20 or len(r["text"]) > 50_000 for r in got)


def test_training_runs_come_from_the_whole_text():
    assert quality.drawn_runs("1", 0) == [(0, 0)] and quality.drawn_runs("1", 40) == [(0, 40)]
    starts = [quality.drawn_runs(str(i), 1000) for i in range(400)]
    assert all(b - a == quality.SAMPLE_LINES and 0 <= a and b <= 1000 for runs in starts for a, b in runs)
    assert all(runs[0][1] <= runs[1][0] for runs in starts)
    assert min(r[0][0] for r in starts) < 20 and max(r[1][1] for r in starts) > 980


def test_visible_text_drops_what_is_not_shown():
    page = "<html><script>var t='<p>';</script><style>p{}</style><!-- <b>no</b> --><p>one&amp;two</p></html>"
    assert " ".join(language.visible(page).split()) == "one&two"
    assert language.grams("").size == 0 and language.grams("ab").size == 2
