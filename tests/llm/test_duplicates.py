"""op2, op5, op9 against brute force; hot groups through small cells; odd rows."""
import random
import re
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from ratecraft.llm import chunks, lines, simhash
from ratecraft.llm.common import WORD
from tests.llm.conftest import union_find

RNG = random.Random(11)
VOCAB = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(RNG.randint(2, 9))) for _ in range(900)]


def prose(rng, n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def edit(rng, text, n):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(VOCAB)
    return " ".join(words)


# ------------------------------------------------------------------ op5
def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components_match_all_pairs(docs_of, monkeypatch):
    rng = random.Random(3)
    base = [prose(rng, rng.randint(1, 120)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, edit(rng, base[i % 7], 1)) for i in range(150)]  # groups of near copies
    rows += [(400 + i, base[5]) for i in range(120)] + [(400, base[5])]  # a third: exact copies, a repeated row
    rows += [(600, None), (601, ""), (602, " \t\n"), (None, "zz"), (None, ""), (603, "ÀÉ word " * 4000), (604, "A b c")]
    fps = [plain_fingerprint(t) for _, t in rows]
    root = union_find(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i)
                                         if (fps[i] ^ fps[j]).bit_count() <= 2])
    members = defaultdict(list)
    for i, r in root.items():
        members[r].append(i)
    want = sorted((str(rows[i][0]), fps[i], str(min((rows[j][0] for j in m if rows[j][0] is not None), default=None)))
                  for m in members.values() for i in m)
    for cell in (simhash.CELL, 3):  # cells of three: hot groups meet cell by cell
        monkeypatch.setattr(simhash.fingerprint_links, "__defaults__", (2, simhash.PIVOTS, cell))
        out = simhash.near_duplicates(docs_of(rows)).collect()
        assert sorted((str(r["key"]), r["fp"] % (1 << 64), str(r["component"])) for r in out) == want
    stay = simhash.without_near_duplicates(docs_of(rows))
    assert stay.columns == docs_of([]).columns
    assert stay.count() == len(members)
    assert simhash.near_duplicates(docs_of([])).count() == 0


def test_pivots_discard_only_pairs_too_far_apart():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (2, 400)).astype(np.uint64)
    b = a ^ flips[0] ^ flips[1]
    gap = np.abs(simhash.distance_table(a, simhash.pivots()) - simhash.distance_table(b, simhash.pivots())).max(axis=1)
    assert (gap <= 2).all()
    far = np.abs(simhash.distance_table(a, simhash.pivots()) - simhash.distance_table(a[::-1].copy(), simhash.pivots())).max(axis=1)
    assert (far > 2).mean() > .99


# ------------------------------------------------------------------ op2
def brute_lines(rows):
    """Dropped line numbers of each row: near lines by all pairs of shingle sets."""
    found = [(i, k, lines.normal(x)) for i, (_, t) in enumerate(rows) for k, x in enumerate((t or "").split("\n"))
             if lines.normal(x)]
    distinct = sorted({x for *_, x in found})
    pad = [x.ljust(lines.SHINGLE, "\0") for x in distinct]
    sets = [{x[k:k + lines.SHINGLE] for k in range(len(x) - lines.SHINGLE + 1)} for x in pad]
    links = [(a, b) for a in range(len(sets)) for b in range(a)
             if len(sets[a] & sets[b]) >= lines.THRESHOLD * len(sets[a] | sets[b])]
    root = union_find(range(len(distinct)), links)
    first, drop = {}, defaultdict(list)
    for i, k, x in sorted(found, key=lambda r: (rows[r[0]][0] is None, rows[r[0]][0] or 0, xxhash_of(rows[r[0]][1]), r[1])):
        r = root[distinct.index(x)]
        place = (rows[i], k)
        if first.setdefault(r, place) != place:
            drop[i].append(k)
    return drop


def xxhash_of(text):
    h = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return h - (1 << 64) if h >= 1 << 63 else h


def test_lines_match_all_pairs(docs_of, monkeypatch):
    rng = random.Random(9)
    hot = prose(rng, 60)
    rows = [(i, "\n".join([prose(rng, rng.randint(1, 40)) for _ in range(rng.randint(1, 4))])) for i in range(40)]
    rows += [(50 + i, f"{prose(rng, 30)}\n{edit(rng, hot, 1)}\n\nAll rights reserved.") for i in range(60)]
    rows += [(200, None), (201, ""), (202, " \n\t\n"), (203, "ab\nab\nAB  \nabc"), (204, rows[3][1]), (204, rows[3][1]),
             (205, "x" * 20000 + "\n" + "x" * 20000), (None, rows[4][1])]
    want = brute_lines(rows)
    for cell in (lines.CELL, 4):
        monkeypatch.setattr(lines, "CELL", cell)
        out = lines.without_near_lines(docs_of(rows)).collect()
        assert len(out) == len(rows)
        got = {(str(r["doc_id"]), r["text"]): (r["__dropped"], r["__kept"], r["__lines"]) for r in out}
        for i, (key, text) in enumerate(rows):
            dropped, kept, n = got[str(key), text]
            assert dropped == sorted(want.get(i, [])), (key, dropped, want.get(i))
            assert n == (0 if text is None else len(text.split("\n")))
            assert kept == (None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in dropped))
    assert lines.without_near_lines(docs_of([])).count() == 0


def test_lines_beside_columns_of_any_name(docs_of):
    names = ("__id", "__h2", "__h", "__key", "__lines0", "id", "h", "rest", "dropped", "root", "digest")
    df = docs_of([(1, "some line of words\nsome line of words"), (2, None)]).withColumns({c: F.lit(f"own {c}") for c in names})
    out = lines.without_near_lines(df).collect()
    assert all(r[c] == f"own {c}" for r in out for c in names) and sorted(map(str, (r["__dropped"] for r in out))) == ["[1]", "[]"]


def test_banding_has_high_recall():
    rng = random.Random(1)
    found = total = 0
    for _ in range(400):
        a = prose(rng, 50)
        b = edit(rng, a, rng.randint(1, 4))
        x, y = lines.shingle_sets([a, b])
        if x != y and len(x & y) >= lines.THRESHOLD * len(x | y):
            total += 1
            keys = lines.band_keys([a, b])
            found += bool((keys[0] == keys[1]).any())
    assert total > 60 and found / total > .97


# ------------------------------------------------------------------ op9
def test_shared_passages_are_found_at_any_offset(docs_of):
    rng = random.Random(7)
    passages = [prose(rng, 52) for _ in range(25)]
    clean = [(i, prose(rng, rng.randint(1, 300))) for i in range(60)]
    hit = [(100 + 10 * p + k, f"{prose(rng, rng.randint(0, 90))} {passages[p]} {prose(rng, rng.randint(0, 90))}")
           for p in range(25) for k in range(3)]
    odd = [(900, None), (901, ""), (902, "x" * 30000), (903, passages[0]), (903, passages[0]), (None, passages[1])]
    out = chunks.without_repeats(docs_of(clean + hit + odd)).collect()
    assert len(out) == len(clean + hit + odd)
    spans = {r["doc_id"]: r["__spans"] for r in out}
    assert all(not spans[i] for i, _ in clean) and not spans[900] and not spans[901] and not spans[902]
    caught = [bool(spans[i]) for i, _ in hit]
    assert sum(caught) >= .98 * len(caught)
    for r in out:
        if r["doc_id"] in dict(hit):
            kept, drop = "", 0
            for s in r["__spans"]:
                assert s["drop"] == (s["first"] != r["doc_id"]) and s["first"] <= r["doc_id"]
                kept += r["text"][drop:s["start"]] if s["drop"] else ""
                drop = s["stop"] if s["drop"] else drop
            assert r["__kept"] == kept + r["text"][drop:]
    assert chunks.without_repeats(docs_of([])).count() == 0


def plain_spans(rows, n=chunks.MIN_WORDS):
    """Drop flags of every character by all stretches of n words, and the rows with any repeated stretch."""
    words = [[(m.start(), m.end(), m.group()) for m in re.finditer(WORD, t or "")] for _, t in rows]
    keys = [chunks.NO_KEY if k is None else k for k, _ in rows]
    stretches = [[tuple(w for *_, w in ws[i:i + n]) for i in range(len(ws) - n + 1)] for ws in words]
    holders = defaultdict(set)
    for key, found in zip(keys, stretches):
        for s in found:
            holders[s].add(key)
    drops, flagged = [], []
    for key, (_, text), ws, found in zip(keys, rows, words, stretches):
        drop = [False] * len(text or "")
        for i, s in enumerate(found):
            if min(holders[s]) != key:
                drop[ws[i][0]:ws[i + n - 1][1]] = [True] * (ws[i + n - 1][1] - ws[i][0])
        drops.append("".join(c for c, d in zip(text or "", drop) if not d))
        flagged.append(any(len(holders[s]) > 1 for s in found))
    return drops, flagged


def check_spans(docs_of, rows):
    kept, flagged = plain_spans(rows)
    got = sorted((str(r["doc_id"]), r["text"] or "", r["__kept"] or "", bool(r["__spans"])) for r in chunks.without_repeats(docs_of(rows)).collect())
    assert got == sorted((str(k), t or "", x, f) for (k, t), x, f in zip(rows, kept, flagged))
    return flagged


def test_quotes_of_a_document_with_copies_are_found(docs_of):
    rng = random.Random(17)
    rows = []
    for p in range(12):  # documents 1 and 4 quote 51 to 62 words of document 2, which has a copy and a near copy
        whole = prose(rng, 200).split(" ")
        quote = " ".join(whole[70:121 + p])
        rows += [(10 * p + 1, f"{prose(rng, 30)} {quote} {prose(rng, 30)}"), (10 * p + 2, " ".join(whole)), (10 * p + 3, " ".join(whole)),
                 (10 * p + 5, edit(rng, " ".join(whole), 1)), (10 * p + 4, f"{prose(rng, 9)} {quote}\n{prose(rng, 50)}")]
    assert all(check_spans(docs_of, rows))


def test_passages_of_short_words_are_found_up_to_their_ends(docs_of):
    rng = random.Random(23)
    tiny = lambda n: " ".join(rng.choice("abcdefghij") for _ in range(n))
    rows = []
    for p in range(40):  # 50 words are too few, 51 and more are found whole, also with other white space
        quote = tiny(50 + p % 3)
        rows += [(10 * p + 1, f"{tiny(20)} X{p} {quote} Y{p} é漢😀 {tiny(20)}"), (10 * p + 2, f"\tZ{p}\n{quote.replace(' ', chr(10), 5)} W{p} {tiny(8)}")]
    rows += [(900, None), (901, ""), (None, rows[5][1]), (None, rows[5][1]), (902, "x " * 3000), (903, "x " * 700), (904, "y" * 20000),
             (1, rows[1][1]), (905, " ".join(rows[k][1] for k in range(6)))]
    flagged = check_spans(docs_of, rows)
    assert flagged[0:40:6].count(False) >= 1 and all(flagged[4:80:6])


def test_gear_hash_rolls_and_cuts_resist_shifts():
    rng = random.Random(2)
    numbers = np.random.default_rng(1).integers(0, 1 << 63, 200).astype(np.uint64)
    h, rolled = 0, []
    for n in numbers.tolist():
        h = ((h << 4) + n) % (1 << 64)
        rolled.append(h)
    assert chunks.gear(numbers, 16).tolist() == rolled[15:]  # after 16 words the first has left the hash
    text = prose(rng, 2000) + " ß漢😀 " + prose(rng, 2000)
    moved = "some inserted words " + text[:9000] + " and more " + text[9000:]
    def pieces(t):
        words = t.split()
        starts = chunks.cut(t)
        return [tuple(words[i:j]) for i, j in zip(starts, [*starts[1:], len(words)])]
    a, b = pieces(text), set(pieces(moved))
    assert sum(p in b for p in a) >= .93 * len(a) and [w for p in a for w in p] == text.split()
    assert 8 < len(text.split()) / len(a) < 40
    assert chunks.cut("") == [] and chunks.cut("ab") == [] and chunks.cut(prose(rng, 51)) == [0]


def test_repeats_beside_columns_of_any_name(docs_of):
    rng = random.Random(4)
    rows = [(1, prose(rng, 80)), (2, prose(rng, 5))]
    rows += [(3, rows[0][1] + " end")]
    names = ("marks", "__id", "__h2", "__h", "__key", "id", "h", "rest", "spans", "chunk", "first")
    df = docs_of(rows).withColumns({c: F.lit(f"own {c}") for c in names})
    out = chunks.without_repeats(df).collect()
    assert len(out) == 3 and all(r[c] == f"own {c}" for r in out for c in names)
    assert {r["doc_id"]: len(r["__spans"]) for r in out} == {1: 1, 2: 0, 3: 1}


def test_both_uses_of_the_chunks_share_one_shuffle(spark, docs_of):
    docs = docs_of([(i, " ".join(f"w{k + i % 2}" for k in range(80))) for i in range(4)])
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for c, v in zip(before, ("false", "-1")):
            spark.conf.set(c, v)
        spans = chunks.repeated_spans(docs)
        plan = spark._jvm.PythonSQLUtils.explainString(spans._jdf.queryExecution(), "simple")
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    # marks for their holders and for the texts, chunks, places, runs
    assert plan.count("MapInArrow") == 5
