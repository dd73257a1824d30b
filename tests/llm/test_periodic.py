"""op11: brute force over all periods, any way of appending, planted texts, odd rows."""
import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecraft.llm import periodic


def all_runs(words, exponent, shortest):
    """Runs by trying every period at every place."""
    n, best = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j - i >= p:
                best.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((a, b - a, p) for (a, b), p in best.items() if b - a >= max(shortest, exponent * p))


def random_words(rng):
    n, k = rng.randrange(0, 150), rng.choice([1, 2, 2, 3, 6])
    words = [rng.randrange(k) for _ in range(n)]
    if n > 4 and rng.random() < .6:
        a = rng.randrange(n)
        p = 1 + rng.randrange(max(1, (n - a) // 2 + 1))
        for i in range(a, n):
            words[i] = words[a + (i - a) % p]
        if rng.random() < .4:
            words[rng.randrange(n)] = 9
    return words


@pytest.mark.parametrize("exponent", [2, 3, 4, 5])
def test_catcher_matches_all_periods_however_words_are_appended(exponent):
    rng = random.Random(exponent)
    for _ in range(300):
        words = random_words(rng)
        catcher, step = periodic.RunCatcher(exponent, 6), rng.choice([1, 3, 7, 1000])
        for lo in range(0, len(words), step):
            catcher.append(np.array(words[lo:lo + step]))
            if rng.random() < .05:
                assert catcher.runs() == all_runs(words[:lo + step], exponent, 6)
        assert catcher.runs() == all_runs(words, exponent, 6)


def test_long_periodic_texts_stay_cheap():
    for words in ([0] * 200_000, [0] * 99_999 + [1] + [0] * 100_000, [i % 37 for i in range(200_000)]):
        start = time.time()
        runs = periodic.text_runs([str(w).encode() for w in words], 4, 6)
        assert 1 <= len(runs) <= 2 and time.time() - start < 20
    with pytest.raises(ValueError):
        periodic.RunCatcher(1)


def plant(key, words):
    n = len(words)
    h = None if key is None else zlib.crc32(str(key).encode())
    if h is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_against_plain_python(spark, docs_of, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{w}" for w in random_words(rng))) for i in range(400)]
    rows += [(10, None), (None, "a a a a a a a"), (None, None), (7, ""), (7, " \n\t "), (8, "é\x0bé\x0cé é é  é é é é é"),
             (9, "x y " * 500), (9, "x y " * 500)]
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = periodic.op11_periodic_runs(spark, str(tmp_path)).collect()
    want = []
    for key, text in rows:
        words = plant(key, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        runs = all_runs(words, 4, 6)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        gone = {i for s, n, p in runs for i in range(s + p, s + n)}
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((key, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
                     sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)),
                     sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sum(r["n_runs"] for r in got) > 50


def test_empty_table_and_clashing_columns(spark, docs_of):
    assert periodic.find_runs(docs_of([])).count() == 0
    docs = docs_of([(1, "a b a b a b a b c")]).withColumns({c: F.lit(1) for c in ("runs", "rest", "n_words", "__text")})
    row = periodic.find_runs(docs).first()
    assert row.asDict(True) == {"doc_id": 1, "n_words": 9, "runs": [{"start": 0, "length": 8, "period": 2}], "rest": "a b c"}
