"""op3, op8, op10 and the shared helpers: brute force, ties, nulls, empty tables, clashing columns."""
import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ratecraft.llm import common, merkle, mixing, sharding
from tests.llm.conftest import union_find

ODD = [(1, "a b c"), (2, None), (None, "x"), (None, None), (3, ""), (3, ""), (4, " \n\t "), (5, "wörter ß\n\nzwei"),
       (5, "wörter ß\n\nzwei"), (6, "long " * 3000)]


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(70)] + [(100, 100 + k) for k in range(1, 40)] + [(200, 201), (201, 202), (202, 200)]
    links += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(80)] + [(7, 7)]
    rng.shuffle(links)
    df = spark.createDataFrame([(a, b) if rng.random() < .5 else (b, a) for a, b in links], "a long, b long")
    got = {r["node"]: r["root"] for r in common.components(df, "t").collect()}
    want = union_find({n for link in links for n in link}, links)
    assert got == {n: r for n, r in want.items() if any(n in link and link[0] != link[1] for link in links)}
    assert common.components(df.limit(0), "t").count() == 0


# ------------------------------------------------------------------ op10
def test_rendezvous_matches_plain_computation(spark, docs_of):
    def best(key, n):
        name = "\\N" if key is None else str(key)
        def score(s):
            u = (int(hashlib.md5(f"{s}:{name}".encode()).hexdigest()[:12], 16) + .5) / 16 ** 12
            return math.log(u)
        return max(range(n), key=lambda s: (score(s), -s))
    rows = ODD + [(i, f"text {i % 7}") for i in range(100, 400)]
    out = sharding.shard_report(docs_of(rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r["shard"] == best(r["doc_id"], 8) and r["grown_shard"] == best(r["doc_id"], 9)
        assert r["grown_shard"] in (r["shard"], 8) and r["law"] == "key"
    for s in range(8):
        slots = sorted(r["slot"] for r in out if r["shard"] == s)
        assert slots == list(range(len(slots)))
    want = sorted((i, len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode())) for i, t in rows if i)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in out if r["doc_id"]) == want
    assert sharding.shard_report(docs_of([])).count() == 0


def test_weighted_shards_and_clashing_columns(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(1).alias("__block"), F.lit("x").alias("slot"))
    out = sharding.assign_shards(df, "doc_id", [1.0, 3.0])
    share = out.groupBy("shard").count().collect()
    assert out.columns == ["doc_id", "__block", "slot", "shard"]
    assert abs({r["shard"]: r["count"] for r in share}[1] / 4000 - .75) < .04
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("doc_id"), [1.0, 0.0])


# ------------------------------------------------------------------ op8
def fill(sizes, weights, budget, cap=2.0):
    """Targets by sharing the rest again until no source is above its cap."""
    targets, left = {}, dict(sizes)
    while left:
        rest = budget - sum(targets.values())
        total = sum(weights[s] for s in left)
        full = [s for s in left if rest * weights[s] / total > cap * sizes[s] + 1e-9]
        if not full:
            return targets | {s: rest * weights[s] / total for s in left}
        for s in full:
            targets[s] = cap * sizes[s]
            del left[s]
    return targets


def test_mixing_targets_and_copies(spark, docs_of):
    rng = random.Random(2)
    rows = [(i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 9, 30, 200]))), rng.choice(["b", "b", "b", "B", "ä", None, "c" if i % 50 == 0 else "b"]))
            for i in range(900)] + [(901, None, "b"), (901, None, "b"), (None, "q w", "zz")]
    out = mixing.mix_sources(docs_of(rows)).collect()
    assert len(out) == len(rows) and set(docs_of([]).columns) <= set(out[0].asDict())
    names = sorted({r[2] for r in rows if r[2] is not None}) + [None]
    sizes = {s: sum(len((t or "").split()) for _, t, x in rows if x == s) for s in names}
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    want = fill(sizes, weights, 1.5 * sum(sizes.values()))
    for s in names:
        mine = [r for r in out if r["source"] == s]
        assert all(r["__size"] == sizes[s] and r["__target"] == pytest.approx(want[s]) for r in mine)
        assert all(0 <= r["__copies"] <= 2 for r in mine)
        taken = sum(r["__words"] * r["__copies"] for r in mine)
        assert abs(taken - want[s]) <= max(r["__words"] for r in mine) * 2
    again = mixing.mix_sources(docs_of(rows[::-1]).repartition(5)).collect()
    key = lambda r: (str(r["doc_id"]), str(r["text"]), r["__copies"])
    assert sorted(map(key, out)) == sorted(map(key, again))
    emitted = mixing.emit(mixing.mix_sources(docs_of(rows)), ["doc_id", "text"])
    assert emitted.count() == sum(r["__copies"] for r in out)
    assert mixing.mix_sources(docs_of([])).count() == 0
    assert [r["__copies"] for r in mixing.mix_sources(docs_of([(1, None), (2, "")])).collect()] == [0, 0]


# ------------------------------------------------------------------ op3
def tree_root(text):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    import re
    def leaves(p):
        return ",".join(sha(m.group()) for m in re.finditer(merkle._LEAF, p))
    return sha(",".join(sha(",".join(sha(leaves(p)) for p in s.split("\n"))) for s in text.split("\n\n")))


def test_merkle_against_plain_python(spark, docs_of):
    rows = ODD + [(10 + i, "\n".join(f"line {i} {j} " + "word " * (j % 13) for j in range(i))) for i in range(1, 12)]
    out = merkle.with_edited(docs_of(rows)).withColumn("edited_fp", merkle.fingerprint(F.col("edited"))).withColumn(
        "near", merkle.likeness(F.col("fp"), F.col("edited_fp"))).collect()
    assert len(out) == len(rows)
    distinct = sorted({(-(1 << 63) if i is None else i, t or "") for i, t in rows}, key=lambda r: -r[0])
    by_id = {}
    for k, (i, t) in enumerate(distinct):
        after = distinct[(k + 1) % len(distinct)][1]
        third = len(t) // 3
        by_id.setdefault(i, []).append(t[:len(t) - third] + after[:third])
    for r in out:
        key = -(1 << 63) if r["key"] is None else r["key"]
        assert len(r["fp"].split("|")[0]) == 64
        if len(by_id[key]) == 1 and key > 0:
            before = [t for i, t in distinct if i == key][0]
            if [i for i, _ in distinct].index(key) + 1 < len(distinct) - 2:
                assert r["edited"] == by_id[key][0]
            assert r["fp"].startswith(tree_root(before)) and r["n_chars"] == len(before)
        assert (r["near"] == 1.0) == (r["fp"] == r["edited_fp"])
    assert merkle.with_edited(docs_of([])).count() == 0
    alone = merkle.with_edited(docs_of([(1, "abcdef")])).first()
    assert alone["edited"] == "abcdab" and alone["next_fp"] == alone["fp"]


def test_merkle_locates_an_edit(spark):
    a = "p0 a b c d e\np1 x y z\n\nq0 k l m"
    df = spark.createDataFrame([(a, a.replace("y", "Y"))], "a string, b string")
    got = df.select(merkle.differing(merkle.fingerprint(F.col("a")), merkle.fingerprint(F.col("b")))).first()[0]
    assert got == ["0.1"]
