"""op12: diagrams, swaps and steps against counting rows, order by order; odd rows."""
import itertools
import random
import re

from pyspark.sql import functions as F

from ratecraft.llm import audit


def naive_steps(rows, letters):
    """Per order and step the counts, by filtering the rows one after the other; rows: (mask, good, toxic)."""
    out, bit = [], {c: 1 << i for i, c in enumerate(letters)}
    removed_by = dict.fromkeys(letters, 0)
    for order in itertools.permutations(letters):
        left = rows
        for i, c in enumerate(order):
            gone = [r for r in left if r[0] & bit[c]]
            left = [r for r in left if not r[0] & bit[c]]
            removed_by[c] += len(gone)
            fails = sum(1 for r in rows if r[0] & bit[c])
            out.append(["".join(order), i + 1, len(left), len(gone), fails - len(gone),
                        sum(1 for r in rows if r[0] == bit[c]), sum(r[1] for r in gone), sum(r[2] for r in gone), c])
    return sorted(tuple(r[:-1]) + (removed_by[r[-1]],) for r in out)


def counted(rows):
    out = {}
    for mask, good, toxic in rows:
        n = out.get(mask, (0, 0, 0))
        out[mask] = (n[0] + 1, n[1] + good, n[2] + toxic)
    return out


def test_swap_chain_visits_every_order_once():
    for n in range(1, 7):
        order, seen = list(range(n)), [tuple(range(n))]
        for place in audit.swap_chain(n):
            order[place], order[place + 1] = order[place + 1], order[place]
            seen.append(tuple(order))
        assert sorted(seen) == sorted(itertools.permutations(range(n)))


def test_steps_of_all_orders_match_filtering_row_by_row():
    rng = random.Random(5)
    for k in (1, 2, 3, 4, 5):
        for size in (1, 7, 90):
            rows = [(rng.randrange(1 << k) & rng.randrange(1 << k), rng.randrange(2), rng.randrange(2)) for _ in range(size)]
            letters = audit.LETTERS[:k]
            assert sorted(audit.audit_part(counted(rows), letters)) == naive_steps(rows, letters)


def test_equal_branches_share_a_node_and_swaps_keep_the_counts():
    diagram = audit.Diagram({m: (3,) for m in range(32)}, 5)
    assert [len(level) for level in diagram.levels] == [1] * 5
    for place in audit.swap_chain(5):
        diagram.swap(place)
        assert [len(level) for level in diagram.levels] == [1] * 5
        assert diagram.weights[diagram.root] == (96,)


ROWS = [(1, "word " * 250, "a"), (2, "word " * 250, "a"), (2, "word " * 250, "b"), (None, "word " * 250, "a"),
        (3, None, None), (4, "", None), (4, "", ""), (5, "LOUD # SIGN", "b"), (6, " ".join(map(str, range(300))), "b"),
        (7, " ".join(map(str, range(300))), "a"), (8, "ÄÖÜ x\x0by & é", "a"), (None, None, "b"), (9, "quiet words", "a")]


def masks_of(rows):
    out = []
    for key, text, part in rows:
        body = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", body)
        mask = (len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1
        mask |= (100 * len(re.findall("[A-Z]", body)) > 2 * len(body)) << 2 | bool(re.search(r"[#$%&*|]", body)) << 3
        mask |= any(k is not None and key is not None and k < key and (t or "") == body for k, t, _ in rows) << 4
        out.append((part or "", mask, key))
    return out


def test_audit_of_odd_rows_against_plain_python(spark, docs_of):
    docs = docs_of(ROWS).withColumns({c: F.lit(9) for c in ("key", "digest", "bits", "part", "mask", "n", "first", "k")})
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (5, 1, 0), (6, None, 1), (None, 1, 1), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    good, toxic = {1, 5}, {5, 6}
    got = audit.interactions(audit.mask_counts(audit.failure_table(docs), labels)).collect()
    want = []
    masks = masks_of(ROWS)
    for part in {m[0] for m in masks}:
        rows = [(m, int(k in good), int(k in toxic)) for p, m, k in masks if p == part]
        want += [(part, *r) for r in naive_steps(rows, audit.LETTERS)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_empty_tables(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.interactions(audit.mask_counts(audit.failure_table(docs_of([])), labels)).count() == 0
    got = audit.interactions(audit.mask_counts(audit.failure_table(docs_of(ROWS)), labels)).agg(
        F.sum("good_lost"), F.sum("toxic_lost"), F.count("*")).first()
    assert tuple(got) == (0, 0, 600 * 3)
