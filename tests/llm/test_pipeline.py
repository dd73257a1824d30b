"""Each stage of the pipeline against a brute-force version on its own input."""
from collections import Counter, defaultdict

import duckdb
import numpy as np
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from ratecraft.llm import bpe, mixing, toxicity
from ratecraft.llm.common import saved
from tests.llm.conftest import union_find
from tests.llm.test_duplicates import brute_lines, plain_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "simhash_near_dedup", "source_mixing", "byte_bpe"]
    assert pipeline.ORACLE_SQL is None

    rows = docs.collect()
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = toxicity.Scorer(model).scores([r["text"] for r in rows])
    kept = saved(stages["toxicity"](spark, docs, SF), "t")
    near = {r["doc_id"] for r, s in zip(rows, scores) if abs(s - toxicity.THRESHOLD) < 1e-4}
    want = {r["doc_id"] for r, s in zip(rows, scores) if s < toxicity.THRESHOLD}
    assert kept.columns == columns and {r["doc_id"] for r in kept.collect()} ^ want <= near

    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    drop = brute_lines(rows)
    lined = saved(stages["line_dedup"](spark, kept, SF), "t")
    got = {r["doc_id"]: r for r in lined.collect()}
    assert lined.columns == columns and len(got) == len(rows)
    for i, (key, text) in enumerate(rows):
        left = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in drop.get(i, []))
        assert got[key]["text"] == left and got[key]["n_chars"] == len(left)

    rows = sorted((r["doc_id"], r["text"]) for r in lined.collect())
    fps = [plain_fingerprint(t) for _, t in rows]
    root = union_find(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    single = saved(stages["simhash_near_dedup"](spark, lined, SF), "t")
    assert single.columns == columns
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({rows[r][0] for r in root.values()})

    con = duckdb.connect()
    con.register("given", single.toPandas())
    copies = con.sql("with " + mixing.MIX_SQL.format(docs="given") + " select doc_id, m_copies from m_x").fetchall()
    mixed = saved(stages["source_mixing"](spark, single, SF), "t")
    assert mixed.columns == columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({i: n for i, n in copies if n})

    path, pattern = bpe.default_vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    tokens = stages["byte_bpe"](spark, mixed, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    assert len(tokens) == mixed.count() and all(r["round_trip"] for r in tokens)
    assert all(r["ids"] == library.encode_ordinary(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"]) for r in tokens)


def test_stages_of_odd_and_empty_tables(spark, docs_of):
    rows = [(1, None, None), (1, None, None), (None, "x y z", "a"), (2, "", "a"), (3, "word " * 5000, "b"), (4, "word " * 5000, "b")]
    labels = f"{SF}"
    for docs in (docs_of([(*r,) for r in rows]), docs_of([])):
        n = docs.count()
        for name, stage in pipeline.STAGES[1:]:
            out = stage(spark, docs, labels)
            assert (out.count() > 0) == (n > 0) or name == "source_mixing"
            if name != "byte_bpe":
                assert out.columns == docs.columns
    lengths = defaultdict(int)
    for r in pipeline.line_dedup(spark, docs_of([(1, "a b c d"), (2, "a b c d\nown line here")]), SF).collect():
        lengths[r["doc_id"]] = r["n_chars"]
    assert dict(lengths) == {1: 7, 2: 13} and np.isfinite(list(lengths.values())).all()


def test_stages_beside_columns_of_any_name(spark, docs_of):
    names = ("__h", "__k", "__key", "__tie", "__rank", "__class", "__block", "__source", "__words0", "__id", "__h2", "k", "h", "row",
             "rest", "key", "tie", "marks", "root", "digest", "dropped", "id")
    docs = docs_of([(i, f"word{i} and some more words {i}\nline {i}", "a") for i in range(6)]).withColumns({c: F.lit(f"own {c}") for c in names})
    for name, stage in pipeline.STAGES[1:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        found = out.select(*names).distinct().collect()
        assert len(found) <= 1 and all(r[c] == f"own {c}" for r in found for c in names), name


def test_toxicity_stage_of_odd_and_empty_tables(spark, docs_of):
    rows = [(1, None), (1, None), (None, "x"), (2, ""), (3, "word " * 50_000), (4, "a")]
    for docs in (docs_of(rows), docs_of([])):
        out = pipeline.toxicity(spark, docs, SF)
        assert out.columns == docs.columns and out.count() <= docs.count()
