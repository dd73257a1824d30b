import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents table from (doc_id, text) or (doc_id, text, source) rows."""
    def make(rows):
        return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]))
                                      for r in rows], DOC)
    return make


def union_find(nodes, links):
    """Smallest node of each node's component."""
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in links:
        x, y = top(a), top(b)
        if x != y:
            root[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}
