"""C1–C4, C5–C11, C12–C24 on the inline fixtures X1–X13, X17, X20."""
import math

import pytest
from pyspark.sql import functions as F

from ratecraft.functions import dates as dt
from ratecraft.functions import numeric as num
from ratecraft.functions import text as tx
from ratecraft.operators import corpus as cp


def _col(spark, values, typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, v {typ}")


def _vals(df, c="out"):
    return [r[c] for r in df.orderBy("id").collect()]


def test_x1_day_of_week(spark):
    df = _col(spark, ["Mon", "sun", "xyz"])
    assert _vals(df.select("id", dt.day_of_week_number(F.col("v")).alias("out"))) == [1, 7, None]


def test_x2_month(spark):
    df = _col(spark, ["jan", "DEC", "foo"])
    assert _vals(df.select("id", dt.month_number(F.col("v")).alias("out"))) == [1, 12, None]


def test_x3_time_to_seconds(spark):
    df = _col(spark, ["01:02:03", "1:2", "00:00:00", "aa:00:00"])
    assert _vals(df.select("id", dt.time_to_seconds(F.col("v")).alias("out"))) == [3723, 0, 0, None]


def test_x4_birthday_age(spark):
    df = _col(spark, ["Jan 5, 1980", "unknown", "May 3", "Jan 1, 2021", "UNKNOWN"])
    out = _vals(df.select("id", dt.birthday_to_age(F.col("v"), 2020).alias("out")))
    assert out == [40, 0, 0, 0, 0]


def test_x5_impute_mean(spark):
    df = spark.createDataFrame([(0, 4.0), (1, None), (2, 6.0)], "id int, ABV double")
    assert _vals(num.impute_mean(df, "ABV", fit_on="all"), "ABV") == [4.0, 5.0, 6.0]


def test_x5_impute_mean_per_split(spark):
    df = spark.createDataFrame([(0, 4.0, "train"), (1, None, "train"), (2, 6.0, "train"),
                                (3, 1.0, "val"), (4, None, "val")], "id int, ABV double, split string")
    assert _vals(num.impute_mean(df, "ABV", fit_on="each"), "ABV") == [4.0, 5.0, 6.0, 1.0, 1.0]
    assert _vals(num.impute_mean(df, "ABV", fit_on="train"), "ABV") == [4.0, 5.0, 6.0, 1.0, 5.0]


def test_x6_outliers(spark):
    df = _col(spark, [1.0, 2.0, 3.0, 4.0, 100.0], "double")
    out = _vals(num.remove_outliers(df, "v"), "v")
    assert out == [1.0, 2.0, 3.0, 4.0, None]


def test_x7_log10(spark):
    df = _col(spark, [None, 0.0, 100.0, -1.0], "double")
    assert _vals(df.select("id", num.log10_or_zero(F.col("v")).alias("out"))) == [None, 0.0, 2.0, None]


def test_x8_zscore_population_sd(spark):
    df = spark.createDataFrame([(0, 2.0, 7.0), (1, 4.0, 7.0)], "id int, a double, c double")
    out = num.zscore(df, ["a", "c"], fit_on="all").orderBy("id").collect()
    assert [r["a"] for r in out] == [-1.0, 1.0]
    assert [r["c"] for r in out] == [0.0, 0.0]  # constant column → 0


def test_x9_minmax(spark):
    df = spark.createDataFrame([(0, 2.0), (1, 4.0), (2, 3.0)], "id int, a double")
    assert _vals(num.minmax(df, ["a"], fit_on="all"), "a") == [0.0, 1.0, 0.5]


def test_x10_closeness_product(spark):
    df = spark.createDataFrame([(5.0, 3.0, 7.0, 4.0, None)], "a1 double, m1 double, a2 double, m2 double, z double")
    r = df.select(num.closeness_product([(F.col("a1"), F.col("a2")), (F.col("m1"), F.col("m2"))]).alias("s"),
                  num.closeness(F.col("a1"), F.col("z")).alias("missing")).first()
    assert r["s"] == pytest.approx(math.exp(-0.2) * math.exp(-0.1), abs=1e-9)
    assert r["s"] == pytest.approx(0.740818, abs=1e-6)
    assert r["missing"] == 0.0


def test_cosine(spark):
    df = spark.createDataFrame([([5.0, 3.0], [3.0, 4.0], [0.0, 0.0])], "a array<double>, b array<double>, z array<double>")
    r = df.select(num.cosine(F.col("a"), F.col("b")).alias("c"), num.cosine(F.col("a"), F.col("z")).alias("zero")).first()
    assert r["c"] == pytest.approx(27 / (math.sqrt(34) * 5), abs=1e-12)
    assert r["zero"] == 0.0


def test_x11_ascii_and_punctuation(spark):
    df = _col(spark, ["Añejo Stout!"])
    out = _vals(df.select("id", tx.strip_punctuation(tx.ascii_only(F.col("v"))).alias("out")))
    assert out == ["Aejo Stout"]


def test_c15_split_keeps_empty_tokens(spark):
    df = _col(spark, ["a  b"])
    assert _vals(df.select("id", tx.split_space(F.col("v")).alias("out"))) == [["a", "", "b"]]


def test_x13_label_and_x17_number(spark):
    df = spark.createDataFrame([(0, 4.5, "dark ale"), (1, None, "x")], "id int, rating double, t string")
    out = _vals(df.select("id", F.concat(tx.label_text(F.col("rating")), F.col("t")).alias("out")))
    assert out == ["__label__4.5 dark ale", None]
    lab = _col(spark, ["__label__3.25", "__label__x"])
    assert _vals(lab.select("id", tx.label_to_number(F.col("v")).alias("out"))) == [3.25, None]


def test_x20_text_chain(spark):
    docs = spark.createDataFrame([(1, "The dark ale"), (2, "dark ale & a porter"), (3, "Porter 2009!")],
                                 "RowID long, text string")
    plain = cp.prepare_text(docs, "text")
    assert [r["text"] for r in plain.orderBy("RowID").collect()] == ["dark ale", "dark ale porter", "porter"]
    merged = cp.prepare_text(docs, "text", top_bigrams_n=1)
    assert [r["text"] for r in merged.orderBy("RowID").collect()] == ["dark_ale", "dark_ale porter", "porter"]


def test_text_chain_top_frequent_and_empty(spark):
    docs = spark.createDataFrame([(1, "ale ale stout"), (2, "stout porter porter"), (3, "!!")],
                                 "RowID long, text string")
    out = cp.prepare_text(docs, "text", remove_top_frequent=1)
    # counts: ale 2, stout 2, porter 2 → top-1 by (n desc, term) is "ale"
    assert [r["text"] for r in out.orderBy("RowID").collect()] == ["stout", "stout porter porter", ""]


def test_bigram_boundaries(spark):
    df = _col(spark, ["pecan ale an ale"])
    exact = df.select("id", tx.merge_bigrams(F.col("v"), [("an", "ale")], exact=True).alias("out"))
    bounded = df.select("id", tx.merge_bigrams(F.col("v"), [("an", "ale")]).alias("out"))
    assert _vals(exact) == ["pecan_ale an_ale"]
    assert _vals(bounded) == ["pecan ale an_ale"]


def test_corpus_bigrams_cross_document_ends(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        docs = spark.createDataFrame([(i, t) for i, t in enumerate(
            ["dark ale", "porter", "!!", "stout dark", "ale porter", "ipa"])], "RowID long, text string")
        freq = {(r["a"], r["b"]): r["n"] for r in cp.corpus_bigram_frequency(cp.tokenize(docs, "text")).collect()}
        words = ["dark", "ale", "porter", "stout", "dark", "ale", "porter", "ipa"]
        want = {}
        for a, b in zip(words, words[1:]):
            want[(a, b)] = want.get((a, b), 0) + 1
        assert freq == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
