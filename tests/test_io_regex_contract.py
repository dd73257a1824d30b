"""S1–S5, K1–K7, C32–C36 and the driver contract."""
from pyspark.sql import functions as F

from ratecraft.functions import regexes as rx
from ratecraft.session import scratch_path
from ratecraft.sources import files as fs


def test_s1_s3_s4_k1_k2_k3(spark):
    path = scratch_path(spark, "t-ratings")
    rows = [(1, 10, 20, "Añejo Stout", "Stout", 4.5), (2, 11, 21, "IPA", "American IPA", 3.0)]
    spark.createDataFrame(rows, fs.RATINGS_SCHEMA).write.option("sep", "\t").csv(path)
    back = fs.read_ratings(spark, path)
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)
    test_path = scratch_path(spark, "t-test")
    spark.createDataFrame([r[:5] for r in rows], fs.TEST_SCHEMA).write.option("sep", "\t").csv(test_path)
    assert {r["rating"] for r in fs.read_test(spark, test_path).collect()} == {0.0}
    assert {r["rating"] for r in fs.read_test(spark, test_path, None).collect()} == {None}
    preds = back.withColumn("est", F.col("rating") - 1)
    sub, run = scratch_path(spark, "t-sub"), scratch_path(spark, "t-run")
    fs.write_subrun(preds, sub)
    header = spark.read.text(sub).first()["value"]
    assert header == "RowID,BeerID,ReviewerID,Predict"
    fs.subrun_to_run(spark, sub, run)
    assert sorted(tuple(r) for r in fs.read_run(spark, run).collect()) == [(1, 3.5), (2, 2.0)]


def test_k4_corpus_and_k6_split_tables(spark):
    df = spark.createDataFrame([(1, "a b", "train"), (2, None, "val")], "RowID long, t string, split string")
    p = scratch_path(spark, "t-corpus")
    fs.write_corpus(df, "t", p)
    assert sorted(r["value"] for r in spark.read.text(p).collect()) == ["", "a b"]
    q = scratch_path(spark, "t-split")
    fs.write_split_tables(df, q)
    assert spark.read.parquet(q).where("split = 'val'").count() == 1


def test_k7_fit_or_load(spark):
    from ratecraft.plans.base import Roles
    data = spark.createDataFrame([(1, "u1", "i1", 4.0), (2, "u2", "i1", 2.0)],
                                 "RowID long, user string, item string, rating double")
    path = scratch_path(spark, "t-model")
    r = Roles("user", "item", "rating")
    a = fs.fit_or_load_baseline(data, path, roles=r, n_epochs=1)
    b = fs.fit_or_load_baseline(data.limit(0), path)  # loaded, not refitted
    assert b.mu == a.mu and b.roles == r
    assert sorted(map(tuple, b.bi.collect())) == sorted(map(tuple, a.bi.collect()))


def test_c32_patterns(spark):
    cases = [("email", "a.b@mail.example.com", True), ("email", "not an email", False),
             ("time_24h", "23:59", True), ("time_24h", "3:59", False),
             ("mobile_au", "0412 345 678", True), ("mobile_au", "+61412345678", True),
             ("mobile_nz", "021 234 5678", True), ("file_csv", "x.CSV", True),
             ("file_documents", "report.docx", True), ("file_documents", "img.png", False),
             ("file_images", "a.JPeG", True), ("has_upper", "Abc", True), ("has_upper", "abC", False),
             ("punctuation_symbol", "hi!", False), ("punctuation_symbol", "!hi", True)]
    df = spark.createDataFrame(cases, "name string, s string, expected boolean")
    for name, s, expected in cases:
        got = df.where(F.col("s") == s).select(rx.matches(F.col("s"), rx.PATTERNS[name]).alias("m")).first()["m"]
        assert got == expected, (name, s)


def test_c33_c34_find_and_groups(spark):
    df = spark.createDataFrame([("mail x.y@a.example.org and z@b.io now",)], "t string")
    found = df.select(rx.find_all(F.col("t"), rx.EMAIL_FIND).alias("f")).first()["f"]
    assert found == ["x.y@a.example.org", "z@b.io"]
    e = spark.createDataFrame([("x.y@a.example.org",)], "e string")
    g = e.select(*rx.match_groups(F.col("e"), rx.PATTERNS["email"], [1, 2, 6])).first()
    assert tuple(g) == ("x.y", "a.example.", "org")


def test_c35_c36_scorecards(spark):
    cases = spark.createDataFrame([("12:30", True, ["12", "30"]), ("1230", False, None), ("99:99", True, None)],
                                  "string string, expected boolean, groups array<string>")
    assert tuple(rx.scorecard(cases, r"^[0-9]{2}:[0-9]{2}$").first()) == (3, 3)
    assert tuple(rx.capture_scorecard(cases, r"^([0-9]{2}):([0-9]{2})$", 2).first()) == (3, 3)
    bad = spark.createDataFrame([("12:30", True, ["12", "31"])], "string string, expected boolean, groups array<string>")
    assert tuple(rx.capture_scorecard(bad, r"^([0-9]{2}):([0-9]{2})$", 2).first()) == (0, 1)


def test_driver_contract():
    import __spark_entry__ as entry
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 70 and len(sqls) >= 50
    from ratecraft.plans.catalog import load_all
    for name in load_all():  # the library's own queries
        assert "pipeline" not in name and not name.startswith("op")


def test_oracle_sql_parses():
    import duckdb
    import __spark_entry__ as entry
    from ratecraft.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    for name, sql in entry.oracle_sql().items():
        con.execute("EXPLAIN " + sql)  # binds every table and column
