"""Registered queries: text preparation and corpus statistics over whole
documents (M18, M19, A14–A18, C12–C24) and regex operators (C32–C34)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratecraft.functions import regexes as rx
from ratecraft.functions import text as tx
from ratecraft.operators import corpus as cp
from ratecraft.plans import oracle_sql as q
from ratecraft.plans.catalog import query
from ratecraft.plans.queries_core import r6
from ratecraft.session import cut_lineage
from ratecraft.sources import ratings as rt
from ratecraft.sources.tables import read_table

BIGRAMS_N = 5
TOP_FREQUENT_N = 3


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_STOP = "[" + ", ".join(_sql_str(w) for w in tx.STOP_WORDS_EN) + "]"


def _clean_sql(src: str, key: str, text: str) -> list[str]:
    """CTEs d, cl, tk, lg, tf for a (key, text) source."""
    return [
        f"d AS (SELECT {key} AS RowID, {text} AS text FROM {src})",
        "cl AS (SELECT RowID, regexp_replace(regexp_replace(coalesce(text, ''), "
        f"{_sql_str(tx.NON_ASCII)}, '', 'g'), {_sql_str(tx.NOT_WORD_OR_SPACE)}, '', 'g') AS c FROM d)",
        "tk AS (SELECT RowID, list_filter(list_transform(string_split(c, ' '), lambda x: lower(x)), "
        f"lambda x: length(x) >= 2 AND NOT list_contains({_STOP}, x)) AS tokens FROM cl)",
        "lg AS (SELECT RowID, unnest(tokens) AS tok, generate_subscripts(tokens, 1) AS pos FROM tk)",
        "tf AS (SELECT tok AS term, count(*) AS n FROM lg GROUP BY tok)",
    ]


def _chain_sql(src: str, key: str, text: str, bigrams: int, top_n: int) -> list[str]:
    ctes = _clean_sql(src, key, text) + [
        "kept AS (SELECT lg.RowID, lg.pos, lg.tok FROM lg JOIN tf ON lg.tok = tf.term WHERE tf.n > 1)",
        "rg AS (SELECT RowID, string_agg(tok, ' ' ORDER BY pos) AS t FROM kept GROUP BY RowID)",
        "base AS (SELECT d.RowID, coalesce(rg.t, '') AS t FROM d LEFT JOIN rg ON d.RowID = rg.RowID)",
        "bg AS (SELECT a.tok AS a, b.tok AS b, count(*) AS n FROM lg a JOIN lg b "
        "ON a.RowID = b.RowID AND b.pos = a.pos + 1 GROUP BY a.tok, b.tok)",
        f"topb AS (SELECT a, b, row_number() OVER (ORDER BY n DESC, a, b) AS rk FROM bg "
        f"ORDER BY n DESC, a, b LIMIT {bigrams})",
        f"topw AS (SELECT list(term ORDER BY n DESC, term) AS words FROM "
        f"(SELECT term, n FROM tf ORDER BY n DESC, term LIMIT {top_n}))",
    ]
    expr = "t"
    for k in range(1, bigrams + 1):
        pat = f"(SELECT '\\b' || a || ' ' || b || '\\b' FROM topb WHERE rk = {k})"
        rep = f"(SELECT a || '_' || b FROM topb WHERE rk = {k})"
        expr = f"coalesce(regexp_replace({expr}, {pat}, {rep}, 'g'), {expr})"
    ctes.append(f"merged AS (SELECT RowID, {expr} AS t FROM base)")
    ctes.append("final AS (SELECT m.RowID, array_to_string(list_filter(string_split(m.t, ' '), "
                "lambda x: NOT list_contains(w.words, x)), ' ') AS t FROM merged m, topw w)")
    return ctes


@query("document_text_clean", sql=q.with_ctes(*_chain_sql("documents", "doc_id", "text",
                                                             BIGRAMS_N, TOP_FREQUENT_N))
       + "SELECT RowID, t AS text FROM final", bench=True)
def document_text_clean(spark, sf):
    docs = read_table(spark, sf, "documents", "doc_id", "text").withColumnRenamed("doc_id", "RowID")
    return cp.prepare_text(docs, "text", remove_top_frequent=TOP_FREQUENT_N, top_bigrams_n=BIGRAMS_N)


def _doc_tokens(spark, sf):
    docs = read_table(spark, sf, "documents", "doc_id", "text").withColumnRenamed("doc_id", "RowID")
    return cp.tokenize(docs, "text")


_DOC = _clean_sql("documents", "doc_id", "text")


@query("term_frequency", sql=q.with_ctes(*_DOC) + "SELECT term, n FROM tf")
def term_frequency(spark, sf):
    return cp.term_frequency(cp.explode_tokens(_doc_tokens(spark, sf)))


@query("hapax_terms", sql=q.with_ctes(*_DOC) + "SELECT term FROM tf WHERE n = 1")
def hapax_terms(spark, sf):
    return cp.hapaxes(cp.term_frequency(cp.explode_tokens(_doc_tokens(spark, sf))))


@query("top_terms", sql=q.with_ctes(*_DOC) + "SELECT term, n FROM tf ORDER BY n DESC, term LIMIT 20")
def top_terms(spark, sf):
    return cp.most_common(cp.term_frequency(cp.explode_tokens(_doc_tokens(spark, sf))), 20)


@query("top_bigrams", sql=q.with_ctes(*_DOC) + """
SELECT a.tok AS a, b.tok AS b, count(*) AS n FROM lg a JOIN lg b
  ON a.RowID = b.RowID AND b.pos = a.pos + 1
GROUP BY a.tok, b.tok ORDER BY n DESC, a, b LIMIT 20""")
def top_bigrams(spark, sf):
    return cp.bigram_frequency(_doc_tokens(spark, sf)).orderBy(F.desc("n"), "a", "b").limit(20)


@query("top_bigrams_corpus", sql=q.with_ctes(*_DOC, """seq AS (
  SELECT tok, row_number() OVER (ORDER BY RowID, pos) AS g FROM lg)""") + """
SELECT a.tok AS a, b.tok AS b, count(*) AS n FROM seq a JOIN seq b ON b.g = a.g + 1
GROUP BY a.tok, b.tok ORDER BY n DESC, a, b LIMIT 20""")
def top_bigrams_corpus(spark, sf):
    """Bigrams over the whole corpus in document order (pairs cross document ends)."""
    tok = cut_lineage(_doc_tokens(spark, sf))  # read for the ranges, the ends and the pairs
    return cp.corpus_bigram_frequency(tok).orderBy(F.desc("n"), "a", "b").limit(20)


@query("vocabulary_size", sql=q.with_ctes(*_DOC) + """
SELECT count(*) AS n_words, count(DISTINCT tok) AS n_vocab FROM lg""")
def vocabulary_size(spark, sf):
    long = cp.explode_tokens(_doc_tokens(spark, sf))
    return long.agg(F.count(F.lit(1)).alias("n_words"), F.countDistinct("tok").alias("n_vocab"))


# ---------------------------------------------------------------- M19 / K5 / C23 / C24
@query("beername_label_corpus", sql=q.with_ctes(
    q.NAMED_RATINGS_CTE, *_chain_sql("named", "RowID", "BeerName", 0, 0)[:-2],
    "final AS (SELECT RowID, t FROM base)") + """
SELECT f.RowID,
       '__label__' || CAST(n.rating AS VARCHAR) || ' ' || f.t AS BeerNameLabel,
       round((TRY_CAST(trim(replace('__label__' || CAST(n.rating AS VARCHAR), '__label__', ''))
              AS DOUBLE)) + 1e-10, 6) AS label_value
FROM final f JOIN named n ON f.RowID = n.RowID WHERE n.split <> 'test'""")
def beername_label_corpus(spark, sf):
    named = rt.ratings(spark, sf)
    # test rows carry no rating in the reference's files (S4): null it here
    named = named.withColumn("rating", F.when(F.col("split") == "test", F.lit(None))
                             .otherwise(F.col("rating")))
    clean = cp.prepare_text(named.select("RowID", "BeerName"), "BeerName")
    corpus = cp.supervised_corpus(clean, named, "BeerName")
    value = tx.label_to_number(F.split(F.col("BeerNameLabel"), " ").getItem(0))
    return corpus.withColumn("label_value", r6(value))


# ---------------------------------------------------------------- C32–C34
_WS = "[ \\t\\n\\r\\f]+"


@query("regex_token_classes", sql=q.with_ctes(
    "tok AS (SELECT unnest(regexp_split_to_array(text, " + _sql_str(_WS) + ")) AS t FROM documents)",
    "counts AS (SELECT " + ", ".join(
        f"CAST(count_if(regexp_matches(t, {_sql_str(rx.anchored(p))})) AS BIGINT) AS \"{k}\""
        for k, p in rx.PATTERNS.items()) + " FROM tok)")
    + " UNION ALL ".join(f"SELECT '{k}' AS pattern, \"{k}\" AS n FROM counts" for k in rx.PATTERNS))
def regex_token_classes(spark, sf):
    docs = read_table(spark, sf, "documents", "text")
    toks = docs.select(F.explode(F.split("text", _WS)).alias("t"))
    wide = toks.agg(*[F.count_if(rx.matches(F.col("t"), p)).alias(k) for k, p in rx.PATTERNS.items()])
    return wide.unpivot([], list(rx.PATTERNS), "pattern", "n")


@query("email_findall", sql=f"""
SELECT doc_id, len(regexp_extract_all(text, {_sql_str(rx.EMAIL_FIND)})) AS n_emails,
       array_to_string(regexp_extract_all(text, {_sql_str(rx.EMAIL_FIND)}), ',') AS emails
FROM documents""")
def email_findall(spark, sf):
    docs = read_table(spark, sf, "documents", "doc_id", "text")
    found = rx.find_all(F.col("text"), rx.EMAIL_FIND)
    return docs.select("doc_id", F.size(found).cast("long").alias("n_emails"),
                       F.array_join(found, ",").alias("emails"))


@query("email_parts", sql=f"""
WITH e AS (SELECT doc_id, unnest(regexp_extract_all(text, {_sql_str(rx.EMAIL_FIND)})) AS email
           FROM documents)
SELECT doc_id, email,
  regexp_extract(email, {_sql_str(rx.anchored(rx.PATTERNS['email']))}, 1) AS user_part,
  regexp_extract(email, {_sql_str(rx.anchored(rx.PATTERNS['email']))}, 2) AS domain_part,
  regexp_extract(email, {_sql_str(rx.anchored(rx.PATTERNS['email']))}, 6) AS tld
FROM e""")
def email_parts(spark, sf):
    docs = read_table(spark, sf, "documents", "doc_id", "text")
    e = docs.select("doc_id", F.explode(rx.find_all(F.col("text"), rx.EMAIL_FIND)).alias("email"))
    user, domain, tld = rx.match_groups(F.col("email"), rx.PATTERNS["email"], [1, 2, 6])
    return e.select("doc_id", "email", user.alias("user_part"), domain.alias("domain_part"),
                    tld.alias("tld"))


_EMAIL_RX = _sql_str(rx.anchored(rx.PATTERNS["email"]))


@query("regex_scorecards", sql=f"""
WITH e AS (SELECT unnest(regexp_extract_all(text, {_sql_str(rx.EMAIL_FIND)})) AS email FROM documents),
c AS (SELECT email AS string, true AS expected FROM e UNION ALL SELECT email || ' x', false FROM e
      UNION ALL SELECT replace(email, '@', ' at '), false FROM e)
SELECT 'match' AS kind, count(*) FILTER (regexp_matches(string, {_EMAIL_RX}) = expected) AS passed, count(*) AS total FROM c
UNION ALL
SELECT 'capture', count(*) FILTER (CASE WHEN expected AND regexp_matches(string, {_EMAIL_RX})
    THEN regexp_extract(string, {_EMAIL_RX}, 1) = string_split(string, '@')[1] ELSE regexp_matches(string, {_EMAIL_RX}) = expected END),
  count(*) FROM c""")
def regex_scorecards(spark, sf):
    """Addresses found in the documents must match, altered ones must not; group 1 is the user part."""
    docs = read_table(spark, sf, "documents", "text")
    e = docs.select(F.explode(rx.find_all(F.col("text"), rx.EMAIL_FIND)).alias("email"))
    cases = e.select(F.explode(F.array(
        F.struct(F.col("email").alias("string"), F.lit(True).alias("expected")),
        F.struct(F.concat("email", F.lit(" x")).alias("string"), F.lit(False).alias("expected")),
        F.struct(F.replace("email", F.lit("@"), F.lit(" at ")).alias("string"), F.lit(False).alias("expected")))).alias("c")).select("c.*")
    cases = cases.withColumn("groups", F.when(F.col("expected"), F.array(F.substring_index("string", "@", 1))))
    return (rx.scorecard(cases, rx.PATTERNS["email"]).select(F.lit("match").alias("kind"), "passed", "total")
            .unionByName(rx.capture_scorecard(cases, rx.PATTERNS["email"], 1)
                         .select(F.lit("capture").alias("kind"), "passed", "total")))
