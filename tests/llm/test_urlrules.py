"""op13: all rules on all urls by plain Python, index and candidates, odd rows."""
import random
import re

from pyspark.sql import functions as F

from ratecraft.llm import urlrules

ODD = [None, "", "no scheme/org/", "http://", "http://ORG", "http://a.org/", "http://a.org?x=/", "http://notorg/", "ftp://EXAMPLE.org/es/x#y",
       "http://x.example.org/en/1", "http://x.example.org/en/12?q", "http://x.example.org/en/2", "http://a.com/fr/1", "http://a.com/FR/1",
       "http://a.com/de/", "http://casino-win.example.com/en/", "http://m.casino-x/", "http://mycasino-x/", "http://a.com://b.org/de/",
       "http://Ä.ORG/\npath", "http://b-pills.shop/x", "http://org/" + "long/" * 4000, "https://a.com:80/de/", "://example.org/es/"]


def plain(url, rules):
    """Host, path and the winning rule by trying every rule."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest).groups()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = []
    for rule, verdict, tier in rules:
        whole = rule.endswith("|")
        h, slash, p = rule.rstrip("|").partition("/")
        expr = r"(?:.*\.)?" + ".*".join(map(re.escape, h.split("*")))
        want = ".*".join(map(re.escape, (slash + p).split("*")))
        ok = re.fullmatch(expr, host, re.S) and (not slash or (re.fullmatch if whole else re.match)(want, path, re.S))
        if ok and rest:
            fits.append((tier, -len(rule), rule, verdict != "block", verdict))
    best = min(fits, default=None)
    return host, path, best and best[2], best[4] if best else "allow"


def check(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns(
        {c: F.lit("x") for c in ("host", "path", "rule", "tier", "verdict", "token", "target", "__key")})
    table = spark.createDataFrame(rules, "rule string, verdict string, tier int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlrules.judge(pages, table).collect()}
    assert got == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_contract_rules_on_odd_urls(spark):
    rules = [(r, v, t) for t, tier in enumerate((urlrules.SITES, urlrules.PATTERNS)) for r, v in tier]
    check(spark, ODD + ODD, rules)


def test_random_rules_and_urls(spark):
    rng = random.Random(2)
    label = lambda: rng.choice(["a", "b1", "cc", "org", "com", "x-y"])
    urls = [f"http://{'.'.join(label() for _ in range(rng.randrange(1, 4)))}" + "".join(
        "/" + label() for _ in range(rng.randrange(0, 4))) + rng.choice(["", "/", "?a/b", "#a"]) for _ in range(400)]
    rules = set()
    while len(rules) < 80:
        host = ".".join(rng.choice([label(), label(), "*"]) for _ in range(rng.randrange(1, 3)))
        path = "".join("/" + rng.choice([label(), label()[:1], "*", label() + "*"]) for _ in range(rng.randrange(0, 3)))
        rules.add((host + path + rng.choice(["", "", "|" if path else ""]), rng.choice(["allow", "block"]), rng.randrange(2)))
    check(spark, urls, sorted(rules) + [("*", "block", 2)])


def test_index_takes_the_rarest_literal_token(spark):
    pages = spark.createDataFrame([(i, f"http://h{i}.example.{'com' if i % 3 else 'org'}/{'de' if i % 9 == 0 else 'en'}/{i}")
                                   for i in range(90)], "page_id long, url string")
    rules = urlrules.rule_rows(spark, (("example.org/de/", "block"), ("example.*/en/7", "block"), ("*", "allow"), ("nowhere.net/", "block")))
    urls = urlrules.url_tokens(pages)
    index = urlrules.token_index(rules, urls)
    assert {r["rule"]: r["token"] for r in index.collect()} == {
        "example.org/de/": "de", "example.*/en/7": "en", "*": "", "nowhere.net/": "net"}
    fetched = urlrules.candidates(urls, index).groupBy("rule").count().collect()
    assert {r["rule"]: r["count"] for r in fetched} == {"example.org/de/": 10, "example.*/en/7": 80, "*": 90}


def test_repeated_nulls_empty_tables_and_no_rules(spark):
    pages = spark.createDataFrame([(None, None), (None, None), (1, "http://a.org/"), (1, "http://a.org/")], "page_id long, url string")
    got = urlrules.judge(pages, urlrules.rule_rows(spark, urlrules.SITES))
    assert sorted(map(str, got.collect())) == sorted(
        ["Row(page_id=None, host='', path='', rule=None, tier=None, verdict='allow')"] * 2
        + ["Row(page_id=1, host='a.org', path='/', rule='org/', tier=0, verdict='allow')"] * 2)
    assert urlrules.judge(pages.limit(0), urlrules.rule_rows(spark, urlrules.SITES)).count() == 0
    assert {r["verdict"] for r in urlrules.judge(pages, urlrules.rule_rows(spark), default="block").collect()} == {"block"}
    broken = spark.createDataFrame([(None, "block", 0), ("org/", None, 0)], "rule string, verdict string, tier int")
    assert {r["rule"] for r in urlrules.judge(pages, broken).collect()} == {None}


def test_main_path_is_native(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    plan = urlrules.judge(pages, urlrules.rule_rows(spark, urlrules.SITES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
