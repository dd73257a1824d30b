"""URL filters: pattern rules indexed by their rarest literal token (native).

A rule is ``host/path``: it fits the host and all its subdomains if the path
starts with the rule's path.  ``*`` stands for any characters (in the host: none
of them a slash), a final ``|`` ends the path there, a rule without a slash fits
every path.  Rules have a tier (0 before 1) and a verdict.  A url takes the verdict of
the fitting rule of the lowest tier; in it the longest rule wins (ties: the
smaller text, then ``block``).

Every rule becomes a regular expression.  Its literal tokens are the runs of
ASCII letters and digits that any fitting url must hold as whole runs: bounded
in the rule by other literal characters, not by ``*`` or the open end.  The
index keeps a rule under the one of them that the fewest urls hold.  A url
fetches the rules of its own tokens by an equi-join, and only those run their
expression on it.  A rule without such a token runs on every url.

Distinct urls are judged once.  The rule side of a join is broadcast only if
its measured size is under the session's threshold; else both sides shuffle on
the token, where the rules' choice of rare tokens keeps hot ones out.  Urls that no rule can fit
(null, no ``://``) take no part in the join back.

Edge cases: a null url or one without ``://`` has an empty host and path, no
rule and the default verdict; of the host only A-Z are lower-cased; repeated
rows are judged each; very long urls are read whole; empty tables of pages give
an empty table, empty rule tables the default verdict; null rules are skipped;
only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm.common import saved, table

#: Rules of single sites: (rule, verdict).
SITES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
         ("com/de/", "block"))
#: Patterns of unwanted hosts, asked where no site rule fits.
PATTERNS = (("casino-*/", "block"), ("*-pills.*/", "block"), ("spam-*/", "block"), ("free-bets.*/", "block"),
            ("ads-track.*/", "block"))
_ASCII = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_SPECIAL = r"([\\.\[\]{}()+?^$|])"


def rule_rows(spark: SparkSession, *tiers: Sequence[tuple[str, str]]) -> DataFrame:
    """(rule, verdict, tier) of short lists; longer ones are tables with these columns."""
    rows = [F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict"), F.lit(t).alias("tier"))
            for t, rules in enumerate(tiers) for r, v in rules]
    if not rows:
        return spark.range(0).select(*[F.lit("").alias(c) for c in ("rule", "verdict")], F.lit(0).alias("tier"))
    return spark.range(1).select(F.inline(F.array(*rows)))


def compiled(rules: DataFrame) -> DataFrame:
    """(rule, verdict, tier, pattern, tokens): the expression over host and path, and the literal tokens."""
    rows = rules.where("rule is not null and verdict is not null")
    rows = rows.withColumn("whole", F.endswith("rule", F.lit("|")))
    rows = rows.withColumn("body", F.when(F.col("whole"), F.expr("substring(rule, 1, length(rule) - 1)")).otherwise(F.col("rule")))
    rows = rows.withColumn("host", F.translate(F.substring_index("body", "/", 1), *_ASCII))
    rows = rows.withColumn("path", F.expr("substring(body, length(host) + 1)"))
    quoted = lambda c: F.regexp_replace(F.col(c), _SPECIAL, r"\\$1")
    end = F.when(F.col("path") == "", r"(?:/|\z)").when(F.col("whole"), r"\z").otherwise("")
    pattern = F.concat(F.lit(r"(?s)^(?:[^/]*\.)?"), F.replace(quoted("host"), F.lit("*"), F.lit("[^/]*")),
                       F.replace(quoted("path"), F.lit("*"), F.lit(".*")), end)
    bounded = F.concat("host", "path", F.when((F.col("path") == "") | F.col("whole"), "").otherwise("*"))
    tokens = F.regexp_extract_all(bounded, F.lit(r"(?<![A-Za-z0-9*])[A-Za-z0-9]+(?![A-Za-z0-9*])"), F.lit(0))
    return rows.select("rule", "verdict", "tier", pattern.alias("pattern"), F.array_distinct(tokens).alias("tokens"))


def parsed(url: str) -> dict[str, Column]:
    """Host and path of a url column."""
    after = F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")
    inside = F.when(F.instr(F.col(url), "://") > 0, after).otherwise("")
    host = F.regexp_extract(inside, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(inside, r"(?s)^[^/?#]*([^?#]*)", 1)
    return {"host": F.translate(host, *_ASCII), "path": path}


def url_tokens(pages: DataFrame, url: str = "url") -> DataFrame:
    """(url, target, tokens) of every distinct url with ``://``."""
    urls = pages.where(F.instr(F.col(url), "://") > 0).select(F.col(url).alias("url")).distinct()
    urls = urls.select("url", F.concat(*parsed("url").values()).alias("target"))
    return urls.withColumn("tokens", F.array_distinct(F.regexp_extract_all("target", F.lit(r"[A-Za-z0-9]+"), F.lit(0))))


def token_index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """(token, rule, verdict, tier, pattern): each rule under its rarest literal token, '' if it has none."""
    literal = compiled(rules).withColumn("token", F.explode_outer("tokens")).drop("tokens")
    wanted = literal.where("token is not null").select("token").distinct()
    held = urls.select(F.explode("tokens").alias("token")).join(wanted, "token", "left_semi")
    counts = held.groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    ranked = literal.join(counts, "token", "left").groupBy("rule", "verdict", "tier", "pattern").agg(
        F.min(F.when(F.col("token").isNotNull(), F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token"))).alias("m"))
    return ranked.select(F.coalesce("m.token", F.lit("")).alias("token"), "rule", "verdict", "tier", "pattern")


def candidates(urls: DataFrame, index: DataFrame) -> DataFrame:
    """(url, target, rule, verdict, tier, pattern): the rules that each url's tokens fetch."""
    return urls.select("url", "target", F.explode(F.concat("tokens", F.array(F.lit("")))).alias("token")).join(index, "token")


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """(key, host, path, rule, tier, verdict) of every page; rule and tier are null where none fits."""
    urls = saved(url_tokens(pages, url), "urls")
    index = saved(token_index(rules, urls), "url-rules")
    fits = candidates(urls, index).where(F.rlike(F.col("target"), F.col("pattern")))
    best = F.struct(F.col("tier"), (-F.length("rule")).alias("l"), F.col("rule"),
                    F.when(F.col("verdict") == "block", 0).otherwise(1).alias("b"), F.col("verdict"))
    won = fits.groupBy("url").agg(F.min(best).alias("best")).select("url", "best.rule", "best.tier", "best.verdict")
    slim = pages.select(F.col(key).alias("__key"), F.col(url).alias("url"))
    can = F.instr("url", F.lit("://")) > 0
    judged = slim.where(can).join(won, "url", "left").select("__key", "url", "rule", "tier", "verdict")
    rest = slim.where(~F.coalesce(can, F.lit(False))).select("__key", "url", *[
        F.lit(None).cast(t).alias(c) for c, t in (("rule", "string"), ("tier", "int"), ("verdict", "string"))])
    return judged.unionByName(rest).select(F.col("__key").alias(key), *[c.alias(n) for n, c in parsed("url").items()],
                                           "rule", "tier", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def op13_url_filters(spark, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "pages").select("page_id", "url"), rule_rows(spark, SITES, PATTERNS))
    of = lambda tier: F.when(F.col("tier") == tier, F.col("rule"))
    return out.select("page_id", "host", "path", of(0).alias("rule"), of(1).alias("pattern"), "verdict")


def _sql_fits(rules) -> str:
    """Each rule's test, written with plain functions."""
    out = []
    for rule, verdict in rules:
        host, _, path = rule.partition("/")
        like = host.replace("*", "%")
        fits = (f"(host like '{like}' or host like '%.{like}') and starts_with(path, '/{path}')")
        out.append(f"select page_id, url, '{rule}' as rule, '{verdict}' as verdict from p where {fits}")
    return " union all ".join(out)


OP13_SQL = f"""
with u as (select page_id, url, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
p as (select page_id, url, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{_ASCII[0]}', '{_ASCII[1]}') as host,
  regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path from u),
s as (select distinct on (url) url, rule, verdict from ({_sql_fits(SITES)}) order by url, length(rule) desc, rule),
m as (select distinct on (url) url, rule, verdict from ({_sql_fits(PATTERNS)}) order by url, length(rule) desc, rule)
select page_id, host, path, s.rule, case when s.rule is null then m.rule end as pattern,
  coalesce(s.verdict, m.verdict, 'allow') as verdict from p left join s on p.url = s.url left join m on p.url = m.url
"""
