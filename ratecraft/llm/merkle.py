"""Document fingerprints as Merkle trees (native).

Sections (cut at empty lines) hold paragraphs (lines), paragraphs hold leaves
(up to ``LEAF_WORDS`` words with the white space after them).  Every leaf, paragraph
and section has a SHA-256 digest over its children's; the root is that over the
sections'.  The cuts lose no character, so equal roots mean equal texts.

The fingerprint string is the root, ``|``, then the shortened leaf digests:
``,`` between leaves, ``;`` between paragraphs, ``/`` between sections.
``likeness`` is twice the shared over the summed numbers of distinct leaves (plus
one if the roots differ, so only equal roots give 1); ``differing`` locates an edit.

Edge cases: a null text is the empty text (one section, one paragraph, no
leaf); rows equal in key and text count as one document in the order and get
equal results; null keys come last in the descending order, as the smallest
long (keys are longs); a single document is its own successor; an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.llm.common import ordered_parts, table

LEAF_WORDS = 4
#: Hex digits of a leaf digest inside a fingerprint string.
LEAF_DIGITS = 8
#: Stands for a null key.
NO_KEY = -(1 << 63)
_SPACE = r"\x20\x09-\x0D"
_LEAF = rf"[{_SPACE}]*(?:[^{_SPACE}]+[{_SPACE}]*){{1,{LEAF_WORDS}}}|[{_SPACE}]+"


def _sha(text: Column) -> Column:
    return F.sha2(text, 256)


def tree(text: Column) -> Column:
    """``array<array<array<string>>>``: sections, paragraphs, full leaf digests."""
    leaves = lambda p: F.transform(F.regexp_extract_all(p, F.lit(_LEAF), F.lit(0)), _sha)
    return F.transform(F.split(text, "\n\n"), lambda s: F.transform(F.split(s, "\n"), leaves))


def fingerprint(text: Column) -> Column:
    """Fingerprint string of a text column (null: as empty)."""
    nodes = tree(F.coalesce(text, F.lit("")))
    root = _sha(F.array_join(F.transform(nodes, lambda s: _sha(F.array_join(
        F.transform(s, lambda p: _sha(F.array_join(p, ","))), ","))), ","))
    short = F.array_join(F.transform(nodes, lambda s: F.array_join(F.transform(s, lambda p: F.array_join(
        F.transform(p, lambda x: F.substring(x, 1, LEAF_DIGITS)), ",")), ";")), "/")
    return F.concat(root, F.lit("|"), short)


def likeness(a: Column, b: Column) -> Column:
    """Share of common leaves of two fingerprints, 0 to 1; 1 only for equal roots."""
    leaves = lambda x: F.array_distinct(F.split(F.substring_index(x, "|", -1), "[,;/]"))
    common = F.size(F.array_except(F.array_intersect(leaves(a), leaves(b)), F.array(F.lit(""))))
    return F.when(a == b, F.lit(1.0)).otherwise(2 * common / (F.size(leaves(a)) + F.size(leaves(b)) + 1))


def differing(a: Column, b: Column) -> Column:
    """Where two fingerprints differ: ``section.paragraph`` numbers (from 0) present in either."""
    def branches(x: Column) -> Column:
        sections = F.split(F.substring_index(x, "|", -1), "/")
        return F.flatten(F.transform(sections, lambda s, i: F.transform(
            F.split(s, ";"), lambda p, j: F.concat(i.cast("string"), F.lit("."), j.cast("string"), F.lit("="), p))))
    only = F.concat(F.array_except(branches(a), branches(b)), F.array_except(branches(b), branches(a)))
    return F.array_distinct(F.transform(only, lambda x: F.substring_index(x, "=", 1)))


def _id(key: str) -> Column:
    return F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY))


def successors(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per distinct (key, text hash) ``id, h, n`` those of the next one, descending key, as ``next``.

    The order is cut into ranges; only the first row of each range, one per
    shuffle partition, is seen across ranges.
    """
    order = [F.col("id").desc(), F.col("h")]
    slim = docs.select(_id(key).alias("id"), F.xxhash64(text).alias("h"), F.length(text).alias("n")).distinct()
    parts = ordered_parts(slim, order, "merkle-order")
    here = F.struct("id", "h", "n")
    inside = Window.partitionBy("__part").orderBy(*order)
    rows = parts.withColumns({"__lead": F.lead(here).over(inside), "__nth": F.row_number().over(inside)})
    heads = rows.where("__nth = 1").select("__part", here.alias("__head"))
    over_parts = Window.orderBy("__part")
    whole = over_parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("__part", F.coalesce(F.lead("__head").over(over_parts),
                                              F.first("__head").over(whole)).alias("__after"))
    return rows.join(heads, "__part").select("id", "h", "n", F.coalesce("__lead", "__after").alias("next"))


def with_edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row with its fingerprint, its edited text and the next document's fingerprint.

    The edit replaces the last third of the characters by the first as many of
    the next document.  Texts are shuffled once by key; a successor sends on
    only the characters asked for and its fingerprint.
    """
    third = lambda n: F.floor(n / F.lit(3)).cast("int")
    slim = docs.select(F.col(key), F.coalesce(text, F.lit("")).alias("text"))
    order = successors(slim, key, "text")
    asked = order.select(F.col("next.id").alias("id"), F.col("next.h").alias("h"),
                         F.col("id").alias("to_id"), F.col("h").alias("to_h"), third(F.col("n")).alias("take"))
    rows = slim.select("text", _id(key).alias("id"), F.xxhash64("text").alias("h"))
    rows = rows.join(asked, ["id", "h"]).withColumn("fp", fingerprint(F.col("text")))
    sent = rows.select("to_id", "to_h", F.struct(F.expr("substring(text, 1, take)").alias("head"), "fp").alias("s"))
    sent = sent.groupBy(F.col("to_id").alias("id"), F.col("to_h").alias("h")).agg(F.any_value("s").alias("s"))
    # both branches read the same columns, so Spark shuffles the texts once and reuses them
    both = rows.select("id", "h", "text", "fp").join(sent, ["id", "h"])
    n = F.length("text")
    kept = F.substring(F.col("text"), F.lit(1), n - third(n))
    return both.select(F.nullif("id", F.lit(NO_KEY)).alias("key"), n.cast("long").alias("n_chars"), "fp", F.concat(kept, F.col("s.head")).alias("edited"),
                       F.col("s.fp").alias("next_fp"))


def op3_merkle_fingerprints(spark, sf_dir: str) -> DataFrame:
    rows = with_edited(table(spark, sf_dir, "documents"))
    rows = rows.withColumn("edited_fp", fingerprint(F.col("edited")))
    return rows.select(
        F.col("key").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.col("fp").alias("fingerprint"), F.col("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))


def _sql_tree(text: str) -> str:
    return (f"list_transform(string_split({text}, chr(10) || chr(10)), lambda s: list_transform("
            f"string_split(s, chr(10)), lambda p: list_transform(regexp_extract_all(p, '{_LEAF}'), lambda x: sha256(x))))")


_SQL_FP = ("sha256(array_to_string(list_transform({t}, lambda s: sha256(array_to_string(list_transform(s, "
           "lambda p: sha256(array_to_string(p, ','))), ','))), ',')) || '|' || array_to_string(list_transform({t}, "
           "lambda s: array_to_string(list_transform(s, lambda p: array_to_string(list_transform(p, "
           f"lambda x: substr(x, 1, {LEAF_DIGITS})), ',')), ';')), '/')")
_SQL_LEAVES = "list_distinct(string_split_regex(string_split({x}, '|')[2], '[,;/]'))"
_SQL_NEAR = ("case when {a} = {b} then 1.0::double else 2 * len(list_filter(list_intersect("
             + _SQL_LEAVES.replace("{x}", "{a}") + ", " + _SQL_LEAVES.replace("{x}", "{b}") + "), lambda x: x <> ''))::double / (len("
             + _SQL_LEAVES.replace("{x}", "{a}") + ") + len(" + _SQL_LEAVES.replace("{x}", "{b}") + ") + 1) end")
OP3_SQL = f"""
with d as (select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n from documents),
e as (select *, coalesce(lead(text) over (order by doc_id desc),
  first_value(text) over (order by doc_id desc)) as after from d),
f as (select *, substr(text, 1, n - n // 3) || substr(after, 1, n // 3) as edited from e),
t as (select *, {_sql_tree('text')} as t1, {_sql_tree('edited')} as t2, {_sql_tree('after')} as t3 from f),
p as (select *, {_SQL_FP.format(t='t1')} as fp, {_SQL_FP.format(t='t2')} as efp, {_SQL_FP.format(t='t3')} as nfp from t)
select doc_id, n::bigint as n_chars, sha256(edited) as edited_sha256, fp as fingerprint, efp as edited_fingerprint,
  {_SQL_NEAR.format(a='fp', b='efp')} as near_edited, {_SQL_NEAR.format(a='fp', b='nfp')} as near_next
from p
"""
