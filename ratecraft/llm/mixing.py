"""Mixing sources to target weights by systematic sampling (native).

Within a source every document expects ``e = target / source size`` copies.
The expected copies (whole millionths, so sums are exact) are prefix-summed in
a fixed order, one random offset per source is added, and a document is emitted
once per integer boundary its interval crosses: ``floor(e)`` or ``ceil(e)``
times.  The order groups documents of like size, which keeps the taken words
near the target as well as the copies.

A source is cut into blocks (size class, hash of the key); windows run inside
blocks and the block totals give each block its offset, so a source with a
third of all rows is spread over thousands of tasks.

Edge cases: a null source is a source of its own, ordered last; a null or empty
text has size 0 and is sampled like any other document; repeated rows are
sampled one by one; sources of total size 0, and empty tables, get target 0 and
no copies; very long texts are counted whole.  Other columns pass through
``mix_sources``, whatever their names (but for the four it adds).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.llm.common import WORD, hex_number, ordered_parts, running, saved, table

#: Expected copies are counted in these parts of a copy.
UNIT = 1_000_000


def _size(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(blocks: DataFrame, weights: Sequence[float], ratio: float, cap: float) -> DataFrame:
    """Per source its size, target and expected copies in units.

    ``blocks`` has __source and __words.  Sources take the weights in code point
    order (null last), repeating.  The budget ``ratio * all words`` is filled up
    to a common level per weight; a source stops at ``cap`` times its size and
    the rest is shared again: source k is full exactly if raising every source
    to k's own level still fits the budget.
    """
    sizes = blocks.groupBy("__source").agg(F.sum("__words").alias("__size"))
    by_name = [F.col("__source").asc_nulls_last()]
    named = ordered_parts(sizes.withColumn("__one", F.lit(1).cast("long")), by_name, "mix-names")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    named = running(named, by_name, {"__rank": "__one"}).drop("__part").withColumn(
        "__w", F.element_at(turn, ((F.col("__rank") - 1) % len(weights) + 1).cast("int")))
    named = named.withColumn("__cap", F.col("__size") * F.lit(float(cap)))
    named = named.withColumn("__level", F.col("__cap") / F.col("__w"))
    by_level = [F.col("__level"), F.col("__rank")]
    leveled = ordered_parts(named, by_level, "mix-levels")
    filled = running(leveled, by_level, {"__caps": "__cap", "__ws": "__w"})
    all_w = leveled.agg(F.sum("__w")).scalar()
    budget = leveled.agg(F.sum("__size") * F.lit(float(ratio))).scalar()
    filled = saved(filled.withColumns({"__budget": budget, "__full": F.col("__caps") + F.col("__level") * (
        all_w - F.col("__ws")) <= budget}), "mix-full")
    used = filled.agg(F.coalesce(F.sum(F.when(F.col("__full"), F.col("__cap"))), F.lit(0.0))).scalar()
    open_w = filled.agg(F.sum(F.when(~F.col("__full"), F.col("__w")))).scalar()
    target = F.when(F.col("__full"), F.col("__cap")).otherwise((F.col("__budget") - used) / open_w * F.col("__w"))
    return filled.withColumn("__target", target).select(
        "__source", "__size", "__target",
        F.when(F.col("__size") > 0, F.floor(F.col("__target") / F.col("__size") * UNIT + 0.5)).otherwise(0)
        .cast("long").alias("__unit"))


def mix_sources(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source",
                weights: Sequence[float] = (3, 1, 2), ratio: float = 1.5, cap: float = 2.0,
                seed: int = 42) -> DataFrame:
    """``docs`` with ``__words, __size, __target`` and ``__copies`` (times it is taken)."""
    bits = F.bin(F.col("__words"))
    named = {key: "key", text: "text", source: "source"}
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in named]
    tie = F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if not kind.startswith("map")])
    # the caller's other columns travel as one struct, so their names can't meet the ones used here
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in named.items()], tie.alias("__tie"),
                       (F.struct(*rest) if rest else F.lit(True)).alias("rest"))
    rows = rows.withColumns({"__words": _size("text"), "__source": F.col("source")})
    rows = rows.withColumns({
        "__class": (F.length(bits) * 8 + F.conv(F.substring(F.rpad(bits, 4, "0"), 2, 3), 2, 10).cast("int")).cast("int"),
        "__block": hex_number(F.coalesce(F.col("key").cast("string"), F.lit("\\N")), 1, 2).cast("int")})
    cells = ["__source", "__class", "__block"]
    blocks = saved(rows.groupBy(*cells).agg(F.count(F.lit(1)).alias("__n"), F.sum("__words").alias("__words")),
                   "mix-blocks")
    targets = saved(source_targets(blocks, weights, ratio, cap), "mix-targets")
    same = lambda a, b: F.col(f"{a}.__source").eqNullSafe(F.col(f"{b}.__source"))
    before = Window.partitionBy("__source").orderBy("__class", "__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.alias("l").join(targets.alias("r"), same("l", "r")).select(
        "l.__source", "l.__class", "l.__block", "l.__n", "r.__size", "r.__target", "r.__unit")
    offset = hex_number(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), F.col("__source")), F.lit("\\N"))),
                        1, 10) % UNIT
    starts = starts.withColumn("__from", F.coalesce(F.sum(F.col("__n") * F.col("__unit")).over(before), F.lit(0))
                               + offset).drop("__n")
    inside = Window.partitionBy(*cells).orderBy("__words", F.col("key").asc_nulls_last(), "__tie")
    ranked = rows.withColumn("__rank", F.row_number().over(inside))
    joined = ranked.alias("l").join(starts.alias("r"), same("l", "r") & (F.col("l.__class") == F.col("r.__class"))
                                    & (F.col("l.__block") == F.col("r.__block")))
    kept = joined.select("l.*", "r.__size", "r.__target", "r.__unit", "r.__from")
    end = F.col("__from") + F.col("__rank") * F.col("__unit")
    copies = F.floor(end / F.lit(UNIT)) - F.floor((end - F.col("__unit")) / F.lit(UNIT))
    added = ("__words", "__size", "__target", "__copies")
    own = [F.col(named[c]).alias(c) if c in named else F.col("rest").getField(c).alias(c) for c in docs.columns if c not in added]
    return kept.withColumn("__copies", copies.cast("int")).select(*own, *added)


def emit(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per copy taken."""
    return mixed.where("__copies > 0").withColumn(
        "__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*columns)


def op8_source_mixing(spark, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", F.col("__words").alias("size"), F.col("__size").alias("source_size"),
                        F.col("__target").alias("target"), (F.col("__words") * F.col("__copies")).alias("taken"))


#: Rows of a documents relation ``{docs}`` with their copies, for this module's and the pipeline's SQL.
MIX_SQL = """
m_d as (select *, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as m_words from {docs}),
m_c as (select *, length(bin(m_words)) * 8 + ('0b' || substr(rpad(bin(m_words), 4, '0'), 2, 3))::int as m_class,
  ('0x' || substr(md5(doc_id::varchar), 1, 2))::int as m_block from m_d),
m_s as (select source, sum(m_words)::bigint as m_size from m_c group by source),
m_n as (select *, row_number() over (order by source nulls last) as m_rank from m_s),
m_w as (select *, [3.0::double, 1.0::double, 2.0::double][((m_rank - 1) % 3 + 1)::int] as w, m_size * 2.0::double as cap from m_n),
m_f as (select *, sum(cap) over (order by cap / w, m_rank) + cap / w * (sum(w) over () - sum(w) over (order by cap / w, m_rank))
  <= sum(m_size) over () * 1.5::double as m_full, sum(m_size) over () * 1.5::double as budget from m_w),
m_t as (select source, m_size, case when m_full then cap else
  (budget - coalesce(sum(case when m_full then cap end) over (), 0)) / sum(case when not m_full then w end) over () * w end as m_target
  from m_f),
m_u as (select *, case when m_size > 0 then floor(m_target / m_size * 1000000 + 0.5)::bigint else 0 end as unit,
  ('0x' || substr(md5('42:' || coalesce('=' || source, '\\N')), 1, 10))::bigint % 1000000 as m_from from m_t),
m_r as (select c.*, u.m_size, u.m_target, unit, m_from + unit *
  row_number() over (partition by c.source order by m_class, m_block, m_words, doc_id) as m_end
  from m_c c join m_u u on c.source is not distinct from u.source),
m_x as (select *, (m_end // 1000000 - (m_end - unit) // 1000000)::int as m_copies from m_r)"""

OP8_SQL = "with " + MIX_SQL.format(docs="documents") + """
select doc_id, m_words as size, m_size as source_size, m_target as target, m_words * m_copies as taken from m_x"""
