"""Sharding by weighted rendezvous hashing of stable record keys (native).

Every (key, shard) pair gets a uniform number from a hash; a record goes to the
shard with the largest ``ln(u) / weight``.  Adding a shard only adds one more
candidate per key, so a record either stays or moves to the new shard.

Edge cases: a null key hashes as the text ``\\N`` (all null keys share a shard),
a null text has 0 bytes (size 1) and a null CRC; repeated rows get the same
shard and separate slots; an empty table gives an empty result; other columns
pass through ``assign_shards`` untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.llm.common import hex_number, saved, table

#: Blocks a shard is cut into for numbering its slots.
SLOT_BLOCKS = 1024


def rendezvous(key: Column, weights: Sequence[float], seed: str = "") -> Column:
    """Index of the winning shard for ``key``; ties go to the lowest index."""
    name = F.coalesce(key.cast("string"), F.lit("\\N"))
    scores = []
    for s, w in enumerate(weights):
        if w <= 0:
            raise ValueError("shard weights must be positive")
        u = (hex_number(F.concat(F.lit(f"{seed}{s}:"), name), 1, 12) + F.lit(0.5)) / F.lit(float(16 ** 12))
        scores.append(F.struct((F.log(u) / F.lit(float(w))).alias("score"), F.lit(-s).alias("s")))
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return (-best.getField("s")).cast("int")


def assign_shards(df: DataFrame, key: str, weights: Sequence[float], out: str = "shard") -> DataFrame:
    """``df`` with the shard of each row: a projection, no shuffle."""
    return df.withColumn(out, rendezvous(F.col(key), weights))


def number_slots(df: DataFrame, shard: str, key: str, order: Sequence[str], out: str = "slot") -> DataFrame:
    """Gapless numbers from 0 within each shard, without one task per shard.

    Rows are numbered inside blocks (a hash of the key), and the blocks' row
    counts, at most ``SLOT_BLOCKS`` a shard, give each block its offset.  ``df``
    must be a written table: it is read twice.
    """
    block = F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("\\N"))), 1, 8),
                   16, 10).cast("long") % SLOT_BLOCKS
    rows = df.withColumn("__block", block)
    counts = rows.groupBy(shard, "__block").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(shard).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard, "__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(shard, "__block").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    numbered = rows.withColumn(out, F.row_number().over(inside).cast("long") - 1)
    return (numbered.join(offsets, [shard, "__block"])
            .withColumn(out, F.col(out) + F.col("__before")).drop("__block", "__before"))


def write_shards(df: DataFrame, key: str, weights: Sequence[float], path: str) -> None:
    """The records as Parquet, one folder a shard (``shard=<n>``)."""
    assign_shards(df, key, weights).write.partitionBy("shard").mode("overwrite").parquet(path)


def shard_report(docs: DataFrame, n_shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    equal = [1.0] * n_shards
    slim = docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.col(text).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col(key), equal).alias("shard"),
        rendezvous(F.col(key), [*equal, 1.0]).alias("grown_shard"))
    slim = saved(slim, "shards")
    return number_slots(slim, "shard", "doc_id", ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op10_rendezvous_sharding(spark, sf_dir: str) -> DataFrame:
    return shard_report(table(spark, sf_dir, "documents"))


def _sql_shard(n: int) -> str:
    scores = ", ".join(
        f"{{'u': ln((('0x' || substr(md5('{s}:' || doc_id::varchar), 1, 12))::bigint + 0.5) / 281474976710656.0), 's': {-s}}}"
        for s in range(n))
    return f"(-(list_max([{scores}]).s))::int"


OP10_SQL = f"""
with t as (select doc_id, text, regexp_extract_all(hex(encode(text)), '..') as bytes from documents),
crc_table as (select list(c order by i) as tab from (
  select i, list_reduce(list_prepend(i::bigint, [k::bigint for k in range(8)]),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end) as c
  from range(256) r(i))),
d as (select doc_id, (octet_length(encode(coalesce(text, ''))) + 1)::bigint as size,
  case when text is null then null else xor(list_reduce(list_prepend(4294967295::bigint,
    list_transform(bytes, lambda x: ('0x' || x)::bigint)),
    lambda c, b: xor(c >> 8, tab[(xor(c & 255, b) + 1)::bigint])), 4294967295::bigint) end as text_crc32,
  'key' as law, {_sql_shard(8)} as shard, {_sql_shard(9)} as grown_shard,
  ('0x' || substr(md5(doc_id::varchar), 1, 8))::bigint % {SLOT_BLOCKS} as block
  from t, crc_table)
select doc_id, size, text_crc32, law, shard,
  row_number() over (partition by shard order by block, doc_id, text_crc32, size) - 1 as slot, grown_shard
from d
"""
