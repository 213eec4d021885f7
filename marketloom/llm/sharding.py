"""Stable sharding by weighted rendezvous hashing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# 52 bits of a digest are exact in a double.
_BITS = 52


def unit_hash(key: Column, salt: str) -> Column:
    """A number in (0, 1) that depends on the key's text and the salt only."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"/{salt}")))
    return (F.conv(F.substring(digest, 1, _BITS // 4), 16, 10).cast("double") + 0.5) / float(2**_BITS)


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the highest weighted score of the key.

    Shard s scores ``w / -ln(u)`` with u from key and s alone. A further shard
    can only win keys over, so none moves between the shards that were there;
    a shard gets rows in proportion to its weight. Equal scores go to the
    smaller shard, a null key to a shard like any other key. A shard of weight
    0 gets nothing.
    """
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must not be negative, and one must be positive")
    named = F.coalesce(key.cast("string"), F.lit("null"))
    scores = [
        F.struct((F.lit(float(w)) / -F.log(unit_hash(named, str(s)))).alias("score"), F.lit(-s).alias("shard"))
        for s, w in enumerate(weights)
        if w > 0
    ]
    best = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return (-best["shard"]).cast("int")


def with_slots(df: DataFrame, shard: str, key: str, rows_per_bucket: int = 50_000, slot: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps.

    A shard's rows are cut into buckets by a hash of the key, numbered within a
    bucket in key order, and moved by the sizes of the buckets before; no task
    holds a whole shard. Rows that agree in everything are interchangeable.
    Runs one count of the rows.
    """
    buckets = max(1, -(-df.count() // rows_per_bucket))
    named = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    b, base, at = "__bucket", "__base", "__at"
    df = df.withColumn(b, F.floor(unit_hash(named, "slot") * buckets).cast("long"))
    rest = [c for c in df.columns if c not in (b, shard, key) and not isinstance(df.schema[c].dataType, T.MapType)]
    from pyspark.sql import Window

    sizes = df.groupBy(shard, b).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(shard).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(
        F.col(shard).alias("__shard"), F.col(b).alias("__b"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(base)
    )
    inside = Window.partitionBy(shard, b).orderBy(key, *rest)
    numbered = df.withColumn(at, F.row_number().over(inside) - 1)
    joined = numbered.join(bases, (F.col(shard) == F.col("__shard")) & (F.col(b) == F.col("__b")))
    return joined.withColumn(slot, (F.col(base) + F.col(at)).cast("long")).drop("__shard", "__b", b, base, at)


def shard_documents(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None) -> DataFrame:
    """Shard and slot of every document, and its shard once ``grown`` holds.

    Returns doc_id, size (UTF-8 bytes of the text and 1; null text: 1),
    text_crc32 (unsigned; null text: that of no bytes), law ``key``, shard,
    slot and grown_shard (null without ``grown``). Repeated rows, null keys and
    empty tables are fine; other columns are not read.
    """
    key = F.col("doc_id")
    placed = docs.select(
        key,
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous_shard(key, weights).alias("shard"),
        (rendezvous_shard(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    out = with_slots(placed, "shard", "doc_id")
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
