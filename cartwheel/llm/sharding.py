"""Shards by vector bin packing: bytes, tokens and rows balanced jointly.

Rows are grouped by equal text, and a group is placed whole where the dot
product of its (bytes, tokens, rows) with the shards' residual capacity is
highest. Groups are as many as the rows, so they are not placed one by one on
the driver: each of the few heavy groups is an item of its own, and the light
ones are dealt into ``PARCELS`` parcels by the hash of their text. The number
of items is bounded by parameters, whatever the input; a group heavier than a
shard's share is the one thing that is split, row by row, by hash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from .scratch import Scratch

PARCELS = 4096
#: A group over this share of a shard is an item of its own; there can be no more than shards / share of them.
HEAVY = 1 / 128
#: Parts of a group that is larger than a shard's share.
PARTS = 64
#: Row numbers are given out in this many bins, over all shards.
SLOT_BINS = 8192
WORD = r"[^\x20\x09-\x0D]+"


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Deal every row of ``docs(doc_id, text)`` to a shard and number the shard's rows.

    Returns ``doc_id, size, tokens, text_crc32, law, shard, slot,
    grown_shard``: ``size`` is the text's UTF-8 bytes plus 1, ``tokens`` its
    words, ``law`` is ``bytes`` (shards get near equal bytes), ``slot`` runs
    gapless from 0 in each shard and ``grown_shard`` is null under this law.
    Rows of equal text share a shard unless their group alone exceeds a
    shard's share of bytes. Null and empty texts have size 1; null texts are a
    group of their own. Repeated rows are rows like any other. An empty table
    gives an empty table. Reruns over the same files and settings agree; slots,
    and the parts of a group larger than a share, follow the order of the input.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    scratch = Scratch(docs.sparkSession, "sharding")
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("null")).alias("digest"),
    )
    # Stored with a number for each row, so that equal rows can be told apart the same way in every step.
    rows = scratch.table(rows.withColumn("uid", F.monotonically_increasing_id()), "rows")
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    groups = scratch.table(rows.groupBy("digest").agg(*sums), "groups")
    total = groups.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("bytes", "tokens", "rows")]).first()
    share = np.maximum(np.array([total["bytes"], total["tokens"], total["rows"]], float) / shards, 1e-9)

    large = F.greatest(*[F.col(c) / F.lit(float(s)) for c, s in zip(("bytes", "tokens", "rows"), share, strict=True)])
    measured = groups.withColumn("weight", large)
    heavy = measured.filter(F.col("weight") > HEAVY).select("digest", "bytes", "tokens", "rows").collect()  # at most 3 * shards / HEAVY
    huge = [g for g in heavy if g["bytes"] > share[0]]
    own = [g for g in heavy if g["bytes"] <= share[0]]
    parcel = F.pmod(F.xxhash64("digest"), F.lit(PARCELS)).cast("int").alias("parcel")
    parcels = measured.filter(F.col("weight") <= HEAVY).groupBy(parcel).agg(F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.sum("rows").alias("rows")).collect()

    items = [(f"g{g['digest']}", [g["bytes"], g["tokens"], g["rows"]]) for g in own]
    items += [(f"p{p['parcel']}", [p["bytes"], p["tokens"], p["rows"]]) for p in parcels]
    part = F.pmod(F.xxhash64("uid", F.lit(3)), F.lit(PARTS)).cast("int")
    if huge:
        split = rows.filter(F.col("digest").isin([g["digest"] for g in huge])).groupBy("digest", part.alias("part")).agg(*sums).collect()
        items += [(f"h{x['digest']}-{x['part']}", [x["bytes"], x["tokens"], x["rows"]]) for x in split]
    placed = place(items, shards, share)

    schema = StructType([StructField("item", StringType()), StructField("shard", IntegerType())])
    places = spark.createDataFrame(sorted(placed.items()), schema)
    name = F.when(
        F.col("digest").isin([g["digest"] for g in own]) if own else F.lit(False), F.concat(F.lit("g"), "digest")
    )
    if huge:
        name = name.when(F.col("digest").isin([g["digest"] for g in huge]), F.concat(F.lit("h"), "digest", F.lit("-"), part))
    name = name.otherwise(F.concat(F.lit("p"), F.pmod(F.xxhash64("digest"), F.lit(PARCELS))))
    bins = max(1, SLOT_BINS // shards)
    # Bounded by PARCELS, HEAVY and PARTS, so it may be broadcast.
    dealt = rows.withColumn("item", name).join(F.broadcast(places), "item").withColumn("bin", F.pmod(F.xxhash64("uid", F.lit(5)), F.lit(bins)).cast("int"))

    counts = dealt.groupBy("shard", "bin").agg(F.count(F.lit(1)).alias("n")).collect()  # about SLOT_BINS rows
    before, at = [], {}
    for c in sorted(counts, key=lambda c: (c["shard"], c["bin"])):
        before.append((c["shard"], c["bin"], at.get(c["shard"], 0)))
        at[c["shard"]] = at.get(c["shard"], 0) + c["n"]
    schema = StructType([StructField("shard", IntegerType()), StructField("bin", IntegerType()), StructField("before", LongType())])
    offsets = F.broadcast(spark.createDataFrame(before, schema))
    within = Window.partitionBy("shard", "bin").orderBy("doc_id", "text_crc32", "uid")
    numbered = dealt.withColumn("k", F.row_number().over(within) - 1).join(offsets, ["shard", "bin"])
    return numbered.select(
        "doc_id", "size", "tokens", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("k")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def place(items: list[tuple[str, list[int]]], shards: int, share: np.ndarray) -> dict[str, int]:
    """Item by item, largest first, to the shard whose residual capacity has the highest dot product.

    Loads are in shares of a shard; an item that would overfill a shard's
    bytes goes there only if it would overfill them all, and then to the one
    with most bytes left.
    """
    vectors = {k: np.array(v, float) / share for k, v in items}
    residual = np.ones((shards, len(share)))
    out = {}
    for k in sorted(vectors, key=lambda k: (-vectors[k][0], k)):
        v = vectors[k]
        fits = residual[:, 0] >= v[0]
        score = np.where(fits, residual @ v, -np.inf) if fits.any() else residual[:, 0]
        out[k] = int(score.argmax())
        residual[out[k]] -= v
    return out
