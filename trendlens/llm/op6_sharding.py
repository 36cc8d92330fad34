"""Operator 6: sharding by sampled splitters.

Records are ordered by (hash of the text, doc_id, tie-break), so equal texts stand together. A
size-weighted sample of keys gives quantile boundaries of many fine ranges, each a small share of
the bytes; ranges that turn out overfull are subdivided by a denser sample of their own. Exact byte
and row offsets of the ranges then place every record on one global scale of bytes, which is cut
into equal shards. A group of equal texts that holds a third of all rows spans many fine ranges
and as many shards as its bytes need.

Law: `bytes`. Shard sizes differ by at most one record's size on either end.

Defined cases: a null text has no bytes and the CRC of no bytes (0); an empty table gives an empty
result; a null doc_id sorts first within its text; repeated rows are separate records; other
columns of the input are ignored.
"""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlens.llm.common import materialise, table

SHARDS = 40
RANGES_PER_SHARD = 64
SAMPLES_PER_RANGE = 8       # the driver holds about SHARDS * RANGES_PER_SHARD * SAMPLES_PER_RANGE keys, whatever the input
ROWS_PER_RANGE = 16         # a small table has fewer ranges
OVERFULL = 3.0              # a range of over so many times the mean bytes is subdivided
ROUNDS = 3                  # of subdivision; a single record cannot be divided
MIN_LONG = -(1 << 63)

KEY = ("h", "k", "tie")


def records(docs: DataFrame) -> DataFrame:
    """One narrow row per document: id, size, CRC and the range key. No text leaves the scan."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id", (F.octet_length(text).cast("long") + 16).alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("h"), F.coalesce(F.col("doc_id"), F.lit(MIN_LONG)).alias("k"),
        F.monotonically_increasing_id().alias("tie"))


def sample_keys(rows: DataFrame, total: int, wanted: int) -> list[tuple[tuple[int, int, int], int]]:
    """Keys with multiplicity, in key order: each record is drawn about wanted * size / total times."""
    u = F.pmod(F.xxhash64("h", "k", "tie"), F.lit(1 << 31)) / F.lit(float(1 << 31))
    draws = F.floor(F.col("size") * F.lit(wanted / total) + u)
    got = rows.withColumn("draws", draws).where("draws > 0").select(*KEY, "draws").collect()
    return sorted(((r.h, r.k, r.tie), r.draws) for r in got)


def quantiles(keys: list, parts: int) -> list[tuple[int, int, int]]:
    """At most parts - 1 boundaries that cut the weighted keys evenly."""
    weight = sum(w for _, w in keys)
    cuts, seen = [], 0
    for key, w in keys:
        if (seen + w) * parts // weight > seen * parts // weight:
            cuts.append(key)
        seen += w
    return cuts


def range_of(cuts: list):
    @F.pandas_udf(T.IntegerType())
    def place(h: pd.Series, k: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(cuts, key) for key in zip(h.tolist(), k.tolist(), tie.tolist())], dtype="int32")

    return place(*KEY)


def splitters(rows: DataFrame, total: int, ranges: int) -> tuple[list, list]:
    """Boundaries, and (range, bytes, rows) of every range that has rows."""
    cuts = quantiles(sample_keys(rows, total, ranges * SAMPLES_PER_RANGE), ranges)
    for left in range(ROUNDS, -1, -1):
        placed = rows.withColumn("rng", range_of(cuts))
        stats = placed.groupBy("rng").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
        full = {r.rng: r.bytes for r in stats if r.n > 1 and r.bytes > OVERFULL * total / ranges}
        if not full or not left:
            return cuts, sorted((r.rng, r.bytes, r.n) for r in stats)
        inside = placed.where(F.col("rng").isin(list(full)))
        parts = -(-sum(full.values()) * ranges // total)
        keys = sample_keys(inside, sum(full.values()), parts * SAMPLES_PER_RANGE)
        more = [k for rng in full for k in quantiles([x for x in keys if bisect_right(cuts, x[0]) == rng] or [(keys[0][0], 1)],
                                                     -(-full[rng] * ranges // total) + 1)]
        cuts = sorted({*cuts, *more})


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every record of `docs`."""
    spark = docs.sparkSession
    rows = materialise(records(docs), "shard-records")
    total, n = rows.agg(F.sum("size"), F.count("*")).first()
    out = ["doc_id", "size", "text_crc32"]
    if not total:
        return rows.select(*out, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    cuts, stats = splitters(rows, total, max(1, min(shards * RANGES_PER_SHARD, n // ROWS_PER_RANGE)))
    offsets, bytes_before, rows_before = [], 0, 0
    for rng, size, n in stats:
        offsets.append((rng, bytes_before, rows_before))
        bytes_before, rows_before = bytes_before + size, rows_before + n
    at = spark.createDataFrame(offsets, "rng int, bytes_before long, rows_before long")
    w = Window.partitionBy("rng").orderBy(*KEY)
    before = F.col("bytes_before") + F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = (rows.withColumn("rng", range_of(cuts)).join(F.broadcast(at), "rng")
              .withColumn("pos", F.col("rows_before") + F.row_number().over(w) - 1).withColumn("before", before)
              .withColumn("shard", F.expr(f"cast(least({shards - 1}, (2 * before + size) * {shards} div {2 * total}) as int)")))
    placed = materialise(placed.select(*out, "shard", "pos"), "shard-positions")
    first = placed.groupBy("shard").agg(F.min("pos").alias("first"))        # one row per shard
    return placed.join(F.broadcast(first), "shard").select(*out, "shard", (F.col("pos") - F.col("first")).alias("slot"))


def op6_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = assign_shards(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
