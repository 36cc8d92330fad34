"""Operator 10: document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last 7 bytes decides where a chunk ends (hash mod block size = block size
- 1), so an edit moves only the chunks it touches. Each chunk gives one base-64 character of the
signature. The block size starts near length / 64 and is halved while the signature is short. A
fingerprint is `block:signature:signature at twice the block`. Two fingerprints are compared when
their block sizes are equal or differ by a factor of two, at the common block size, by
1 - edit distance / longer signature.

Chunks are hashed whole with vectorised arithmetic: a polynomial over bytes modulo 2^64, made
independent of position by the inverse power of the chunk's start.

`edited_texts` puts each document beside the next one (descending doc_id) with one shuffle of the
texts: explicit id ranges ("blocks") from quantiles, and the first document of each block copied
to the block before it. Every block is read in order as a stream, one document behind.

Defined cases: a null text counts as empty (fingerprint `3::`); equal fingerprints have likeness 1;
an empty signature is like nothing but itself; repeated doc_ids are ordered by text hash; a null
doc_id comes last; a table of one document is its own next; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.llm.common import table

MIN_BLOCK = 3
SIGNATURE = 64
WINDOW = 7
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
PRIME = 0x9E3779B97F4A7C15          # odd, so it has an inverse modulo 2^64
MIX = 0xBF58476D1CE4E5B9
LETTERS = np.frombuffer(ALPHABET.encode(), np.uint8)

BLOCK_ROWS = 1000                   # documents in a block, about
MAX_BLOCKS = 4096                   # the table of block heads has at most so many rows
MIN_LONG = -(1 << 63)


class Powers:
    """Powers of PRIME and of its inverse modulo 2^64, grown as longer texts come."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            m = max(n, 2 * len(self.up), 1 << 14)
            for name, base in (("up", PRIME), ("down", pow(PRIME, -1, 1 << 64))):
                steps = np.full(m, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the last WINDOW bytes at every position, modulo 2^32."""
    c = np.concatenate([np.zeros(WINDOW - 1, np.uint32), data.astype(np.uint32)])
    n = len(data)
    plain, weighted, shifted = np.zeros(n, np.uint32), np.zeros(n, np.uint32), np.zeros(n, np.uint32)
    for back in range(WINDOW):
        part = c[WINDOW - 1 - back:WINDOW - 1 - back + n]
        plain += part
        weighted += part * np.uint32(WINDOW - back)
        shifted ^= part << np.uint32(5 * back)
    return plain + weighted + shifted


def ends_at(roll: np.ndarray, block: int) -> np.ndarray:
    return np.flatnonzero(roll % np.uint32(block) == block - 1)


def signature(terms: np.ndarray, ends: np.ndarray, down: np.ndarray) -> str:
    """One character per chunk; the last of SIGNATURE characters covers all that remains."""
    n = len(terms)
    starts = np.concatenate([[0], ends + 1])
    starts = starts[starts < n][:SIGNATURE]
    sums = np.add.reduceat(terms, starts) * down[starts]
    sums ^= sums >> np.uint64(31)
    return LETTERS[((sums * np.uint64(MIX)) >> np.uint64(58)).astype(np.intp)].tobytes().decode()


def fingerprint(text: str, powers: Powers | None = None) -> str:
    data = np.frombuffer(text.encode(), np.uint8)
    if not len(data):
        return f"{MIN_BLOCK}::"
    up, down = (powers or Powers()).upto(len(data))
    roll = rolling(data)
    block = MIN_BLOCK
    while block * SIGNATURE < len(data):
        block *= 2
    ends = ends_at(roll, block)
    while block > MIN_BLOCK and len(ends) < SIGNATURE // 2:
        block //= 2
        ends = ends_at(roll, block)
    terms = (data.astype(np.uint64) + np.uint64(1)) * up[:len(data)]
    return f"{block}:{signature(terms, ends, down)}:{signature(terms, ends_at(roll, 2 * block), down)}"


def likeness(left: str, right: str):
    """Column: likeness (0 to 1) of two fingerprint columns."""
    lp, rp = F.split(left, ":"), F.split(right, ":")

    def same(a, b):
        longest = F.greatest(F.length(a), F.length(b))
        return F.when((F.length(a) == 0) | (F.length(b) == 0), 0.0).otherwise(1.0 - F.levenshtein(a, b) / longest)

    lb, rb = lp[0].cast("long"), rp[0].cast("long")
    return (F.when(F.col(left) == F.col(right), 1.0)
            .when(lb == rb, F.greatest(same(lp[1], rp[1]), same(lp[2], rp[2])))
            .when(lb == 2 * rb, same(lp[1], rp[2]))
            .when(2 * lb == rb, same(lp[2], rp[1]))
            .otherwise(0.0))


def in_blocks(docs: DataFrame) -> DataFrame:
    """doc_id, text, k, h, blk, head: the documents of a block, and a copy (head = 1) of the first
    document of the next block. Blocks are ranges of descending k."""
    ids = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                      F.coalesce(F.col("doc_id"), F.lit(MIN_LONG)).alias("k"))
    ids = ids.withColumn("h", F.xxhash64("text"))
    small = docs.select(F.coalesce(F.col("doc_id"), F.lit(MIN_LONG)).alias("k"))
    n = small.count()
    blocks = min(MAX_BLOCKS, max(1, n // BLOCK_ROWS))
    cuts = sorted({float(q) for q in small.approxQuantile("k", [i / blocks for i in range(1, blocks)], 1 / (4 * blocks))}) if blocks > 1 else []

    def place(df: DataFrame) -> DataFrame:
        if not cuts:
            return df.withColumn("blk", F.lit(0.0))
        return Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="at", outputCol="blk").transform(
            df.withColumn("at", F.col("k").cast("double"))).drop("at")

    first = sorted(((r.blk, r.k) for r in place(small).groupBy("blk").agg(F.max("k").alias("k")).collect()), reverse=True)
    before = [(blk, k, first[i - 1][0]) for i, (blk, k) in enumerate(first)]     # wraps: the first block follows the last
    heads = F.broadcast(docs.sparkSession.createDataFrame(before, "blk double, first_k long, blk_before double"))
    copies = F.when(F.col("k") == F.col("first_k"), F.array(F.struct("blk", F.lit(0).alias("head")), F.struct(F.col("blk_before").alias("blk"), F.lit(1).alias("head")))
                    ).otherwise(F.array(F.struct("blk", F.lit(0).alias("head"))))
    return place(ids).join(heads, "blk").withColumn("to", F.explode(copies)).select("doc_id", "text", "k", "h", "to.blk", "to.head")


def edited(text: str, following: str) -> str:
    """The last third of `text` (code points, rounded down) replaced by as many of the next text."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint")
    powers, last = Powers(), None
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for doc_id, text, blk, head in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            print_ = fingerprint(text, powers)
            if last and last[2] == blk and not last[3]:
                changed = edited(last[1], text)
                for column, value in zip(out, (last[0], len(last[1]), hashlib.sha256(changed.encode()).hexdigest(),
                                               last[4], fingerprint(changed, powers), print_), strict=True):
                    column.append(value)
            last = (doc_id, text, blk, head, print_)
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64() if i < 2 else pa.string()) for i, v in enumerate(out)], names)


def edited_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, next_fingerprint."""
    rows = (in_blocks(docs).repartition("blk").sortWithinPartitions("blk", "head", F.desc("k"), "h")
            .select("doc_id", "text", "blk", "head"))
    return rows.mapInArrow(_pairs, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string")


def op10_piecewise_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = edited_texts(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                      likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
                      likeness("fingerprint", "next_fingerprint").alias("near_next"))
