"""Exact integer names for large contents, of which only one copy of each crosses the network.

A digest stands for a content wherever no second content of the corpus has the same digest. So the distinct
contents are met once per digest (repeats collapse on the map side), the digests that stand for several
contents are listed, and only occurrences of those carry their content on, as a `twin`. (digest, twin) then
is equal exactly where contents are equal: no answer rests on a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import materialise


def clashes(contents: DataFrame) -> DataFrame:
    """The digests of `contents` (digest, content) that stand for more than one content: one column, digest."""
    twice = contents.distinct().groupBy("digest").agg(F.count("*").alias("n")).where("n > 1")
    return materialise(twice.select("digest", F.lit(True).alias("clash")), "clashes")


def with_twin(rows: DataFrame, clash: DataFrame, content: Column) -> DataFrame:
    """`rows` (with a digest) and `twin`: the binary `content` where its digest clashes, else empty."""
    return rows.join(clash, "digest", "left").withColumn("twin", F.when(F.col("clash"), content).otherwise(F.lit("").cast("binary"))).drop("clash")


def integer_names(keys: DataFrame, name: str, step: str) -> DataFrame:
    """The distinct rows of `keys`, sorted within each part and numbered: unique, not contiguous integers."""
    parts = keys.distinct().sortWithinPartitions(*keys.columns)
    return materialise(parts.withColumn(name, F.monotonically_increasing_id()), step)
