"""Substring search with an equi-key.

`value LIKE %needle%` between two tables that both come from the data would be a nested-loop join.
Here every value is listed under its distinct grams of 0 to GRAM characters, every needle looks under
one gram of its own (GRAM characters, or the whole needle when it is shorter; the rarest among the
values' grams, ties by gram), and the caller checks the pairs that meet. A value that holds the needle
holds all of its grams, so no match is lost, and a needle meets a value at most once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3


def _grams(s: Column, n) -> Column:
    """All substrings of n characters; empty when `s` is shorter."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.when(F.length(s) >= n, F.transform(F.sequence(F.lit(1), F.length(s) - n + 1), lambda i: F.substring(s, i, n))) \
        .otherwise(F.array().cast("array<string>"))


def _listed(s: Column) -> Column:
    return F.concat(F.array(F.lit("")), *[_grams(s, n) for n in range(1, GRAM + 1)])


def meet(needles: DataFrame, needle: str, values: DataFrame, *held_in: str) -> DataFrame:
    """Rows of `needles` beside the rows of `values` that may hold the needle in one of the columns
    `held_in`. The caller filters by `contains`. NULL needles meet nothing, a NULL value holds nothing."""
    every = F.concat(*[F.coalesce(_listed(F.col(c)), F.array().cast("array<string>")) for c in held_in])
    under = values.withColumn("_gram", F.explode(F.array_distinct(every)))
    keys = needles.select(F.col(needle).alias("_n")).where("_n is not null").distinct()
    own = keys.withColumn("_gram", F.explode(F.array_distinct(_grams(F.col("_n"), F.least(F.length("_n"), F.lit(GRAM))))))
    often = under.groupBy("_gram").agg(F.count(F.lit(1)).alias("_often"))
    rarest = own.join(often, "_gram", "left").groupBy("_n").agg(
        F.min(F.struct(F.coalesce("_often", F.lit(0)), "_gram"))["_gram"].alias("_gram"))
    return needles.join(rarest, F.col(needle) == F.col("_n")).join(under, "_gram").drop("_n", "_gram")
