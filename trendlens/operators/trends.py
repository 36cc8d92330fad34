"""Keyword trends: word counts per (discipline, year), top words per group, dense yearly series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlens.functions import text
from trendlens.plans.broadcast import spread
from trendlens.params import Params

TREND_COLUMNS = ("discipline", "publish_year", "word", "count")


def title_tokens(cleaned: DataFrame) -> DataFrame:
    """Id, tokens (cleaned title split on each whitespace char, empties kept)."""
    return cleaned.select("id", "discipline", "publish_year", text.tokens(F.col("title")).alias("tokens"))


def filtered_words(cleaned: DataFrame) -> DataFrame:
    """Tokens without stop words (repeats and empty tokens kept, as the stop filter does)."""
    return cleaned.select("id", "discipline", "publish_year",
                          text.drop_stop_words(text.tokens(F.col("title"))).alias("words"))


def word_freq(cleaned: DataFrame, params: Params = Params()) -> DataFrame:
    """A1: occurrences of each long word per (discipline, year); a word twice in a title counts 2.

    Explode -> filter -> partial count before the shuffle; the shuffle carries one row per
    distinct (discipline, year, word) per map task, whatever the skew of disciplines.
    """
    words = cleaned.select("discipline", "publish_year",
                           F.explode(text.tokens(F.col("title"))).alias("word"))
    return (words.filter(text.is_long_word(F.col("word"), params.trend_min_len))
            .groupBy("discipline", "publish_year", "word")
            .agg(F.count(F.lit(1)).alias("count")))


def top_words(freq: DataFrame, params: Params = Params()) -> DataFrame:
    """The `top_words` most frequent words per (discipline, year); ties by word."""
    w = Window.partitionBy("discipline", "publish_year").orderBy(F.desc("count"), F.asc("word"))
    return (freq.withColumn("_rank", F.row_number().over(w))
            .filter(F.col("_rank") <= params.top_words)
            .select(*TREND_COLUMNS))


def trend_history(cleaned: DataFrame, params: Params = Params()) -> DataFrame:
    return top_words(word_freq(cleaned, params), params)


def keyword_weights(cleaned: DataFrame, params: Params = Params(), per_group: int = 10) -> DataFrame:
    """TF-IDF: per (discipline, year) the `per_group` words of the highest weight, weight = occurrences in the group
    * ln((N + 1) / (papers that hold the word + 1)), N = all papers; rounded to 6 places, ties by word.

    Two partial aggregates over the same tokens (occurrences, papers), joined by word: the word of every paper is
    one row of the smaller side, its groups are split by adaptive execution. Output: discipline, publish_year,
    rank, word, count, papers, weight."""
    counts = word_freq(cleaned, params)
    words = cleaned.select(F.explode(F.array_distinct(text.tokens(F.col("title")))).alias("word"))
    papers = words.filter(text.is_long_word(F.col("word"), params.trend_min_len)).groupBy("word").agg(F.count(F.lit(1)).alias("papers"))
    n = cleaned.select(F.count(F.lit(1))).scalar()
    weighed = counts.join(papers, "word").withColumn("weight", F.round(F.col("count") * F.log((n + 1) / (F.col("papers") + 1)), 6))
    w = Window.partitionBy("discipline", "publish_year").orderBy(F.desc("weight"), F.asc("word"))
    return weighed.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= per_group) \
        .select("discipline", "publish_year", "rank", "word", "count", "papers", "weight")


def max_year(trend: DataFrame):
    """A8 (global): the last historical year, as a scalar subquery column."""
    return trend.select(F.max("publish_year")).scalar()


def dense_series(history: DataFrame, params: Params = Params()) -> DataFrame:
    """J2 + A11 + A12: one row per (discipline, word) with its counts for every year
    min_year..max_year (0 where the word was not a top word), as array<double>.

    Null disciplines are dropped (they get no forecast). The year spine comes from `sequence`,
    not from a join, and the global max year from a scalar subquery.
    """
    last_year = max_year(history)
    keyed = spread(history.filter(F.col("discipline").isNotNull()), "discipline", "word")
    # the fits run per series row: keep the series spread over all partitions
    series = keyed.groupBy("discipline", "word").agg(
        F.map_from_entries(F.collect_list(F.struct(
            F.col("publish_year"), F.col("count").cast("double")))).alias("_by_year"))
    # the scalar subquery may not sit inside a lambda: project the spine first
    spined = series.select("discipline", "word", "_by_year", last_year.alias("max_year"))
    years = F.sequence(F.lit(params.min_year), F.col("max_year"))
    return spined.select(
        "discipline", "word",
        F.transform(years, lambda y: F.coalesce(F.col("_by_year")[y], F.lit(0.0))).alias("ys"),
        "max_year",
    )


def dense_rows(series: DataFrame, params: Params = Params()) -> DataFrame:
    """The dense series as rows: discipline, word, publish_year, count (0-filled)."""
    return series.select(
        "discipline", "word",
        F.posexplode("ys").alias("_i", "_y"),
    ).select("discipline", "word",
             (F.col("_i") + params.min_year).cast("int").alias("publish_year"),
             F.col("_y").cast("long").alias("count"))
