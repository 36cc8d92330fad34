"""Reporting queries over the trend table (history + forecast) and the rule table.

Each report is computed for every discipline at once (one job, no per-discipline loop); the
single-discipline form is a filter on the result. Tables read here are bounded by construction:
the trend table holds at most `top_words` rows per (discipline, year) plus forecasts of those
words, the rule table at most `rules_per_source` rows per source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlens.functions import vocab

ACTIVE_WORDS = 150
LEADER_DISCIPLINES = 10
LEADER_WORDS = 5
STARS = 5
BRIDGES = 5
HEAT_CAP = 50_000
CROSS_CAP = 100
DEFAULT_MAX_YEAR = 2026      # of a discipline that the trend does not have


def discipline_list(trend: DataFrame) -> DataFrame:
    """Q11 / A9."""
    return trend.select("discipline").distinct()


def theme_river(trend: DataFrame, discipline: str | None = None) -> DataFrame:
    """Q1: discipline, year (text), count, word; ordered by year then word."""
    t = trend if discipline is None else trend.filter(F.col("discipline") == discipline)
    return (t.select("discipline", F.col("publish_year").cast("string").alias("year"), "count", "word")
            .orderBy("discipline", "year", "word"))


def active_words(trend: DataFrame, year: int, limit: int = ACTIVE_WORDS) -> DataFrame:
    """A5 / L2: the `limit` words with the highest total count in `year` (ties by word)."""
    return (trend.filter(F.col("publish_year") == year)
            .groupBy("word").agg(F.sum("count").cast("long").alias("total_count"))
            .orderBy(F.desc("total_count"), F.asc("word")).limit(limit))


def _nodes(trend: DataFrame, year: int) -> DataFrame:
    """Active node names: every discipline plus the active words of `year` (bounded: D + 150)."""
    disc = discipline_list(trend).select(F.col("discipline").alias("name"), F.lit(True).alias("is_discipline"))
    words = active_words(trend, year).select(F.col("word").alias("name"), F.lit(False).alias("is_discipline"))
    both = disc.unionByName(words)
    # a name is a discipline if it is one, whatever else it is
    return both.groupBy("name").agg(F.max("is_discipline").alias("is_discipline"))


def _links(rules: DataFrame, nodes: DataFrame) -> DataFrame:
    names = nodes.select("name")
    return (rules.join(names.withColumnRenamed("name", "source"), "source", "left_semi")
            .join(names.withColumnRenamed("name", "target"), "target", "left_semi")
            .select("source", "target", F.col("confidence").alias("value")))


def network_links(trend: DataFrame, rules: DataFrame, year: int) -> DataFrame:
    """Rules whose source and target are both active nodes."""
    return _links(rules, _nodes(trend, year))


def network_nodes(trend: DataFrame, rules: DataFrame, year: int) -> DataFrame:
    """Name, symbol_size, category (0 discipline, 1 word), value (= degree).
    The node table built for the links also gives each node's category."""
    nodes = _nodes(trend, year)
    links = _links(rules, nodes)
    # both ends of every link in one pass (no union reading the links twice)
    ends = links.select(F.explode(F.array("source", "target")).alias("name"))
    degree = ends.groupBy("name").agg(F.count(F.lit(1)).alias("value"))
    j = degree.join(nodes, "name")
    is_disc = F.col("is_discipline")
    size = F.when(is_disc, F.least(F.col("value") * 8 + 20, F.lit(80))) \
        .otherwise(F.least(F.col("value") * 3 + 10, F.lit(30)))
    return j.select("name", size.cast("long").alias("symbol_size"),
                    F.when(is_disc, 0).otherwise(1).alias("category"), "value")


def leaderboard(trend: DataFrame) -> DataFrame:
    """Top 10 disciplines by total count, each with its 5 hottest words.

    One aggregate per level plus one window; no per-discipline query loop."""
    heat = trend.groupBy("discipline").agg(F.sum("count").cast("long").alias("total_heat"))
    order = (F.desc("total_heat"), F.asc("discipline"))
    # global top-10 first (TakeOrderedAndProject), the rank window then sees 10 rows only
    top_d = heat.orderBy(*order).limit(LEADER_DISCIPLINES) \
        .withColumn("discipline_rank", F.row_number().over(Window.orderBy(*order)))
    word_heat = trend.groupBy("discipline", "word").agg(F.sum("count").cast("long").alias("word_heat"))
    ranked = word_heat.withColumn("_r", F.row_number().over(
        Window.partitionBy("discipline").orderBy(F.desc("word_heat"), F.asc("word")))) \
        .filter(F.col("_r") <= LEADER_WORDS)
    words = ranked.groupBy("discipline").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_r", "word"))),
                                 lambda s: s["word"]), ", ").alias("top_words"))
    return F.broadcast(top_d).join(words, "discipline", "left").select(   # top_d: 10 rows
        "discipline_rank", "discipline", "total_heat", "top_words")


def max_year_by_discipline(trend: DataFrame) -> DataFrame:
    """Discipline, max_year (history and forecast years)."""
    return trend.groupBy("discipline").agg(F.max("publish_year").alias("max_year"))


def discipline_insights(trend: DataFrame, rules: DataFrame, requests: DataFrame) -> DataFrame:
    """The request form of Q5 to Q7 and A8: per requested discipline (column `discipline`, abbreviations resolved) its
    last year (2026 where the trend has none), rising words, bridge words and the two radar metrics (0 where there
    is nothing). One row per distinct request; lists are in rank order, '' when empty.
    Output: discipline, resolved, max_year, rising, bridges, heat, cross_breadth."""
    asked = resolve_alias(requests.select("discipline").where("discipline is not null").distinct(), "discipline")
    words = lambda rows, c: rows.groupBy("discipline").agg(      # noqa: E731
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", c))), lambda s: s[c]), ", ").alias("words"))
    parts = {"max_year": max_year_by_discipline(trend).withColumnRenamed("max_year", "value"),
             "rising": words(rising_stars(trend), "word").withColumnRenamed("words", "value"),
             "bridges": words(bridge_words(trend, rules), "keyword").withColumnRenamed("words", "value")}
    out = asked
    for name, part in parts.items():
        out = out.join(part.select(F.col("discipline").alias("resolved"), F.col("value").alias(name)), "resolved", "left")
    radar = radar_metrics(trend, rules).select(F.col("discipline").alias("resolved"), "heat", "cross_breadth")
    return out.join(radar, "resolved", "left").select(
        "discipline", "resolved", F.coalesce("max_year", F.lit(DEFAULT_MAX_YEAR)).alias("max_year"),
        F.coalesce("rising", F.lit("")).alias("rising"), F.coalesce("bridges", F.lit("")).alias("bridges"),
        F.coalesce("heat", F.lit(0)).cast("long").alias("heat"), F.coalesce("cross_breadth", F.lit(0)).cast("long").alias("cross_breadth"))


def _top_rows_fallback(trend: DataFrame, missing: DataFrame, k: int) -> DataFrame:
    """Top `k` trend rows by count for disciplines in `missing` (ties: word, then year)."""
    w = Window.partitionBy("discipline").orderBy(F.desc("count"), F.asc("word"), F.asc("publish_year"))
    return (trend.join(missing, "discipline", "left_semi")
            .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k))


def rising_stars(trend: DataFrame) -> DataFrame:
    """Per discipline, the 5 words with the highest growth from year Y-1 to Y,
    Y = the discipline's last year; growth = (a - b) / b * 100 with b > 0.
    A discipline with no growth pair gets its 5 largest trend rows, growth NULL, is_fallback.

    One shuffle: every window below is partitioned by discipline first, and a hash partitioning on
    discipline also satisfies the (discipline, word) window. The previous row of a word in year
    order is its Y-1 row exactly when one exists ((discipline, word, year) is unique), so `lag`
    plus a year check is the exact self-join on year - 1."""
    by_d = Window.partitionBy("discipline")
    by_dw = Window.partitionBy("discipline", "word").orderBy("publish_year")
    t = (trend.select("discipline", "publish_year", "word", "count")
         .withColumn("_max_y", F.max("publish_year").over(by_d))
         .withColumn("_prev_y", F.lag("publish_year").over(by_dw))
         .withColumn("_b", F.lag("count").over(by_dw)))
    grows = ((F.col("publish_year") == F.col("_max_y")) & (F.col("_prev_y") == F.col("_max_y") - 1)
             & (F.col("_b") > 0))
    growth = F.when(grows, (F.col("count") - F.col("_b")) / F.col("_b") * 100)
    t = t.withColumn("growth", growth) \
        .withColumn("_has", F.max(F.col("growth").isNotNull()).over(by_d))
    # one ranking for both cases (`_has` is constant within a discipline): with growth pairs,
    # growth desc then word (rows without growth sort last); without, count desc, word, year
    has = F.col("_has")
    order = by_d.orderBy(F.desc_nulls_last(F.when(has, F.col("growth"))), F.asc(F.when(has, F.col("word"))),
                         F.desc(F.when(~has, F.col("count"))), F.asc("word"), F.asc("publish_year"))
    ranked = t.withColumn("rank", F.row_number().over(order))
    keep = (F.col("rank") <= STARS) & (F.col("growth").isNotNull() | ~has)
    return ranked.filter(keep).select(
        "discipline", "rank", "word", F.when(has, F.col("growth")).alias("growth"),
        (~has).alias("is_fallback"))


def bridge_words(trend: DataFrame, rules: DataFrame) -> DataFrame:
    """Per discipline, its 5 strongest rules (confidence desc, target), each with a
    partner: the source of another rule to the same target (highest confidence, then source),
    NULL when there is none. A discipline without rules gets its 5 largest trend rows, flagged."""
    disc = discipline_list(trend)
    own = rules.join(disc.withColumnRenamed("discipline", "source"), "source", "left_semi")
    w = Window.partitionBy("source").orderBy(F.desc("confidence"), F.asc("target"))
    top = own.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= BRIDGES)
    other = rules.select(F.col("source").alias("partner"), F.col("target").alias("_pt"), F.col("confidence").alias("_pc"))
    # one left join keeps rules without a partner (partner NULL); the pick window then takes the
    # strongest other source per rule, NULL only when there is none
    cand = top.join(other, (F.col("_pt") == F.col("target")) & (F.col("partner") != F.col("source")), "left")
    pick = Window.partitionBy("source", "target").orderBy(F.desc_nulls_last("_pc"), F.asc("partner"))
    with_partner = cand.withColumn("_p", F.row_number().over(pick)).filter(F.col("_p") == 1)
    bridges = with_partner.select(
        F.col("source").alias("discipline"), "rank", F.col("target").alias("keyword"),
        F.col("partner").alias("linked_discipline"), F.lit(False).alias("is_fallback"))
    missing = disc.join(bridges.select("discipline"), "discipline", "left_anti")
    fallback = _top_rows_fallback(trend, missing, BRIDGES).select(
        "discipline", "rank", F.col("word").alias("keyword"),
        F.lit(None).cast("string").alias("linked_discipline"), F.lit(True).alias("is_fallback"))
    return bridges.unionByName(fallback)


def radar_metrics(trend: DataFrame, rules: DataFrame) -> DataFrame:
    """Heat (sum of counts), cross breadth (distinct rule targets) and the two
    chart axes min(heat, 50000) and min(2*cross, 100). A metric of 0 keeps its true axis value 0 and
    sets its `*_fallback` flag (where the original showed an invented constant)."""
    heat = trend.groupBy("discipline").agg(F.sum("count").cast("long").alias("heat"))
    cross = rules.groupBy(F.col("source").alias("discipline")).agg(
        F.countDistinct("target").alias("cross_breadth"))
    j = heat.join(cross, "discipline", "left").fillna(0, ["cross_breadth"])
    return j.select(
        "discipline", "heat", F.col("cross_breadth").cast("long").alias("cross_breadth"),
        F.least(F.col("heat"), F.lit(HEAT_CAP)).cast("long").alias("heat_axis"),
        (F.col("heat") <= 0).alias("heat_fallback"),
        F.least(F.col("cross_breadth") * 2, F.lit(CROSS_CAP)).cast("long").alias("cross_axis"),
        (F.col("cross_breadth") <= 0).alias("cross_fallback"))


def resolve_alias(rows: DataFrame, column: str) -> DataFrame:
    """Map an abbreviation (case-insensitive, trimmed) to its discipline; unknown values
    pass through trimmed. Adds column `resolved`."""
    aliases = F.broadcast(alias_map(rows.sparkSession))
    key = F.lower(F.trim(F.col(column)))
    j = rows.join(aliases, key == F.col("alias"), "left")
    return j.select(*[rows[c] for c in rows.columns],
                    F.coalesce(F.col("resolved"), F.trim(rows[column])).alias("resolved"))


def alias_map(spark) -> DataFrame:
    """The 10-entry abbreviation table as a DataFrame (fixed size, safe to broadcast)."""
    return spark.createDataFrame(list(vocab.DISCIPLINE_ALIASES), "alias string, resolved string")
