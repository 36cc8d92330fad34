"""Association rules between keywords and disciplines (1 -> 1 rules only), by pair counting.

Only single-item antecedents and consequents are kept from the mining, so the frequent itemsets
that matter are items and pairs. Counting pairs directly gives the same rules as FP-Growth
without mining larger itemsets:

  N          = number of baskets
  min_count  = ceil(min_support * N)
  support(a) = baskets containing a             (frequent when >= min_count)
  n(a, b)    = baskets containing a and b       (frequent when >= min_count)
  rule a->b  : n(a, b) >= min_count and n(a, b) / support(a) >= min_confidence

Plan, in three steps that the job writes as tables, so that the pair and the rule query share them:

  frequent items   partial counts per item; they are numbered, so that a pair is one long
  pair counts      occurrences of frequent items -> one sorted id array per basket -> work units
                   (basket, block i, block j) in ranges -> pairs -> partial counts per (x, y)
  rules            the counts mirrored into both directions, beside the two items' supports

Items are cut into blocks of neighbouring ids. A work unit (basket, block i, block j) holds the basket's ids in
both blocks and makes each unordered pair (x < y) of them once; units are laid out in ranges of (i, j, basket).
So a task meets the pairs of few blocks only: it counts them in one array of a block's width squared (at most
WIDEST^2 counts), and a document with tens of thousands of frequent words is many units on many tasks.
Only these partial counts leave a task. A pair costs a few array steps there (a row per pair in a hash aggregate
was ten times dearer), and pairs are made CHUNK at a time. Adaptive execution chooses the number of partitions.
No step fixes a partition count, forces a broadcast or runs a job of its own (the range bounds come from Spark's
sample of the units).

Cost: the pairs of one basket are the pairs of frequent items inside one document; the total is the
sum over baskets of (frequent items in the basket)^2, linear in the number of baskets. This is exactly
the count the rules are defined by (FP-Growth builds the same supports). A hot item (a discipline is in
a fifth of all baskets) only adds partial-aggregate rows, and its occurrences meet the item table in a
join that adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlens.functions import text
from trendlens.params import Params

RULE_COLUMNS = ("source", "target", "confidence")
BLOCK = 512             # ids in a block, or so many that there are at most BLOCKS blocks, but not over WIDEST
BLOCKS = 16
WIDEST = 2048
CHUNK = 1 << 20         # pairs that a task makes at a time


def baskets_observed(cleaned: DataFrame, params: Params = Params()) -> DataFrame:
    """One basket per cleaned paper: basket_id, items = {discipline} + long title words.

    Papers without a discipline form no basket (their items would include a NULL)."""
    papers = cleaned.filter(F.col("discipline").isNotNull())
    # one pass over the tokens: a word of >= basket_min_len letters is a stop word only if it is
    # in the (short) list of long stop words, so the full stop list need not be scanned
    return papers.select(
        F.col("id").alias("basket_id"),
        F.concat(F.lit("paper:"), F.col("id").cast("string")).alias("basket_key"),
        text.basket_items(F.col("discipline"), text.tokens(F.col("title")), params.basket_min_len)
        .alias("items"))


def baskets_forecast(forecast: DataFrame) -> DataFrame:
    """T7 + P11: one basket {discipline, word} per forecast row with count > 2 (no paper id;
    basket_key names the forecast row)."""
    rows = forecast.filter((F.col("count") > 2) & F.col("discipline").isNotNull())
    return rows.select(
        F.lit(None).cast("long").alias("basket_id"),
        F.concat_ws(":", F.lit("forecast"), "discipline", "word", F.col("publish_year").cast("string"))
        .alias("basket_key"),
        F.array_distinct(F.array("discipline", "word")).alias("items"))


def baskets_full(cleaned: DataFrame, forecast: DataFrame | None, params: Params = Params()) -> DataFrame:
    """Observed baskets plus forecast baskets (when enabled)."""
    observed = baskets_observed(cleaned, params)
    if forecast is None or not params.include_forecast_baskets:
        return observed
    return observed.unionByName(baskets_forecast(forecast))


def _min_count(baskets: DataFrame, params: Params):
    n = baskets.select(F.count(F.lit(1))).scalar()
    return F.ceil(F.lit(float(params.min_support)) * n)


def item_support(baskets: DataFrame) -> DataFrame:
    """A14 (items): item, support = number of baskets holding it (items are a set per basket)."""
    return (baskets.select(F.explode("items").alias("item"))
            .groupBy("item").agg(F.count(F.lit(1)).alias("support")))


def frequent_items(baskets: DataFrame, params: Params = Params()) -> DataFrame:
    return item_support(baskets).filter(F.col("support") >= _min_count(baskets, params))


def numbered(frequent: DataFrame) -> DataFrame:
    """Frequent items with ids 1, 2, ... in the order of their names (item, support, iid). One sort of the frequent
    items, of which there are at most (average basket size) / min_support, however many baskets there are."""
    return frequent.withColumn("iid", F.row_number().over(Window.orderBy("item")))


def work_units(baskets: DataFrame, items: DataFrame) -> DataFrame:
    """i, j, width, left, right: for every basket and every two blocks of `width` ids, the basket's ids in them (right:
    NULL for the same block). In ranges of (block, block, basket)."""
    if "_bid" not in baskets.columns:
        baskets = baskets.withColumn("_bid", F.monotonically_increasing_id())
    last = items.agg(F.max("iid").alias("last"))
    span = F.coalesce(F.least(F.greatest(F.ceil(F.col("last") / BLOCKS), F.lit(BLOCK)), F.lit(max(BLOCK, WIDEST))), F.lit(BLOCK))
    width = last.select(span.cast("int")).scalar()
    blocks = last.select(F.coalesce(F.ceil(F.col("last") / span), F.lit(1)).cast("int")).scalar()
    occ = baskets.select("_bid", F.explode("items").alias("item")).join(items.select("item", "iid"), "item")
    per = occ.groupBy("_bid").agg(F.sort_array(F.collect_list("iid")).alias("ids")).where(F.size("ids") > 1)
    per = per.select("_bid", "ids", blocks.alias("blocks"), width.alias("width"))
    of_block = lambda b: F.filter("ids", lambda x: (x > b * F.col("width")) & (x <= (b + 1) * F.col("width")))       # noqa: E731
    per = per.select("_bid", "width", F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), of_block).alias("parts"))
    units = per.select("_bid", "width", "parts", F.posexplode("parts").alias("i", "left")).where(F.size("left") > 0)
    units = units.select("_bid", "width", "i", "left", F.posexplode("parts").alias("j", "right")).where((F.col("j") >= F.col("i")) & (F.size("right") > 0))
    return units.select("_bid", "width", "i", "j", "left", F.when(F.col("i") != F.col("j"), F.col("right")).alias("right")) \
        .repartitionByRange("i", "j", F.xxhash64("_bid"))


def _count_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """xy, n: partial counts of the units' pairs (x in the upper half of xy). Units come sorted by (i, j), so one
    array of counts is held at a time."""
    place, counts = None, None

    def told() -> Iterator[pa.RecordBatch]:
        if place is None:
            return
        i, j, width = place
        found = np.flatnonzero(counts)
        for k in np.split(found, range(1 << 16, len(found), 1 << 16)):
            xy = (i * width + 1 + k // width << 32) + j * width + 1 + k % width
            yield pa.RecordBatch.from_arrays([pa.array(xy), pa.array(counts[k])], names=["xy", "n"])

    for batch in batches:
        at = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("i", "j", "width")])
        left, right = batch.column("left"), batch.column("right")
        lo, ro = left.offsets.to_numpy().astype(np.int64), right.offsets.to_numpy().astype(np.int64)
        xs, ys = left.values.to_numpy().astype(np.int64), right.values.to_numpy().astype(np.int64)
        cuts = np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1
        for rows in np.split(np.arange(batch.num_rows), cuts):
            if not len(rows):
                continue
            here = tuple(map(int, at[:, rows[0]]))
            if here != place:
                yield from told()
                place, counts = here, np.zeros(here[2] ** 2, np.int64)
            i, j, width = here
            # every left id meets the ids first..last of its row: the later ones of its own block, or the other block's
            e = np.arange(lo[rows[0]], lo[rows[-1] + 1])
            row = np.repeat(rows, lo[rows + 1] - lo[rows])
            first, last, others = (e + 1, lo[row + 1], xs) if i == j else (ro[row], ro[row + 1], ys)
            ends = np.cumsum(last - first)
            for part in np.split(np.arange(len(e)), np.searchsorted(ends, np.arange(CHUNK, ends[-1], CHUNK))):
                n = last[part] - first[part]
                met = np.repeat(first[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                cell = np.repeat((xs[e[part]] - i * width - 1) * width, n) + others[met] - j * width - 1
                counts += np.bincount(cell, minlength=width ** 2)
    yield from told()


def pair_counts(baskets: DataFrame, items: DataFrame, params: Params = Params()) -> DataFrame:
    """X, y, pair_count of the unordered frequent pairs (x < y) with n(x, y) >= min_count.
    `items`: the frequent items of these baskets (item, iid)."""
    units = work_units(baskets, items).select("i", "j", "width", "left", "right").sortWithinPartitions("i", "j")
    # both ids in one long: the partial counts hash one column
    counts = (units.mapInArrow(_count_units, "xy long, n long").groupBy("xy").agg(F.sum("n").alias("pair_count"))
              .filter(F.col("pair_count") >= _min_count(baskets, params)))
    y = F.col("xy").bitwiseAND((1 << 32) - 1).cast("int")
    return counts.select(F.shiftright("xy", 32).cast("int").alias("x"), y.alias("y"), "pair_count")


def _both_ways(counts: DataFrame) -> DataFrame:
    ways = F.array(F.struct(F.col("x").alias("a_id"), F.col("y").alias("b_id")),
                   F.struct(F.col("y").alias("a_id"), F.col("x").alias("b_id")))
    return counts.select(F.explode(ways).alias("way"), "pair_count").select("way.*", "pair_count")


def named_pairs(counts: DataFrame, items: DataFrame) -> DataFrame:
    """a, b, pair_count, support (of a): the counted pairs in both orders, by name."""
    of = lambda name, *more: items.select(F.col("iid").alias(f"{name}_id"), F.col("item").alias(name), *more)
    return _both_ways(counts).join(of("a", "support"), "a_id").join(of("b"), "b_id").select("a", "b", "pair_count", "support")


def pair_support(baskets: DataFrame, params: Params = Params(),
                 frequent: DataFrame | None = None) -> DataFrame:
    """A14 (pairs): ordered pairs a != b of frequent items with n(a, b) >= min_count."""
    items = numbered(frequent_items(baskets, params) if frequent is None else frequent)
    return named_pairs(pair_counts(baskets, items, params), items).drop("support")


def rules_of(counts: DataFrame, items: DataFrame, params: Params = Params()) -> DataFrame:
    """G1: source, target, confidence from counted pairs and their items' supports."""
    rules = named_pairs(counts, items).select(
        F.col("a").alias("source"), F.col("b").alias("target"), (F.col("pair_count") / F.col("support")).alias("confidence"))
    return rules.filter(F.col("confidence") >= F.lit(float(params.min_confidence)))


def assoc_rules(baskets: DataFrame, params: Params = Params()) -> DataFrame:
    """G1: every 1 -> 1 rule: source, target, confidence (= n(a,b) / support(a)), in one plan."""
    items = numbered(frequent_items(baskets, params))
    return rules_of(pair_counts(baskets, items, params), items, params)


def top_rules(rules: DataFrame, params: Params = Params()) -> DataFrame:
    """At most `rules_per_source` rules per source, by confidence desc then target."""
    w = Window.partitionBy("source").orderBy(F.desc("confidence"), F.asc("target"))
    return (rules.withColumn("_rank", F.row_number().over(w))
            .filter(F.col("_rank") <= params.rules_per_source)
            .select(*RULE_COLUMNS))
