from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from trendlens.functions import text
from trendlens.operators import rules
from trendlens.params import FIXTURE_PARAMS, Params
from trendlens.plans.job import pipeline

from conftest import SF01


def test_pair_rules_by_hand(spark):
    b = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "b"]), (3, ["a"])], "basket_id long, items array<string>")
    got = {(r["source"], r["target"]): r["confidence"]
           for r in rules.assoc_rules(b, Params(min_support=0.1, min_confidence=0.1)).collect()}
    assert got == {("a", "b"): 2 / 3, ("b", "a"): 1.0}


def test_same_rules_as_fpgrowth(spark):
    """Pair counting gives exactly FP-Growth's 1 -> 1 rules. FP-Growth mines itemsets of every
    size, so the cross-check uses small baskets (discipline + the first 6 long words of each
    sf0.01 paper); the registered queries use whole texts."""
    p = FIXTURE_PARAMS
    cleaned = pipeline(spark, SF01, p).cleaned()
    small = F.array_union(F.array("discipline"), F.slice(text.long_words(text.tokens(F.col("title")), 5), 1, 6))
    baskets = cleaned.select(F.col("id").alias("basket_id"), small.alias("items")).cache()
    ours = {(r["source"], r["target"]): r["confidence"] for r in rules.assoc_rules(baskets, p).collect()}
    model = FPGrowth(itemsCol="items", minSupport=p.min_support, minConfidence=p.min_confidence).fit(baskets)
    ar = model.associationRules.filter((F.size("antecedent") == 1) & (F.size("consequent") == 1))
    theirs = {(r["antecedent"][0], r["consequent"][0]): r["confidence"] for r in ar.collect()}
    assert len(ours) > 50
    assert ours.keys() == theirs.keys()
    assert max(abs(ours[k] - theirs[k]) for k in ours) < 1e-12


def test_wide_baskets_in_work_units(spark, monkeypatch):
    """Baskets of up to 40 blocks, one that holds a third of all occurrences: the pairs of a plain double loop."""
    monkeypatch.setattr(rules, "BLOCK", 5)
    sizes = [0, 1, 2, 5, 6, 11, 200, 3, 37]
    rows = [(i, [f"w{(7 * i + k) % 211:03d}" for k in range(n)]) for i, n in enumerate(sizes)]
    b = spark.createDataFrame(rows, "basket_id long, items array<string>")
    got = {(r["a"], r["b"]): r["pair_count"] for r in rules.pair_support(b, Params(min_support=0.01)).collect()}
    want = {}
    for _, items in rows:
        for x in items:
            for y in items:
                if x != y:
                    want[x, y] = want.get((x, y), 0) + 1
    assert got == want


def test_written_items_give_the_same_pairs(spark, tmp_path):
    """Numbered items read back from a table (the job's way) against items that stand for themselves."""
    rows = [(i, [f"w{k}" for k in range(30) if (i * k) % 7 < 3]) for i in range(40)]
    b = spark.createDataFrame(rows, "basket_id long, items array<string>")
    p = Params(min_support=0.2, min_confidence=0.3)
    rules.numbered(rules.frequent_items(b, p)).write.parquet(str(tmp_path / "items"))
    items = spark.read.parquet(str(tmp_path / "items"))
    got = sorted(map(tuple, rules.rules_of(rules.pair_counts(b, items, p), items, p).collect()))
    assert got and got == sorted(map(tuple, rules.assoc_rules(b, p).collect()))


def test_top_rules_cap_and_order(spark):
    p = Params(rules_per_source=2)
    r = spark.createDataFrame([("s", "t1", 0.5), ("s", "t2", 0.9), ("s", "t3", 0.9), ("u", "t", 0.3)],
                              "source string, target string, confidence double")
    got = sorted((x["source"], x["target"]) for x in rules.top_rules(r, p).collect())
    assert got == [("s", "t2"), ("s", "t3"), ("u", "t")]


def test_pairs_are_counted_before_they_leave_a_task(spark):
    """Partial counts, not a row per pair, come out of the units (60 baskets of 40 items: 46,800 pairs, 780 counts)."""
    rows = [(i, [f"w{k:02d}" for k in range(40)]) for i in range(60)]
    b = spark.createDataFrame(rows, "basket_id long, items array<string>")
    items = rules.numbered(rules.frequent_items(b, Params(min_support=0.1)))
    units = rules.work_units(b, items).select("i", "j", "width", "left", "right").coalesce(1).sortWithinPartitions("i", "j")
    parts = units.mapInArrow(rules._count_units, "xy long, n long")
    assert (parts.count(), parts.agg(F.sum("n")).first()[0]) == (780, 60 * 780)


def test_pairs_in_chunks(spark, monkeypatch):
    """A chunk ends inside a basket, and a block of ids is not wider than its limit."""
    rows = [(i, [f"w{k:02d}" for k in range(60) if (i + k) % 3]) for i in range(30)]
    b = spark.createDataFrame(rows, "basket_id long, items array<string>")
    items = rules.numbered(rules.frequent_items(b, Params(min_support=0.1)))
    for name, value in (("BLOCK", 2), ("WIDEST", 3)):
        monkeypatch.setattr(rules, name, value)
    assert rules.work_units(b, items).agg(F.max("width")).first()[0] == 3
    monkeypatch.setattr(rules, "WIDEST", 25)
    units = rules.work_units(b, items).select("i", "j", F.lit(4).alias("width"), "left", "right").sort("i", "j")
    want = {}
    for r in units.collect():
        for k, x in enumerate(r.left):
            for y in r.left[k + 1:] if r.right is None else r.right:
                want[(x << 32) + y] = want.get((x << 32) + y, 0) + 1
    monkeypatch.setattr(rules, "CHUNK", 7)
    got = [pair for part in rules._count_units(units.toArrow().to_batches(max_chunksize=50)) for pair in zip(part["xy"].to_pylist(), part["n"].to_pylist())]
    assert dict(got) == want and len(got) == len(want)
