"""The physical-plan properties the design relies on at scale (see README, 'How the job runs')."""

from pyspark.sql import functions as F

from trendlens.operators import clean, search
from trendlens.operators.substring import meet
from trendlens.plans import catalog

from conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_cut_before_shuffle(spark):
    """Dedup, top words, quota and search keep at most k rows per key per map task."""
    frames = {name: catalog.QUERIES[name](spark, SF001) for name in ("clean_papers", "trend_history", "quota_sample", "assoc_rules_topk")}
    # the registered search writes its hits before they meet the titles: the same operator in one plan
    requests = spark.createDataFrame(list(catalog.SEARCH_QUERIES), "qid int, keyword string, discipline string, year string")
    frames["paper_search"] = search.paper_search(frames["clean_papers"], requests)
    for name, df in frames.items():
        plan = _plan(df)
        assert "WindowGroupLimit" in plan and "Partial" in plan, name


def test_counts_combine_map_side(spark):
    for name in ("word_freq", "item_support", "pair_counts"):
        assert "partial_count" in _plan(catalog.QUERIES[name](spark, SF001)), name


def test_pair_counting_leaves_partitions_and_broadcasts_to_the_planner(spark):
    """No fixed partition count, no forced broadcast and no checkpointed data inside the plan."""
    counts = catalog.QUERIES["pair_counts"](spark, SF001)
    assert "REPARTITION_BY_NUM" not in _plan(counts) and "REPARTITION_BY_COL" in _plan(counts)
    assert "hint" not in counts._jdf.queryExecution().analyzed().toString().lower()
    assert "ExistingRDD" not in _plan(counts)


def test_hot_title_dedups_to_lowest_id(spark):
    """A title shared by a third of the rows: one survivor, the lowest id; the rest untouched."""
    n = 3000
    rows = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 1, F.lit("Untitled")).otherwise(F.concat(F.lit("t"), F.col("id").cast("string")))
        .alias("title"),
        F.lit("d").alias("discipline"), F.lit(2020).alias("publish_year"),
        F.lit("a").alias("authors"), F.lit("s").alias("source"))
    out = clean.clean_papers(rows)
    assert out.count() == n - n // 3 + 1
    assert out.filter(F.col("title") == "Untitled").select("id").first()[0] == 1


def test_qc_combines_hot_titles_map_side(spark):
    """The summary counts per title before its shuffle: no window holds a hot title's rows."""
    plan = _plan(catalog.QUERIES["clean_qc"](spark, SF001))
    assert "partial_count" in plan and "Window " not in plan
    rows = spark.range(3000).selectExpr(
        "id", "if(id % 3 = 1, cast(null as string), concat('t', id)) as title", "'d' as discipline",
        "2020 as publish_year", "'a' as authors", "'s' as source")
    r = clean.clean_qc(rows).first().asDict()
    assert r == {"rows_in": 3000, "dup_rows": 999, "empty_titles": 1, "bad_years": 0, "old_years": 0, "kept": 2000}


def test_top_per_key_in_two_levels(spark):
    """Same rows and ranks as one window, on a key that holds all rows but one; both levels cut early."""
    rows = spark.range(5000).selectExpr("if(id = 7, 'b', 'a') as k", "id", "id % 10 as v")
    top = clean.top_per_key(rows, "k", "id", 20, F.desc("v"), F.asc("id"))
    got = [(r["k"], r["rank"], r["id"]) for r in top.orderBy("k", "rank").collect()]
    assert got == [("a", i + 1, 9 + 10 * i) for i in range(20)] + [("b", 1, 7)]
    assert _plan(top).count("WindowGroupLimit") >= 3


def test_no_python_udfs_in_plans(spark):
    """Every registered batch query stays on JVM built-ins (no Python UDF / Arrow eval nodes)."""
    for name, fn in catalog.QUERIES.items():
        plan = _plan(fn(spark, SF001))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_substring_reports_join_by_key(spark):
    """Keyword reports over data-derived tables: no nested loop and no cartesian product."""
    for name in ("keyword_evidence", "related_terms", "topic_candidates", "search_suggest"):
        plan = _plan(catalog.QUERIES[name](spark, SF001))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_gram_meeting_loses_no_match(spark):
    words = ["", "a", "ab", "abc", "bcab", "été", "tété", "x%_y", "aaaa", None, "zz"]
    needles = spark.createDataFrame([(w,) for w in [*words, "%_", "aaa", "q"]], "n string")
    values = spark.createDataFrame([(i, w, words[-1 - i]) for i, w in enumerate(words)], "i int, v string, u string")
    met = meet(needles, "n", values, "v", "u").where(F.contains("v", "n") | F.contains("u", "n"))
    want = sorted((n, i) for n in {r.n for r in needles.collect()} if n is not None
                  for i, w in enumerate(words) if any(x is not None and n in x for x in (w, words[-1 - i])))
    assert sorted((r.n, r.i) for r in met.collect()) == want
