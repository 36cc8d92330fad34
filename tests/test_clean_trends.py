from pyspark.sql import functions as F

from trendlens.operators import clean, trends
from trendlens.params import Params

RAW = "id long, title string, discipline string, publish_year int, authors string, source string"


def test_dedup_before_filter(spark):
    raw = spark.createDataFrame([(1, "A", "d", 2010, "x", "s"), (2, "A", "d", 2020, "x", "s")], RAW)
    assert clean.clean_papers(raw).count() == 0


def test_titles_case_sensitive(spark):
    raw = spark.createDataFrame([(1, "A b", "d", 2020, "x", "s"), (2, "a b", "d", 2020, "x", "s")], RAW)
    assert clean.clean_papers(raw).count() == 2


def test_clean_qc_counts(spark):
    raw = spark.createDataFrame([(1, "A", "d", 2020, "x", "s"), (2, "A", "d", 2020, "x", "s"),
                                 (3, "", "d", 2020, "x", "s"), (4, "B", "d", 2011, "x", "s")], RAW)
    r = clean.clean_qc(raw).first().asDict()
    assert r == {"rows_in": 4, "dup_rows": 1, "empty_titles": 1, "bad_years": 0, "old_years": 1, "kept": 1}


def test_occurrences_count_twice(spark):
    raw = spark.createDataFrame([(1, "graph graph neural", "d", 2020, "x", "s")], RAW)
    freq = {r["word"]: r["count"] for r in trends.word_freq(clean.clean_papers(raw)).collect()}
    assert freq == {"graph": 2, "neural": 1}


def test_top_k_ties_by_word(spark):
    words = [f"w{chr(97 + i)}xx" for i in range(13)]
    raw = spark.createDataFrame([(1, " ".join(words), "d", 2020, "x", "s")], RAW)
    top = trends.trend_history(clean.clean_papers(raw))
    assert sorted(r["word"] for r in top.collect()) == sorted(words)[:12]
