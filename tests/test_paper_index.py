"""The title index against a plain scan of every title."""

import unicodedata

from trendlens.functions import text
from trendlens.operators import paper_index, search
from trendlens.plans import catalog

from conftest import SF001

PAPERS = [
    (1, "Étude des réseaux", "Éducation", 2020), (2, "etude des reseaux de neurones", "education", 2021),
    (3, "Machine  learning", "CS", 2021), (4, "machine learning at scale", "cs", 2019), (5, "learningmachine", None, 2021),
    (6, "abab ab", "CS", 2020), (7, "x%y_z", "CS", 2020), (8, "tab\there", "CS", 2021), (9, "a" * 50, "CS", 2018),
    (10, "machine learning", "CS", 2021), (11, "ÀÇÑ ß", "Médecine", 2020), (12, "étude jointe", "CS", 2022)]
REQUESTS = [
    (1, "ETUDE", "", ""), (2, "étude dès", "All", None), (3, "machine learning", None, "2021"), (4, "machine  learning", "", ""),
    (5, "ne le", "", ""), (6, "ab ab", "", ""), (7, "abab a", "", ""), (8, "%", "", ""), (9, "b here", "", ""), (10, "", "EDUCATION", "All"),
    (11, None, "cs", "2021"), (12, " \t ", "All", "2018"), (13, "", "", ""), (14, "a", "CS", ""), (15, "etude", "", "20x"), (16, "zzz q", "", ""),
    (17, "acn", "medecine", "2020"), (18, "learning machine", "", ""), (19, "\tmachine", "", "")]


def fold(s):
    return "".join(c for c in unicodedata.normalize("NFD", s.lower()) if not unicodedata.combining(c))


def scan(keyword, discipline, year):
    kw = fold((keyword or "").strip())
    hits = [p for p in PAPERS if kw in fold(p[1])
            and (discipline in (None, "", "All") or fold(p[2] or "") == fold(discipline))
            and (year in (None, "", "All") or str(p[3]) == year)]
    return [p[0] for p in sorted(hits, key=lambda p: (-p[3], p[0]))]


def frames(spark):
    papers = spark.createDataFrame([(i, t, d, y, "a", "s") for i, t, d, y in PAPERS],
                                   "id long, title string, discipline string, publish_year int, authors string, source string")
    return papers, spark.createDataFrame(REQUESTS, "qid int, keyword string, discipline string, year string")


def test_search_equals_a_scan(spark):
    papers, requests = frames(spark)
    got = {}
    for r in search.paper_search(papers, requests).orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append(r["id"])
    assert got == {q: ids for q, *rest in REQUESTS if (ids := scan(*rest))}


def test_written_index_and_limit(spark, tmp_path, monkeypatch):
    """The index read back from its tables, and the newest two only."""
    monkeypatch.setattr(search, "SEARCH_LIMIT", 2)
    papers, requests = frames(spark)
    paper_index.postings(papers).write.parquet(str(tmp_path / "postings"))
    posted = spark.read.parquet(str(tmp_path / "postings"))
    paper_index.word_grams(posted).write.parquet(str(tmp_path / "grams"))
    got = {}
    for r in search.paper_search(papers, requests, posted, spark.read.parquet(str(tmp_path / "grams"))).collect():
        got.setdefault(r["qid"], []).append((r["rank"], r["id"]))
    assert {q: [i for _, i in sorted(v)] for q, v in got.items()} == {q: ids[:2] for q, *rest in REQUESTS if (ids := scan(*rest))}


def test_empty_tables(spark):
    papers, requests = frames(spark)
    assert search.paper_search(papers.limit(0), requests).count() == 0
    assert search.paper_search(papers, requests.limit(0)).count() == 0


def test_fold_drops_case_and_accents(spark):
    words = ["Étude", "étude", "ÀÇÑ", "Ångström", "naïve", "ß", "x%_", "Ǘ", "ḗ"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(text.fold(df.w)).collect()]
    assert got == [fold(w) for w in words]


def test_paper_search_reads_titles_by_key(spark):
    """No nested loop and no cartesian product over the papers, and nothing counted while the plan is built."""
    plans = [catalog.QUERIES["paper_search"](spark, SF001), search.paper_search(*frames(spark))]
    for plan in (p._jdf.queryExecution().executedPlan().toString() for p in plans):
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan
