from trendlens.operators import reports, search

TREND = "discipline string, publish_year int, word string, count long"
RULES = "source string, target string, confidence double"


def test_growth_rules(spark):
    t = spark.createDataFrame([
        ("D", 2025, "grow", 4), ("D", 2026, "grow", 5),     # 25 %
        ("D", 2025, "zero", 0), ("D", 2026, "zero", 3),     # b = 0 -> excluded
        ("D", 2024, "gap", 2), ("D", 2026, "gap", 9),       # only Y-2 -> excluded
    ], TREND)
    got = [(r["word"], r["growth"], r["is_fallback"]) for r in reports.rising_stars(t).collect()]
    assert got == [("grow", 25.0, False)]


def test_rising_fallback_flagged(spark):
    t = spark.createDataFrame([("D", 2026, "a", 7), ("D", 2026, "b", 9)], TREND)
    got = [(r["word"], r["growth"], r["is_fallback"]) for r in reports.rising_stars(t).orderBy("rank").collect()]
    assert got == [("b", None, True), ("a", None, True)]


def test_bridge_partner(spark):
    t = spark.createDataFrame([("x", 2020, "w", 1)], TREND)
    r = spark.createDataFrame([("x", "t", 0.5), ("y", "t", 0.9), ("z", "t", 0.9)], RULES)
    row = reports.bridge_words(t, r).first()
    assert (row["discipline"], row["keyword"], row["linked_discipline"]) == ("x", "t", "y")


def test_network_drops_inactive_and_counts_degrees(spark):
    t = spark.createDataFrame([("D", 2024, "alpha", 5), ("D", 2024, "beta", 3)], TREND)
    r = spark.createDataFrame([("D", "alpha", 0.5), ("alpha", "beta", 0.4), ("D", "gone", 0.9)], RULES)
    links = reports.network_links(t, r, 2024).collect()
    assert sorted((x["source"], x["target"]) for x in links) == [("D", "alpha"), ("alpha", "beta")]
    nodes = {x["name"]: x for x in reports.network_nodes(t, r, 2024).collect()}
    assert sum(n["value"] for n in nodes.values()) == 2 * len(links)
    assert nodes["D"]["category"] == 0 and nodes["D"]["symbol_size"] == 28
    assert nodes["alpha"]["category"] == 1 and nodes["alpha"]["symbol_size"] == 16


def test_leaderboard_ranks(spark):
    t = spark.createDataFrame([("A", 2020, "w1", 5), ("A", 2021, "w1", 5), ("A", 2020, "w2", 3),
                               ("B", 2020, "v", 20)], TREND)
    rows = {r["discipline"]: r for r in reports.leaderboard(t).collect()}
    assert rows["B"]["discipline_rank"] == 1 and rows["A"]["top_words"] == "w1, w2"
    assert rows["A"]["total_heat"] == 13


def test_alias_resolution(spark):
    req = spark.createDataFrame([(1, " ML "), (2, "Computer Vision"), (3, "")], "id int, discipline string")
    got = {r["id"]: r["resolved"] for r in search.alias_resolve(req).collect()}
    assert got == {1: "Machine Learning", 2: "Computer Vision", 3: ""}


def test_suggest_alias_first_and_literal_match(spark):
    t = spark.createDataFrame([("Machine Learning", 2020, "learning", 3), ("Machine Learning", 2020, "percent", 1)], TREND)
    qs = spark.createDataFrame([(1, "ml"), (2, "%"), (3, "")], "qid int, q string")
    got = [(r["qid"], r["rank"], r["suggestion"]) for r in search.search_suggest(t, qs).orderBy("qid", "rank").collect()]
    assert got == [(1, 1, "Machine Learning")]


def test_topic_candidates_padding(spark):
    r = spark.createDataFrame([("cloud", "edge", 0.9), ("cloud", "cloud", 0.8)], RULES)
    kw = spark.createDataFrame([("cloud",)], "keyword string")
    rows = search.topic_candidates(r, kw).orderBy("slot").collect()
    assert [(x["related"], x["is_padded"]) for x in rows] == [("edge", False), ("知识图谱", True), ("强化学习", True)]
    assert {x["domain"] for x in rows} == {"cs_eng"}
