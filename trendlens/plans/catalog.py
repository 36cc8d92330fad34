"""The registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (or stages the job derived from them) in full. Stage
queries return the lazy plan of that stage over the previous materialised stage, so running one
measures exactly that stage's work; reports read the materialised trend and rule tables.
Outputs avoid array columns (lists are rendered as text in a fixed order) so results compare
by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.operators import clean, forecast, paper_index, reports, rules, search, trends
from trendlens.params import FIXTURE_PARAMS
from trendlens.plans.job import pipeline
from trendlens.session import scratch_path
from trendlens.sources import ingest, tables

P = FIXTURE_PARAMS
NETWORK_YEAR = 2024
QUOTA_PER_SUBJECT = 100

# Request tables of the batch search reports (FIXTURES.md §3): parameters, joined with the data.
SUGGEST_QUERIES = ((1, "ml"), (2, "nlp"), (3, "tion"), (4, "learn"), (5, ""), (6, "zzzz"),
                   (7, "LÉARN"), (8, "vísion"))
SEARCH_QUERIES = ((1, "tion", "All", "All"), (2, "TION", "Machine Learning", "2020"),
                  (3, "", "Computer Vision", ""), (4, "%", "", ""), (5, "zzzz", "All", "All"),
                  (6, "étion", "All", "All"), (7, "ETION de", "", ""), (8, "", "máchine LEARNING", "2019"), (9, "", "", ""),
                  (10, "the a", "Computer Vision", "All"), (11, "of the in", "", "20x"), (12, "e", "All", "2021"))


def _pl(spark: SparkSession, sf_dir: str):
    return pipeline(spark, sf_dir, P)


def _sorted_text(items) -> F.Column:
    return F.array_join(F.array_sort(items), " ")


def _nonempty_text(words) -> F.Column:
    return F.array_join(F.filter(words, lambda w: w != F.lit("")), " ")


# ---------------------------------------------------------------- cleaning and text
def q_clean_papers(spark, sf_dir):
    return clean.clean_papers(_pl(spark, sf_dir).raw(), P)


def q_clean_qc(spark, sf_dir):
    return clean.clean_qc(_pl(spark, sf_dir).raw(), P)


def q_year_normalise(spark, sf_dir):
    # the normalised year is emitted as DOUBLE: NULL (not a number) then converts the same way in
    # every client (a nullable int becomes float in some and a nullable-int type in others)
    y = clean.year_normalise(tables.raw_years(tables.load(spark, sf_dir, "documents")))
    return y.select("id", "raw_year", F.col("year_int").cast("double").alias("year_num"))


def q_quota_sample(spark, sf_dir):
    return clean.quota_sample(_pl(spark, sf_dir).cleaned(), QUOTA_PER_SUBJECT)


def q_title_tokens(spark, sf_dir):
    t = trends.title_tokens(_pl(spark, sf_dir).cleaned())
    return t.select("id", F.size("tokens").alias("n_tokens"), _nonempty_text(F.col("tokens")).alias("tokens"))


def q_stopword_filter(spark, sf_dir):
    w = trends.filtered_words(_pl(spark, sf_dir).cleaned())
    kept = F.filter("words", lambda x: x != F.lit(""))
    return w.select("id", F.size(kept).alias("n_words"), F.array_join(kept, " ").alias("words"))


def q_word_freq(spark, sf_dir):
    return trends.word_freq(_pl(spark, sf_dir).cleaned(), P)


def q_trend_history(spark, sf_dir):
    return trends.trend_history(_pl(spark, sf_dir).cleaned(), P)


def q_trend_dense_series(spark, sf_dir):
    return trends.dense_rows(trends.dense_series(_pl(spark, sf_dir).history(), P), P)


# ---------------------------------------------------------------- forecast
def q_forecast_horizon(spark, sf_dir):
    return forecast.horizon(_pl(spark, sf_dir).history(), P)


def _fits(spark, sf_dir, materialised: bool = True) -> DataFrame:
    pl = _pl(spark, sf_dir)
    return pl.fits() if materialised else forecast.fit_series(pl.series())


def q_forecast_holt(spark, sf_dir):
    f = _fits(spark, sf_dir, materialised=False).filter(F.col("model") == "holt")
    return f.select("discipline", "word", "alpha", "beta", "sse", "level", "trend")


def q_forecast_ses(spark, sf_dir):
    f = _fits(spark, sf_dir, materialised=False).filter(F.col("model") == "ses")
    return f.select("discipline", "word", "alpha", "sse", "level")


def q_forecast_rows(spark, sf_dir):
    return forecast.forecast_rows(_fits(spark, sf_dir), P)


def q_trend_full(spark, sf_dir):
    return _pl(spark, sf_dir).trend().select(*trends.TREND_COLUMNS, "is_forecast")


# ---------------------------------------------------------------- association rules
def q_baskets_observed(spark, sf_dir):
    b = rules.baskets_observed(_pl(spark, sf_dir).cleaned(), P)
    return b.select("basket_id", _sorted_text(F.col("items")).alias("items"))


def q_baskets_full(spark, sf_dir):
    b = _pl(spark, sf_dir).baskets()
    kind = F.when(F.col("basket_id").isNull(), F.lit("forecast")).otherwise(F.lit("title"))
    return b.select("basket_key", kind.alias("kind"), _sorted_text(F.col("items")).alias("items"))


def q_item_support(spark, sf_dir):
    return rules.item_support(_pl(spark, sf_dir).baskets())


def q_pair_support(spark, sf_dir):
    pl = _pl(spark, sf_dir)
    return rules.named_pairs(pl.pair_counts(), pl.frequent()).drop("support")


def q_pair_counts(spark, sf_dir):
    """The counting stage itself, over the written baskets and frequent items (in one order, by name)."""
    pl = _pl(spark, sf_dir)
    name = lambda c, to: pl.frequent().select(F.col("iid").alias(c), F.col("item").alias(to))
    counts = rules.pair_counts(pl.baskets(), pl.frequent(), P).join(name("x", "_a"), "x").join(name("y", "_b"), "y")
    return counts.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"), "pair_count")


def q_assoc_rules(spark, sf_dir):
    pl = _pl(spark, sf_dir)
    return rules.rules_of(pl.pair_counts(), pl.frequent(), P)


def q_assoc_rules_topk(spark, sf_dir):
    return rules.top_rules(_pl(spark, sf_dir).rules_all(), P)


# ---------------------------------------------------------------- reports
def _trend(spark, sf_dir):
    return _pl(spark, sf_dir).trend()


def _rules(spark, sf_dir):
    return _pl(spark, sf_dir).rules()


def q_active_words(spark, sf_dir):
    return reports.active_words(_trend(spark, sf_dir), NETWORK_YEAR)


def q_network_links(spark, sf_dir):
    return reports.network_links(_trend(spark, sf_dir), _rules(spark, sf_dir), NETWORK_YEAR)


def q_network_nodes(spark, sf_dir):
    return reports.network_nodes(_trend(spark, sf_dir), _rules(spark, sf_dir), NETWORK_YEAR)


def q_theme_river(spark, sf_dir):
    return reports.theme_river(_trend(spark, sf_dir))


def q_leaderboard(spark, sf_dir):
    return reports.leaderboard(_trend(spark, sf_dir))


def q_max_year_by_discipline(spark, sf_dir):
    return reports.max_year_by_discipline(_trend(spark, sf_dir))


def q_rising_stars(spark, sf_dir):
    return reports.rising_stars(_trend(spark, sf_dir))


def q_bridge_words(spark, sf_dir):
    return reports.bridge_words(_trend(spark, sf_dir), _rules(spark, sf_dir))


def q_radar_metrics(spark, sf_dir):
    return reports.radar_metrics(_trend(spark, sf_dir), _rules(spark, sf_dir))


def q_discipline_list(spark, sf_dir):
    return reports.discipline_list(_trend(spark, sf_dir))


# ---------------------------------------------------------------- search and topics
def _search_log(spark, sf_dir):
    return tables.search_log(tables.load(spark, sf_dir, "events"))


def q_alias_resolve(spark, sf_dir):
    return search.alias_resolve(_search_log(spark, sf_dir).select("id", "discipline"))


def q_discipline_insights(spark, sf_dir):
    return reports.discipline_insights(_trend(spark, sf_dir), _rules(spark, sf_dir), _search_log(spark, sf_dir))


def q_search_log_append(spark, sf_dir):
    """The log after two batches of requests, one of which is sent twice."""
    log = _search_log(spark, sf_dir).select(F.col("id").alias("qid"), F.when(F.col("id") % 3 != 0, F.col("search_keyword")).alias("keyword"),
                                            "discipline", F.when(F.col("id") % 2 != 0, F.col("search_year")).alias("year"))
    path = scratch_path(spark, "search-log")
    for batch in ("even", "odd", "odd"):
        search.append_search_log(log.where(F.abs(F.col("qid")) % 2 == (0 if batch == "even" else 1)), path, batch)
    return spark.read.parquet(path).drop("batch")


def q_keyword_weights(spark, sf_dir):
    return trends.keyword_weights(_pl(spark, sf_dir).cleaned(), P)


def q_topic_requests(spark, sf_dir):
    """Requests: every discipline's words of each year as one keyword list, separated in four ways."""
    trend = _trend(spark, sf_dir)
    words = trend.where("discipline is not null").groupBy("discipline", "publish_year").agg(F.sort_array(F.collect_list("word")).alias("w"))
    sep = F.element_at(F.array(*[F.lit(x) for x in (",", " ; ", "，", "；, ")]), (F.col("publish_year") % 4 + 1).cast("int"))
    lists = words.select(F.concat_ws(":", "discipline", F.col("publish_year").cast("string")).alias("qid"), F.concat(F.lit(" ,"), F.array_join("w", "|"), F.lit(";")).alias("_k"), sep.alias("_s"))
    return search.topic_requests(trend, _rules(spark, sf_dir), lists.select("qid", F.replace("_k", F.lit("|"), F.col("_s")).alias("keywords")))


def q_search_suggest(spark, sf_dir):
    qs = spark.createDataFrame(list(SUGGEST_QUERIES), "qid int, q string")
    return search.search_suggest(_trend(spark, sf_dir), qs)


def q_paper_search(spark, sf_dir):
    reqs = spark.createDataFrame(list(SEARCH_QUERIES), "qid int, keyword string, discipline string, year string")
    pl = _pl(spark, sf_dir)
    return search.paper_search(pl.cleaned(), reqs, pl.postings(), pl.word_grams(), pl.gram_sizes(), pl.written)


def q_paper_postings(spark, sf_dir):
    """The title index stage itself: papers per word."""
    posted = paper_index.postings(_pl(spark, sf_dir).cleaned())
    return posted.groupBy("word").agg(F.count(F.lit(1)).alias("papers"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def q_keyword_split(spark, sf_dir):
    c = _pl(spark, sf_dir).cleaned().select("id", "title")
    return search.keyword_split(c, "title").select("id", "n_keywords", "main_keyword")


def q_domain_classify(spark, sf_dir):
    c = _pl(spark, sf_dir).cleaned().select("id", "title")
    return search.domain_classify(c, "title").select("id", "domain")


def _keywords(spark, sf_dir):
    return search.topic_keywords(_trend(spark, sf_dir))


def q_keyword_evidence(spark, sf_dir):
    return search.keyword_evidence(_trend(spark, sf_dir), _keywords(spark, sf_dir))


def q_related_terms(spark, sf_dir):
    return search.related_terms(_rules(spark, sf_dir), _keywords(spark, sf_dir))


def q_topic_candidates(spark, sf_dir):
    return search.topic_candidates(_rules(spark, sf_dir), _keywords(spark, sf_dir))


# ---------------------------------------------------------------- ingest
def _payloads(spark, sf_dir):
    return tables.ingest_payloads(_pl(spark, sf_dir).raw())


def q_ingest_batches(spark, sf_dir):
    return ingest.ingest_batches(_payloads(spark, sf_dir))


def q_ingest_batch_status(spark, sf_dir):
    return ingest.batch_status(_payloads(spark, sf_dir))


def q_ingest_rejects(spark, sf_dir):
    return ingest.rejected_batches(_payloads(spark, sf_dir))


def _works(spark, sf_dir):
    """Parsed work records with the subject of their concept (one row per work and subject)."""
    works = ingest.parse_works(tables.api_works(tables.load(spark, sf_dir, "documents")))
    subjects = spark.createDataFrame(
        [(cid, name) for name, cid in ingest.vocab.SUBJECT_CONCEPTS], "concept_id string, subject string")
    tagged = works.select("*", F.explode("concepts").alias("_c")).join(
        F.broadcast(subjects), F.col("_c.id") == F.col("concept_id"))
    return tagged


def q_normalise_works(spark, sf_dir):
    return ingest.normalise_works(_works(spark, sf_dir), F.col("subject"))


def q_works_source_filter(spark, sf_dir):
    kept = ingest.source_filter(_works(spark, sf_dir), F.col("concept_id"))
    return ingest.normalise_works(kept, F.col("subject"))


def q_search_log_rollup(spark, sf_dir):
    from trendlens.streaming.jobs import search_log_windows
    return search_log_windows(_search_log(spark, sf_dir))


QUERIES = {
    name[2:]: fn for name, fn in list(globals().items())
    if name.startswith("q_") and callable(fn)
}
