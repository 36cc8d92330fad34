"""Search, suggestions and topic evidence in batch form: a table of requests joined with the data.

Substring matching (`LIKE %q%`) between data-derived tables (keywords, trend words, rules) goes by
grams (`substring.meet`), an equi-join. Paper search reads a written index of the titles (`paper_index`).
Text is compared without case and accents. Only the alias and fallback tables (fixed values) are broadcast by hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlens.functions import text, vocab
from trendlens.operators import paper_index
from trendlens.operators.reports import alias_map, discipline_list, resolve_alias
from trendlens.operators.substring import meet

SUGGESTIONS = 8
SUGGEST_PER_BRANCH = 5
SEARCH_LIMIT = 50
RELATED_RULES = 5


def alias_resolve(requests: DataFrame, column: str = "discipline") -> DataFrame:
    """See `reports.resolve_alias`."""
    return resolve_alias(requests, column)


def search_suggest(trend: DataFrame, queries: DataFrame) -> DataFrame:
    """Per query (qid, q): the exact alias first, then up to 5 words and up to 5
    disciplines containing q (case- and accent-insensitive, alphabetical), duplicates dropped, at most 8.
    An empty q suggests nothing. Output: qid, rank, suggestion."""
    q = queries.select("qid", text.fold(text.strip(F.col("q"))).alias("q")).filter(F.col("q") != "")
    aliases = F.broadcast(alias_map(queries.sparkSession))
    alias_hits = q.join(aliases, F.col("q") == F.col("alias")).select(
        "qid", F.lit(0).alias("branch"), F.lit(0).alias("pos"), F.col("resolved").alias("suggestion"))

    # both branches (words = 1, disciplines = 2) in one value table: one probe, one window
    values = trend.select(F.col("word").alias("value"), F.lit(1).alias("branch")).unionByName(
        trend.select(F.col("discipline").alias("value"), F.lit(2).alias("branch"))).filter(
        F.col("value").isNotNull()).distinct().withColumn("_v", text.fold(F.col("value")))
    hits = meet(q, "q", values, "_v").where(F.contains(F.col("_v"), F.col("q")))
    w = Window.partitionBy("qid", "branch").orderBy("value")
    branches = hits.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= SUGGEST_PER_BRANCH) \
        .select("qid", "branch", "pos", F.col("value").alias("suggestion"))
    every = alias_hits.unionByName(branches)
    first = every.groupBy("qid", "suggestion").agg(F.min(F.struct("branch", "pos")).alias("_k"))
    w = Window.partitionBy("qid").orderBy("_k")
    return first.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= SUGGESTIONS) \
        .select("qid", "rank", "suggestion")


def paper_search(cleaned: DataFrame, requests: DataFrame, posted: DataFrame | None = None, grams: DataFrame | None = None,
                 sizes: DataFrame | None = None, write=lambda name, rows: rows) -> DataFrame:
    """Per request (qid, keyword, discipline, year), the 50 newest matching papers.

    keyword: substring of the title, literal, case- and accent-insensitive; discipline: equality that ignores
    both; year: equality. Empty or "All" means no filter on that field; a year that is no number finds nothing.
    Output: qid, rank, id, title, discipline, publish_year, source.

    `posted`, `grams`, `sizes`: the title index (`paper_index`), as the job wrote it; made in the plan where not given.
    `write` (name, rows) -> rows: writes the narrow tables in between, where the caller has a place for them.
    """
    if posted is None:
        posted = paper_index.postings(cleaned)
    if grams is None:
        grams = paper_index.word_grams(posted)
    if sizes is None:
        sizes = paper_index.gram_sizes(grams)
    return paper_index.search(cleaned, requests, posted, grams, sizes, SEARCH_LIMIT, write)


def search_log_entries(requests: DataFrame) -> DataFrame:
    """The search-history rows a batch of requests appends (any criterion non-empty)."""
    kw = F.trim(F.coalesce(F.col("keyword"), F.lit("")))
    disc = F.coalesce(F.col("discipline"), F.lit(""))
    year = F.coalesce(F.col("year"), F.lit(""))
    return requests.filter((kw != "") | (disc != "") | (year != "")).select(
        "qid", kw.alias("search_keyword"), disc.alias("discipline"), year.alias("search_year"))


def append_search_log(requests: DataFrame, log_dir: str, batch: str) -> None:
    """Append a batch of requests to the log under `log_dir`, in a folder named by the batch: a batch that is
    sent again replaces itself. A batch without any criterion leaves an empty folder with the log's columns."""
    search_log_entries(requests).write.mode("overwrite").parquet(f"{log_dir}/batch={batch}")


def keyword_split(rows: DataFrame, column: str) -> DataFrame:
    """Split a keyword list on , ， ; ； (runs count as one), trim, drop empties.
    Adds n_keywords and main_keyword (NULL when nothing is left)."""
    parts = text.split_keywords(F.col(column))
    return rows.select("*", F.size(parts).alias("n_keywords"),
                       F.element_at(parts, 1).alias("main_keyword")) \
        .withColumn("main_keyword", F.when(F.col("n_keywords") > 0, F.col("main_keyword")))


def domain_classify(rows: DataFrame, column: str) -> DataFrame:
    """Adds `domain` for the text in `column`."""
    return rows.withColumn("domain", text.domain_of(F.col(column)))


def topic_keywords(trend: DataFrame) -> DataFrame:
    """The keyword requests for topic evidence: every word and discipline of the trend table."""
    words = trend.select(F.col("word").alias("keyword"))
    discs = discipline_list(trend).select(F.col("discipline").alias("keyword"))
    return words.unionByName(discs).filter(F.col("keyword").isNotNull()).distinct()


def keyword_evidence(trend: DataFrame, keywords: DataFrame) -> DataFrame:
    """Per keyword: domain, matched volume (sum of counts of trend rows whose word
    or discipline contains it, without case and accents) and its band."""
    t = trend.groupBy(text.fold(F.col("word")).alias("_w"), text.fold(F.col("discipline")).alias("_d")).agg(F.sum("count").alias("count"))
    k = keywords.select("keyword").distinct().withColumn("_k", text.fold(F.col("keyword")))
    hit = F.contains(F.col("_w"), F.col("_k")) | F.contains(F.col("_d"), F.col("_k"))
    found = meet(k, "_k", t, "_w", "_d").where(hit).groupBy("keyword").agg(F.sum("count").alias("_sum"))
    vol = k.join(found, "keyword", "left").select("keyword", F.coalesce("_sum", F.lit(0)).cast("long").alias("main_count"))
    return vol.select("keyword", text.domain_of(F.col("keyword")).alias("domain"), "main_count",
                      text.volume_band(F.col("main_count")).alias("band"))


def related_terms(rules: DataFrame, keywords: DataFrame) -> DataFrame:
    """Per keyword, the 5 strongest rules whose source or target contains it
    (confidence desc, source, target). Output: keyword, rank, source, target, confidence."""
    r = rules.select("source", "target", "confidence", text.fold(F.col("source")).alias("_s"), text.fold(F.col("target")).alias("_t"))
    k = keywords.withColumn("_k", text.fold(F.col("keyword")))
    hit = F.contains(F.col("_s"), F.col("_k")) | F.contains(F.col("_t"), F.col("_k"))
    w = Window.partitionBy("keyword").orderBy(F.desc("confidence"), F.asc("source"), F.asc("target"))
    return meet(k, "_k", r, "_s", "_t").where(hit).withColumn("rank", F.row_number().over(w)) \
        .filter(F.col("rank") <= RELATED_RULES).select("keyword", "rank", "source", "target", "confidence")


def _fallback_table(spark) -> DataFrame:
    rows = [(d, i + 1, term) for d, terms in vocab.DOMAIN_FALLBACK_TERMS for i, term in enumerate(terms)]
    return spark.createDataFrame(rows, "domain string, pad_pos int, term string")


def topic_candidates(rules: DataFrame, keywords: DataFrame) -> DataFrame:
    """Q10: per keyword, 3 (template, related term) slots. Related terms are the targets of its
    related rules other than the keyword itself, strongest first; missing slots are padded with
    the domain's fallback terms in list order.
    Output: keyword, domain, slot, template_id, related, is_padded."""
    rel = related_terms(rules, keywords).filter(F.lower(F.col("target")) != F.lower(F.col("keyword")))
    w = Window.partitionBy("keyword").orderBy("rank")
    rel = rel.withColumn("slot", F.row_number().over(w)).filter(F.col("slot") <= vocab.TOPIC_SLOTS) \
        .select("keyword", "slot", F.col("target").alias("related"))
    slots = keywords.select("keyword", text.domain_of(F.col("keyword")).alias("domain"),
                            F.explode(F.sequence(F.lit(1), F.lit(vocab.TOPIC_SLOTS))).alias("slot"))
    # kept related terms fill slots 1..n without gaps, so n = how many slots of the keyword have one
    n_rel = F.count("related").over(Window.partitionBy("keyword"))
    j = slots.join(rel, ["keyword", "slot"], "left") \
        .withColumn("pad_pos", F.col("slot") - n_rel)
    pads = F.broadcast(_fallback_table(keywords.sparkSession))
    j = j.join(pads, ["domain", "pad_pos"], "left")
    padded = F.col("related").isNull()
    return j.select("keyword", "domain", "slot", F.col("slot").alias("template_id"),
                    F.coalesce(F.col("related"), F.col("term")).alias("related"),
                    padded.alias("is_padded"))


def topic_requests(trend: DataFrame, rules: DataFrame, requests: DataFrame) -> DataFrame:
    """Q9 + Q10 as requests (qid, keywords): the list is split, its first keyword is the main one; evidence for it
    (domain, matched volume, band) beside its candidate slots. A list without a keyword has no rows.
    Output: qid, keyword, n_keywords, domain, main_count, band, slot, template_id, related, is_padded."""
    asked = keyword_split(requests, "keywords").where("n_keywords > 0").select("qid", "n_keywords", F.col("main_keyword").alias("keyword"))
    keys = asked.select("keyword").distinct()
    evidence = keyword_evidence(trend, keys)
    slots = topic_candidates(rules, keys).drop("domain")
    return asked.join(evidence, "keyword").join(slots, "keyword").select(
        "qid", "keyword", "n_keywords", "domain", "main_count", "band", "slot", "template_id", "related", "is_padded")
