"""Oracle SQL (DuckDB) per registered query; same column names and types as the Spark result."""

from __future__ import annotations

from trendlens.functions import vocab
from trendlens.oracle.duckdb_sql import (ALIASES, RAW_PAPERS, SEARCH_LOG, STOP, SUBJECTS, TOKENS, YEAR_NORM,
                                          _case_index, _q, band_sql, chain, contains_ci, domain_sql, fold_sql, with_ctes)
from trendlens.params import FIXTURE_PARAMS
from trendlens.plans import catalog
from trendlens.sources import tables

P = FIXTURE_PARAMS
INT = "INTEGER"
TRIM_WS = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _rank(expr: str) -> str:
    return f"CAST({expr} AS {INT})"


def _values(rows, names) -> str:
    vals = ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else _q(v) for v in r) + ")" for r in rows)
    return f"({', '.join(names)}) AS (VALUES {vals})"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    C = lambda stage, *extra: with_ctes(P, stage, *extra)

    # ------------------------------------------------------------ cleaning and text
    q["clean_papers"] = chain(P, "cleaned") + "SELECT id, title, discipline, publish_year, authors, source FROM cleaned"
    y = YEAR_NORM.format(c="publish_year")
    has_title = "(title IS NOT NULL AND title <> '')"
    n = lambda cond: f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"
    q["clean_qc"] = f"""WITH {RAW_PAPERS},
marked AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY id) AS rn, {y} AS y FROM raw_papers)
SELECT count(*) AS rows_in, {n('rn <> 1')} AS dup_rows, {n(f'rn = 1 AND NOT {has_title}')} AS empty_titles,
       {n(f'rn = 1 AND {has_title} AND y IS NULL')} AS bad_years,
       {n(f'rn = 1 AND {has_title} AND y < {P.min_year}')} AS old_years,
       {n(f'rn = 1 AND {has_title} AND y >= {P.min_year}')} AS kept
FROM marked"""
    years = _case_index("doc_id % 6", list(tables.RAW_YEAR_CYCLE))
    q["year_normalise"] = f"""WITH raw_years AS (SELECT doc_id AS id, {years} AS raw_year FROM documents)
SELECT id, raw_year, CAST({YEAR_NORM.format(c='raw_year')} AS DOUBLE) AS year_num FROM raw_years"""
    q["quota_sample"] = chain(P, "cleaned") + f"""SELECT id, title, discipline, publish_year, authors, source FROM (
  SELECT *, row_number() OVER (PARTITION BY discipline ORDER BY id) AS rk FROM cleaned)
WHERE rk <= {catalog.QUOTA_PER_SUBJECT}"""
    q["title_tokens"] = chain(P, "cleaned") + f"""SELECT id, CAST(len(t) AS {INT}) AS n_tokens,
  array_to_string(list_filter(t, lambda w: w <> ''), ' ') AS tokens
FROM (SELECT id, {TOKENS} AS t FROM cleaned)"""
    q["stopword_filter"] = chain(P, "cleaned") + f"""SELECT id, CAST(len(k) AS {INT}) AS n_words, array_to_string(k, ' ') AS words
FROM (SELECT id, list_filter({TOKENS}, lambda w: w <> '' AND NOT list_contains({STOP}, w)) AS k FROM cleaned)"""
    q["word_freq"] = chain(P, "history") + "SELECT discipline, publish_year, word, count FROM word_freq"
    q["trend_history"] = chain(P, "history") + "SELECT discipline, publish_year, word, count FROM history"
    q["trend_dense_series"] = chain(P, "series") + \
        "SELECT discipline, word, publish_year, CAST(y AS BIGINT) AS count FROM dense"

    # ------------------------------------------------------------ forecast
    q["forecast_horizon"] = chain(P, "history") + f"""SELECT max_year, {P.target_year} AS target_year,
  {P.target_year} - max_year AS steps FROM (SELECT max(publish_year) AS max_year FROM history)"""
    q["forecast_holt"] = chain(P, "fits") + \
        "SELECT discipline, word, alpha, beta, sse, level, trend FROM fits WHERE model = 'holt'"
    q["forecast_ses"] = chain(P, "fits") + "SELECT discipline, word, alpha, sse, level FROM fits WHERE model = 'ses'"
    q["forecast_rows"] = chain(P, "trend") + "SELECT discipline, publish_year, word, count FROM forecast"
    q["trend_full"] = chain(P, "trend") + "SELECT discipline, publish_year, word, count, is_forecast FROM trend"

    # ------------------------------------------------------------ association rules
    q["baskets_observed"] = chain(P, "rules") + \
        "SELECT basket_id, array_to_string(list_sort(items), ' ') AS items FROM baskets WHERE kind = 'title'"
    q["baskets_full"] = chain(P, "rules") + \
        "SELECT basket_key, kind, array_to_string(list_sort(items), ' ') AS items FROM baskets"
    q["item_support"] = chain(P, "rules") + "SELECT item, support FROM support"
    q["pair_support"] = chain(P, "rules") + "SELECT a, b, pair_count FROM pairs"
    q["pair_counts"] = chain(P, "rules") + "SELECT a, b, pair_count FROM pairs WHERE a < b"
    q["assoc_rules"] = chain(P, "rules") + "SELECT source, target, confidence FROM rules_all"
    q["assoc_rules_topk"] = chain(P, "rules") + "SELECT source, target, confidence FROM rules"

    # ------------------------------------------------------------ reports
    active = f"""active AS (
  SELECT word, CAST(sum(count) AS BIGINT) AS total_count FROM trend WHERE publish_year = {catalog.NETWORK_YEAR}
  GROUP BY word ORDER BY total_count DESC, word ASC LIMIT 150)"""
    links = """nodes AS (SELECT DISTINCT discipline AS name FROM trend UNION SELECT word FROM active),
links AS (SELECT source, target, confidence AS value FROM rules
          WHERE source IN (SELECT name FROM nodes) AND target IN (SELECT name FROM nodes))"""
    q["active_words"] = C("rules", active) + "SELECT word, total_count FROM active"
    q["network_links"] = C("rules", active, links) + "SELECT source, target, value FROM links"
    q["network_nodes"] = C("rules", active, links, """deg AS (
  SELECT name, count(*) AS value FROM (SELECT source AS name FROM links UNION ALL SELECT target FROM links)
  GROUP BY name),
flag AS (SELECT deg.*, name IN (SELECT discipline FROM trend WHERE discipline IS NOT NULL) AS d FROM deg)""") + """
SELECT name, CAST(CASE WHEN d THEN least(value * 8 + 20, 80) ELSE least(value * 3 + 10, 30) END AS BIGINT) AS symbol_size,
       CASE WHEN d THEN 0 ELSE 1 END AS category, value
FROM flag"""
    q["theme_river"] = chain(P, "trend") + \
        "SELECT discipline, CAST(publish_year AS VARCHAR) AS year, count, word FROM trend"
    q["leaderboard"] = C("trend", """heat AS (SELECT discipline, CAST(sum(count) AS BIGINT) AS total_heat FROM trend GROUP BY discipline),
top_d AS (SELECT discipline, total_heat,
                 CAST(row_number() OVER (ORDER BY total_heat DESC, discipline ASC) AS INTEGER) AS discipline_rank
          FROM heat QUALIFY discipline_rank <= 10),
wh AS (SELECT discipline, word, CAST(sum(count) AS BIGINT) AS word_heat FROM trend GROUP BY discipline, word),
rk AS (SELECT *, row_number() OVER (PARTITION BY discipline ORDER BY word_heat DESC, word ASC) AS r FROM wh QUALIFY r <= 5),
tw AS (SELECT discipline, string_agg(word, ', ' ORDER BY r) AS top_words FROM rk GROUP BY discipline)""") + """
SELECT t.discipline_rank, t.discipline, t.total_heat, w.top_words
FROM top_d t LEFT JOIN tw w ON w.discipline = t.discipline"""
    q["max_year_by_discipline"] = chain(P, "trend") + \
        "SELECT discipline, max(publish_year) AS max_year FROM trend GROUP BY discipline"

    def fallback(name: str, word_as: str, extra: str) -> str:
        return f"""{name} AS (
  SELECT discipline, {_rank('row_number() OVER (PARTITION BY discipline ORDER BY count DESC, word ASC, publish_year ASC)')} AS rank,
         word AS {word_as}, {extra}, true AS is_fallback
  FROM trend WHERE discipline IN (SELECT discipline FROM missing) QUALIFY rank <= 5)"""

    q["rising_stars"] = C("trend", """lasty AS (SELECT discipline, max(publish_year) AS max_year FROM trend GROUP BY discipline),
grown AS (
  SELECT a.discipline, a.word, (a.count - b.count) / b.count * 100 AS growth
  FROM trend a JOIN lasty l ON a.discipline = l.discipline AND a.publish_year = l.max_year
  JOIN trend b ON b.discipline = a.discipline AND b.word = a.word AND b.publish_year + 1 = l.max_year
  WHERE b.count > 0),
stars AS (
  SELECT discipline, CAST(row_number() OVER (PARTITION BY discipline ORDER BY growth DESC, word ASC) AS INTEGER) AS rank,
         word, growth, false AS is_fallback
  FROM grown QUALIFY rank <= 5),
missing AS (SELECT DISTINCT discipline FROM trend WHERE discipline NOT IN (SELECT discipline FROM stars))""",
                          fallback("fb", "word", "CAST(NULL AS DOUBLE) AS growth")) + """
SELECT discipline, rank, word, growth, is_fallback FROM stars
UNION ALL SELECT discipline, rank, word, growth, is_fallback FROM fb"""
    q["bridge_words"] = C("rules", """disc AS (SELECT DISTINCT discipline FROM trend WHERE discipline IS NOT NULL),
top AS (
  SELECT source, target, confidence,
         CAST(row_number() OVER (PARTITION BY source ORDER BY confidence DESC, target ASC) AS INTEGER) AS rank
  FROM rules WHERE source IN (SELECT discipline FROM disc) QUALIFY rank <= 5),
partner AS (
  SELECT t.source, t.target, o.source AS partner,
         row_number() OVER (PARTITION BY t.source, t.target ORDER BY o.confidence DESC, o.source ASC) AS p
  FROM top t JOIN rules o ON o.target = t.target AND o.source <> t.source QUALIFY p = 1),
bridges AS (
  SELECT t.source AS discipline, t.rank, t.target AS keyword, pa.partner AS linked_discipline, false AS is_fallback
  FROM top t LEFT JOIN partner pa ON pa.source = t.source AND pa.target = t.target),
missing AS (SELECT discipline FROM disc WHERE discipline NOT IN (SELECT discipline FROM bridges))""",
                          fallback("fb", "keyword", "CAST(NULL AS VARCHAR) AS linked_discipline")) + """
SELECT discipline, rank, keyword, linked_discipline, is_fallback FROM bridges
UNION ALL SELECT discipline, rank, keyword, linked_discipline, is_fallback FROM fb"""
    q["radar_metrics"] = C("rules", """heat AS (SELECT discipline, CAST(sum(count) AS BIGINT) AS heat FROM trend GROUP BY discipline),
xb AS (SELECT source AS discipline, count(DISTINCT target) AS cross_breadth FROM rules GROUP BY source),
j AS (SELECT h.discipline, h.heat, CAST(coalesce(x.cross_breadth, 0) AS BIGINT) AS cross_breadth
      FROM heat h LEFT JOIN xb x ON x.discipline = h.discipline)""") + """
SELECT discipline, heat, cross_breadth,
       CAST(least(heat, 50000) AS BIGINT) AS heat_axis, heat <= 0 AS heat_fallback,
       CAST(least(cross_breadth * 2, 100) AS BIGINT) AS cross_axis, cross_breadth <= 0 AS cross_fallback
FROM j"""
    q["discipline_list"] = chain(P, "trend") + "SELECT DISTINCT discipline FROM trend"

    # ------------------------------------------------------------ search and topics
    q["alias_resolve"] = f"""WITH {SEARCH_LOG}, {ALIASES}
SELECT l.id, l.discipline, coalesce(a.resolved, trim(l.discipline)) AS resolved
FROM search_log l LEFT JOIN aliases a ON lower(trim(l.discipline)) = a.alias"""
    qs = "qs" + _values(catalog.SUGGEST_QUERIES, ["qid", "q"])
    q["search_suggest"] = C("trend", ALIASES, qs, f"""q AS (SELECT qid, {fold_sql(TRIM_WS.format(x='q'))} AS q FROM qs WHERE {fold_sql(TRIM_WS.format(x='q'))} <> ''),
alias_hits AS (SELECT q.qid, 0 AS branch, 0 AS pos, a.resolved AS suggestion FROM q JOIN aliases a ON q.q = a.alias),
wv AS (SELECT DISTINCT word AS value FROM trend),
dv AS (SELECT DISTINCT discipline AS value FROM trend WHERE discipline IS NOT NULL),
wh AS (SELECT q.qid, 1 AS branch, row_number() OVER (PARTITION BY q.qid ORDER BY v.value) AS pos, v.value AS suggestion
       FROM q JOIN wv v ON {contains_ci('v.value', 'q.q')} QUALIFY pos <= 5),
dh AS (SELECT q.qid, 2 AS branch, row_number() OVER (PARTITION BY q.qid ORDER BY v.value) AS pos, v.value AS suggestion
       FROM q JOIN dv v ON {contains_ci('v.value', 'q.q')} QUALIFY pos <= 5),
every AS (SELECT * FROM alias_hits UNION ALL SELECT * FROM wh UNION ALL SELECT * FROM dh),
firsts AS (SELECT qid, suggestion, min(branch * 100 + pos) AS k FROM every GROUP BY qid, suggestion)""") + """
SELECT qid, CAST(row_number() OVER (PARTITION BY qid ORDER BY k) AS INTEGER) AS rank, suggestion
FROM firsts QUALIFY rank <= 8"""
    reqs = "reqs" + _values(catalog.SEARCH_QUERIES, ["qid", "keyword", "discipline", "year"])
    q["paper_search"] = C("cleaned", reqs, f"""r AS (SELECT qid, {TRIM_WS.format(x="coalesce(keyword, '')")} AS kw, coalesce(discipline, '') AS disc,
             coalesce(year, '') AS yr FROM reqs),
hits AS (
  SELECT r.qid, c.* FROM cleaned c JOIN r
    ON (r.kw = '' OR {contains_ci('c.title', 'r.kw')})
   AND (r.disc IN ('', 'All') OR {fold_sql('c.discipline')} = {fold_sql('r.disc')})
   AND (r.yr IN ('', 'All') OR c.publish_year = TRY_CAST(r.yr AS INTEGER)))""") + """
SELECT qid, CAST(row_number() OVER (PARTITION BY qid ORDER BY publish_year DESC, id ASC) AS INTEGER) AS rank,
       id, title, discipline, publish_year, source
FROM hits QUALIFY rank <= 50"""
    words = f"list_distinct(string_split_regex({fold_sql('title')}, '\\s'))"
    q["paper_postings"] = chain(P, "cleaned") + f"""SELECT word, count(*) AS papers, min(id) AS first_id, max(id) AS last_id
FROM (SELECT id, unnest({words}) AS word FROM cleaned) WHERE word <> '' GROUP BY word"""
    parts = (f"list_filter(list_transform(regexp_split_to_array(title, '[,，;；]+'), "
             f"lambda p: {TRIM_WS.format(x='p')}), lambda p: p <> '')")
    q["keyword_split"] = chain(P, "cleaned") + f"""SELECT id, CAST(len(k) AS {INT}) AS n_keywords,
  CASE WHEN len(k) > 0 THEN k[1] END AS main_keyword
FROM (SELECT id, {parts} AS k FROM cleaned)"""
    q["domain_classify"] = chain(P, "cleaned") + f"SELECT id, {domain_sql('title')} AS domain FROM cleaned"
    kw = """kw AS (SELECT DISTINCT keyword FROM (SELECT word AS keyword FROM trend UNION ALL SELECT discipline FROM trend)
        WHERE keyword IS NOT NULL)"""
    q["keyword_evidence"] = C("trend", kw, f"""vol AS (
  SELECT k.keyword, CAST(coalesce(sum(t.count), 0) AS BIGINT) AS main_count
  FROM kw k LEFT JOIN trend t ON {contains_ci('t.word', 'k.keyword')} OR {contains_ci('t.discipline', 'k.keyword')}
  GROUP BY k.keyword)""") + f"""
SELECT keyword, {domain_sql('keyword')} AS domain, main_count, {band_sql('main_count')} AS band FROM vol"""
    related = f"""related AS (
  SELECT keyword, CAST(rank AS {INT}) AS rank, source, target, confidence FROM (
    SELECT k.keyword, r.source, r.target, r.confidence,
           row_number() OVER (PARTITION BY k.keyword ORDER BY r.confidence DESC, r.source ASC, r.target ASC) AS rank
    FROM kw k JOIN rules r ON {contains_ci('r.source', 'k.keyword')} OR {contains_ci('r.target', 'k.keyword')})
  WHERE rank <= 5)"""
    q["related_terms"] = C("rules", kw, related) + "SELECT keyword, rank, source, target, confidence FROM related"
    pads = "pads" + _values([(d, i + 1, t) for d, terms in vocab.DOMAIN_FALLBACK_TERMS for i, t in enumerate(terms)],
                            ["domain", "pad_pos", "term"])
    q["topic_candidates"] = C("rules", kw, related, pads, f"""rel3 AS (
  SELECT keyword, row_number() OVER (PARTITION BY keyword ORDER BY rank) AS slot, target AS related
  FROM related WHERE lower(target) <> lower(keyword) QUALIFY slot <= {vocab.TOPIC_SLOTS}),
nrel AS (SELECT keyword, count(*) AS n_rel FROM rel3 GROUP BY keyword),
slots AS (SELECT keyword, {domain_sql('keyword')} AS domain, s.slot FROM kw, range(1, {vocab.TOPIC_SLOTS + 1}) s(slot))""") + """
SELECT s.keyword, s.domain, CAST(s.slot AS INTEGER) AS slot, CAST(s.slot AS INTEGER) AS template_id,
       coalesce(r.related, p.term) AS related, r.related IS NULL AS is_padded
FROM slots s LEFT JOIN rel3 r ON r.keyword = s.keyword AND r.slot = s.slot
LEFT JOIN nrel n ON n.keyword = s.keyword
LEFT JOIN pads p ON p.domain = s.domain AND p.pad_pos = s.slot - coalesce(n.n_rel, 0)"""

    q["topic_requests"] = C("rules", """lists AS (
  SELECT concat_ws(':', discipline, CAST(publish_year AS VARCHAR)) AS qid, min(word) AS keyword, count(*) AS n_keywords
  FROM trend WHERE discipline IS NOT NULL GROUP BY discipline, publish_year)""") + f"""
SELECT l.qid, l.keyword, CAST(l.n_keywords AS INTEGER) AS n_keywords, e.domain, e.main_count, e.band, t.slot, t.template_id, t.related, t.is_padded
FROM lists l JOIN ({q['keyword_evidence']}) e ON e.keyword = l.keyword JOIN ({q['topic_candidates']}) t ON t.keyword = l.keyword"""
    q["discipline_insights"] = C("rules", SEARCH_LOG, ALIASES, """asked AS (
  SELECT DISTINCT l.discipline, coalesce(a.resolved, trim(l.discipline)) AS resolved
  FROM search_log l LEFT JOIN aliases a ON lower(trim(l.discipline)) = a.alias WHERE l.discipline IS NOT NULL)""") + f"""
SELECT k.discipline, k.resolved, coalesce(m.max_year, 2026) AS max_year, coalesce(s.words, '') AS rising, coalesce(b.words, '') AS bridges,
       coalesce(r.heat, 0) AS heat, coalesce(r.cross_breadth, 0) AS cross_breadth
FROM asked k LEFT JOIN ({q['max_year_by_discipline']}) m ON m.discipline = k.resolved
LEFT JOIN (SELECT discipline, string_agg(word, ', ' ORDER BY rank) AS words FROM ({q['rising_stars']}) GROUP BY discipline) s ON s.discipline = k.resolved
LEFT JOIN (SELECT discipline, string_agg(keyword, ', ' ORDER BY rank) AS words FROM ({q['bridge_words']}) GROUP BY discipline) b ON b.discipline = k.resolved
LEFT JOIN ({q['radar_metrics']}) r ON r.discipline = k.resolved"""
    q["search_log_append"] = f"""WITH {SEARCH_LOG},
asked AS (SELECT id AS qid, CASE WHEN id % 3 <> 0 THEN trim(search_keyword) ELSE '' END AS search_keyword, discipline,
                 CASE WHEN id % 2 <> 0 THEN search_year ELSE '' END AS search_year FROM search_log)
SELECT * FROM asked WHERE search_keyword <> '' OR discipline <> '' OR search_year <> ''"""
    q["keyword_weights"] = C("history", f"""held AS (
  SELECT word, count(*) AS papers FROM (SELECT unnest(list_distinct({TOKENS})) AS word FROM cleaned) GROUP BY word),
weighed AS (SELECT w.*, h.papers, round(w.count * ln(((SELECT count(*) FROM cleaned) + 1) / (h.papers + 1)), 6) AS weight
            FROM word_freq w JOIN held h ON h.word = w.word)""") + f"""
SELECT discipline, publish_year, {_rank('row_number() OVER (PARTITION BY discipline, publish_year ORDER BY weight DESC, word ASC)')} AS rank,
       word, count, papers, weight FROM weighed QUALIFY rank <= 10"""

    # ------------------------------------------------------------ ingest
    src = f"CASE WHEN id % 7 = 0 THEN {_q(vocab.DEFAULT_INGEST_SOURCE)} WHEN id % 11 = 0 THEN NULL ELSE source END"
    ingest_rows = f"""SELECT CAST(floor(id / 200) AS BIGINT) AS batch_id,
       CAST(row_number() OVER (PARTITION BY floor(id / 200) ORDER BY id) - 1 AS INTEGER) AS pos,
       title, discipline, publish_year, authors, {src} AS source
FROM raw_papers"""
    q["ingest_batches"] = f"WITH {RAW_PAPERS}\n{ingest_rows}"
    bad = ["empty payload", "empty list", "not a JSON list", "not a JSON list", "record is not an object",
           "publish_year is not a number", "publish_year is not a whole number", "nested value in title", "nested value in authors"]
    bad_rows = "\nUNION ALL ".join(
        f"SELECT CAST({-(i + 1)} AS BIGINT), false, CAST(0 AS BIGINT), {_q(r)}" for i, r in enumerate(bad))
    q["ingest_batch_status"] = f"""WITH {RAW_PAPERS}
SELECT CAST(floor(id / 200) AS BIGINT) AS batch_id, true AS accepted, CAST(count(*) AS BIGINT) AS inserted,
       CAST(NULL AS VARCHAR) AS reason
FROM raw_papers GROUP BY floor(id / 200)
UNION ALL {bad_rows}"""
    bodies = ["", "[]", '{"a":1}', "bad", "[null]", '[{"title":"t","publish_year":"20x"}]',
              '[{"title":"t"},{"title":"u","publish_year":2019.5}]', '[{"title":{"main":"t"}}]', '[{"title":"t","authors":["a"]}]']
    q["ingest_rejects"] = "\nUNION ALL ".join(
        f"SELECT CAST({-(i + 1)} AS BIGINT) AS batch_id, {_q(b)} AS body, {_q(r)} AS reason" for i, (b, r) in enumerate(zip(bodies, bad, strict=True)))
    subject = _case_index("CAST(substr(source, 4) AS INTEGER) % 5", SUBJECTS)
    name = "text"
    names = "[concat('Author ', CAST((doc_id + 7 * i) % 37 AS VARCHAR)) for i in range(1, 2 + doc_id % 5)]"
    works = f"""SELECT doc_id AS id,
       substr(CASE WHEN doc_id % 9 = 0 OR {name} = '' THEN {_q(vocab.DEFAULT_WORK_TITLE)} ELSE {name} END, 1, {vocab.MAX_TITLE_CHARS}) AS title,
       {subject} AS discipline,
       CAST(CASE WHEN doc_id % 8 = 0 THEN {vocab.DEFAULT_WORK_YEAR} ELSE 2018 + CAST(floor(doc_id / 20) AS INTEGER) % 15 END AS INTEGER) AS publish_year,
       array_to_string(list_slice({names}, 1, {vocab.AUTHORS_KEPT}), ', ') AS authors,
       {_q(vocab.CRAWL_SOURCE)} AS source
FROM documents"""
    q["normalise_works"] = works
    q["works_source_filter"] = works + " WHERE doc_id % 8 <> 0 AND 2018 + CAST(floor(doc_id / 20) AS INTEGER) % 15 > 2018 AND lang = 'en'"
    q["search_log_rollup"] = f"""WITH {SEARCH_LOG}
SELECT CAST(epoch(date_trunc('day', create_time)) AS BIGINT) AS window_start,
       CAST(epoch(date_trunc('day', create_time) + INTERVAL 1 day) AS BIGINT) AS window_end,
       search_keyword, count(*) AS searches
FROM search_log GROUP BY 1, 2, 3"""
    return q


ORACLE = build()
