"""DuckDB reference SQL for every batch query (the correctness oracle).

Each query is a self-contained statement over the driver's views (documents, events, ...),
built from shared CTEs that restate the job's semantics in plain SQL. Arithmetic that must agree
bit for bit with Spark (the forecast fold) is written with the same operations in the same order.
"""

from __future__ import annotations

from trendlens.functions import vocab
from trendlens.params import FIXTURE_PARAMS, Params
from trendlens.sources import tables


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(_q(w) for w in words) + "]"


def _dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _case_index(expr: str, values, default_last: bool = True) -> str:
    whens = " ".join(f"WHEN {i} THEN {_q(v) if v is not None else 'NULL'}" for i, v in enumerate(values[:-1]))
    last = values[-1]
    return f"CASE {expr} {whens} ELSE {_q(last) if last is not None else 'NULL'} END"


SUBJECTS = [name for name, _ in vocab.SUBJECT_CONCEPTS]

RAW_PAPERS = f"""raw_papers AS (
  SELECT doc_id AS id,
         text AS title,
         {_case_index("CAST(substr(source, 4) AS INTEGER) % 5", SUBJECTS)} AS discipline,
         CAST(2010 + CAST(floor(doc_id / 20) AS INTEGER) % 15 AS INTEGER) AS publish_year,
         concat('Author ', CAST(doc_id % 37 AS VARCHAR)) AS authors,
         source
  FROM documents)"""

YEAR_NORM = "TRY_CAST(substr(CAST({c} AS VARCHAR), 1, 4) AS INTEGER)"


def cleaned_cte(p: Params) -> str:
    return f"""first_titles AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY id) AS rn FROM raw_papers) WHERE rn = 1),
cleaned AS (
  SELECT id, title, discipline, {YEAR_NORM.format(c='publish_year')} AS publish_year, authors, source
  FROM first_titles
  WHERE title IS NOT NULL AND title <> '' AND {YEAR_NORM.format(c='publish_year')} >= {p.min_year})"""


_CLEAN = r"lower(regexp_replace(title, '[^a-zA-Z\s]', '', 'g'))"
# tokens after the last non-empty one are dropped; an empty title keeps its one empty token
TOKENS = (rf"(CASE WHEN {_CLEAN} = '' THEN [''] WHEN regexp_full_match({_CLEAN}, '\s+') THEN CAST([] AS VARCHAR[]) "
          rf"ELSE string_split_regex(regexp_replace({_CLEAN}, '\s+$', ''), '\s') END)")
STOP = _list(vocab.stop_words())


def _long_word(w: str, min_len: int) -> str:
    return f"(length({w}) >= {min_len} AND NOT list_contains({STOP}, {w}))"


def trend_ctes(p: Params) -> str:
    return f"""words AS (
  SELECT discipline, publish_year, unnest({TOKENS}) AS word FROM cleaned),
word_freq AS (
  SELECT discipline, publish_year, word, count(*) AS count
  FROM words WHERE {_long_word('word', p.trend_min_len)}
  GROUP BY discipline, publish_year, word),
history AS (
  SELECT discipline, publish_year, word, count FROM (
    SELECT *, row_number() OVER (PARTITION BY discipline, publish_year ORDER BY count DESC, word ASC) AS rk
    FROM word_freq) WHERE rk <= {p.top_words})"""


def series_ctes(p: Params) -> str:
    return f"""maxy AS (SELECT max(publish_year) AS max_year FROM history),
series_keys AS (SELECT DISTINCT discipline, word FROM history WHERE discipline IS NOT NULL),
spine AS (
  SELECT k.discipline, k.word, CAST(y.publish_year AS INTEGER) AS publish_year
  FROM series_keys k, (SELECT unnest(range({p.min_year}, (SELECT max_year FROM maxy) + 1)) AS publish_year) y),
dense AS (
  SELECT s.discipline, s.word, s.publish_year, CAST(coalesce(h.count, 0) AS DOUBLE) AS y
  FROM spine s LEFT JOIN history h
    ON h.discipline = s.discipline AND h.word = s.word AND h.publish_year = s.publish_year),
series AS (
  SELECT discipline, word, list(y ORDER BY publish_year) AS ys, (SELECT max_year FROM maxy) AS max_year
  FROM dense GROUP BY discipline, word)"""


# --- forecast fold -------------------------------------------------------------------------------
# Same recurrences as trendlens.operators.forecast; DuckDB's list_reduce needs the list elements to
# have the accumulator's type, so each y is wrapped in a state struct (field yy).

_HOLT_FIELDS = ("yy", "p", "q", "r", "u", "v", "w", "s_aa", "s_ac", "s_cc", "s_az", "s_cz", "s_zz")


def _holt_step() -> str:
    fd = "(s.p + s.u)"
    fa = "(s.q + s.v)"
    fc = "(s.r + s.w)"
    y = "e.yy"
    z = f"({y} - {fd})"
    one_a = "(1.0 - alpha)"
    one_b = "(1.0 - beta)"
    p2 = f"((alpha * {y}) + ({one_a} * {fd}))"
    q2 = f"({one_a} * {fa})"
    r2 = f"({one_a} * {fc})"
    parts = {
        "yy": "0.0::DOUBLE", "p": p2, "q": q2, "r": r2,
        "u": f"((beta * ({p2} - s.p)) + ({one_b} * s.u))",
        "v": f"((beta * ({q2} - s.q)) + ({one_b} * s.v))",
        "w": f"((beta * ({r2} - s.r)) + ({one_b} * s.w))",
        "s_aa": f"(s.s_aa + ({fa} * {fa}))",
        "s_ac": f"(s.s_ac + ({fa} * {fc}))",
        "s_cc": f"(s.s_cc + ({fc} * {fc}))",
        "s_az": f"(s.s_az + ({fa} * {z}))",
        "s_cz": f"(s.s_cz + ({fc} * {z}))",
        "s_zz": f"(s.s_zz + ({z} * {z}))",
    }
    return "{" + ", ".join(f"'{k}': {parts[k]}" for k in _HOLT_FIELDS) + "}"


def _state(values: dict, fields) -> str:
    return "{" + ", ".join(f"'{k}': CAST({values.get(k, 0.0)!r} AS DOUBLE)" for k in fields) + "}"


def _holt_fold() -> str:
    init = _state({"q": 1.0, "w": 1.0}, _HOLT_FIELDS)
    elem = "{" + ", ".join(
        f"'{k}': " + ("y" if k == "yy" else "0.0::DOUBLE") for k in _HOLT_FIELDS) + "}"
    return (f"list_reduce(list_transform(ys, lambda y: {elem}), "
            f"lambda s, e: {_holt_step()}, {init})")


_SES_FIELDS = ("yy", "p", "q", "s_aa", "s_az", "s_zz")


def _ses_fold() -> str:
    z = "(e.yy - s.p)"
    one_a = "(1.0 - alpha)"
    parts = {
        "yy": "0.0::DOUBLE",
        "p": f"((alpha * e.yy) + ({one_a} * s.p))",
        "q": f"({one_a} * s.q)",
        "s_aa": "(s.s_aa + (s.q * s.q))",
        "s_az": f"(s.s_az + (s.q * {z}))",
        "s_zz": f"(s.s_zz + ({z} * {z}))",
    }
    step = "{" + ", ".join(f"'{k}': {parts[k]}" for k in _SES_FIELDS) + "}"
    init = _state({"q": 1.0}, _SES_FIELDS)
    elem = "{" + ", ".join(f"'{k}': " + ("y" if k == "yy" else "0.0::DOUBLE") for k in _SES_FIELDS) + "}"
    return f"list_reduce(list_transform(ys, lambda y: {elem}), lambda s, e: {step}, {init})"


def fit_ctes(p: Params) -> str:
    nz = "len(list_filter(ys, lambda y: y <> 0.0))"
    return f"""grid_holt AS (
  SELECT CAST(a.i AS DOUBLE) / CAST(10 AS DOUBLE) AS alpha, CAST(b.j AS DOUBLE) / CAST(10 AS DOUBLE) AS beta
  FROM range(1, 11) a(i), range(0, 11) b(j)),
grid_ses AS (
  SELECT CAST(a.i AS DOUBLE) / CAST(10 AS DOUBLE) AS alpha, CAST(0.0 AS DOUBLE) AS beta FROM range(1, 11) a(i)),
holt_states AS (
  SELECT s.discipline, s.word, g.alpha, g.beta, {_holt_fold()} AS st
  FROM series s, grid_holt g WHERE {nz} >= 3),
holt_fits AS (
  SELECT discipline, word, alpha, beta,
         (st.s_aa * st.s_cc) - (st.s_ac * st.s_ac) AS det,
         ((st.s_az * st.s_cc) - (st.s_cz * st.s_ac)) / ((st.s_aa * st.s_cc) - (st.s_ac * st.s_ac)) AS l0,
         ((st.s_cz * st.s_aa) - (st.s_az * st.s_ac)) / ((st.s_aa * st.s_cc) - (st.s_ac * st.s_ac)) AS b0,
         st
  FROM holt_states),
holt_eval AS (
  SELECT discipline, word, alpha, beta,
         st.s_zz - ((l0 * st.s_az) + (b0 * st.s_cz)) AS sse,
         (st.p + (st.q * l0)) + (st.r * b0) AS level,
         (st.u + (st.v * l0)) + (st.w * b0) AS trend
  FROM holt_fits WHERE abs(det) >= {_dbl(1e-9)}),
ses_states AS (
  SELECT s.discipline, s.word, g.alpha, g.beta, {_ses_fold()} AS st
  FROM series s, grid_ses g WHERE {nz} < 3),
ses_eval AS (
  SELECT discipline, word, alpha, beta,
         st.s_zz - ((st.s_az / st.s_aa) * st.s_az) AS sse,
         st.p + (st.q * (st.s_az / st.s_aa)) AS level,
         CAST(0.0 AS DOUBLE) AS trend
  FROM ses_states WHERE abs(st.s_aa) >= {_dbl(1e-9)}),
best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY discipline, word ORDER BY sse ASC, alpha ASC, beta ASC) AS rk
    FROM (SELECT * FROM holt_eval UNION ALL SELECT * FROM ses_eval)) WHERE rk = 1),
fits AS (
  SELECT s.discipline, s.word,
         CASE WHEN {nz} >= 3 THEN 'holt' ELSE 'ses' END AS model,
         coalesce(b.alpha, CAST(0.1 AS DOUBLE)) AS alpha, coalesce(b.beta, CAST(0.0 AS DOUBLE)) AS beta,
         b.sse, b.level, b.trend, s.ys[len(s.ys)] AS last, s.max_year
  FROM series s LEFT JOIN best b ON b.discipline = s.discipline AND b.word = s.word)"""


def forecast_ctes(p: Params) -> str:
    v = "(f.level + (CAST(h.h AS DOUBLE) * f.trend))"
    val = f"CASE WHEN {v} IS NULL OR isnan({v}) THEN f.last ELSE {v} END"
    return f"""forecast AS (
  SELECT f.discipline, CAST(f.max_year + h.h AS INTEGER) AS publish_year, f.word,
         greatest(CAST({p.floor} AS BIGINT),
                  CAST(trunc(f.last * {_dbl(p.damp)}) AS BIGINT),
                  CAST(trunc(round({val}, 6)) AS BIGINT)) AS count
  FROM fits f, (SELECT unnest(range(1, {p.target_year} - (SELECT max_year FROM maxy) + 1)) AS h) h
  WHERE f.max_year < {p.target_year}),
trend AS (
  SELECT discipline, publish_year, word, count, false AS is_forecast FROM history
  UNION ALL
  SELECT discipline, publish_year, word, count, true AS is_forecast FROM forecast)"""


def basket_ctes(p: Params, include_forecast: bool = True) -> str:
    items = (f"list_distinct(list_concat([discipline], list_filter({TOKENS}, "
             f"lambda x: {_long_word('x', p.basket_min_len)})))")
    fc = f"""
  UNION ALL
  SELECT NULL::BIGINT AS basket_id, concat_ws(':', 'forecast', discipline, word, CAST(publish_year AS VARCHAR)) AS basket_key,
         'forecast' AS kind, list_distinct([discipline, word]) AS items
  FROM forecast WHERE count > 2 AND discipline IS NOT NULL""" if include_forecast else ""
    return f"""baskets AS (
  SELECT id AS basket_id, 'paper:' || CAST(id AS VARCHAR) AS basket_key, 'title' AS kind, {items} AS items
  FROM cleaned WHERE discipline IS NOT NULL{fc}),
baskets_n AS (SELECT row_number() OVER () AS bid, items FROM baskets),
basket_items AS (SELECT bid, unnest(items) AS item FROM baskets_n),
min_count AS (SELECT ceil({_dbl(p.min_support)} * count(*)) AS mc FROM baskets),
support AS (SELECT item, count(*) AS support FROM basket_items GROUP BY item),
frequent AS (SELECT item, support FROM support WHERE support >= (SELECT mc FROM min_count)),
fitems AS (SELECT bid, item FROM basket_items WHERE item IN (SELECT item FROM frequent)),
pairs AS (
  SELECT a.item AS a, b.item AS b, count(*) AS pair_count
  FROM fitems a JOIN fitems b ON a.bid = b.bid AND a.item <> b.item
  GROUP BY a.item, b.item HAVING count(*) >= (SELECT mc FROM min_count)),
rules_all AS (
  SELECT pr.a AS source, pr.b AS target, pr.pair_count / f.support AS confidence
  FROM pairs pr JOIN frequent f ON f.item = pr.a
  WHERE pr.pair_count / f.support >= {_dbl(p.min_confidence)}),
rules AS (
  SELECT source, target, confidence FROM (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY confidence DESC, target ASC) AS rk
    FROM rules_all) WHERE rk <= {p.rules_per_source})"""


def chain(p: Params, upto: str) -> str:
    """WITH clause up to (and including) a stage: cleaned, history, series, fits, trend, rules."""
    order = ["cleaned", "history", "series", "fits", "trend", "rules"]
    parts = [RAW_PAPERS, cleaned_cte(p)]
    builders = {"history": trend_ctes, "series": series_ctes, "fits": fit_ctes,
                "trend": forecast_ctes, "rules": basket_ctes}
    for stage in order[1:order.index(upto) + 1]:
        parts.append(builders[stage](p))
    return "WITH " + ",\n".join(parts) + "\n"


def with_ctes(p: Params, upto: str, *extra: str) -> str:
    return chain(p, upto).rstrip("\n") + "".join(",\n" + e for e in extra) + "\n"


ALIASES = "aliases(alias, resolved) AS (VALUES " + ", ".join(
    f"({_q(a)}, {_q(r)})" for a, r in vocab.DISCIPLINE_ALIASES) + ")"


def domain_sql(col: str) -> str:
    low = f"lower({col})"
    out = _q(vocab.GENERIC_DOMAIN)
    for name, words in reversed(vocab.DOMAIN_PRECEDENCE):
        cond = f"len(list_filter({_list(words)}, lambda k: contains({low}, k))) > 0"
        out = f"CASE WHEN {cond} THEN {_q(name)} ELSE {out} END"
    return out


def band_sql(col: str) -> str:
    return (f"CASE WHEN {col} > 2000 THEN 'rich' WHEN {col} < 100 THEN 'scarce' "
            f"ELSE 'sufficient' END")


def fold_sql(x: str) -> str:
    return f"strip_accents(lower({x}))"


def contains_ci(text_col: str, q_col: str) -> str:
    return f"contains({fold_sql(text_col)}, {fold_sql(q_col)})"


SEARCH_LOG = f"""search_log AS (
  SELECT event_id AS id, event_type AS search_keyword,
         {_case_index("user_id % 5", list(tables.SEARCH_LOG_DISCIPLINES))} AS discipline,
         CAST(2012 + user_id % 13 AS VARCHAR) AS search_year, ts AS create_time
  FROM events)"""
