"""Readers for the input tables and the derived views the operators expect.

The views are plain projections over the driver's tables (FIXTURES.md), so every query's work
grows with `documents` / `events`. Nothing here collects rows or builds local data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.functions import vocab

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def subject_of(index: Column) -> Column:
    """Subject name for a crawl-order index 0..4."""
    names = [name for name, _ in vocab.SUBJECT_CONCEPTS]
    expr = F.lit(names[-1])
    for i in range(len(names) - 2, -1, -1):
        expr = F.when(index == i, F.lit(names[i])).otherwise(expr)
    return expr


def concept_of(subject: Column) -> Column:
    expr = F.lit(None).cast("string")
    for name, cid in reversed(vocab.SUBJECT_CONCEPTS):
        expr = F.when(subject == name, F.lit(cid)).otherwise(expr)
    return expr


def _source_index(source: Column) -> Column:
    # source is 'src<k>'
    return F.substr(source, F.lit(4)).cast("int")


def raw_papers(documents: DataFrame) -> DataFrame:
    """`raw_paper_data` view over `documents`:
    id, title (the whole text), discipline (5 subjects by source), publish_year (2010..2024),
    authors, source."""
    d = documents
    return d.select(
        d.doc_id.alias("id"),
        d.text.alias("title"),
        subject_of(_source_index(d.source) % 5).alias("discipline"),
        (F.lit(2010) + F.floor(d.doc_id / 20).cast("int") % 15).cast("int").alias("publish_year"),
        F.concat(F.lit("Author "), (d.doc_id % 37).cast("string")).alias("authors"),
        d.source,
    )


def load_raw_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_papers(load(spark, sf_dir, "documents"))


# Year strings for the year-normalisation check, cycled by doc_id % 6.
RAW_YEAR_CYCLE = ("2019", "20191", "", "19a2", None, "2011")


def raw_years(documents: DataFrame) -> DataFrame:
    k = documents.doc_id % 6
    year = F.lit(None).cast("string")
    for i in range(len(RAW_YEAR_CYCLE) - 1, -1, -1):
        v = RAW_YEAR_CYCLE[i]
        year = F.when(k == i, F.lit(v).cast("string")).otherwise(year)
    return documents.select(documents.doc_id.alias("id"), year.alias("raw_year"))


# Search-log discipline field by user_id % 5: a mix of "All", aliases and full names.
SEARCH_LOG_DISCIPLINES = ("All", "ml", "Computer Vision", "NLP", "")


def search_log(events: DataFrame) -> DataFrame:
    """`search_history` rows derived from `events`:
    id, search_keyword, discipline, search_year, create_time."""
    k = events.user_id % 5
    disc = F.lit(SEARCH_LOG_DISCIPLINES[-1])
    for i in range(len(SEARCH_LOG_DISCIPLINES) - 2, -1, -1):
        disc = F.when(k == i, F.lit(SEARCH_LOG_DISCIPLINES[i])).otherwise(disc)
    return events.select(
        events.event_id.alias("id"),
        events.event_type.alias("search_keyword"),
        disc.alias("discipline"),
        (F.lit(2012) + events.user_id % 13).cast("string").alias("search_year"),
        events.ts.alias("create_time"),
    )


WORK_SCHEMA = (
    "id long, display_name string, publication_year int, language string, "
    "concepts array<struct<id: string>>, "
    "authorships array<struct<author: struct<display_name: string>>>"
)


def api_works(documents: DataFrame) -> DataFrame:
    """API work records (nested) derived from `documents`, serialised as one JSON string per work:
    display_name = the whole text (null when doc_id % 9 = 0), publication_year null when
    doc_id % 8 = 0 (else the paper year + 8, i.e. 2018..2032), 1 to 5 authors named by doc_id,
    language = lang, one concept = the subject of the paper's source."""
    d = documents
    places = F.sequence(F.lit(1).cast("long"), 1 + d.doc_id % 5)
    names = F.transform(places, lambda i: F.concat(F.lit("Author "), ((d.doc_id + 7 * i) % 37).cast("string")))
    year = (F.lit(2018) + F.floor(d.doc_id / 20).cast("int") % 15).cast("int")
    work = F.struct(
        d.doc_id.alias("id"),
        F.when(d.doc_id % 9 != 0, d.text).alias("display_name"),
        F.when(d.doc_id % 8 != 0, year).alias("publication_year"),
        d.lang.alias("language"),
        F.array(F.struct(concept_of(subject_of(_source_index(d.source) % 5)).alias("id"))).alias("concepts"),
        F.transform(names, lambda w: F.struct(F.struct(w.alias("display_name")).alias("author")))
        .alias("authorships"),
    )
    return d.select(d.doc_id.alias("id"), F.to_json(work).alias("body"))


# Batches with invalid payloads, appended after the real ones (batch ids -1, -2, ...): one for each reason.
BAD_PAYLOADS = ("", "[]", '{"a":1}', "bad", "[null]", '[{"title":"t","publish_year":"20x"}]',
                '[{"title":"t"},{"title":"u","publish_year":2019.5}]', '[{"title":{"main":"t"}}]', '[{"title":"t","authors":["a"]}]')


def ingest_payloads(raw: DataFrame, batch_size: int = 200) -> DataFrame:
    """JSON batch payloads built from raw papers: one JSON list of up to `batch_size` records per
    batch (ordered by id); key `source` omitted when id % 7 = 0, explicit null when id % 11 = 0.

    A batch is a bounded group (batch_size rows), so collecting it into one value is safe.
    """
    rec = F.map_from_arrays(
        F.array(*[F.lit(k) for k in ("title", "discipline", "publish_year", "authors")]),
        F.array(raw.title, raw.discipline, raw.publish_year.cast("string"), raw.authors),
    )
    with_source = F.map_concat(rec, F.create_map(F.lit("source"), raw.source))
    with_null = F.map_concat(rec, F.create_map(F.lit("source"), F.lit(None).cast("string")))
    record = (F.when(raw.id % 7 == 0, rec)
              .when(raw.id % 11 == 0, with_null)
              .otherwise(with_source))
    keyed = raw.select(F.floor(raw.id / batch_size).alias("batch_id"), raw.id,
                       F.to_json(record).alias("rec"))
    batches = keyed.groupBy("batch_id").agg(
        F.sort_array(F.collect_list(F.struct("id", "rec"))).alias("recs"))
    good = batches.select(
        F.col("batch_id"),
        F.concat(F.lit("["), F.array_join(F.transform("recs", lambda r: r["rec"]), ","), F.lit("]"))
        .alias("body"))
    spark = raw.sparkSession
    bad = spark.createDataFrame(
        [(-(i + 1), body) for i, body in enumerate(BAD_PAYLOADS)], "batch_id long, body string")
    return good.unionByName(bad)
