"""Ingest: JSON paper batches (S4) and nested API work records.

A batch payload must be a non-empty JSON list of objects; a text field may not hold a list or an object, and
publish_year, where given, is a whole number (as a number or as text). Otherwise the whole batch is rejected,
with a reason. Payloads are parsed as arrays of VARIANT, so every value keeps its JSON type until it is checked,
and a record without the key `source` (default source) differs from an explicit `"source": null` (stays NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.functions import vocab
from trendlens.sources.tables import WORK_SCHEMA

RECORDS = "array<variant>"
TEXT_FIELDS = ("title", "discipline", "authors", "source")
RAW_COLUMNS = ("title", "discipline", "publish_year", "authors", "source")
NUMBERS = "^(BIGINT|DECIMAL|DOUBLE|FLOAT)"
NESTED = "^(OBJECT|ARRAY)"


def _records(body: Column) -> Column:
    # malformed text, a JSON object or a scalar all parse to NULL under this schema
    return F.from_json(body, RECORDS)


def _field(record: Column, name: str, kind: str = "variant") -> Column:
    return F.try_variant_get(record, f"$.{name}", kind)


def _kind(value: Column) -> Column:
    """The JSON type of a variant; NULL where the key is missing."""
    return F.schema_of_variant(value)


def _year(record: Column) -> Column:
    """publish_year as an int, from a whole number or from text; NULL when it is neither."""
    number = _field(record, "publish_year", "double")
    whole = F.when((number == F.floor(number)) & (F.abs(number) < 2**31), number).cast("int")
    return F.when(F.rlike(_kind(_field(record, "publish_year")), F.lit(NUMBERS)), whole) \
        .when(_kind(_field(record, "publish_year")) == "STRING", _field(record, "publish_year", "string").try_cast("int"))


def _fault(record: Column) -> Column:
    """What is wrong with a record that is an object; NULL when nothing is."""
    told = F.lit(None).cast("string")
    year = _kind(_field(record, "publish_year"))
    given = year.isNotNull() & (year != "VOID")
    told = F.when(given & _year(record).isNull(),
                  F.when(F.rlike(year, F.lit(NUMBERS)), F.lit("publish_year is not a whole number")).otherwise(F.lit("publish_year is not a number")))
    for name in reversed(TEXT_FIELDS):
        nested = F.coalesce(F.rlike(_kind(_field(record, name)), F.lit(NESTED)), F.lit(False))
        told = F.when(nested, F.lit(f"nested value in {name}")).otherwise(told)
    return told


def _reason(body: Column, recs: Column) -> Column:
    """Why a batch is rejected; NULL when it is accepted."""
    kinds = F.transform(recs, _kind)
    faults = F.filter(F.transform(recs, _fault), lambda f: f.isNotNull())
    return (F.when(body.isNull() | (F.trim(body) == ""), F.lit("empty payload"))
            .when(recs.isNull() | F.exists(kinds, lambda k: ~k.startswith("OBJECT") & (k != "VOID")), F.lit("not a JSON list"))
            .when(F.size(recs) == 0, F.lit("empty list"))
            .when(F.exists(kinds, lambda k: k == "VOID"), F.lit("record is not an object"))
            .otherwise(F.get(faults, F.lit(0))))


def batch_status(payloads: DataFrame) -> DataFrame:
    """Per batch: batch_id, accepted, inserted (records landed), reason (NULL when accepted)."""
    recs = _records(F.col("body"))
    told = payloads.select("batch_id", _reason(F.col("body"), recs).alias("reason"), F.size(recs).alias("_n"))
    ok = F.col("reason").isNull()
    return told.select("batch_id", ok.alias("accepted"), F.when(ok, F.col("_n")).otherwise(F.lit(0)).cast("long").alias("inserted"), "reason")


def rejected_batches(payloads: DataFrame) -> DataFrame:
    """The batches that land nowhere, whole: batch_id, body, reason."""
    reason = _reason(F.col("body"), _records(F.col("body")))
    return payloads.select("batch_id", "body", reason.alias("reason")).where("reason is not null")


def ingest_batches(payloads: DataFrame) -> DataFrame:
    """Accepted batches exploded into raw paper rows:
    batch_id, pos (0-based order in the batch), title, discipline, publish_year, authors, source."""
    recs = _records(F.col("body"))
    good = payloads.where(_reason(F.col("body"), recs).isNull()).select("batch_id", recs.alias("_recs"))
    rows = good.select("batch_id", F.posexplode("_recs").alias("pos", "_m"))
    m = F.col("_m")
    given = _field(m, "source").isNotNull()         # a JSON null is a variant that holds null
    source = F.when(given, _field(m, "source", "string")).otherwise(F.lit(vocab.DEFAULT_INGEST_SOURCE))
    return rows.select(
        "batch_id", "pos",
        _field(m, "title", "string").alias("title"), _field(m, "discipline", "string").alias("discipline"),
        _year(m).alias("publish_year"),
        _field(m, "authors", "string").alias("authors"), source.alias("source"))


def parse_works(works_json: DataFrame) -> DataFrame:
    """Parse one JSON work record per row (column `body`) into the nested work struct."""
    return works_json.select(F.from_json("body", WORK_SCHEMA).alias("w")).select("w.*")


def source_filter(works: DataFrame, concept_id: str, min_year_exclusive: int = 2018,
                  language: str = "en") -> DataFrame:
    """Works tagged with the concept, published after the given year, in the given language."""
    return works.filter(
        F.exists("concepts", lambda c: c["id"] == F.lit(concept_id))
        & (F.col("publication_year") > min_year_exclusive)
        & (F.col("language") == language))


def normalise_works(works: DataFrame, subject: Column | str) -> DataFrame:
    """Flatten work records into raw paper rows.

    title: display name, empty -> "Untitled", first 500 chars; year: empty -> 2026;
    authors: first 3 author names joined ", " (a missing name counts as "");
    discipline: the crawled subject; source: the crawler label."""
    subject_col = F.lit(subject) if isinstance(subject, str) else subject
    name = F.col("display_name")
    title = F.when(name.isNull() | (name == ""), F.lit(vocab.DEFAULT_WORK_TITLE)).otherwise(name)
    year = F.when(F.col("publication_year").isNull() | (F.col("publication_year") == 0),
                  F.lit(vocab.DEFAULT_WORK_YEAR)).otherwise(F.col("publication_year"))
    names = F.transform(F.coalesce(F.col("authorships"), F.array()),
                        lambda a: F.coalesce(a["author"]["display_name"], F.lit("")))
    return works.select(
        "id",
        F.substring(title, 1, vocab.MAX_TITLE_CHARS).alias("title"),
        subject_col.alias("discipline"),
        year.cast("int").alias("publish_year"),
        F.array_join(F.slice(names, 1, vocab.AUTHORS_KEPT), ", ").alias("authors"),
        F.lit(vocab.CRAWL_SOURCE).alias("source"))
