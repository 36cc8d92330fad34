"""Cleaning: title dedup (before any filter), empty titles, year normalisation, year floor."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from trendlens.functions.text import normalise_year
from trendlens.params import Params

CLEAN_COLUMNS = ("id", "title", "discipline", "publish_year", "authors", "source")
SALTS = 64          # parts that a hot key's rows are dealt to before its top rows are chosen


def _first_per_title(raw: DataFrame) -> DataFrame:
    """Mark the lowest-id row of every exact (case-sensitive) title.

    `row_number() = 1` over the title partition is planned with a partial WindowGroupLimit before
    the shuffle, so a title shared by a third of all rows (e.g. a default "Untitled") leaves each
    map task as one row instead of landing whole on a single reducer.
    """
    # The hash leads the partition key: the groups are the same (a title fixes its hash), but the
    # sort behind the window compares 8-byte hash prefixes instead of long title strings.
    w = Window.partitionBy(F.xxhash64("title"), "title").orderBy("id")
    return raw.withColumn("_rn", F.row_number().over(w))


def dedup_titles(raw: DataFrame) -> DataFrame:
    """One row per title, lowest id wins."""
    return _first_per_title(raw).filter(F.col("_rn") == 1).drop("_rn")


class CleanMetrics:
    """P6 / A2 without a pass of its own: the numbers of `clean_qc`, observed while `clean_papers` is written.

    They count the rows that went through the write's tasks. A stage that is run again after a lost executor counts
    its rows again, so after such a loss `clean_qc` is the exact figure."""

    def __init__(self) -> None:
        suffix = uuid.uuid4().hex[:8]
        self._raw, self._titles = Observation(f"raw_{suffix}"), Observation(f"titles_{suffix}")

    def of_raw(self, raw: DataFrame) -> DataFrame:
        return raw.observe(self._raw, F.count(F.lit(1)).alias("rows_in"))

    def of_titles(self, survivors: DataFrame, params: Params) -> DataFrame:
        n = lambda cond: F.count(F.when(cond, 1))
        return survivors.observe(self._titles, F.count(F.lit(1)).alias("titles"),
                                 *(n(cond).alias(name) for name, cond in _fates(normalise_year(F.col("publish_year")), params)))

    def get(self) -> dict[str, int]:
        """The numbers, once the cleaned papers are written."""
        fates = dict(self._titles.get)
        titles = fates.pop("titles")
        rows_in = self._raw.get["rows_in"] if titles else 0     # a plan known to be empty is cut before it counts rows
        return {"rows_in": rows_in, "dup_rows": rows_in - titles, **fates}


def clean_papers(raw: DataFrame, params: Params = Params(), metrics: CleanMetrics | None = None) -> DataFrame:
    """Dedup by title first, then drop empty titles, normalise the year, keep year >= min_year."""
    raw = raw.select(*CLEAN_COLUMNS)
    survivors = dedup_titles(raw if metrics is None else metrics.of_raw(raw))
    if metrics is not None:
        survivors = metrics.of_titles(survivors, params)
    year = normalise_year(F.col("publish_year"))
    return (survivors
            .filter(F.col("title").isNotNull() & (F.col("title") != ""))
            .withColumn("publish_year", year)
            .filter(F.col("publish_year") >= params.min_year)
            .select(*CLEAN_COLUMNS))


def year_normalise(rows: DataFrame, column: str = "raw_year") -> DataFrame:
    """P3 on its own: the raw value and its normalised int."""
    return rows.withColumn("year_int", normalise_year(F.col(column)))


def _fates(year, params: Params) -> list[tuple]:
    """What becomes of a title's first row: name and condition, of which one holds."""
    has_title = F.col("title").isNotNull() & (F.col("title") != "")
    return [("empty_titles", ~has_title), ("bad_years", has_title & year.isNull()),
            ("old_years", has_title & (year < params.min_year)), ("kept", has_title & (year >= params.min_year))]


def clean_qc(raw: DataFrame, params: Params = Params()) -> DataFrame:
    """One-row quality summary, computed in the same pass as the cleaning rules.

    rows_in, dup_rows (lost to dedup), empty_titles, bad_years (year not a number),
    old_years (before min_year), kept.
    """
    # one partial aggregate per title: a title (or NULL) shared by a third of all rows leaves each map
    # task as one row; the survivor is the lowest id, as in dedup_titles
    titles = raw.groupBy(F.xxhash64("title").alias("_h"), "title").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "publish_year")).alias("first"))
    year = normalise_year(F.col("first.publish_year"))
    total = lambda value: F.coalesce(F.sum(value), F.lit(0)).cast("long")
    n = lambda cond: total(F.when(cond, 1).otherwise(0))
    return titles.agg(
        total("n").alias("rows_in"),
        total(F.col("n") - 1).alias("dup_rows"),
        *(n(cond).alias(name) for name, cond in _fates(year, params)),
    )


def top_per_key(rows: DataFrame, key: str, spread_by: str, k: int, *order) -> DataFrame:
    """The first k rows per key with their `rank`, in two levels: k per (key, salt), then k per key.
    One task then reads at most SALTS * k rows of a key, however many map tasks there are."""
    salted = Window.partitionBy(key, "_salt").orderBy(*order)
    some = (rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)))
            .withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= k).drop("_salt", "rank"))
    return some.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("rank") <= k)


def quota_sample(cleaned: DataFrame, per_subject: int) -> DataFrame:
    """At most `per_subject` papers per discipline, lowest ids first (exact quota)."""
    return top_per_key(cleaned, "discipline", "id", per_subject, "id").drop("rank")
