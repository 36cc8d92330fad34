"""Word trends kept up to date batch by batch, without counting earlier papers again.

Counts per (discipline, year, word) add up, so each batch leaves a folder of partial counts, and only the groups
(discipline, year) that a batch touches get their top words anew. Titles are deduplicated across batches by the
folder of title digests that each batch leaves: papers arrive with rising ids, so the first batch that brings a
title keeps it, before any filter, as the full job does.

  state of a batch      seen/    digests of the titles that it brought first
                        counts/  its partial counts
                        history/ the top words of all groups after it
  compaction            the folders of all batches as one, past `compact_after` of them

The live folders are named by a `Manifest`: a batch that fails leaves the last state as it was, and a batch that
is run again finds its titles seen only if it was committed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.operators import clean, trends
from trendlens.params import Params
from trendlens.plans.manifest import Manifest

GROUP = ["discipline", "publish_year"]
COUNTS = "discipline string, publish_year int, word string, count long"
SEEN = "title_key string"


def title_key(title: F.Column) -> F.Column:
    """Digest that stands for a title across batches (NULL titles share one)."""
    return F.coalesce(F.sha2(title, 256), F.lit(""))


def merged(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*GROUP, "word").agg(F.sum("count").alias("count"))


def refreshed(history: DataFrame, counts: DataFrame, touched: DataFrame, params: Params) -> DataFrame:
    """The history with the groups of `touched` (discipline, publish_year) taken from `counts`."""
    same = lambda a, b: a["discipline"].eqNullSafe(b["discipline"]) & (a["publish_year"] == b["publish_year"])     # noqa: E731
    anew = trends.top_words(merged(counts.join(touched, same(counts, touched), "left_semi")), params)
    return history.join(touched, same(history, touched), "left_anti").select(*trends.TREND_COLUMNS).unionByName(anew)


class TrendStore:
    """The trend history under `root`, a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str, params: Params = Params(), compact_after: int = 8):
        self.spark, self.root, self.params, self.compact_after = spark, root.rstrip("/"), params, compact_after
        self.manifest = Manifest(spark, root)

    def _read(self, paths: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, name: str, rows: DataFrame) -> str:
        path = f"{self.root}/{name}/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return path

    def history(self) -> DataFrame:
        return self._read(self.manifest.current()[1].get("history", []), COUNTS)

    def add(self, batch: DataFrame) -> int:
        """Take a batch of raw papers in; the version that is live now."""
        _, live = self.manifest.current()
        seen, counts = live.get("seen", []), live.get("counts", [])
        keyed = clean.dedup_titles(batch).withColumn("title_key", title_key(F.col("title")))
        fresh = keyed.join(self._read(seen, SEEN), "title_key", "left_anti")
        new_seen = self._write("seen", fresh.select("title_key"))
        seen = [*seen, new_seen]
        # the batch's own first titles, cleaned: its digests are read back, so that both tables tell the same rows
        mine = keyed.join(self._read([new_seen], SEEN), "title_key", "left_semi")
        part = self._write("counts", trends.word_freq(clean.clean_papers(mine, self.params), self.params))
        counts = [*counts, part]
        if len(counts) > self.compact_after:
            counts = [self._write("counts", merged(self._read(counts, COUNTS)))]
        if len(seen) > self.compact_after:
            seen = [self._write("seen", self._read(seen, SEEN))]
        touched = self._read([part], COUNTS).select(*GROUP).distinct()
        history = refreshed(self.history(), self._read(counts, COUNTS), touched, self.params)
        return self.manifest.commit({"seen": seen, "counts": counts, "history": [self._write("history", history)]})
