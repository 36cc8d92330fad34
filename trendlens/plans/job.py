"""The batch job as a chain of materialised stages:

    raw papers -> cleaned -> trend history -> series fits -> trend (history + forecast)
               -> baskets -> frequent items -> pair counts -> rules (all) -> rules (top per source)

Each stage is written once as a parquet table and read back by the next ones, so:
  * every later stage and every report reads a small, already-reduced table (cheap counts,
    real sizes for broadcast decisions);
  * lineage is cut at each stage: a lost executor recomputes from the last written table, not
    from the raw papers;
  * the history and the forecast always come from the same cleaned snapshot.

Tables go to the shared folder named by `spark.checkpoint.dir` (never a machine-local folder).
`write_outputs` has the three public tables (cleaned, trend, rules) written once, straight into a staged
folder of the destination, and moves them into place when all three are whole.
"""

from __future__ import annotations

import threading
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.operators import clean, forecast, paper_index, rules, trends
from trendlens.params import Params
from trendlens.plans.manifest import Manifest
from trendlens.session import scratch_path
from trendlens.sources import jdbc, tables


@dataclass
class Pipeline:
    spark: SparkSession
    sf_dir: str
    params: Params = Params()
    raw_frame: DataFrame | None = None                  # any table of raw papers, instead of the fixture's view
    _tables: dict = field(default_factory=dict)
    stage_seconds: dict = field(default_factory=dict)   # wall time of each stage's own write
    _staged: str | None = None                          # folder that the public tables are written to
    _metrics: clean.CleanMetrics | None = None
    _lock: threading.RLock = field(default_factory=threading.RLock)

    # ------------------------------------------------------------------ plumbing
    def _materialise(self, name: str, build) -> DataFrame:
        with self._lock:
            if name not in self._tables:
                staged = self._staged and name in PUBLIC
                path = f"{self._staged}/{PUBLIC[name][0]}" if staged else scratch_path(self.spark, "stage", name)
                partition_by = PUBLIC[name][1] if staged else ()
                plan = build()                      # inputs are materialised inside build()
                t0 = time.time()
                plan.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
                self.stage_seconds[name] = round(time.time() - t0, 3)
                self._tables[name] = path
            return self.spark.read.parquet(self._tables[name])

    def written(self, name: str, rows: DataFrame) -> DataFrame:
        """`rows`, written to a fresh table in the shared folder and read back (not kept as a stage)."""
        path = scratch_path(self.spark, "step", name)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def table(self, name: str) -> DataFrame:
        return tables.load(self.spark, self.sf_dir, name)

    # ------------------------------------------------------------------ stages
    def raw(self) -> DataFrame:
        return tables.raw_papers(self.table("documents")) if self.raw_frame is None else self.raw_frame

    def cleaned(self) -> DataFrame:
        """The cleaned papers. Their quality numbers (P6) are observed while they are written."""
        def build():
            self._metrics = clean.CleanMetrics()
            return clean.clean_papers(self.raw(), self.params, self._metrics)
        return self._materialise("cleaned", build)

    def quality(self) -> dict[str, int]:
        """The numbers of `clean.clean_qc`, from the write of the cleaned papers."""
        self.cleaned()
        return self._metrics.get()

    def history(self) -> DataFrame:
        return self._materialise("history", lambda: trends.trend_history(self.cleaned(), self.params))

    def series(self) -> DataFrame:
        return trends.dense_series(self.history(), self.params)

    def fits(self) -> DataFrame:
        return self._materialise("fits", lambda: forecast.fit_series(self.series()))

    def forecast(self) -> DataFrame:
        return forecast.forecast_rows(self.fits(), self.params)

    def trend(self) -> DataFrame:
        """History and forecast rows, with `is_forecast` (public projection: the first 4 columns)."""
        def build():
            hist = self.history().withColumn("is_forecast", F.lit(False))
            fut = self.forecast().withColumn("is_forecast", F.lit(True))
            return hist.unionByName(fut).select(*trends.TREND_COLUMNS, "is_forecast")
        return self._materialise("trend", build)

    def baskets(self) -> DataFrame:
        """Title baskets plus forecast baskets, built once (the text work is the expensive part)."""
        def build():
            fc = self.trend().filter("is_forecast").drop("is_forecast")
            # _bid: a unique id per basket, fixed once written (forecast baskets have no paper id)
            return rules.baskets_full(self.cleaned(), fc, self.params) \
                .withColumn("_bid", F.monotonically_increasing_id())
        return self._materialise("baskets", build)

    def frequent(self) -> DataFrame:
        """The frequent items with their ids (item, support, iid)."""
        return self._materialise("frequent", lambda: rules.numbered(rules.frequent_items(self.baskets(), self.params)))

    def pair_counts(self) -> DataFrame:
        """The counted pairs, shared by pair support and rules."""
        return self._materialise("pair_counts", lambda: rules.pair_counts(self.baskets(), self.frequent(), self.params))

    def rules_all(self) -> DataFrame:
        return self._materialise("rules_all", lambda: rules.rules_of(self.pair_counts(), self.frequent(), self.params))

    def rules(self) -> DataFrame:
        return self._materialise("rules", lambda: rules.top_rules(self.rules_all(), self.params))

    def postings(self) -> DataFrame:
        """The title index: words of every paper (see operators.paper_index)."""
        return self._materialise("postings", lambda: paper_index.postings(self.cleaned()))

    def word_grams(self) -> DataFrame:
        """The title index: grams of every word."""
        return self._materialise("word_grams", lambda: paper_index.word_grams(self.postings()))

    def gram_sizes(self) -> DataFrame:
        """The title index: words under each gram."""
        return self._materialise("gram_sizes", lambda: paper_index.gram_sizes(self.word_grams()))

    def run(self) -> "Pipeline":
        """Compute every stage (each exactly once)."""
        self.rules()
        return self

    def write_outputs(self, dest: str) -> None:
        """Replace the three result tables under `dest`; cleaned only when it has rows.

        Each table is written once, as its stage, under `dest/_staged/<run>`. A failure up to there leaves the old
        tables untouched. Then the tables change places by renames (the old ones go to `dest/_previous/<run>`, and
        back if a rename fails), and the run is noted in the manifest."""
        run = uuid.uuid4().hex[:12]
        with self._lock:
            self._tables.clear()
            self._staged = f"{dest}/_staged/{run}"
            try:
                self.run()
                names = [n for n in PUBLIC if n != "cleaned" or self.cleaned().limit(1).count()]
                _swap(self.spark, dest, run, [PUBLIC[n][0] for n in names])
                self._tables.update({n: f"{dest}/{PUBLIC[n][0]}" for n in names})
            finally:
                self._staged = None
        Manifest(self.spark, dest).commit({"run": run, "tables": [PUBLIC[n][0] for n in names]})


    def publish_jdbc(self, **connection) -> None:
        """S2/S3 for the relational deployment: the three public tables as they stand, each overwritten by one write
        that keeps its definition. An empty cleaned table leaves the old one, as `write_outputs` does."""
        found = {"cleaned": self.cleaned(), "trend": self.trend(), "rules": self.rules()}
        for name, rows in found.items():
            if name != "cleaned" or rows.limit(1).count():
                jdbc.write_table(rows, PUBLIC[name][0], **connection)


# stage -> public table, and the columns whose values name its folders
PUBLIC = {"cleaned": ("cleaned_paper_data", ()), "trend": ("hotspot_trend_data", ("publish_year",)), "rules": ("fp_growth_rules", ())}


def _swap(spark: SparkSession, dest: str, run: str, names: list[str]) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(dest).getFileSystem(spark._jsc.hadoopConfiguration())
    done: list[tuple[str, str]] = []

    def move(a: str, b: str) -> None:
        fs.mkdirs(path(b).getParent())
        if not fs.exists(path(a)) or not fs.rename(path(a), path(b)):
            raise OSError(f"cannot move {a} to {b}")
        done.append((a, b))

    try:
        for name in names:
            if fs.exists(path(f"{dest}/{name}")):
                move(f"{dest}/{name}", f"{dest}/_previous/{run}/{name}")
            move(f"{dest}/_staged/{run}/{name}", f"{dest}/{name}")
    except Exception:
        for a, b in reversed(done):
            fs.rename(path(b), path(a))
        raise


def _changed_at(spark: SparkSession, path: str) -> int:
    """When a file or the listing of a folder last changed."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).getModificationTime()


_PIPELINES: dict = {}
_PIPELINES_LOCK = threading.Lock()


def pipeline(spark: SparkSession, sf_dir: str, params: Params = Params()) -> Pipeline:
    """One pipeline per (application, input as it is now, parameters): stages are shared by all queries, and
    input that has changed since gets stages of its own."""
    sf_dir = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, sf_dir, _changed_at(spark, f"{sf_dir}/documents.parquet"), params)
    with _PIPELINES_LOCK:
        if key not in _PIPELINES:
            _PIPELINES[key] = Pipeline(spark, sf_dir, params)
        return _PIPELINES[key]
