"""Streaming queries registered with the driver.

Each runs a Structured Streaming job to completion (`availableNow`) over data derived from the
driver's tables and returns its sink as a DataFrame. A finished stream must equal its batch twin,
so each also has the batch oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.oracle import queries as oracle_queries
from trendlens.oracle.duckdb_sql import RAW_PAPERS
from trendlens.params import FIXTURE_PARAMS
from trendlens.operators.increments import TrendStore
from trendlens.plans.job import Pipeline, pipeline
from trendlens.session import scratch_path
from trendlens.sources import tables
from trendlens.streaming import jobs


MICRO_BATCHES = 3       # the landed files are taken in about this many micro-batches, however many files there are


def _land(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str, int]:
    """Base folder, landing folder and the files of one micro-batch. The payloads land in the partitions that they
    are built in, whose number grows with the input: no task takes a fixed share of all payloads."""
    base = scratch_path(spark, "stream", name)
    landing = f"{base}/landing"
    jobs.land_payloads(tables.ingest_payloads(pipeline(spark, sf_dir, FIXTURE_PARAMS).raw()), landing)
    return base, landing, max(1, -(-len(spark.read.schema(jobs.PAYLOAD_SCHEMA).json(landing).inputFiles()) // MICRO_BATCHES))


def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed JSON batches -> raw paper rows (file sink, exactly once)."""
    base, landing, files = _land(spark, sf_dir, "ingest")
    q = jobs.run_ingest(spark, landing, f"{base}/sink", f"{base}/_checkpoint", files_per_trigger=files)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/sink")


def q_stream_subject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running count of landed rows per discipline (its final state)."""
    base, landing, files = _land(spark, sf_dir, "subjects")
    q = jobs.run_subject_counts(spark, landing, f"{base}/out", f"{base}/_checkpoint", files_per_trigger=files)
    q.awaitTermination()
    return jobs.latest_per_key(jobs.read_epochs(spark, f"{base}/out", jobs.COUNTS_SCHEMA), ["discipline"])


def q_stream_search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search-log rollup per day and keyword, watermarked, over the events as a stream."""
    base = scratch_path(spark, "stream", "search_log")
    events = tables.load(spark, sf_dir, "events")
    # a glob takes the table as one file or as a folder of part files (a plain path must be a folder)
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")
    q = jobs.run_search_log_rollup(spark, tables.search_log(stream), f"{base}/out", f"{base}/_checkpoint")
    q.awaitTermination()
    keys = ["window_start", "window_end", "search_keyword"]
    return jobs.latest_per_key(jobs.read_epochs(spark, f"{base}/out", jobs.WINDOWS_SCHEMA), keys)


def landed(spark: SparkSession, base: str, landing: str, files: int = 1) -> DataFrame:
    """Both ingest streams run to the end of what has landed: the raw papers, one row per title."""
    ran = [jobs.run_ingest(spark, landing, f"{base}/rows", f"{base}/_rows", files_per_trigger=files),
           jobs.run_first_places(spark, landing, f"{base}/places", f"{base}/_places", files_per_trigger=files)]
    for q in ran:
        q.awaitTermination()
    return jobs.landed_papers(spark.read.parquet(f"{base}/rows"), jobs.read_epochs(spark, f"{base}/places", jobs.PLACES_SCHEMA))


def q_stream_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 + P1 into the job: payloads -> ingest and first places, as streams -> raw papers -> clean -> trend history."""
    base, landing, files = _land(spark, sf_dir, "trend")
    return Pipeline(spark, sf_dir, FIXTURE_PARAMS, raw_frame=landed(spark, base, landing, files)).history()


BATCHES = 3


def q_trend_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 / W1 kept up to date: the papers arrive in three batches of rising ids; counts are compacted on the way."""
    raw = pipeline(spark, sf_dir, FIXTURE_PARAMS).raw()
    last = raw.agg(F.max("id")).first()[0] or 0
    store = TrendStore(spark, scratch_path(spark, "trend-store"), FIXTURE_PARAMS, compact_after=2)
    for k in range(BATCHES):
        low, high = (k * (last + 1) // BATCHES, (k + 1) * (last + 1) // BATCHES)
        store.add(raw.where((F.col("id") >= low) & (F.col("id") < high)))
    return store.history()


QUERIES = {
    "stream_trend": q_stream_trend,
    "trend_incremental": q_trend_incremental,
    "stream_ingest": q_stream_ingest,
    "stream_subject_counts": q_stream_subject_counts,
    "stream_search_log": q_stream_search_log,
}


def oracle() -> dict[str, str]:
    o = oracle_queries.ORACLE
    return {
        "stream_trend": o["trend_history"],
        "trend_incremental": o["trend_history"],
        "stream_ingest": o["ingest_batches"],
        "stream_subject_counts": f"WITH {RAW_PAPERS}\nSELECT discipline, count(*) AS inserted FROM raw_papers GROUP BY discipline",
        "stream_search_log": o["search_log_rollup"],
    }
