"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Per query: one warm-up run, then the median of 3 timed runs, each executed to a `noop` sink.
The batch job's stages are materialised once first (timed as `job_materialise`, not part of
the total), so report queries read the written trend and rule tables as they would in
production. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = (
    # job stages (each over the previous written stage)
    "clean_papers", "trend_history", "forecast_rows", "pair_counts", "assoc_rules", "assoc_rules_topk",
    # reports over the trend / rule tables
    "leaderboard", "rising_stars", "bridge_words", "network_nodes", "radar_metrics",
    # search and topic evidence
    "paper_postings", "paper_search", "search_suggest", "keyword_evidence", "topic_candidates",
    # ingest
    "ingest_batches", "normalise_works", "search_log_rollup",
)


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    from trendlens.plans import catalog
    from trendlens.plans.job import pipeline
    from trendlens.session import local_session

    spark = local_session(cpus, shuffle_partitions=max(8, 2 * int(cpus) if cpus.isdigit() else 16), app="trendlens-bench")
    t0 = time.time()
    pl = pipeline(spark, sf_dir, catalog.P).run()
    pl.postings(), pl.gram_sizes()          # the title index
    job_sec = time.time() - t0

    timings: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in HEADLINE:
        fn = catalog.QUERIES[name]
        try:
            _run(fn(spark, sf_dir))                   # warm-up
            runs = []
            for _ in range(repeats):
                t = time.time()
                _run(fn(spark, sf_dir))
                runs.append(time.time() - t)
            timings[name] = round(statistics.median(runs), 4)
        except Exception as e:  # noqa: BLE001 - one failing query must not hide the others
            errors[name] = str(e)[:300]

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "total_sec", "value": round(sum(timings.values()), 4), "unit": "sec",
        "queries": timings, "sf": sf, "job_materialise_sec": round(job_sec, 3),
        "job_stage_sec": pl.stage_seconds,
        "documents": docs, "cpus": cpus, "errors": errors,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
