"""Run the batch job: python -m trendlens --input <dir with documents.parquet> --output <dir>

Writes cleaned_paper_data, hotspot_trend_data (partitioned by publish_year) and fp_growth_rules
as parquet, then prints the stage timings. On a cluster run it with spark-submit; the session
picks up the cluster's configuration (and its spark.checkpoint.dir).
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from trendlens.params import FIXTURE_PARAMS, Params
from trendlens.plans.job import Pipeline
from trendlens.sources import jdbc


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="trendlens")
    source = ap.add_mutually_exclusive_group(required=True)
    source.add_argument("--input", help="folder holding documents.parquet")
    source.add_argument("--jdbc-input", metavar="TABLE", help="table of raw papers, read over JDBC by ranges of its id (TRENDLENS_JDBC_URL, ...)")
    ap.add_argument("--jdbc-publish", action="store_true", help="also overwrite the three result tables over JDBC")
    ap.add_argument("--output", required=True, help="folder for the three result tables")
    ap.add_argument("--fixture", action="store_true",
                    help="mining thresholds for the documents fixture instead of the job's own (0.0008 / 0.20)")
    ap.add_argument("--min-support", type=float)
    ap.add_argument("--min-confidence", type=float)
    ap.add_argument("--target-year", type=int)
    args = ap.parse_args(argv)

    params = FIXTURE_PARAMS if args.fixture else Params()
    overrides = {k: v for k, v in (("min_support", args.min_support), ("min_confidence", args.min_confidence),
                                   ("target_year", args.target_year)) if v is not None}
    params = params.with_(**overrides)

    spark = SparkSession.builder.appName("trendlens-job").getOrCreate()
    raw = jdbc.read_table(spark, args.jdbc_input) if args.jdbc_input else None
    pl = Pipeline(spark, (args.input or "").rstrip("/"), params, raw_frame=raw)
    pl.write_outputs(args.output.rstrip("/"))
    if args.jdbc_publish:
        pl.publish_jdbc()
    print(json.dumps({"stage_seconds": pl.stage_seconds, "quality": pl.quality(), "params": params.__dict__}))


if __name__ == "__main__":
    main()
