"""Restart safety: a stream restarted from its checkpoint picks up only newly landed batches."""

from pyspark.sql import functions as F

from trendlens.session import checkpoint_root, scratch_path
from trendlens.sources import tables
from trendlens.streaming import jobs

from conftest import SF001


def test_ingest_restart_processes_each_batch_once(spark):
    payloads = tables.ingest_payloads(tables.load_raw_papers(spark, SF001)).cache()
    first, second = payloads.filter(F.col("batch_id") == 0), payloads.filter(F.col("batch_id") != 0)
    base = scratch_path(spark, "test", "restart")
    landing, sink, ckpt = f"{base}/landing", f"{base}/sink", f"{base}/_checkpoint"

    jobs.land_payloads(first, landing)
    jobs.run_ingest(spark, landing, sink, ckpt).awaitTermination()
    n_first = spark.read.parquet(sink).count()
    assert n_first == 200

    jobs.land_payloads(second, landing)          # new files arrive while the job is down
    jobs.run_ingest(spark, landing, sink, ckpt).awaitTermination()   # restart from the checkpoint
    out = spark.read.parquet(sink)
    assert out.count() == tables.load(spark, SF001, "documents").count()
    assert out.groupBy("batch_id", "pos").count().filter("count > 1").count() == 0


def test_stages_live_under_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    assert scratch_path(spark, "x").startswith(root + "/trendlens/")
