"""The search-log stream over several micro-batches: what comes too late is told apart, and nothing is lost."""

from datetime import datetime, timedelta

from trendlens.streaming import jobs

LOG = "id long, search_keyword string, create_time timestamp_ntz"
DAY = datetime(2024, 1, 1)


def at(days, hours=0):
    return DAY + timedelta(days=days, hours=hours)


# each list lands as one file and is one micro-batch; the watermark is one day behind the batches before
BATCHES = [[(1, "a", at(0, 1)), (2, "a", at(0, 9))],
           [(3, "b", at(5)), (4, "a", at(0, 23))],          # day 0 is still open: no batch has gone past it yet
           [(5, "a", at(0, 12)), (6, "b", at(3, 2)), (7, "b", at(4, 1)), (8, "c", at(6))],     # days 0 and 3 have ended by day 4
           [(9, "c", at(4, 5)), (10, "c", at(5, 1))]]       # day 4 has ended by day 5


def run(spark, base):
    landing = f"{base}/log"
    for k, rows in enumerate(BATCHES):
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(landing)
        stream = lambda: spark.readStream.schema(LOG).parquet(landing)      # noqa: E731
        jobs.run_search_log_rollup(spark, stream(), f"{base}/out", f"{base}/_out").awaitTermination()      # each run is a restart
        late = jobs.run_late_searches(spark, stream(), f"{base}/side", f"{base}/_side")
        late.awaitTermination()
    rolled = jobs.latest_per_key(jobs.read_epochs(spark, f"{base}/out", jobs.WINDOWS_SCHEMA), ["window_start", "window_end", "search_keyword"])
    return rolled, spark.read.schema(LOG).parquet(f"{base}/side/late")


def test_late_rows_go_to_the_side_table(spark, tmp_path):
    rolled, late = run(spark, str(tmp_path))
    assert sorted(r.id for r in late.collect()) == [5, 6, 9]
    got = {(datetime.utcfromtimestamp(r.window_start).day - 1, r.search_keyword): r.searches for r in rolled.collect()}
    assert got == {(0, "a"): 3, (5, "b"): 1, (4, "b"): 1, (6, "c"): 1, (5, "c"): 1}
    assert sum(got.values()) + late.count() == sum(map(len, BATCHES))


def test_an_empty_stream_has_a_readable_sink(spark, tmp_path):
    spark.createDataFrame([], LOG).write.parquet(f"{tmp_path}/log")
    jobs.run_search_log_rollup(spark, spark.readStream.schema(LOG).parquet(f"{tmp_path}/log"), f"{tmp_path}/out", f"{tmp_path}/_out").awaitTermination()
    table = jobs.read_epochs(spark, f"{tmp_path}/out", jobs.WINDOWS_SCHEMA)
    assert table.count() == 0 and "searches" in table.columns
