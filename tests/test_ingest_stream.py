from trendlens.sources import ingest, tables
from trendlens.streaming import jobs, registered

from conftest import SF001


def test_missing_vs_null_source(spark):
    p = spark.createDataFrame([(1, '[{"title":"a"},{"title":"b","source":null}]')], "batch_id long, body string")
    got = [(r["title"], r["source"]) for r in ingest.ingest_batches(p).orderBy("pos").collect()]
    assert got == [("a", "Crossref_API"), ("b", None)]


def test_bad_batches_rejected(spark):
    p = spark.createDataFrame([(i, b) for i, b in enumerate(["", "[]", '{"a":1}', "bad", '[{"title":"x"}]'])],
                              "batch_id long, body string")
    assert ingest.ingest_batches(p).count() == 1
    status = {r["batch_id"]: (r["accepted"], r["inserted"], r["reason"]) for r in ingest.batch_status(p).collect()}
    assert status[0] == (False, 0, "empty payload") and status[1] == (False, 0, "empty list")
    assert status[2][0] is False and status[3][0] is False and status[4] == (True, 1, None)


def test_one_bad_record_rejects_its_batch(spark, tmp_path):
    bodies = ['[{"title":"a","publish_year":"abc"},{"title":"b"}]', "[null]", '[{"title":"c"}, 5]',
              '[{"title":"d","publish_year":"2020"},{"publish_year":null}]', None]
    p = spark.createDataFrame(list(enumerate(bodies)), "batch_id long, body string")
    want = {0: "publish_year is not a number", 1: "record is not an object", 2: "not a JSON list", 4: "empty payload"}
    assert {r.batch_id: r.reason for r in ingest.rejected_batches(p).collect()} == want
    assert {r.batch_id: r.reason for r in ingest.batch_status(p).where("not accepted and inserted = 0").collect()} == want
    assert [(r.batch_id, r.title, r.publish_year) for r in ingest.ingest_batches(p).orderBy("pos").collect()] == [(3, "d", 2020), (3, None, None)]
    jobs.land_payloads(p, f"{tmp_path}/in")
    jobs.run_rejects(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/check", files_per_trigger=1).awaitTermination()
    assert {r.batch_id: r.reason for r in spark.read.parquet(f"{tmp_path}/out").collect()} == want


def test_a_retried_epoch_replaces_itself(spark, tmp_path):
    write = jobs._epoch_sink(f"{tmp_path}/log")
    for epoch, n in ((0, 1), (1, 5), (1, 7)):
        write(spark.createDataFrame([("d", n)], "discipline string, inserted long"), epoch)
    log = spark.read.parquet(f"{tmp_path}/log")
    assert log.count() == 2 and [tuple(r) for r in jobs.latest_per_key(log, ["discipline"]).collect()] == [("d", 7)]


def test_normalise_defaults(spark):
    w = spark.createDataFrame([('{"id": 1, "display_name": "", "publication_year": null, '
                                '"authorships": [{"author": {"display_name": "A"}}, {"author": {}}, '
                                '{"author": {"display_name": "C"}}, {"author": {"display_name": "D"}}]}',)], "body string")
    row = ingest.normalise_works(ingest.parse_works(w), "Machine Learning").first()
    assert (row["title"], row["publish_year"], row["authors"]) == ("Untitled", 2026, "A, , C")


def test_stream_ingest_equals_batch(spark):
    streamed = registered.q_stream_ingest(spark, SF001)
    batch = ingest.ingest_batches(tables.ingest_payloads(tables.load_raw_papers(spark, SF001)))
    cols = batch.columns
    assert sorted(map(tuple, streamed.select(*cols).collect()), key=str) == \
        sorted(map(tuple, batch.collect()), key=str)


def test_landing_has_no_fixed_number_of_files(spark):
    """As many files as the payloads are built in, taken in three micro-batches."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        _, landing, per_batch = registered._land(spark, SF001, "test")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    files = spark.read.schema(jobs.PAYLOAD_SCHEMA).json(landing).inputFiles()
    assert len(files) > 3 and 2 * per_batch < len(files) <= 3 * per_batch
    n = tables.load(spark, SF001, "documents").select("doc_id").distinct().count()
    assert ingest.ingest_batches(spark.read.schema(jobs.PAYLOAD_SCHEMA).json(landing)).count() == n


def test_stream_counts_and_search_log(spark):
    counts = {r["discipline"]: r["inserted"] for r in registered.q_stream_subject_counts(spark, SF001).collect()}
    assert sum(counts.values()) == tables.load(spark, SF001, "documents").count()
    rolled = registered.q_stream_search_log(spark, SF001)
    assert rolled.groupBy().sum("searches").first()[0] == tables.load(spark, SF001, "events").count()


def test_source_filter(spark):
    w = spark.createDataFrame([
        ('{"id": 1, "publication_year": 2020, "language": "en", "concepts": [{"id": "C1"}, {"id": "C2"}]}',),
        ('{"id": 2, "publication_year": 2018, "language": "en", "concepts": [{"id": "C1"}]}',),
        ('{"id": 3, "publication_year": 2021, "language": "fr", "concepts": [{"id": "C1"}]}',),
        ('{"id": 4, "publication_year": 2021, "language": "en", "concepts": [{"id": "C9"}]}',)], "body string")
    got = [r["id"] for r in ingest.source_filter(ingest.parse_works(w), "C1").collect()]
    assert got == [1]


def test_search_log_entries(spark):
    from trendlens.operators import search
    req = spark.createDataFrame([(1, "tion", "All", "All"), (2, " ", "", ""), (3, "", "", "2020")],
                                "qid int, keyword string, discipline string, year string")
    got = [(r["qid"], r["search_keyword"]) for r in search.search_log_entries(req).orderBy("qid").collect()]
    assert got == [(1, "tion"), (3, "")]
