"""Published versions, the trend store and the streams into the job, against full recomputation."""

import pytest
from pyspark.sql import functions as F

from trendlens.operators import clean, rules, trends
from trendlens.operators.increments import TrendStore
from trendlens.params import Params
from trendlens.plans import catalog
from trendlens.plans.job import Pipeline, pipeline
from trendlens.plans.manifest import Manifest
from trendlens.sources import tables
from trendlens.streaming import jobs, registered

from conftest import SF001

P = Params(top_words=2, min_year=2012)
RAW = "id long, title string, discipline string, publish_year int, authors string, source string"


def papers(spark):
    words = ["alpha", "gamma", "delta", "omega", "theta"]
    rows = []
    for i in range(120):
        title = f"{words[i % 5]} {words[(i * 7) % 3]}" if i % 9 else ("Untitled" if i % 2 else None)
        rows.append((i, title if i % 10 else f"{words[i % 5]} unique{chr(97 + i % 26)}{chr(97 + i // 26)}", None if i % 17 == 0 else f"d{i % 2}",
                     2009 + (i * 5) % 9, "a", "s"))
    return spark.createDataFrame(rows, RAW)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*trends.TREND_COLUMNS).collect()), key=str)


@pytest.mark.parametrize("batches, compact_after", [(1, 8), (4, 8), (5, 1), (6, 2)])
def test_trend_store_equals_full_recompute(spark, tmp_path, batches, compact_after):
    """Titles that come again in later batches (also after their first paper was filtered out), null disciplines,
    a batch without rows; the state is right after every batch, not only the last."""
    raw, store = papers(spark), TrendStore(spark, str(tmp_path / "store"), P, compact_after)
    assert store.history().count() == 0
    for k in range(batches):
        high = (k + 1) * 120 // batches
        store.add(raw.where((F.col("id") >= k * 120 // batches) & (F.col("id") < high)))
        assert rows_of(store.history()) == rows_of(trends.trend_history(clean.clean_papers(raw.where(F.col("id") < high), P), P))
    before = rows_of(store.history())
    assert store.add(raw.limit(0)) == batches + 1 and rows_of(store.history()) == before
    assert len(store.manifest.current()[1]["counts"]) <= compact_after


def test_a_failed_batch_changes_nothing(spark, tmp_path, monkeypatch):
    raw, store = papers(spark), TrendStore(spark, str(tmp_path / "store"), P)
    first, second = raw.where("id < 60"), raw.where("id >= 60")
    store.add(first)
    before = rows_of(store.history())

    def fails(*_):
        raise RuntimeError("no")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr("trendlens.operators.increments.refreshed", fails)
        store.add(second)
    assert store.manifest.current()[0] == 1 and rows_of(store.history()) == before
    store.add(second)
    assert rows_of(store.history()) == rows_of(trends.trend_history(clean.clean_papers(raw, P), P))


def test_only_touched_groups_are_counted_again(spark, tmp_path):
    store = TrendStore(spark, str(tmp_path / "store"), P)
    store.add(spark.createDataFrame([(1, "alpha beta", "d", 2015, "a", "s"), (2, "gamma", "e", 2015, "a", "s")], RAW))
    # a history that no count explains stays, as long as no batch touches its group
    other = store._write("history", spark.createDataFrame([("e", 2015, "marker", 9), ("d", 2015, "marker", 9)], "discipline string, publish_year int, word string, count long"))
    store.manifest.commit({**store.manifest.current()[1], "history": [other]})
    store.add(spark.createDataFrame([(3, "alpha beata", "d", 2015, "a", "s")], RAW))
    assert rows_of(store.history()) == [("d", 2015, "alpha", 2), ("d", 2015, "beata", 1), ("e", 2015, "marker", 9)]


def test_manifest_takes_the_last_commit(spark, tmp_path):
    m = Manifest(spark, str(tmp_path))
    assert m.current() == (0, {})
    assert [m.commit({"at": i}) for i in range(3)] == [1, 2, 3] and m.current() == (3, {"at": 2})


def read(spark, dest):
    return {t: sorted(map(str, spark.read.parquet(f"{dest}/{t}").collect())) for t in ("cleaned_paper_data", "hotspot_trend_data", "fp_growth_rules")}


def test_publish_is_all_or_nothing(spark, tmp_path, monkeypatch):
    """A run that fails in its last table leaves the three old ones whole; the next one replaces all three."""
    dest = str(tmp_path / "out")
    first, second = papers(spark).where("id < 60"), papers(spark)
    small = Params(min_support=0.05, min_confidence=0.1)
    Pipeline(spark, SF001, small, raw_frame=first).write_outputs(dest)
    old = read(spark, dest)

    def fails(*_):
        raise RuntimeError("no rules")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(rules, "top_rules", fails)
        Pipeline(spark, SF001, small, raw_frame=second).write_outputs(dest)
    assert read(spark, dest) == old and Manifest(spark, dest).current()[0] == 1
    pl = Pipeline(spark, SF001, small, raw_frame=second)
    pl.write_outputs(dest)
    now = read(spark, dest)
    assert all(now[t] != old[t] for t in now) and Manifest(spark, dest).current()[0] == 2
    assert sorted(map(str, pl.rules().collect())) == now["fp_growth_rules"]
    assert pl.cleaned().inputFiles()[0].startswith(f"file://{dest}/cleaned_paper_data")      # written once, read where it is


def test_a_failed_move_is_undone(spark, tmp_path):
    from trendlens.plans import job
    dest = str(tmp_path / "out")
    for path, n in (("a", 1), ("b", 2), ("_staged/r/a", 3)):
        spark.range(n).write.parquet(f"{dest}/{path}")
    with pytest.raises(OSError):
        job._swap(spark, dest, "r", ["a", "b"])             # b was never staged
    assert [spark.read.parquet(f"{dest}/{t}").count() for t in ("a", "b", "_staged/r/a")] == [1, 2, 3]


def test_changed_input_gets_its_own_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    folder = str(tmp_path / "in")
    docs.where("doc_id < 50").write.parquet(f"{folder}/documents.parquet")
    one = pipeline(spark, folder, catalog.P)
    n = one.cleaned().count()
    assert pipeline(spark, folder, catalog.P) is one
    docs.where("doc_id >= 50").write.mode("append").parquet(f"{folder}/documents.parquet")
    two = pipeline(spark, folder, catalog.P)
    assert two is not one and two.cleaned().count() > n


def test_streams_into_the_job_survive_a_restart(spark, tmp_path):
    """Ingest and first places stopped and started again: the trend of the streamed papers is that of the direct path."""
    raw = tables.raw_papers(tables.load(spark, SF001, "documents"))
    again = raw.where("id % 5 = 0").withColumn("id", F.col("id") + 1000).withColumn("discipline", F.lit("Elsewhere"))
    payloads = tables.ingest_payloads(raw.unionByName(again), batch_size=40).cache()
    base, landing = str(tmp_path), str(tmp_path / "landing")
    for part in ("batch_id >= 0 and batch_id < 3", "batch_id >= 3", "batch_id < 0"):
        jobs.land_payloads(payloads.where(part), landing)
        landed = registered.landed(spark, base, landing)
    assert landed.count() == raw.select("title").distinct().count() == landed.select("title").distinct().count()
    streamed = Pipeline(spark, SF001, catalog.P, raw_frame=landed).history()
    assert rows_of(streamed) == rows_of(pipeline(spark, SF001, catalog.P).history())
