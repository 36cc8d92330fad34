from trendlens.__main__ import main
from trendlens.operators import clean
from trendlens.plans import catalog
from trendlens.plans.job import Pipeline
from trendlens.session import scratch_path
from trendlens.sources import jdbc

from conftest import SF001


def test_write_outputs_three_tables(spark):
    pl = Pipeline(spark, SF001, catalog.P)
    dest = scratch_path(spark, "test", "outputs")
    pl.write_outputs(dest)
    cleaned = spark.read.parquet(f"{dest}/cleaned_paper_data")
    trend = spark.read.parquet(f"{dest}/hotspot_trend_data")
    rules = spark.read.parquet(f"{dest}/fp_growth_rules")
    assert cleaned.count() == pl.cleaned().count() > 0
    assert trend.count() == pl.trend().count()
    assert set(trend.columns) == {"discipline", "publish_year", "word", "count", "is_forecast"}
    assert sorted(map(tuple, rules.collect())) == sorted(map(tuple, pl.rules().collect()))
    assert set(pl.stage_seconds) >= {"cleaned", "history", "fits", "trend", "baskets", "rules_all", "rules"}


def test_quality_is_observed_by_the_clean_write(spark):
    """The job's quality numbers equal clean_qc's and cost no scan beside the write's own."""
    rows = [(i, t, "d", y, "a", "s") for i, (t, y) in enumerate([("x", 2020), ("x", 2020), ("", 2020), (None, 2020), (None, 2019), ("bad", None),
                                                                ("old", 2001), ("y", 20191), ("z", 2012)] * 3)]
    path = scratch_path(spark, "test", "raw")
    spark.createDataFrame(rows, "id int, title string, discipline string, publish_year int, authors string, source string").write.parquet(path)
    for raw in (spark.read.parquet(path), spark.read.parquet(path).limit(0)):
        pl = Pipeline(spark, SF001, catalog.P, raw_frame=raw)
        assert pl.quality() == clean.clean_qc(raw, catalog.P).first().asDict()
        assert pl.cleaned().count() == pl.quality()["kept"]
    pl = Pipeline(spark, SF001, catalog.P)
    assert pl.quality() == clean.clean_qc(pl.raw(), catalog.P).first().asDict()
    observed = clean.clean_papers(spark.read.parquet(path), catalog.P, clean.CleanMetrics())
    plan = observed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("CollectMetrics") == 2 and "WindowGroupLimit" in plan


def test_job_reads_and_publishes_over_jdbc(spark, monkeypatch):
    """The wiring alone: no database runs here, so reader and writer are stood in for."""
    raw = Pipeline(spark, SF001, catalog.P).raw()
    sent: dict = {}
    monkeypatch.setattr(jdbc, "read_table", lambda spark, table: raw if table == "raw_paper_data" else None)
    monkeypatch.setattr(jdbc, "write_table", lambda df, table, **more: sent.update({table: df.count()}))
    dest = scratch_path(spark, "test", "jdbc")
    main(["--jdbc-input", "raw_paper_data", "--output", dest, "--jdbc-publish", "--min-support", "0.004", "--min-confidence", "0.1"])
    assert sent == {t: spark.read.parquet(f"{dest}/{t}").count() for t in ("cleaned_paper_data", "hotspot_trend_data", "fp_growth_rules")}
    assert all(sent.values())
