"""Structured Streaming jobs: continuous batch ingest, running subject counts, search-log rollup.

All three are restartable: state and progress live in a checkpoint location in the shared folder,
sinks are idempotent per micro-batch (file sink, or one folder per epoch that a retry overwrites).
`availableNow` processes everything that has landed and stops, which is what the tests and the
registered queries use; a long-running deployment passes a processing-time trigger instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendlens.operators.increments import title_key
from trendlens.plans.manifest import path_exists
from trendlens.sources.ingest import ingest_batches, rejected_batches

PAYLOAD_SCHEMA = "batch_id long, body string"
COUNTS_SCHEMA = "discipline string, inserted long, _epoch int"
WINDOWS_SCHEMA = "window_start long, window_end long, search_keyword string, searches long, _epoch int"
PLACES_SCHEMA = "title_key string, batch_id long, pos int, _epoch int"


def land_payloads(payloads: DataFrame, landing_dir: str) -> None:
    """Drop payloads (batch_id, body) into the landing folder as JSON lines (append)."""
    payloads.write.mode("append").json(landing_dir)


def payload_stream(spark: SparkSession, landing_dir: str, files_per_trigger: int | None = None) -> DataFrame:
    """The landed payloads as a stream, at most `files_per_trigger` files in a micro-batch."""
    reader = spark.readStream.schema(PAYLOAD_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(landing_dir)


def ingest_stream(spark: SparkSession, landing_dir: str, files_per_trigger: int | None = None) -> DataFrame:
    """X1 source: landed payloads -> raw paper rows (streaming DataFrame)."""
    return ingest_batches(payload_stream(spark, landing_dir, files_per_trigger))


def run_rejects(spark: SparkSession, landing_dir: str, sink_dir: str, checkpoint: str,
                trigger: dict | None = None, files_per_trigger: int | None = None):
    """Append rejected payloads and their reasons to a parquet table (exactly-once file sink)."""
    return (rejected_batches(payload_stream(spark, landing_dir, files_per_trigger)).writeStream.format("parquet")
            .option("path", sink_dir).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(**(trigger or {"availableNow": True})).start())


def run_ingest(spark: SparkSession, landing_dir: str, sink_dir: str, checkpoint: str,
               trigger: dict | None = None, files_per_trigger: int | None = None):
    """Append landed rows to a parquet table (exactly-once file sink)."""
    q = (ingest_stream(spark, landing_dir, files_per_trigger).writeStream.format("parquet")
         .option("path", sink_dir).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(**(trigger or {"availableNow": True})).start())
    return q


def _epoch_sink(out_dir: str):
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/_epoch={epoch_id}")
    return write


def latest_per_key(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Current value per key from an update-mode changelog (last epoch wins)."""
    w = Window.partitionBy(*keys).orderBy(F.desc("_epoch"))
    return updates.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "_epoch")


def run_subject_counts(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint: str,
                       trigger: dict | None = None, files_per_trigger: int | None = None):
    """Running count of landed rows per discipline (update mode, changelog of updated keys)."""
    counts = ingest_stream(spark, landing_dir, files_per_trigger).groupBy("discipline").agg(
        F.count(F.lit(1)).alias("inserted"))
    return (counts.writeStream.outputMode("update").foreachBatch(_epoch_sink(out_dir))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def first_places(rows: DataFrame, keep: str = "1 day") -> DataFrame:
    """P1 on a stream: title_key, batch_id, pos of the first place of every title (lowest batch, then position)
    among the rows that arrive within `keep`. Only digests and places are held in state, and a window's state is
    dropped once the watermark has passed it; a title that comes again later starts anew, and `landed_papers`
    takes the first of all. The clock is the arrival, so no row is ever late."""
    src = rows.withColumn("create_time", F.current_timestamp())
    src = src.withWatermark("create_time", keep) if rows.isStreaming else src
    return (src.groupBy(F.window("create_time", keep).alias("w"), title_key(F.col("title")).alias("title_key"))
            .agg(F.min(F.struct("batch_id", "pos")).alias("first")).select("title_key", "first.batch_id", "first.pos"))


def run_first_places(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint: str,
                     trigger: dict | None = None, files_per_trigger: int | None = None):
    """Keep a changelog of the titles' first places (update mode, one folder per epoch)."""
    return (first_places(ingest_stream(spark, landing_dir, files_per_trigger)).writeStream.outputMode("update")
            .foreachBatch(_epoch_sink(out_dir)).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def landed_papers(rows: DataFrame, places: DataFrame) -> DataFrame:
    """`raw_paper_data` as the streams have landed it: one row per title, ids in order of arrival. Rows whose title
    stands earlier are dropped; a row whose place the other stream has not told yet waits for the next read."""
    first = places.groupBy("title_key").agg(F.min(F.struct("batch_id", "pos")).alias("first")).select("first.*")
    kept = rows.join(first, ["batch_id", "pos"], "left_semi")
    arrival = F.shiftleft(F.col("batch_id"), 31) + F.col("pos")
    return kept.select(arrival.alias("id"), "title", "discipline", "publish_year", "authors", "source")


def utc_instant(ts: F.Column) -> F.Column:
    """A TIMESTAMP_NTZ wall-clock read as UTC, as a TIMESTAMP instant (independent of the session
    time zone; watermarks need TIMESTAMP)."""
    return F.make_timestamp_ltz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts),
                                F.date_part(F.lit("SECOND"), ts), F.lit("UTC"))


def search_log_windows(log: DataFrame, window: str = "1 day", watermark: str = "1 day") -> DataFrame:
    """X3 logic (stream or batch): searches per keyword per tumbling window of create_time.
    Window bounds are epoch seconds (UTC)."""
    src = log.withColumn("create_time", utc_instant(F.col("create_time")))
    src = src.withWatermark("create_time", watermark) if log.isStreaming else src
    return (src.groupBy(F.window("create_time", window).alias("w"), "search_keyword")
            .agg(F.count(F.lit(1)).alias("searches"))
            .select(F.unix_seconds("w.start").alias("window_start"),
                    F.unix_seconds("w.end").alias("window_end"),
                    "search_keyword", "searches"))


def run_late_searches(spark: SparkSession, log_stream: DataFrame, out_dir: str, checkpoint: str,
                      window: str = "1 day", watermark: str = "1 day", trigger: dict | None = None):
    """The log rows that the rollup drops, as a side table `out_dir/late` (one folder per epoch): rows whose window
    had ended by the watermark, which is the latest create_time of the epochs before, less the delay. Each epoch notes
    its own latest time under `out_dir/clock`, so an epoch that is run again finds the same watermark."""
    clock, epochs = f"{out_dir}/clock", "_epoch int, latest timestamp"

    def write(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        timed = batch.withColumn("_at", utc_instant(F.col("create_time")))
        before = read_epochs(session, clock, epochs).where(F.col("_epoch") < epoch_id).agg(F.max("latest").alias("latest"))
        until = F.col("latest") - F.expr(f"INTERVAL {watermark}")
        late = timed.crossJoin(F.broadcast(before)).where(F.window("_at", window)["end"] <= until)      # `before`: one row
        late.select(*batch.columns).write.mode("overwrite").parquet(f"{out_dir}/late/_epoch={epoch_id}")
        timed.agg(F.max("_at").alias("latest")).write.mode("overwrite").parquet(f"{clock}/_epoch={epoch_id}")

    return (log_stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def read_epochs(spark: SparkSession, out_dir: str, schema: str) -> DataFrame:
    """The table that epochs have written under `out_dir`; empty, with its schema, before the first one."""
    if not path_exists(spark, out_dir):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out_dir)


def run_search_log_rollup(spark: SparkSession, log_stream: DataFrame, out_dir: str, checkpoint: str,
                          trigger: dict | None = None):
    """Windowed rollup with a watermark; update mode so open windows are visible, state for
    windows older than the watermark is dropped."""
    return (search_log_windows(log_stream).writeStream.outputMode("update")
            .foreachBatch(_epoch_sink(out_dir)).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
