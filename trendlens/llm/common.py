"""Shared helpers: table access, materialised steps in the shared folder, connected components."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`. A local master (tests) may leave it unset and
    gets a temporary folder; a cluster session without it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-steps-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


BATCH_ROWS = 1000           # rows of whole texts that a Python task is handed at a time
BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_batches(docs: DataFrame) -> DataFrame:
    """`docs`, with the session's Arrow batches cut to BATCH_ROWS rows. Whole texts are large, and Spark's
    10,000 rows of them are held several times at once (JVM buffers, Arrow, Python). A session that has
    a size of its own keeps it."""
    conf = docs.sparkSession.conf
    if conf.get(BATCH_KEY) == "10000":
        conf.set(BATCH_KEY, str(BATCH_ROWS))
    return docs


@contextmanager
def whole_texts(spark: SparkSession, rows: int = BATCH_ROWS):
    """Arrow batches of at most `rows` rows while the block runs; the session's own size is put back behind it.
    For steps that run inside the block, such as `materialise`."""
    before = spark.conf.get(BATCH_KEY)
    spark.conf.set(BATCH_KEY, str(min(int(before), rows) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_KEY, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a step's rows once as Parquet in the shared folder and read them back. A lost executor
    then recomputes from this table and never from the raw input."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """True when every node b has one parent a and no parent is itself a child."""
    if edges.groupBy("b").count().where("count > 1").limit(1).count():
        return False
    return edges.join(edges.select(F.col("b").alias("a")), "a", "left_semi").limit(1).count() == 0


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node that has an edge to another node; component = smallest node
    reachable. Alternating large-star and small-star rounds: each round is a partial aggregation
    and equi-joins, so a hub with very many neighbours is pre-aggregated and its join rows are
    split by AQE. Every round is written to the shared folder. An edge with a null end is ignored."""
    a, b = F.least(left, right), F.greatest(left, right)
    cur = materialise(edges.where(F.col(left) != F.col(right)).select(a.alias("a"), b.alias("b")).distinct(), "edges")
    while not _is_forest_of_stars(cur):
        both = cur.select(F.col("b").alias("u"), F.col("a").alias("v")).unionByName(
            cur.select(F.col("a").alias("u"), F.col("b").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        root = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(root, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        cur = materialise(small.unionByName(root.select(F.col("m").alias("a"), "b")).distinct(), "edges")
    children = cur.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return children.unionByName(cur.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


class Forest:
    """Union-find over 0..n-1 that keeps the smallest index as root (a helper inside one task)."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True
