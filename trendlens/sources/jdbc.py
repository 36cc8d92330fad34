"""JDBC source and sink for the relational deployment.

The original job reads `raw_paper_data` over JDBC in a single partition and overwrites its result
tables by dropping them. Here the read is range-partitioned on the numeric key, and the write
truncates instead of dropping, so column types and indexes survive. Connection settings come only
from arguments or the environment; nothing is hard-coded.

Not exercised by the tests: no database runs in this environment.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def connection(url: str | None = None, user: str | None = None, password: str | None = None,
               driver: str | None = None) -> tuple[str, dict]:
    """(url, properties) from the arguments, else TRENDLENS_JDBC_URL / _USER / _PASSWORD / _DRIVER."""
    url = url or os.environ["TRENDLENS_JDBC_URL"]
    props = {"user": user or os.environ.get("TRENDLENS_JDBC_USER", ""),
             "password": password or os.environ.get("TRENDLENS_JDBC_PASSWORD", "")}
    drv = driver or os.environ.get("TRENDLENS_JDBC_DRIVER")
    if drv:
        props["driver"] = drv
    return url, props


def read_table(spark: SparkSession, table: str, key: str = "id", num_partitions: int = 64,
               url: str | None = None, fetch_size: int = 10_000, **auth) -> DataFrame:
    """Parallel read: `num_partitions` range queries over `key`, bounds taken from the table.

    The bounds come from a pushed-down MIN/MAX query (one row), not from reading the data."""
    url, props = connection(url, **auth)
    bounds = (spark.read.jdbc(url, f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}) b",
                              properties=props)
              .select(F.col("lo").cast("long"), F.col("hi").cast("long")).first())
    if bounds is None or bounds[0] is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(url, table, column=key, lowerBound=bounds[0], upperBound=bounds[1] + 1,
                           numPartitions=num_partitions, properties={**props, "fetchsize": str(fetch_size)})


def write_table(df: DataFrame, table: str, mode: str = "overwrite", url: str | None = None,
                batch_size: int = 10_000, **auth) -> None:
    """Overwrite by TRUNCATE (keeps the table definition) or append, in batched inserts."""
    url, props = connection(url, **auth)
    (df.write.mode(mode).option("truncate", "true").option("batchsize", str(batch_size))
     .jdbc(url, table, properties=props))
