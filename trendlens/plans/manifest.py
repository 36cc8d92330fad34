"""A log of published versions: which folders are the live tables.

Each commit appends one small file, and readers take the highest version. Spark's file commit makes that file
appear whole or not at all, so a job that fails before it commits leaves the last version as it was. One writer
at a time.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

SCHEMA = "version long, entries string"


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


class Manifest:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/_manifest"

    def current(self) -> tuple[int, dict]:
        """(version, entries) of the last commit; (0, {}) before the first."""
        if not path_exists(self.spark, self.path):
            return 0, {}
        last = self.spark.read.schema(SCHEMA).parquet(self.path).orderBy("version", ascending=False).first()
        return (last["version"], json.loads(last["entries"])) if last else (0, {})

    def commit(self, entries: dict) -> int:
        version = self.current()[0] + 1
        self.spark.createDataFrame([(version, json.dumps(entries))], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        return version
