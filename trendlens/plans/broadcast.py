"""Spread a small shuffle over all partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition on `keys` into `spark.sql.shuffle.partitions` partitions, for a shuffle whose
    output is small but feeds CPU-heavy or data-expanding work (pair generation, model fits).

    With an explicit partition count AQE keeps the partitions instead of coalescing the small
    shuffle into one task; a following groupBy on the same keys reuses this partitioning, so no
    extra exchange is added."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)
