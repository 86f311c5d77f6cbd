"""Partitioning helpers."""
from __future__ import annotations

from pyspark.sql import DataFrame


def spread_for_cpu(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``repartition`` for CPU-heavy narrow work when the input has
    fewer partitions than the cluster can run at once (e.g. one small file);
    a no-op otherwise -- a large input already has one task per file split,
    and repartitioning it would only add a shuffle."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
