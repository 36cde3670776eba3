"""How rows are laid out over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share when a scan has fewer partitions than cores.

    Meant for heavy per-row work on small or well compressed inputs.  Large
    inputs have more partitions than cores and are left alone, so no shuffle
    is added where it would cost something.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def settled(df: DataFrame) -> DataFrame:
    """The same rows, for columns that are costly to compute: later filters stay after them.

    Moved before them, a filter would compute its columns once more.  No filter is moved before
    a number that depends on where a row is; columns nobody uses are still left out.
    """
    name = "_row"
    while name in df.columns:
        name += "_"
    return df.withColumn(name, F.monotonically_increasing_id()).where(F.col(name) >= 0).drop(name)
