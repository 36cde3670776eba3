"""Tables written between the steps of an operator.

Each goes to the folder in ``spark.checkpoint.dir`` as Parquet: executors share
it, a lost executor costs only the tasks it ran, and a random or order-dependent
step is never computed twice with two outcomes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from wagelens.session import scratch_path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write the rows and read them back; an empty table keeps its schema."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
