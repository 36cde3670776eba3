"""Writing and reading the tables between steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

ROWS_PER_FILE = 5_000_000


def write_table(df: DataFrame, path: str, source: str | None = None, fmt: str = "parquet") -> str:
    """Overwrite a table; the target must not be where the rows come from."""
    if source is not None and path.rstrip("/") == source.rstrip("/"):
        raise ValueError("output path equals input path")
    writer = _flat(df) if fmt == "csv" else df
    write = writer.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE)
    if fmt == "csv":
        write.option("header", True).option("escape", '"').csv(path)
    else:
        write.format(fmt).save(path)
    return path


def _flat(df: DataFrame) -> DataFrame:
    """Array columns as JSON text, for CSV."""
    lists = [f.name for f in df.schema.fields if isinstance(f.dataType, ArrayType)]
    return df.withColumns({c: F.to_json(c) for c in lists}) if lists else df


def read_processed(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """Read a processed table by declared schema; a missing path is an error."""
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    lists = {f.name: f.dataType for f in schema.fields if isinstance(f.dataType, ArrayType)}
    plain = StructType()
    for f in schema.fields:
        plain = plain.add(f.name, "string" if f.name in lists else f.dataType)
    df = (
        spark.read.schema(plain).option("header", True).option("multiLine", True)
        .option("escape", '"').option("mode", "FAILFAST").csv(path)
    )
    return df.withColumns({c: F.from_json(c, t) for c, t in lists.items()}) if lists else df


def write_snapshot(df: DataFrame, path: str, run_ts: str, fmt: str = "parquet") -> str:
    """Write one run under its timestamp.

    Writing a run again replaces that run only, so a retry cannot repeat rows
    and earlier runs stay.
    """
    (
        df.withColumn("run_ts", F.lit(run_ts))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy("run_ts")
        .format(fmt)
        .save(path)
    )
    return path


def _runs(spark: SparkSession, folder: str) -> DataFrame | None:
    """A table by run, run_ts as text, so that other runs are not opened; None before its first run."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    schema = spark.read.parquet(folder).schema
    return spark.read.schema(StructType([StructField(f.name, StringType() if f.name == "run_ts" else f.dataType) for f in schema])).parquet(folder)


def write_changes(df: DataFrame, path: str, run_ts: str) -> str:
    """Write one run of a growing export; rows that an earlier run has written are not written again.

    ``rows`` holds every row where it first came, ``manifest`` the hash and number of all
    rows of each run.  The manifest comes last, so a run that failed halfway is no run.
    Writing the last run again replaces it, whatever it now holds; earlier runs are
    refused, as later ones build on their rows.  Equal rows are one row and a number.
    """
    spark = df.sparkSession
    manifest, rows = (f"{path.rstrip('/')}/{name}" for name in ("manifest", "rows"))
    done, written = _runs(spark, manifest), _runs(spark, rows)
    if done is not None and done.where(F.col("run_ts") > run_ts).limit(1).count():
        raise ValueError(f"runs after {run_ts} are there")
    fields = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    digest = F.sha2(F.to_json(fields, {"ignoreNullFields": "false"}), 256)
    counted = df.select(digest.alias("row_hash"), fields.alias("row")).groupBy("row_hash").agg(F.any_value("row").alias("row"), F.count(F.lit(1)).alias("n"))
    new = counted.select("row_hash", "row")
    if written is not None:
        new = new.join(written.where(F.col("run_ts") < run_ts).select("row_hash"), "row_hash", "left_anti")
    for table, folder in ((new, rows), (counted.select("row_hash", "n"), manifest)):
        to = f"{folder}/run_ts={run_ts}"
        table.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(to)
    return path


def read_run(spark: SparkSession, path: str, run_ts: str) -> DataFrame:
    """All rows of a run of ``write_changes``, repeats included; an unknown run is an error."""
    manifest = spark.read.parquet(f"{path.rstrip('/')}/manifest/run_ts={run_ts}")
    rows = _runs(spark, f"{path.rstrip('/')}/rows").where(F.col("run_ts") <= run_ts).select("row_hash", "row")
    every = manifest.join(rows, "row_hash").select("row", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("k"))
    return every.select("row.*")


def append_rows(df: DataFrame, path: str) -> str:
    df.write.mode("append").parquet(path)
    return path


def write_results(tables: dict[str, DataFrame], directory: str, fmt: str = "parquet") -> dict[str, str]:
    """Write each result table to its own folder.

    Reports are a few rows, but residuals are as many as test rows, so nothing
    is forced into one file; adaptive execution merges small partitions.
    """
    return {
        name: write_table(df, f"{directory.rstrip('/')}/{name}", fmt=fmt) for name, df in tables.items()
    }
