"""Reading a folder of posting CSV files whose headers differ."""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wagelens.operators.clean import with_missing_columns
from wagelens.sources import csv_damage
from wagelens.sources.csv_damage import open_file

CORRUPT = "_corrupt_record"
HEADER_BYTES = 1 << 16


@dataclass
class Loaded:
    """Good rows, rows that did not fit their header, unreadable files, and all files with their sizes, if surveyed."""

    rows: DataFrame
    corrupt_rows: DataFrame
    load_errors: DataFrame
    files: DataFrame | None = None

    def accounts(self) -> DataFrame:
        """(source_file, n_bytes, n_records, n_read, n_corrupt, n_unread, reason), a row per file of a surveyed load.

        Every record is read, corrupt or in an unread file: n_records is the sum of the three.  It is
        null, as n_unread is, where a file is no text; its bytes and its reason say what was left out.
        """
        if self.files is None:
            raise ValueError("only a load with survey=True has accounts")

        def counted(df: DataFrame, name: str) -> DataFrame:
            return df.groupBy("source_file").agg(F.count(F.lit(1)).alias(name))

        out = self.files.join(counted(self.rows, "n_read"), "source_file", "left").join(counted(self.corrupt_rows, "n_corrupt"), "source_file", "left")
        unread = F.when(F.col("reason").isNull(), F.lit(0)).otherwise(F.col("n_records"))
        zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
        return out.select("source_file", "n_bytes", "n_records", zero("n_read"), zero("n_corrupt"), unread.cast("long").alias("n_unread"), "reason")


def list_files(spark: SparkSession, directory: str) -> list[str]:
    """Paths of the ``*.csv`` files in a folder, not its subfolders; no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(directory)
    return sorted(unquote(p) for p in files.inputFiles())


def _read_headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """First line of each file, read where the task runs."""
    for batch in batches:
        found = []
        for path in batch["path"]:
            header, reason = None, None
            try:
                with open_file(path) as stream:
                    head = stream.read(HEADER_BYTES).decode("utf-8-sig")
                names = next(csv.reader(io.StringIO(head)), [])
                if not any(n.strip() for n in names):
                    reason = "no header line"
                elif len(set(names)) != len(names):
                    reason = "repeated column name"
                else:
                    header = "\x1f".join(names)
            except Exception as error:  # any failure makes the file unreadable, not the load
                reason = f"{type(error).__name__}: {error}"
            found.append((path, header, reason))
        yield pd.DataFrame(found, columns=["path", "header", "reason"])


def _a_file_a_task(spark: SparkSession, files: list[tuple], kind: str) -> DataFrame:
    return spark.createDataFrame(files, kind).repartition(min(len(files), 1000) or 1)


def file_headers(spark: SparkSession, directory: str, survey: bool = False) -> DataFrame:
    """(path, header, reason) per file, read by the tasks: the header lines, or in a survey whole files and their sizes."""
    listed = _a_file_a_task(spark, [(p,) for p in list_files(spark, directory)], "path string")
    if survey:
        return listed.mapInPandas(csv_damage.survey_files, csv_damage.SURVEY)
    return listed.mapInPandas(_read_headers, "path string, header string, reason string")


def load_folder(spark: SparkSession, directory: str | None = None, multi_line: bool = True, survey: bool = False) -> Loaded:
    """All CSV files of a folder as one table of text columns.

    Files are read in groups of equal header: one reader over mixed headers
    would put values under the wrong names.  Columns are the union over the
    groups; absent ones are NULL.  ``source_file`` is the base name.
    ``multi_line=False`` lets big files be split between tasks, for data known
    to hold no line breaks inside fields.  Falls back to the current folder.

    ``survey=True`` first reads every file once, in pieces, for damage.  Files with records that
    are no UTF-8, hold NUL characters or have a quote that is never closed are then read record by
    record: sound records are rows, damaged ones are corrupt rows.  Files that are compressed or
    UTF-16 are load errors.  ``Loaded.accounts()`` says where each record of each file went.
    Without it, bytes that are no UTF-8 become replacement characters, and an open quote takes
    what follows into its field.
    """
    headers = None
    for place in [directory or ".", "."]:
        headers = file_headers(spark, place, survey).collect()  # one short row per file
        if headers:
            break
    if not headers:
        raise FileNotFoundError(f"no CSV files in {directory or '.'} or the current folder")

    groups: dict[str, list[str]] = {}
    damaged: dict[str, list[str]] = {}
    for row in headers:
        if row["header"] is not None:
            kind = damaged if survey and row["n_damaged"] else groups
            kind.setdefault(row["header"], []).append(row["path"])
    if not groups and not damaged:
        raise ValueError("none of the CSV files could be read")

    parts = [_read_group(spark, h.split("\x1f"), sorted(p), multi_line) for h, p in sorted(groups.items())]
    if damaged:
        files = [(p, h) for h, paths in sorted(damaged.items()) for p in sorted(paths)]
        records = _a_file_a_task(spark, files, "path string, header string").mapInPandas(csv_damage.read_records, csv_damage.RECORDS)
        parts += [_read_records(records.where(F.col("header") == h), h.split("\x1f")) for h in sorted(damaged)]
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    errors = [(r["path"], r["reason"]) for r in headers if r["header"] is None]
    # the reader refuses plans that need the corrupt text alone (such as a count),
    # so a data column takes part in both filters; its test is always true
    any_text = F.length(F.concat_ws("", F.col(f"`{table.columns[0]}`"), CORRUPT)) >= 0
    good = table.where(F.col(CORRUPT).isNull() & any_text).drop(CORRUPT)
    bad = table.where(F.col(CORRUPT).isNotNull() & any_text)
    return Loaded(
        rows=with_missing_columns(good, ["description"]),
        corrupt_rows=bad.select("source_file", CORRUPT),
        load_errors=spark.createDataFrame(errors, "path string, reason string"),
        files=_file_table(spark, headers) if survey else None,
    )


def _file_table(spark: SparkSession, headers: list) -> DataFrame:
    kind = "path string, n_bytes long, n_records long, reason string"
    files = spark.createDataFrame([(r["path"], r["n_bytes"], r["n_records"], r["reason"]) for r in headers], kind)
    return files.select(_base_name("path").alias("source_file"), "n_bytes", "n_records", "reason")


def _base_name(path: str) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _columns(names: list[str]) -> list[str]:
    return [n.strip() or f"_unnamed_{i}" for i, n in enumerate(names)]


def _fields_and_one(text: str, width: int) -> Column:
    """Fields c0, c1, … of a record and the one ``beyond`` its header."""
    wider = ", ".join([f"c{i} string" for i in range(width)] + ["beyond string"])
    return F.from_csv(text, wider, {"escape": '"'})


def _read_records(records: DataFrame, names: list[str]) -> DataFrame:
    """Records of damaged files of one header, judged as ``_read_group`` judges rows."""
    fields = records.withColumn("fields", _fields_and_one("text", len(names)))
    bad = F.col("damage").isNotNull() | F.col("fields.beyond").isNotNull()
    values = [F.when(~bad, F.col(f"fields.c{i}")).alias(n) for i, n in enumerate(_columns(names))]
    return fields.select(*values, F.when(bad, F.col("text")).alias(CORRUPT), _base_name("path").alias("source_file"))


def _read_group(spark: SparkSession, names: list[str], paths: list[str], multi_line: bool) -> DataFrame:
    names = _columns(names)
    fields = [StructField(n, StringType()) for n in names] + [StructField(CORRUPT, StringType())]
    plus_kept = F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))
    # a row with too few fields is kept with NULLs, one with too many is not
    beyond = _fields_and_one(CORRUPT, len(names))["beyond"]
    return (
        spark.read.schema(StructType(fields))
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("columnPruning", False)  # a row is judged by all its fields
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv([re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths])
        .withColumn("source_file", F.url_decode(plus_kept))
        .withColumn(CORRUPT, F.when(F.col(CORRUPT).isNotNull() & beyond.isNotNull(), F.col(CORRUPT)))
    )


# tasks get these functions with the job, so workers need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
