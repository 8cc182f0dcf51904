"""One row for each raw file: how it's encoded, delimited and laid out, how many rows it has, and whether it names identifiers."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import delimited, workbook

SCHEMA = "source string, file_name string, file_path string, sheet_name string, encoding string, delimiter string, header_row int, row_count long, columns string, identifier_status string"


def identifier_status(columns) -> str:
    return "has_identifier" if any("issn" in c.casefold() or c.casefold() == "sourceid" for c in columns) else "title_only"


def profile_csvs(spark: SparkSession, files: list[tuple[str, str]]) -> list[tuple]:
    """(source, path) of delimited files, profiled together: one scan for all files of a layout."""
    out, sources = [], {spark._jvm.org.apache.hadoop.fs.Path(path).getName(): source for source, path in files}
    for layout, found in delimited.layouts(spark, [path for _, path in files], None).items():
        df = delimited.read_layout(spark, layout, [path for path, _ in found])
        columns = [c for c in df.columns if not c.startswith("_")]
        counts = {r._file: r.n for r in df.groupBy("_file").agg(F.count("*").alias("n")).collect()}  # one row a file
        for path, uri in found:
            name = path.rsplit("/", 1)[-1]
            out.append((sources[name], name, path, None, layout.encoding, layout.delimiter, 0, counts.get(uri, 0), json.dumps(columns), identifier_status(columns)))
    return out


def profile_workbook(spark: SparkSession, source: str, path: str) -> list[tuple]:
    """A row for each sheet with a title column; here one signal is enough for the header."""
    out = []
    for name, rows in workbook.sheets(workbook.content_of(spark, path)).items():
        at = workbook.find_header_row(rows, workbook.TITLE_NAMES, two_signals=False)
        columns = [c for c in map(workbook.clean_cell, rows[at]) if c]
        n = sum(any((c or "").strip() for c in row) for row in rows[at + 1 :])
        out.append((source, path.rsplit("/", 1)[-1], path, name, None, None, at, n, json.dumps(columns), identifier_status(columns)))
    return out


def inventory(spark: SparkSession, files: list[tuple[str, str]]) -> DataFrame:
    """(source, path) pairs profiled; every file has to have rows and columns."""
    books = [x for x in files if x[1].lower().endswith(".xlsx")]
    rows = profile_csvs(spark, delimited_files) if (delimited_files := [x for x in files if x not in books]) else []
    for source, path in books:
        rows += profile_workbook(spark, source, path)
    if lost := {path.rsplit("/", 1)[-1] for _, path in files} - {row[1] for row in rows}:
        raise ValueError(f"{sorted(lost)[0]} has no rows or no columns")
    for row in rows:
        if not row[7] or row[8] == "[]":
            raise ValueError(f"{row[2]} has no rows or no columns")
    return spark.createDataFrame(rows, SCHEMA)
