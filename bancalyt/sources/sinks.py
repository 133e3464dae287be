"""Result sinks at the edge of the engine.

Queries return DataFrames; these helpers are for callers that need files
or JSON.  Nulls stay nulls (the catalogue turned them into "" or 0, which
mixes types in one column); zero-filling is done inside the queries where
zero is the meaning.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def to_json_lines(df: DataFrame) -> DataFrame:
    """One JSON string per row, built executor-side (``value`` column)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the result as JSON lines, one file per task."""
    df.write.mode(mode).json(path)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", fmt: str = "parquet") -> None:
    df.write.mode(mode).format(fmt).save(path)


def write_report(df: DataFrame, path: str, metadata: Mapping[str, object], mode: str = "errorifexists") -> dict:
    """Write the result as JSON lines and, beside them, ``_metadata.json``: ``metadata``
    (id, title, ...), the column names and ``total``, the number of rows.

    The rows are counted by the job that writes them (an observed metric), so the
    result is computed once.  Readers of the folder skip the file, whose name
    begins with an underscore.  Returns the metadata."""
    counted = Observation()
    df.observe(counted, F.count(F.lit(1)).alias("total")).write.mode(mode).json(path)
    found = {**metadata, "columns": df.columns, "total": counted.get["total"]}
    context = df.sparkSession.sparkContext
    file = context._jvm.org.apache.hadoop.fs.Path(path, "_metadata.json")
    out = file.getFileSystem(context._jsc.hadoopConfiguration()).create(file, True)
    try:
        out.write(bytearray(json.dumps(found, ensure_ascii=False).encode()))
    finally:
        out.close()
    return found
