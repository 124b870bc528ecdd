"""Log table source and report sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quoted import Dialect, read_quoted

LOG_SCHEMA = T.StructType([
    T.StructField(name, T.StringType(), True)
    for name in ("log_id", "timestamp", "service", "severity", "log_message", "root_cause_label")
])


def read_logs(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType = LOG_SCHEMA,
              escape: str | None = None, multi_line: bool = True) -> DataFrame:
    """Read a log table. A missing path raises ``FileNotFoundError``.

    CSV: columns are found by the header names of each file, in any order;
    columns of ``schema`` that a file lacks are null, further ones are left
    out. Fields are quoted with ``"``, blanks after a comma skipped, an empty
    field is null whether quoted or not. A quote inside a quoted field is
    doubled or stands behind a backslash, which protects any character;
    ``escape`` allows one of the two ways alone. Quoted fields may hold line
    breaks; without ``multi_line`` those raise an error. Files are read in splits either way.
    """
    try:
        if fmt == "parquet":
            return spark.read.parquet(path)
        if fmt != "csv":
            raise ValueError(f"unknown format {fmt}")
        if escape not in (None, '"', "\\"):
            raise ValueError(f"unknown escape {escape}")
        rows = read_quoted(spark, path, schema.names, Dialect(escape != "\\", escape != '"'), multi_line)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from err
        raise
    return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


def write_json_report(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write a report as JSON lines; nested columns stay nested. Returns the path."""
    df.write.mode(mode).json(path)
    return path


def write_per_class_csv(metrics: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write a per-class metric table as CSV, sorted by class. Returns the path."""
    metrics.orderBy(F.col("label")).write.mode(mode).csv(path, header=True)
    return path
