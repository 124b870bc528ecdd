"""Scoring of logs as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.model import LogModel, score
from ..operators.profile import check_columns, validate_for_scoring
from ..operators.summary import summarize, top_n_labels
from ..rules import DEFAULT_PACKS, RulePacks
from ..sources.logs import LOG_SCHEMA


def read_log_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType = LOG_SCHEMA,
                    max_files: int | None = None) -> DataFrame:
    """A stream over the files that appear in a folder."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def score_logs(df: DataFrame, model: LogModel, n: int = 3, packs: RulePacks = DEFAULT_PACKS,
               arrival_time: bool = False) -> tuple[DataFrame, DataFrame]:
    """(scored, rejected): the same row-wise plan for a batch and for a stream.

    ``arrival_time`` sets an absent time to the time of processing; otherwise
    such rows get zero time features.
    """
    check_columns(df)
    if "timestamp" not in df.columns:
        df = df.withColumn("timestamp", F.lit(None).cast("string"))
    good, bad = validate_for_scoring(df, mode="split")
    if arrival_time:
        now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        good = good.withColumn("timestamp", F.coalesce(F.when(F.col("timestamp") != "", F.col("timestamp")), now))
    ranked = top_n_labels(score(good, model), model.labels, n)
    return summarize(ranked, packs=packs), bad


def score_stream(stream: DataFrame, model: LogModel, path: str, rejected_path: str, checkpoint: str,
                 fmt: str = "parquet", n: int = 3, packs: RulePacks = DEFAULT_PACKS,
                 once: bool = False) -> list[StreamingQuery]:
    """Start the two queries that append scored and rejected rows to files.

    Stateless: progress lives in the checkpoint folder, which must be shared.
    ``once`` processes what is there and stops.
    """
    scored, rejected = score_logs(stream, model, n, packs, arrival_time=True)

    def start(df: DataFrame, out: str, check: str) -> StreamingQuery:
        writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", check)
        if once:
            writer = writer.trigger(availableNow=True)
        return writer.start(out)

    return [start(scored, path, f"{checkpoint}/scored"), start(rejected, rejected_path, f"{checkpoint}/rejected")]
