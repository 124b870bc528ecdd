"""Profiling and validation of log tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar, text
from ..rules import DEFAULT_PACKS, RulePacks

EXPECTED_COLUMNS = ["log_id", "timestamp", "service", "severity", "log_message", "root_cause_label"]
REQUIRED_FOR_SCORING = ["log_message", "service", "severity"]


def _long(df: DataFrame, section: str, values: dict[str, Column]) -> DataFrame:
    """One pass over ``df``: each aggregate becomes a row (section, name, value)."""
    if not values:
        return df.sparkSession.createDataFrame([], "section string, name string, value bigint")
    names = list(values)
    row = df.agg(*[values[n].cast("bigint").alias(f"v{i}") for i, n in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"v{i}").alias("value"))
                      for i, n in enumerate(names)])
    return row.select(F.lit(section).alias("section"), F.inline(pairs))


def _type_name(t: T.DataType) -> str:
    return t.simpleString()


def profile_shape(df: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """Rows (item, name, value): row and column count, type per column, absent expected columns."""
    expected = EXPECTED_COLUMNS if expected is None else expected
    facts = [("total_columns", "", str(len(df.columns)))]
    facts += [("data_type", f.name, _type_name(f.dataType)) for f in df.schema.fields]
    facts += [("missing_column", c, "") for c in expected if c not in df.columns]
    static = df.sparkSession.createDataFrame(facts, "item string, name string, value string")
    rows = df.agg(F.count(F.lit(1)).cast("string").alias("value")).select(
        F.lit("total_rows").alias("item"), F.lit("").alias("name"), "value")
    return rows.unionByName(static)


def profile_missing(df: DataFrame) -> DataFrame:
    """Null count of each column that has nulls; one pass over the data."""
    counts = {c: F.count_if(F.col(c).isNull()) for c in df.columns}
    return (_long(df, "missing", counts).filter("value > 0")
            .select(F.col("name").alias("column_name"), F.col("value").alias("n_missing")))


def _row_digest(columns: list[str]) -> Column:
    """256-bit digest of a row in which nulls and field borders are unambiguous."""
    fields = []
    for c in columns:
        as_text = F.col(c).cast("string")
        fields.append(F.when(as_text.isNull(), F.lit("-")).otherwise(
            F.concat(F.length(as_text).cast("string"), F.lit(":"), as_text)))
    return F.unhex(F.sha2(F.concat(*fields), 256))


def _surplus(grouped: DataFrame, name: str) -> DataFrame:
    return grouped.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("n")).select(
        F.lit(name).alias("metric"), "n")


def profile_duplicates(df: DataFrame, key: str = "log_id") -> DataFrame:
    """Rows beyond the first of each identical row, and of each key; nulls are equal.

    Rows are compared by digest, so the shuffle carries 32 bytes per row
    instead of the message text, and copies fold together before it.
    """
    rows = _surplus(df.groupBy(_row_digest(df.columns).alias("digest")).count(), "total_duplicate_rows")
    keys = _surplus(df.groupBy(key).count(), f"duplicate_{key}s")
    return rows.unionByName(keys)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Count per non-null value, most frequent first, ties by value."""
    return (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc("value")))


def class_balance(df: DataFrame, label: str = "root_cause_label") -> DataFrame:
    """Per class: count and percent of all rows; with totals, class count, smallest and largest class.

    Rows without a label count towards the total but not as a class. Only the
    table of class counts is looked at twice, never the data.
    """
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(
        F.sum("n").alias("total_samples"),
        F.count("label").alias("unique_classes"),
        F.min(F.when(F.col("label").isNotNull(), F.col("n"))).alias("min_samples"),
        F.max(F.when(F.col("label").isNotNull(), F.col("n"))).alias("max_samples"),
        F.collect_list(F.when(F.col("label").isNotNull(), F.struct("label", "n"))).alias("classes"))
    return whole.select("total_samples", "unique_classes", "min_samples", "max_samples",
                        F.inline("classes")).select(
        "label", "n", F.round(F.col("n") * 100.0 / F.col("total_samples"), 2).alias("percent"),
        "total_samples", "unique_classes", "min_samples", "max_samples")


def sample_head(df: DataFrame, n: int = 3, order: str = "log_id") -> DataFrame:
    """The first ``n`` rows by ``order`` (kept per task, merged at the end)."""
    return df.orderBy(F.col(order).asc_nulls_last()).limit(n)


def profile_summary(df: DataFrame, key: str = "log_id", head: int = 3,
                    distributions: tuple[str, ...] = ("root_cause_label", "service", "severity")) -> DataFrame:
    """Everything above as rows (section, name, value).

    Shape and nulls share one pass, and all value distributions share another
    (grouping sets), however many columns are profiled.
    """
    counts = {"total_rows": F.count(F.lit(1))}
    counts.update({f"missing {c}": F.count_if(F.col(c).isNull()) for c in df.columns})
    passed = _long(df, "shape", counts)
    shape = passed.filter((F.col("name") == "total_rows") | (F.col("value") > 0)).select(
        F.when(F.col("name") == "total_rows", F.lit("shape")).otherwise(F.lit("missing")).alias("section"),
        F.regexp_replace("name", "^missing ", "").alias("name"),
        F.col("value").cast("string").alias("value"))
    static = profile_shape(df.limit(0)).filter("item <> 'total_rows'").select(
        F.col("item").alias("section"), "name", "value")
    dup = profile_duplicates(df, key).select(
        F.lit("duplicates").alias("section"), F.col("metric").alias("name"),
        F.col("n").cast("string").alias("value"))
    cols = [F.col(c) for c in distributions]
    sets = (df.groupingSets([[c] for c in cols], *cols)
            .agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n")))
    last = len(distributions) - 1
    ids = [(1 << len(distributions)) - 1 - (1 << (last - i)) for i in range(len(distributions))]
    section, name = F.when(F.lit(False), F.lit("")), F.when(F.lit(False), F.lit(""))
    for gid, c in zip(ids, distributions):
        section = section.when(F.col("gid") == gid, F.lit(f"distribution {c}"))
        name = name.when(F.col("gid") == gid, F.col(c))
    dist = sets.select(section.alias("section"), name.alias("name"),
                       F.col("n").cast("string").alias("value")).filter("name is not null")
    first = sample_head(df, head, key).select(
        F.lit("sample").alias("section"), F.col(key).cast("string").alias("name"),
        F.to_json(F.struct(*df.columns)).alias("value"))
    return reduce(DataFrame.unionByName, [shape, static, dup, dist, first])


def feature_profile(df: DataFrame, n_features: int = 0, packs: RulePacks = DEFAULT_PACKS,
                    message: str = "log_message", service: str = "service",
                    severity: str = "severity", timestamp: str = "timestamp") -> DataFrame:
    """One row: distinct error classes, mean tag count, distinct services and severities,
    whether any time parses, sample and feature counts."""
    staged = df.select(
        text.classify_error(F.col(message), packs).alias("error_class"),
        F.size(text.tag_service_keywords(F.col(service), F.col(message), packs)).alias("n_tags"),
        F.col(service).alias("service"), F.col(severity).alias("severity"),
        scalar.parse_time(F.col(timestamp)).isNotNull().alias("has_time"))
    # Fold to the few distinct combinations first: the distinct counts then
    # never multiply the data.
    folded = staged.groupBy("error_class", "service", "severity").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_tags").alias("tags"), F.bool_or("has_time").alias("has_time"))
    return folded.agg(
        F.countDistinct("error_class").alias("unique_error_types"),
        F.try_divide(F.sum("tags"), F.sum("n")).alias("avg_service_patterns"),
        F.countDistinct("service").alias("unique_services"),
        F.countDistinct("severity").alias("unique_severities"),
        F.coalesce(F.bool_or("has_time"), F.lit(False)).alias("has_timestamp"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_samples"),
    ).withColumn("total_features", F.lit(n_features).cast("bigint"))


class InvalidLogs(ValueError):
    """The input of a scoring run is not acceptable."""


def scorable(message: str = "log_message") -> Column:
    """Is the message neither null nor empty?"""
    return F.col(message).isNotNull() & (F.col(message) != "")


def check_columns(df: DataFrame, message: str = "log_message",
                  required: list[str] | None = None) -> None:
    """Raise unless all needed columns are there and the message is text."""
    required = REQUIRED_FOR_SCORING if required is None else required
    absent = sorted(set(required) - set(df.columns))
    if absent:
        raise InvalidLogs(f"absent columns: {absent}, needed: {sorted(required)}")
    if not isinstance(df.schema[message].dataType, T.StringType):
        raise InvalidLogs(f"column {message} must be a string, is {_type_name(df.schema[message].dataType)}")


def validate_for_scoring(df: DataFrame, mode: str = "fail", message: str = "log_message",
                         required: list[str] | None = None) -> DataFrame | tuple[DataFrame, DataFrame]:
    """``fail``: the frame itself, or an error that counts the empty messages.
    ``split``: (good, bad) frames, lazily."""
    check_columns(df, message, required)
    if mode == "split":
        ok = scorable(message)
        return df.filter(ok), df.filter(~F.coalesce(ok, F.lit(False)))
    if mode != "fail":
        raise ValueError(f"unknown mode {mode}")
    bad = validation_counts(df, message).first()["n_rejected"]
    if bad:
        raise InvalidLogs(f"{bad} log messages are empty")
    return df


def validation_counts(df: DataFrame, message: str = "log_message") -> DataFrame:
    """One row: all, accepted and rejected rows."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(scorable(message)).alias("n_accepted"),
                  F.count_if(F.coalesce(F.col(message), F.lit("")) == "").alias("n_rejected"))
