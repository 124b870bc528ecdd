"""Column placement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns so that later filters and projections use their values.

    Spark moves a filter below the projection that computes its column by
    repeating the expression in the filter. For model scores or long rule
    expressions that doubles the work and swells the plan. It does not move
    filters below a generator, so the columns come from one with a single row.
    """
    return df.select("*", F.inline(F.array(F.struct(*[v.alias(k) for k, v in columns.items()]))))


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on equal columns where null equals null; the key columns come from ``left``."""
    renamed = right.withColumnsRenamed({name: f"_right_{name}" for name in on})
    met = reduce(lambda a, b: a & b, (left[name].eqNullSafe(renamed[f"_right_{name}"]) for name in on))
    return left.join(renamed, met, how).drop(*[f"_right_{name}" for name in on])


def sparse(vector: str, indices: str = "indices", values: str = "values") -> tuple[Column, Column]:
    """Positions and values of the entries of an ML vector that are not 0, without a dense array in between."""
    v = F.unwrap_udt(F.col(vector))
    # A dense vector has values alone: its positions are those of its values.
    at = F.when(v["type"] == 0, v["indices"]).otherwise(F.sequence(F.lit(0), F.size(v["values"]) - 1))
    entries = F.filter(F.arrays_zip(at.alias("at"), v["values"].alias("v")), lambda e: e["v"] != 0)
    return (F.transform(entries, lambda e: e["at"]).alias(indices), F.transform(entries, lambda e: e["v"]).alias(values))
