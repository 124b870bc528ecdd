"""Mixing sources to target weights: hash-random order, distributed prefix sums, an exact cut.

Every document gets a random key from its id and a seed. Within a source, the
keys are cut into hash ranges of even size; word counts are summed per range
and carried forward over the ranges, and running sums are formed inside each
range. A source may hold any share of the rows: its ranges spread over tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANK_WORD, cut

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # words of the mix, as a multiple of all words
LIMIT = 2  # epochs of a source at most
RANGE_ROWS = 5_000
OUT = ("size", "source_size", "target", "taken")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            limit: int = LIMIT) -> DataFrame:
    """(source, source_size) with the target of each source.

    Sources in code point order, null last, take the weights in turn. The mix
    holds ``share`` times all words; a source stops at ``limit`` times its
    size, and what it leaves goes to the others by weight. Filling by rising
    limit-to-weight ratio gives that result at once: in this order, sources
    are full up to the first one whose limit lies above its part of the rest.
    One row a source: the windows see sources, not documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(order) - 1) % len(weights))
    own = (sizes.withColumn("weight", weight.cast("double"))
           .withColumn("cap", F.col("source_size") * F.lit(limit).cast("long"))
           .withColumn("ratio", F.col("cap") / F.col("weight")))
    rising = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, rest = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / F.sum("weight").over(rest))
    filled = own.withColumn("level", level).withColumn("place", F.row_number().over(rising))
    open_ = F.col("ratio") > F.col("level")
    filled = filled.withColumn("first", F.min(F.when(open_, F.struct("place", "level"))).over(everything))
    full = F.col("first").isNull() | (F.col("place") < F.col("first.place"))
    return filled.select("source", "source_size", F.when(full, F.col("cap").cast("double")).otherwise(
        F.col("first.level") * F.col("weight")).alias("target"))


def order_key(key: Column, seed: int) -> Column:
    """The random position of a document: a hex digest of the seed and its id."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: int = LIMIT, seed: int = 42,
        key: str = "doc_id", text: str = "text", source: str = "source", range_rows: int = RANGE_ROWS) -> DataFrame:
    """``docs`` with (size, source_size, target, taken); columns of these names are replaced.

    A source is taken in random order, whole epochs first and then up to its
    budget; ``taken`` counts the words of a document that the mix takes. The
    document at the cut gives just the words that are left, so the taken words
    of a source are its target, rounded down.

    A null or empty text has size 0 and gives nothing; a null source is a
    source like any other and comes last. Rows that repeat an id are ordered by
    size and each take their own place. An empty table gives an empty result.
    """
    # Where the ids are random, a range holds about ``range_rows`` documents; the count reads no column.
    n_ranges = max(1, math.ceil(docs.count() / range_rows))
    unit = F.conv(F.substring("_m_key", 1, 12), 16, 10).cast("double") / float(16 ** 12)
    base = (docs.drop(*[c for c in OUT if c not in (key, text, source)])
            .withColumn("_m_size", F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(BLANK_WORD)).cast("long"))
            .withColumn("_m_key", order_key(F.col(key), seed))
            .withColumn("_m_range", F.floor(unit * n_ranges).cast("long")))
    parts = cut(base.groupBy(F.col(source).alias("source"), F.col("_m_range").alias("range")).agg(F.sum("_m_size").alias("size")))
    goals = targets(parts.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, limit)
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("source", "range", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("_m_before"))
    offsets = (offsets.join(goals, offsets["source"].eqNullSafe(goals["source"])).drop(goals["source"])
               .select(F.col("source").alias("_m_source"), F.col("range").alias("_m_at"), "_m_before",
                       F.col("source_size").alias("_m_total"), F.col("target").alias("_m_target")))
    inside = (Window.partitionBy(source, "_m_range").orderBy("_m_key", F.col(key), "_m_size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = base.withColumn("_m_inside", F.coalesce(F.sum("_m_size").over(inside), F.lit(0)))
    met = placed.join(offsets, placed[source].eqNullSafe(offsets["_m_source"]) & (placed["_m_range"] == offsets["_m_at"]))
    budget = F.floor("_m_target").cast("long")
    epochs = F.when(F.col("_m_total") > 0, F.floor(budget / F.col("_m_total"))).otherwise(F.lit(0)).cast("long")
    left = budget - epochs * F.col("_m_total") - F.col("_m_before") - F.col("_m_inside")
    taken = epochs * F.col("_m_size") + F.greatest(F.lit(0), F.least(left, F.col("_m_size")))
    kept = [F.col(c) for c in docs.columns if c not in OUT or c in (key, text, source)]
    return met.select(*kept, F.col("_m_size").alias("size"), F.col("_m_total").alias("source_size"),
                      F.col("_m_target").alias("target"), taken.cast("long").alias("taken"))


def sample_mix(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: each document as often as the mix takes it.

    The last repeat of a document may end after fewer words, where its source's
    budget ends; what stands before those words is kept as it is.
    """
    own = {c: f"_m_own_{c}" for c in docs.columns if c in OUT}
    mixed = mix(docs.withColumnsRenamed(own), key=own.get(key, key), text=own.get(text, text), **options).filter("taken > 0")
    t = F.col(own.get(text, text))
    whole = F.floor(F.col("taken") / F.col("size")).cast("int")
    rest = (F.col("taken") - whole * F.col("size")).cast("int")
    repeats = F.concat(F.array_repeat(F.col("size").cast("int"), whole),
                       F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    piece = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
    rows = mixed.withColumn("_m_words", F.explode(repeats))
    part = F.array_join(F.slice(F.regexp_extract_all(t, F.lit(piece), F.lit(0)), 1, F.col("_m_words")), "")
    rows = rows.withColumn(own.get(text, text), F.when(F.col("_m_words") < F.col("size"), part).otherwise(t))
    return rows.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])
