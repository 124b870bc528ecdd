"""Licence scan: MinHash bands over overlapping windows retrieve templates, containment verifies them.

Texts are cut into overlapping windows of several lengths; a template belongs
to the shortest length that holds it wherever it stands. Window and template
share a band if they have the same minimum of one hash function; with the worst
ratio of template to window, ``BANDS`` functions miss a true match with a
chance below 0.0002. A candidate counts if the window has at least 0.8 of the
template's five-word shingles, compared as texts.

A band can only meet if the window has the very shingle that is the template's
minimum. Those shingles are few, so windows without any are left out before
their minima are formed: the candidates stay the same.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, text_key
from .licence_texts import TEMPLATES

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 32
# Shingles of all templates; they become part of the plan.
MAX_SHINGLES = 50_000


def plain_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def shingles(tokens: Column, n: int = SHINGLE) -> Column:
    """The runs of ``n`` words as texts; fewer words are one shingle, none are none."""
    m = F.least(F.lit(n), F.size(tokens))
    return F.when(m > 0, F.transform(F.sequence(F.lit(1), F.size(tokens) - m + 1),
                                     lambda i: F.concat_ws(" ", F.slice(tokens, i, m)))).otherwise(
        F.array().cast("array<string>"))


def shingle_hashes(tokens: Column, n: int = SHINGLE) -> Column:
    """As ``shingles``, hashed: of runs of just ``n`` words."""
    return F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1),
                                                   lambda i: F.xxhash64(F.concat_ws(" ", F.slice(tokens, i, n))))).otherwise(
        F.array().cast("array<bigint>"))


def minima(hashes: Column, bands: int = BANDS) -> Column:
    """The minimum of each band's hash function over shingle hashes."""
    return F.array(*[F.array_min(F.transform(hashes, _hash(k))) for k in range(bands)])


def _hash(k: int):
    return lambda h: F.xxhash64(h, F.lit(k))


def window_length(n_words: int) -> int:
    """The shortest window, a power of two, that holds ``n_words`` words wherever they start: its stride is a quarter."""
    length = 8
    while n_words > length - length // 4 + 1:
        length *= 2
    return length


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(TEMPLATES.items()), "license string, text string")


def scan_licenses(docs: DataFrame, templates: DataFrame, containment: float = CONTAINMENT, bands: int = BANDS,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: (key, text_key, n_words, matches).

    ``matches`` holds, by licence, the best containment and the first word of
    the first window that reaches it. ``templates`` (license, text) is a pack of
    bounded size; its texts need five words at least, others are left out, and
    of equal names every text counts. Null and empty texts match nothing. Rows
    that repeat a key have a row each; a null key stays null. An empty pack or
    table gives no matches.
    """
    pack = (templates.select(F.col("license"), plain_words(F.col("text")).alias("words"))
            .filter(F.size("words") >= SHINGLE)
            .select("license", F.size("words").alias("n"), F.array_distinct(shingles(F.col("words"))).alias("t_shingles"),
                    minima(shingle_hashes(F.col("words")), bands).alias("t_minima"),
                    shingle_hashes(F.col("words")).alias("t_hashes")))
    rows = pack.collect()
    if sum(len(r["t_shingles"]) for r in rows) > MAX_SHINGLES:
        raise ValueError("too many templates: scan in packs")
    # The shingle behind each minimum of each template.
    def argmin(k: int) -> Column:
        return F.get(F.filter("t_hashes", lambda h: _hash(k)(h) == F.get("t_minima", F.lit(k))), F.lit(0))
    anchors = sorted({r["h"] for r in pack.select(F.explode(F.array(*map(argmin, range(bands)))).alias("h")).distinct().collect()})
    lengths = sorted({window_length(r["n"]) for r in rows})
    own = docs.select(F.col(key).alias("_key"), text_key(F.col(text)).alias("_text"), plain_words(F.col(text)).alias("_words"))
    own = own.withColumn("_hits", F.filter(F.transform(
        shingle_hashes(F.col("_words")), lambda h, i: F.when(h.isin(anchors) if anchors else F.lit(False), i)),
        lambda i: i.isNotNull()))
    # Windows (length, start word) around the anchors, and one row without any for each document.
    kind = "array<struct<length:int,start:int>>"
    around = [F.array(F.struct(F.lit(0).alias("length"), F.lit(0).alias("start"))).cast(kind)]

    def holding(n: int) -> Column:
        step = n // 4
        return F.array_distinct(F.flatten(F.transform("_hits", lambda i: F.transform(
            F.sequence(F.greatest(F.lit(0), F.ceil((i + SHINGLE - n) / step)).cast("int"), F.floor(i / step).cast("int")),
            lambda s: F.struct(F.lit(n).alias("length"), (s * step).alias("start")))))).cast(kind)
    around += [holding(n) for n in lengths]
    windows = (own.select("_key", "_text", F.size("_words").alias("n_words"), "_words",
                          F.explode(F.concat(*around)).alias("w"))
               .select("_key", "_text", "n_words", F.col("w.length").alias("length"), F.col("w.start").alias("start"),
                       F.when(F.col("w.length") > 0, F.slice("_words", F.col("w.start") + 1, F.col("w.length"))).alias("seen")))
    bound = pack.select("license", "t_shingles", _length_of(F.col("n"), lengths).alias("t_length"),
                        F.col("t_minima").alias("t_all"), F.posexplode("t_minima").alias("t_band", "t_value"))
    probe = windows.withColumn("minima", F.when(F.col("length") > 0, minima(shingle_hashes(F.col("seen")), bands)))
    probe = probe.select("*", F.posexplode_outer("minima").alias("band", "value"))
    met = probe.join(F.broadcast(bound), (F.col("length") == F.col("t_length")) & (F.col("band") == F.col("t_band"))
                     & (F.col("value") == F.col("t_value")), "left")
    # A window and a template that meet in several bands are verified in the first of them.
    first = F.array_position(F.zip_with("minima", "t_all", lambda a, b: a == b), True) == F.col("band") + 1
    met = met.filter(F.col("license").isNull() | first)
    share = F.size(F.array_intersect("t_shingles", shingles(F.col("seen")))) / F.size("t_shingles")
    checked = met.withColumn("share", F.when(F.col("license").isNotNull(), share)).filter(
        (F.col("length") == 0) | (F.col("share") >= containment))
    best = checked.groupBy("_key", "_text", "license").agg(
        F.max("n_words").alias("n_words"), F.sum(F.when(F.col("length") == 0, 1).otherwise(0)).alias("copies"),
        F.max(F.when(F.col("length") > 0, F.struct("share", (-F.col("start")).alias("back")))).alias("best"))
    found = best.groupBy("_key", "_text").agg(
        F.max("n_words").cast("long").alias("n_words"), F.sum("copies").cast("int").alias("copies"),
        F.array_sort(F.collect_list(F.when(F.col("license").isNotNull(), F.struct(
            "license", F.col("best.share").alias("containment"), (-F.col("best.back")).alias("start_word"))))).alias("matches"))
    return (found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(F.col("_key").alias(key), F.col("_text").alias("text_key"), "n_words", "matches"))


def _length_of(n: Column, lengths: list[int]) -> Column:
    out = F.lit(None).cast("int")
    for length in reversed(lengths):
        out = F.when(n <= length - length // 4 + 1, F.lit(length)).otherwise(out)
    return out


def miss_chance(template_shingles: int, length: int, containment: float = CONTAINMENT, bands: int = BANDS) -> float:
    """The chance that no band of a true match meets, at the lowest containment that counts."""
    need = math.ceil(containment * template_shingles - 1e-9)
    other = length - SHINGLE + 1 - need
    return (1 - need / (template_shingles + other)) ** bands


def without_licenses(docs: DataFrame, templates: DataFrame, drop: list[str], key: str = "doc_id", text: str = "text",
                     **options) -> DataFrame:
    """``docs`` without the rows whose text matches a licence named in ``drop``."""
    bad = (scan_licenses(docs, templates, key=key, text=text, **options)
           .filter(F.exists("matches", lambda m: m["license"].isin(drop)) if drop else F.lit(False))
           .select(F.col(key).alias("_key"), F.col("text_key").alias("_text")))
    return docs.join(bad, docs[key].eqNullSafe(bad["_key"]) & (text_key(docs[text]) == bad["_text"]), "left_anti")
