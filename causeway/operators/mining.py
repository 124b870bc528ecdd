"""Category mining: what the messages of each root-cause label have in common.

All message scans are conditional aggregates in one hash aggregation per
operator, grouped by label. Partial sums are formed before the shuffle, so a
label that holds most rows moves no more data than a rare one. Everything
after that works on tables with one row per label and rule.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.regex import search_ignore_case
from ..rules import DEFAULT_PACKS, RulePacks
from ..rules.fixed_values import ERROR_TYPE_MIN_SHARE, PHRASE_MIN_SHARE, SHAPE_MIN_SHARE

# Aggregates per pass; beyond about 100 columns Spark leaves generated code.
TALLIES_PER_PASS = 90

LABEL, MESSAGE = "root_cause_label", "log_message"


def _as_int(flag: Column) -> Column:
    return F.coalesce(flag.cast("int"), F.lit(0))


@dataclass(frozen=True)
class _Rule:
    """One thing to count: a 0/1 (or small integer) value per message."""

    kind: str
    ord: int
    name: str
    flag: Column


def _matches(pattern: str) -> Column:
    return _as_int(search_ignore_case(F.col("message"), F.col("lowered"), pattern))


def _shape_rules(packs: RulePacks) -> list[_Rule]:
    return [_Rule("shape", i, name, _matches(p)) for i, (p, name) in enumerate(packs.message_shapes)]


def _type_rules(packs: RulePacks) -> list[_Rule]:
    return [_Rule("error_type", i, name, reduce(Column.__add__, [_matches(p) for p in ps]))
            for i, (name, ps) in enumerate(packs.mined_error_types.items())]


def _term_rules(packs: RulePacks, fold_terms: bool) -> list[_Rule]:
    return [_Rule("phrase", i, t, _as_int(F.col("lowered").contains(t.lower() if fold_terms else t)))
            for i, t in enumerate(packs.technical_terms)]


def _tallies(df: DataFrame, packs: RulePacks, rules: list[_Rule], label: str, message: str) -> DataFrame:
    """Rows (label, total, kind, ord, name, n): how often each rule holds per label."""
    messages = (df.filter(F.col(label).isin(packs.labels))
                .select(F.col(label).alias("label"), F.col(message).alias("message"),
                        F.lower(F.col(message)).alias("lowered")))
    passes = []
    for start in range(0, len(rules), TALLIES_PER_PASS):
        chunk = rules[start:start + TALLIES_PER_PASS]
        wide = messages.groupBy("label").agg(
            F.count(F.lit(1)).alias("total"), *[F.sum(r.flag).alias(f"t{i}") for i, r in enumerate(chunk)])
        cells = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.ord).alias("ord"),
                                   F.lit(r.name).alias("name"), F.col(f"t{i}").alias("n"))
                          for i, r in enumerate(chunk)])
        passes.append(wide.select("label", "total", F.inline(cells)))
    return reduce(DataFrame.unionByName, passes)


def _frequent() -> Column:
    """Is a tally row frequent enough for its kind?"""
    n, total = F.col("n"), F.col("total")
    return (F.when(F.col("kind") == "shape", n > total * SHAPE_MIN_SHARE)
            .when(F.col("kind") == "error_type", (n > 0) & (n >= total * ERROR_TYPE_MIN_SHARE))
            .otherwise(n >= F.greatest(F.lit(1.0), total * PHRASE_MIN_SHARE)))


def message_shapes(df: DataFrame, packs: RulePacks = DEFAULT_PACKS,
                   label: str = LABEL, message: str = MESSAGE) -> DataFrame:
    """Per label, the shapes that more than 30 % of its messages have."""
    return (_tallies(df, packs, _shape_rules(packs), label, message).filter(_frequent())
            .select("label", "ord", F.col("name").alias("shape"), "n", "total"))


def key_phrases(df: DataFrame, packs: RulePacks = DEFAULT_PACKS, fold_terms: bool = False,
                label: str = LABEL, message: str = MESSAGE) -> DataFrame:
    """Per label, the terms found in at least 20 % of its messages (and in one at least)."""
    return (_tallies(df, packs, _term_rules(packs, fold_terms), label, message).filter(_frequent())
            .select("label", F.col("name").alias("phrase"), "n", "total"))


def mined_error_types(df: DataFrame, packs: RulePacks = DEFAULT_PACKS,
                      label: str = LABEL, message: str = MESSAGE) -> DataFrame:
    """Per label, error types whose pattern hits reach 30 % of its messages.

    A message counts once for each pattern of the type it matches.
    """
    return (_tallies(df, packs, _type_rules(packs), label, message).filter(_frequent())
            .select("label", "ord", F.col("name").alias("error_type"), "n", "total"))


def category_distribution(df: DataFrame, packs: RulePacks = DEFAULT_PACKS, label: str = LABEL,
                          service: str = "service", severity: str = "severity") -> DataFrame:
    """Rows (label, kind, value, n): services and severities per label, from one scan."""
    rows = df.filter(F.col(label).isin(packs.labels)).select(
        F.col(label).alias("label"), F.col(service).alias("service"), F.col(severity).alias("severity"))
    counted = rows.groupBy("label", "service", "severity").agg(F.count(F.lit(1)).alias("n"))
    parts = F.array(F.struct(F.lit("service").alias("kind"), F.col("service").alias("value")),
                    F.struct(F.lit("severity").alias("kind"), F.col("severity").alias("value")))
    return (counted.select("label", "n", F.inline(parts)).filter("value is not null")
            .groupBy("label", "kind", "value").agg(F.sum("n").alias("n")))


def category_examples(df: DataFrame, n: int = 3, packs: RulePacks = DEFAULT_PACKS, label: str = LABEL,
                      message: str = MESSAGE, order: str = "log_id") -> DataFrame:
    """The first ``n`` messages per label by ``order``.

    Spark limits the ranks per task before the shuffle, so at most
    ``n`` rows per label and task move.
    """
    by = Window.partitionBy("label").orderBy(F.col("ord_key"), F.col("message"))
    rows = df.filter(F.col(label).isin(packs.labels)).select(
        F.col(label).alias("label"), F.col(order).alias("ord_key"), F.col(message).alias("message"))
    return (rows.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= n)
            .select("label", "rank", F.col("ord_key").alias(order), F.col("message").alias(message)))


def _distribution_facts(dist: DataFrame) -> DataFrame:
    """Per label: number of services, most common service and severity (ties: smallest),
    and both counts as maps. The maps are as large as the number of distinct values."""
    def top(kind: str) -> Column:
        return F.min(F.when(F.col("kind") == kind, F.struct((-F.col("n")).alias("minus"), "value"))).getField("value")

    def counts(kind: str) -> Column:
        pairs = F.collect_list(F.when(F.col("kind") == kind, F.struct("value", "n")))
        return F.map_from_entries(F.sort_array(pairs))

    return dist.groupBy("label").agg(
        F.count_if(F.col("kind") == "service").alias("n_services"),
        top("service").alias("common_service"), top("severity").alias("common_severity"),
        counts("service").alias("service_distribution"), counts("severity").alias("severity_distribution"))


def _definitions(df: DataFrame, packs: RulePacks) -> DataFrame:
    rows = [(k, c.name, c.text, list(c.issues)) for k, c in sorted(packs.categories.items())]
    return df.sparkSession.createDataFrame(
        rows, "label string, name string, text string, issues array<string>")


def _description() -> Column:
    return F.format_string(
        "%s. %s This category contains %d log entries across %d different services. "
        "Most commonly affects the %s service with %s severity levels.",
        "name", "text", "total", F.coalesce("n_services", F.lit(0)),
        F.coalesce("common_service", F.lit("various")), F.coalesce("common_severity", F.lit("mixed")))


def category_description(df: DataFrame, packs: RulePacks = DEFAULT_PACKS, label: str = LABEL,
                         service: str = "service", severity: str = "severity") -> DataFrame:
    """Rows (label, description): name, text, row count, services, most common values."""
    totals = (df.filter(F.col(label).isin(packs.labels)).groupBy(F.col(label).alias("label"))
              .agg(F.count(F.lit(1)).alias("total")))
    facts = _distribution_facts(category_distribution(df, packs, label, service, severity))
    return (totals.join(facts, "label", "left").join(F.broadcast(_definitions(df, packs)), "label")
            .select("label", _description().alias("description")))


def category_profile(df: DataFrame, packs: RulePacks = DEFAULT_PACKS, fold_terms: bool = False,
                     label: str = LABEL, message: str = MESSAGE, service: str = "service",
                     severity: str = "severity", order: str = "log_id") -> DataFrame:
    """One row per label that occurs: shapes, phrases, error types, issues, description,
    examples, service and severity counts.

    The three rule scans share one pass over the messages. Lists keep the order
    of their operators: rule order for shapes, falling counts for the others.
    """
    rules = _shape_rules(packs) + _type_rules(packs) + _term_rules(packs, fold_terms)
    tallies = _tallies(df, packs, rules, label, message)

    def kept(kind: str, *order_by: Column) -> Column:
        cell = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order_by)], F.col("name"))
        picked = F.collect_list(F.when((F.col("kind") == kind) & _frequent(), cell))
        return F.transform(F.sort_array(picked), lambda c: c["name"])

    lists = tallies.groupBy("label").agg(
        F.max("total").alias("total"), kept("shape", F.col("ord")).alias("common_patterns"),
        kept("phrase", -F.col("n")).alias("key_phrases"),
        kept("error_type", -F.col("n"), F.col("ord")).alias("error_types"))
    facts = _distribution_facts(category_distribution(df, packs, label, service, severity))
    examples = (category_examples(df, 3, packs, label, message, order).groupBy("label")
                .agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", message))),
                                 lambda s: s[message]).alias("example_logs")))
    nothing = F.create_map().cast("map<string,bigint>")
    # A label may have neither services nor severities.
    return (lists.join(facts, "label", "left").join(examples, "label")
            .join(F.broadcast(_definitions(df, packs)), "label")
            .select("label", "common_patterns", "key_phrases", "error_types",
                    F.col("issues").alias("typical_system_issues"),
                    _description().alias("category_description"), "example_logs",
                    *[F.coalesce(k, nothing).alias(k) for k in ("service_distribution", "severity_distribution")]))


def category_pairs(phrase_rows: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Rows (label_a, phrases_a, label_b, phrases_b) over all labels, itself included.

    ``phrase_rows`` holds (label, phrase), ``labels`` further labels without
    phrases. The table of categories is defined by the rule pack, so it is
    folded into one row and unfolded twice.
    """
    rows = phrase_rows.select("label", "phrase")
    if labels is not None:
        rows = rows.unionByName(labels.select("label", F.lit(None).cast("string").alias("phrase")))
    per_label = rows.groupBy("label").agg(F.sort_array(F.collect_set("phrase")).alias("phrases"))
    whole = per_label.agg(F.collect_list(F.struct("label", "phrases")).alias("all"))
    left = whole.select("all", F.inline("all").alias("label_a", "phrases_a"))
    return left.select("label_a", "phrases_a", F.inline("all").alias("label_b", "phrases_b"))


def phrase_overlap(phrase_rows: DataFrame) -> DataFrame:
    """Rows (pair, phrases): sorted shared phrases of two labels, pairs without any omitted."""
    shared = F.sort_array(F.array_intersect("phrases_a", "phrases_b"))
    return (category_pairs(phrase_rows).filter(F.col("label_a") < F.col("label_b"))
            .select(F.concat_ws("-", "label_a", "label_b").alias("pair"), shared.alias("phrases"))
            .filter(F.size("phrases") > 0))


def distinctive_phrases(phrase_rows: DataFrame) -> DataFrame:
    """Rows (label, phrases): sorted phrases no other label has; labels without any omitted."""
    single = (phrase_rows.groupBy("phrase").agg(F.countDistinct("label").alias("n"), F.min("label").alias("label"))
              .filter("n = 1"))
    return single.groupBy("label").agg(F.sort_array(F.collect_set("phrase")).alias("phrases"))


def category_similarity(phrase_rows: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Jaccard similarity of the phrase sets of each two labels; 0 where both are empty."""
    both = F.size(F.array_intersect("phrases_a", "phrases_b"))
    any_ = F.size(F.array_union("phrases_a", "phrases_b"))
    return category_pairs(phrase_rows, labels).select(
        "label_a", "label_b",
        F.round(F.coalesce(F.try_divide(both, any_), F.lit(0.0)), 3).alias("similarity"))


def similar_pairs(similarity: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Pairs of different labels above the threshold."""
    return similarity.filter((F.col("label_a") != F.col("label_b")) & (F.col("similarity") > threshold))


def _match_share(lowered: Column, phrases: list[str]) -> Column:
    if not phrases:
        return F.lit(0.0)
    hits = reduce(Column.__add__, [_as_int(lowered.contains(p.lower())) for p in phrases])
    return hits / F.lit(float(len(phrases)))


def category_scores(lowered: Column, packs: RulePacks = DEFAULT_PACKS) -> dict[str, Column]:
    """Per label, the share of its phrases that the lower-cased message contains."""
    return {label: _match_share(lowered, packs.categories[label].phrases) for label in packs.labels}


def score_categories(df: DataFrame, packs: RulePacks = DEFAULT_PACKS, message: str = MESSAGE) -> DataFrame:
    """The frame with a map column ``category_scores`` (label to share, 3 digits)."""
    scores = category_scores(F.col("_lowered"), packs)
    pairs = [c for k in packs.labels for c in (F.lit(k), F.round(scores[k], 3))]
    return (df.withColumn("_lowered", F.lower(F.coalesce(F.col(message), F.lit(""))))
            .withColumn("category_scores", F.create_map(*pairs)).drop("_lowered"))


def top_categories(df: DataFrame, n: int = 3, scores: str = "category_scores") -> DataFrame:
    """The ``n`` best categories with a score above 0, best first, ties by label."""
    entries = F.transform(F.map_entries(scores), lambda e: F.struct(
        (-e["value"]).alias("minus"), e["key"].alias("label"), e["value"].alias("score")))
    best = F.slice(F.sort_array(F.filter(entries, lambda e: e["score"] > 0)), 1, n)
    return df.withColumn("top_categories", F.transform(best, lambda e: F.struct(e["label"].alias("label"),
                                                                                e["score"].alias("score"))))


def category_texts(spark, packs: RulePacks = DEFAULT_PACKS) -> DataFrame:
    """Rows (label, text): ``name: description`` of every defined category."""
    return spark.createDataFrame(
        [(k, f"{c.name}: {c.text}") for k, c in sorted(packs.categories.items())], "label string, text string")


def category_report(profile: DataFrame) -> DataFrame:
    """Rows (section, label, other, value): counts, details and cross analysis of a profile.

    The profile is read several times: cache or materialize it first when it
    comes straight from the logs.
    """
    phrase_rows = profile.select("label", F.explode("key_phrases").alias("phrase"))
    labels = profile.select("label")
    blank = F.lit("")

    def rows(df: DataFrame, section: str, label: Column, other: Column, value: Column) -> DataFrame:
        return df.select(F.lit(section).alias("section"), label.alias("label"), other.alias("other"),
                         value.alias("value"))

    parts = [
        rows(profile.agg(F.count(F.lit(1)).cast("string").alias("v")), "total_categories", blank, blank, F.col("v")),
        rows(phrase_rows.agg(F.countDistinct("phrase").cast("string").alias("v")), "total_unique_key_phrases",
             blank, blank, F.col("v")),
        rows(profile, "description", F.col("label"), blank, F.col("category_description")),
        rows(phrase_overlap(phrase_rows), "overlap", F.col("pair"), blank, F.array_join("phrases", ", ")),
        rows(distinctive_phrases(phrase_rows), "distinctive", F.col("label"), blank, F.array_join("phrases", ", ")),
        rows(category_similarity(phrase_rows, labels), "similarity", F.col("label_a"), F.col("label_b"),
             F.format_string("%.3f", "similarity")),
    ]
    for column in ("common_patterns", "key_phrases", "error_types", "typical_system_issues", "example_logs"):
        at = profile.select("label", F.posexplode(column).alias("pos", "v"))
        parts.append(rows(at, column, F.col("label"), F.col("pos").cast("string"), F.col("v")))
    for column in ("service_distribution", "severity_distribution"):
        at = profile.select("label", F.explode(column).alias("k", "v"))
        parts.append(rows(at, column, F.col("label"), F.col("k"), F.col("v").cast("string")))
    return reduce(DataFrame.unionByName, parts)
