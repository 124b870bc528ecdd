"""Misclassification, importance and confidence analysis of predictions.

Everything but ``misclassified_rows``, ``sample_rows`` and the confidence
counts works on the small confusion, rate and importance tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..rules.fixed_values import LOW_CONFIDENCE
from .ranking import hash_order

# Limits of the rule tables.
ACCURACY_POOR, ACCURACY_FAIR = 0.7, 0.85
CLASS_ERROR_HIGH, CLASS_ERROR_MEDIUM = 0.3, 0.15
ERROR_CLUSTER_FACTOR = 1.5
ONE_WAY_MIN_COUNT = 2
DOMINANT_IMPORTANCE = 0.3
BANDS = [("very_high", 0.9), ("high", 0.7), ("medium", 0.5)]
SWEEP = [0.3, 0.4, 0.5, 0.6, 0.7]


def class_error_rate(cm: DataFrame) -> DataFrame:
    """Rows (label, n, n_wrong, error_rate); 0 for a label that is never true."""
    total = F.sum("n")
    wrong = F.sum(F.when(F.col("label") != F.col("prediction"), F.col("n")).otherwise(0))
    return cm.groupBy("label").agg(total.alias("n"), wrong.alias("n_wrong")).withColumn(
        "error_rate", F.coalesce(F.try_divide(F.col("n_wrong"), F.col("n")), F.lit(0.0)))


def top_misclassifications(cm: DataFrame, k: int = 20) -> DataFrame:
    """Rows (rank, label, prediction, n, share): the ``k`` most frequent confusions."""
    row = Window.partitionBy("label")
    wrong = (cm.withColumn("share", F.col("n") / F.sum("n").over(row).cast("double"))
             .filter((F.col("label") != F.col("prediction")) & (F.col("n") > 0)))
    best = wrong.orderBy(F.desc("n"), "label", "prediction").limit(k)
    whole = best.agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("n")).alias("key"), "label", "prediction", "n", "share"))).alias("rows"))
    return whole.select(F.posexplode("rows").alias("pos", "r")).select(
        (F.col("pos") + 1).alias("rank"), "r.label", "r.prediction", "r.n", "r.share")


def challenging_pairs(top: DataFrame, k: int = 10, threshold: float = 0.1) -> DataFrame:
    """Among the ``k`` most frequent confusions, those above a share of their true class."""
    return top.filter((F.col("rank") <= k) & (F.col("share") > threshold)).select(
        "rank", F.concat_ws(" → ", "label", "prediction").alias("pair"), "n", "share",
        F.format_string("%s frequently misclassified as %s", "label", "prediction").alias("description"),
        "label", "prediction")


def misclassified_rows(preds: DataFrame, logs: DataFrame | None = None, key: str = "log_id",
                       label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Source rows with a wrong prediction, with both labels.

    Predictions that already carry the log columns are only filtered. Otherwise
    the wrong ones alone are joined to the logs.
    """
    wrong = preds.filter(F.col(label) != F.col(prediction))
    if logs is None:
        return wrong.withColumnsRenamed({label: "true_label", prediction: "predicted_label"})
    sides = wrong.select(key, F.col(label).alias("true_label"), F.col(prediction).alias("predicted_label"))
    return logs.join(sides, key)


def extreme_classes(rates: DataFrame) -> DataFrame:
    """One row (most_challenging_class, easiest_class); the first label on ties."""
    return rates.agg(
        F.min(F.struct((-F.col("error_rate")).alias("key"), "label")).getField("label").alias("most_challenging_class"),
        F.min(F.struct("error_rate", "label")).getField("label").alias("easiest_class"))


def top_features_per_class(importance: DataFrame, k: int = 5) -> DataFrame:
    """Rows (label, rank, feature, importance) from (label, feature, importance)."""
    by = Window.partitionBy("label").orderBy(F.desc("importance"), F.asc("feature"))
    return (importance.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
            .select("label", "rank", "feature", "importance"))


def common_features(top: DataFrame, k: int = 3, min_classes: int = 3) -> DataFrame:
    """Rows (feature, n_classes): features among the ``k`` best of enough classes."""
    return (top.filter(F.col("rank") <= k).groupBy("feature").agg(F.count(F.lit(1)).alias("n_classes"))
            .filter(F.col("n_classes") >= min_classes))


def _percent(share: Column) -> Column:
    return F.format_string("%.1f%%", share * 100)


def _rule(df: DataFrame, ord_: int, sub: Column, kind: Column, priority: Column,
          description: Column, action: Column) -> DataFrame:
    return df.select(F.lit(ord_).alias("ord"), sub.cast("string").alias("sub"), kind.alias("type"),
                     priority.alias("priority"), description.alias("description"), action.alias("action"))


def recommendations(accuracy: DataFrame, rates: DataFrame, common: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows (ord, sub, type, priority, description, action) from the small metric tables.

    ``accuracy`` has one row (accuracy), ``rates`` (label, error_rate),
    ``common`` (feature, n_classes), ``pairs`` comes from ``challenging_pairs``.
    """
    acc, rate = F.col("accuracy"), F.col("error_rate")
    overall = accuracy.filter(acc < ACCURACY_FAIR)
    poor = acc < ACCURACY_POOR
    high = rate > CLASS_ERROR_HIGH
    shared = common.agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("n_classes")).alias("key"), "feature"))).alias("rows")).filter(F.size("rows") > 0)
    first = F.array_join(F.transform(F.slice("rows", 1, 3), lambda r: r["feature"]), ", ")
    parts = [
        _rule(overall, 1, F.lit(""),
              F.when(poor, F.lit("model_improvement")).otherwise(F.lit("model_tuning")),
              F.when(poor, F.lit("high")).otherwise(F.lit("medium")),
              F.concat(F.lit("Overall accuracy is "), _percent(acc),
                       F.when(poor, F.lit(", below 70%")).otherwise(F.lit(", below 85%"))),
              F.when(poor, F.lit("Gather more labelled logs or try another kind of model"))
              .otherwise(F.lit("Search the parameter grid"))),
        _rule(rates.filter(rate > CLASS_ERROR_MEDIUM), 2, F.col("label"), F.lit("class_specific"),
              F.when(high, F.lit("high")).otherwise(F.lit("medium")),
              F.concat(F.col("label"), F.when(high, F.lit(" has a high error rate: ")).otherwise(
                  F.lit(" has a moderate error rate: ")), _percent(rate)),
              F.concat(F.when(high, F.lit("Gather logs and add features for ")).otherwise(
                  F.lit("Read the wrong predictions of ")), F.col("label"))),
        _rule(shared, 3, F.lit(""), F.lit("feature_engineering"), F.lit("medium"),
              F.concat(F.lit("Features that matter for many classes: "), first),
              F.lit("Derive further features from them")),
        _rule(pairs.filter("rank <= 3"), 4, F.format_string("%02d", "rank"), F.lit("confusion_resolution"),
              F.lit("medium"), F.col("description"),
              F.format_string("Add features that tell %s from %s", "label", "prediction")),
    ]
    return reduce(DataFrame.unionByName, parts)


def error_patterns(rates: DataFrame, top: DataFrame, importance: DataFrame) -> DataFrame:
    """Rows (ord, sub, type, description, implication): clustered errors, one-way confusions,
    a dominating feature. ``importance`` has (feature, importance)."""
    whole = rates.agg(F.avg("error_rate").alias("mean"), F.collect_list(F.struct("label", "error_rate")).alias("rows"))
    above = F.filter("rows", lambda r: r["error_rate"] > F.col("mean") * ERROR_CLUSTER_FACTOR)
    names = F.array_join(F.array_sort(F.transform(above, lambda r: r["label"])), ", ")
    clusters = whole.select(names.alias("names")).filter("names <> ''")
    back = top.select(F.col("label").alias("prediction"), F.col("prediction").alias("label"))
    one_way = (top.filter((F.col("rank") <= 5) & (F.col("n") > ONE_WAY_MIN_COUNT))
               .join(back, ["label", "prediction"], "left_anti"))
    leader = importance.agg(F.min(F.struct((-F.col("importance")).alias("key"), "feature")).alias("best")).select(
        (-F.col("best.key")).alias("importance"), F.col("best.feature").alias("feature")
    ).filter(F.col("importance") > DOMINANT_IMPORTANCE)

    def rows(df: DataFrame, ord_: int, sub: Column, kind: str, description: Column, implication: Column) -> DataFrame:
        return df.select(F.lit(ord_).alias("ord"), sub.alias("sub"), F.lit(kind).alias("type"),
                         description.alias("description"), implication.alias("implication"))

    return reduce(DataFrame.unionByName, [
        rows(clusters, 1, F.lit(""), "error_clustering",
             F.concat(F.lit("Error rates far above the mean: "), F.col("names")),
             F.lit("Too few logs or unclear boundaries for these classes")),
        rows(one_way, 2, F.format_string("%02d", "rank"), "asymmetric_confusion",
             F.format_string("%s is taken for %s %d times, never the other way round", "label", "prediction", "n"),
             F.format_string("What marks %s may also occur in %s", "prediction", "label")),
        rows(leader, 3, F.lit(""), "feature_dominance",
             F.concat(F.lit("Feature "), F.col("feature"), F.lit(" carries "), _percent(F.col("importance")),
                      F.lit(" of the importance")),
             F.lit("The model leans on one feature, consider regularization")),
    ])


# --- confidence --------------------------------------------------------------

def confidence_stats(df: DataFrame, confidence: str = "confidence", prediction: str = "prediction") -> DataFrame:
    """Rows (section, name, value): mean, smallest, largest confidence, low rows, rows per label.

    One aggregation by predicted label serves all of them.
    """
    c = F.col(confidence)
    per = df.groupBy(F.col(prediction).alias("name")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(c).alias("total"), F.min(c).alias("low"), F.max(c).alias("high"),
        F.count_if(c < LOW_CONFIDENCE).alias("n_low"))
    whole = per.agg(
        F.try_divide(F.sum("total"), F.sum("n")).alias("avg"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("n_low").cast("double").alias("n_low"),
        F.collect_list(F.struct("name", F.col("n").cast("double").alias("value"))).alias("labels"))
    facts = F.array(*[F.struct(F.lit("confidence").alias("section"), F.lit(n).alias("name"), v.alias("value"))
                      for n, v in (("average", F.col("avg")), ("minimum", F.col("low")),
                                   ("maximum", F.col("high")), ("below_0.5", F.col("n_low")))])
    labels = F.transform("labels", lambda r: F.struct(
        F.lit("predictions").alias("section"), r["name"].alias("name"), r["value"].alias("value")))
    return whole.select(F.inline(F.concat(facts, labels)))


def confidence_buckets(df: DataFrame, confidence: str = "confidence") -> DataFrame:
    """Rows (band, n, percent, advice): the four bands, also empty ones, and what the low share suggests."""
    c = F.col(confidence)
    bounds = [(name, low, high) for (name, low), high in zip(BANDS, [None] + [b for _, b in BANDS])]
    flags = {name: (c >= low) if high is None else ((c >= low) & (c < high)) for name, low, high in bounds}
    flags["low"] = c < BANDS[-1][1]
    row = df.agg(F.count(c).alias("total"), *[F.count_if(f).alias(name) for name, f in flags.items()])

    def percent(name: str) -> Column:
        return F.coalesce(F.try_divide(F.col(name) * 100.0, F.col("total")), F.lit(0.0))

    advice = (F.when(percent("low") > 20, F.lit("lower the threshold to 0.3 or improve the model"))
              .when(percent("low") > 10, F.lit("use a threshold of 0.4")).otherwise(F.lit("use a threshold of 0.5")))
    cells = F.array(*[F.struct(F.lit(n).alias("band"), F.col(n).alias("n"), percent(n).alias("percent")) for n in flags])
    return row.select(F.inline(cells), advice.alias("advice"))


def threshold_sweep(df: DataFrame, thresholds: list[float] | None = None, confidence: str = "confidence") -> DataFrame:
    """Rows (threshold, n, percent): rows at or above each threshold, counted in one pass."""
    thresholds = SWEEP if thresholds is None else thresholds
    c = F.col(confidence)
    row = df.agg(F.count(c).alias("total"), *[F.count_if(c >= t).alias(f"t{i}") for i, t in enumerate(thresholds)])
    cells = F.array(*[F.struct(
        F.lit(float(t)).alias("threshold"), F.col(f"t{i}").alias("n"),
        F.coalesce(F.try_divide(F.col(f"t{i}") * 100.0, F.col("total")), F.lit(0.0)).alias("percent"))
        for i, t in enumerate(thresholds)])
    return row.select(F.inline(cells))


def sample_rows(df: DataFrame, n: int = 20, seed: int = 42, key: str = "log_id") -> DataFrame:
    """``n`` pseudo-random rows, the same for the same seed: a top-n by hash, no full sort."""
    return (df.withColumn("_order", hash_order(F.col(key), seed)).orderBy("_order", key).limit(n).drop("_order"))
