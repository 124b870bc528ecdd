"""Evaluation of predictions.

Two small tables carry everything: the confusion counts (one row per true and
predicted label) and the score counts (rows per class, truth and distinct
score). Both are partial sums before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .ranking import sums_before

LABEL, PREDICTION, PROBABILITY = "label", "prediction", "probability"


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """Rows (label, prediction, n), dense over all labels that occur on either side.

    The counts have one row per pair of labels; the gaps are filled from them.
    """
    counts = df.groupBy(F.col(label).cast("string").alias("label"), F.col(prediction).cast("string").alias("prediction")
                        ).agg(F.count(F.lit(1)).alias("n"))
    return dense_confusion(counts)


def dense_confusion(counts: DataFrame) -> DataFrame:
    """Fill a table (label, prediction, n) with zero cells.

    Its rows and a zero for every pair of labels are added up.
    """
    whole = counts.agg(
        F.array_union(F.collect_set("label"), F.collect_set("prediction")).alias("labels"),
        F.collect_list(F.struct("label", "prediction", F.col("n").cast("bigint").alias("n"))).alias("cells"))
    zero = F.lit(0).cast("bigint").alias("n")
    zeros = F.flatten(F.transform("labels", lambda a: F.transform("labels", lambda b: F.struct(
        a.alias("label"), b.alias("prediction"), zero))))
    return (whole.select(F.inline(F.concat("cells", zeros)))
            .groupBy("label", "prediction").agg(F.sum("n").alias("n")))


def confusion_normalized(cm: DataFrame) -> DataFrame:
    """Add ``share``: the cell divided by its row total, 0 for an empty row."""
    row = Window.partitionBy("label")
    return cm.select("label", "prediction", "n", _ratio(F.col("n"), F.sum("n").over(row)).alias("share"))


def per_class_metrics(cm: DataFrame) -> DataFrame:
    """Rows (label, precision, recall, f1, support) from a confusion table."""
    sides = F.array(
        F.struct(F.col("label").alias("of"), F.col("n").alias("true"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("prediction").alias("of"), F.lit(0).cast("bigint").alias("true"), F.col("n").alias("predicted")))
    flat = cm.select("label", "prediction", "n", F.inline(sides))
    hit = F.sum(F.when((F.col("label") == F.col("prediction")) & (F.col("true") > 0), F.col("n")).otherwise(0))
    sums = flat.groupBy(F.col("of").alias("label")).agg(
        hit.alias("hits"), F.sum("true").alias("support"), F.sum("predicted").alias("predicted"))
    return sums.select(
        "label", _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"), "support")


def overall_metrics(cm: DataFrame) -> DataFrame:
    """Rows (metric, value): accuracy, macro and support-weighted precision, recall, F1."""
    per = per_class_metrics(cm)
    names = ["precision", "recall", "f1"]
    weighted = {f"weighted_{m}": _ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")) for m in names}
    # Support-weighted recall is the share of right rows.
    values = {"accuracy": weighted["weighted_recall"], **{f"macro_{m}": F.avg(m) for m in names}, **weighted}
    row = per.agg(*[v.alias(k) for k, v in values.items()])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k in values])))


# --- ranking metrics ---------------------------------------------------------

def class_scores(df: DataFrame, labels: list[str], label: str = LABEL, probability: str = PROBABILITY,
                 digits: int | None = None) -> DataFrame:
    """Rows (class, truth, score, n): rows per class, true label and distinct score.

    ``digits`` rounds the scores, which bounds the table; None keeps them exact.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("class"), F.get(F.col(probability), F.lit(i)).alias("score"))
                      for i, c in enumerate(labels)])
    rows = df.select(F.col(label).alias("truth"), F.inline(cells))
    if digits is not None:
        rows = rows.withColumn("score", F.round("score", digits))
    return rows.groupBy("class", "truth", "score").agg(F.count(F.lit(1)).alias("n"))


def area(points: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, auc) from (keys, score, pos, neg); null where one side is empty."""
    run = sums_before(_with_keys(points, [*keys, "score"]), keys, "score", ["neg"])
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0))
    return run.groupBy(*keys).agg(
        F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"))


def _with_keys(points: DataFrame, keys: list[str]) -> DataFrame:
    return points.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))


def _strict_mean(value: str) -> Column:
    """Mean, or null if any value is null: the metric is undefined then."""
    return F.when(F.count_if(F.col(value).isNull()) == 0, F.avg(value))


def roc_auc_ovr(scores: DataFrame) -> DataFrame:
    """Rows (class, auc) of each class against the rest, from ``class_scores``; ties count half."""
    own = F.col("truth") == F.col("class")
    points = scores.groupBy("class", "score").agg(
        F.sum(F.when(own, F.col("n")).otherwise(0)).alias("pos"),
        F.sum(F.when(own, F.lit(0)).otherwise(F.col("n"))).alias("neg"))
    return area(points, ["class"])


def roc_auc_ovo(scores: DataFrame, labels: list[str]) -> DataFrame:
    """Rows (class_a, class_b, auc) for each pair a < b: the mean of both directions, each
    over the rows of the two classes only.

    A row of the class itself stands on the positive side of every pair the
    class is in; any other row on the negative side of one pair.
    """
    own = F.col("truth") == F.col("class")
    listed = F.array(*[F.lit(c) for c in labels])
    rivals = F.when(own, F.array_remove(listed, F.col("class"))).otherwise(F.array(F.col("truth")))
    sided = scores.withColumn("pos", F.when(own, F.col("n")).otherwise(0)).withColumn(
        "neg", F.when(own, F.lit(0)).otherwise(F.col("n")))
    points = (sided.select("class", "score", "pos", "neg", F.explode(rivals).alias("rival"))
              .groupBy("class", "rival", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    sides = area(points, ["class", "rival"])
    return (sides.groupBy(F.least("class", "rival").alias("class_a"), F.greatest("class", "rival").alias("class_b"))
            .agg(_strict_mean("auc").alias("auc")))


def average_precision(scores: DataFrame) -> DataFrame:
    """Rows (class, average_precision): sum of recall gain times precision over falling scores."""
    own = F.col("truth") == F.col("class")
    points = scores.groupBy("class", "score").agg(
        F.sum(F.when(own, F.col("n")).otherwise(0)).alias("pos"), F.sum("n").alias("all"))
    run = sums_before(_with_keys(points, ["class", "score"]), ["class"], "score", ["pos", "all"], ascending=False)
    precision = (F.col("pos_before") + F.col("pos")) / (F.col("all_before") + F.col("all"))
    return run.groupBy("class").agg(
        F.try_divide(F.sum(F.col("pos") * precision), F.sum("pos").cast("double")).alias("average_precision"))


def macro_mean(table: DataFrame, value: str, name: str) -> DataFrame:
    """One row (metric, value): the mean over classes, null if undefined for any."""
    return table.agg(_strict_mean(value).alias("value")).select(F.lit(name).alias("metric"), "value")


def ranking_metrics(df: DataFrame, labels: list[str], label: str = LABEL, probability: str = PROBABILITY,
                    digits: int | None = None) -> DataFrame:
    """Rows (metric, value): both areas and the average precision, as macro means.

    The score counts feed three metrics with two reads each: they are written once.
    """
    scores = materialize(class_scores(df, labels, label, probability, digits), "class-scores")
    return (macro_mean(roc_auc_ovo(scores, labels), "auc", "roc_auc_ovo")
            .unionByName(macro_mean(roc_auc_ovr(scores), "auc", "roc_auc_ovr"))
            .unionByName(macro_mean(average_precision(scores), "average_precision", "average_precision")))


# --- reports -----------------------------------------------------------------

def classification_report(cm: DataFrame) -> DataFrame:
    """Rows (name, precision, recall, f1, support): classes, accuracy, macro and weighted average."""
    per = per_class_metrics(cm)
    cols = ["precision", "recall", "f1"]
    classes = per.select(F.col("label").alias("name"), *cols, "support")
    sums = per.agg(*[F.avg(c).alias(f"macro_{c}") for c in cols],
                   *[_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"weighted_{c}") for c in cols],
                   F.sum("support").alias("support"))
    lines = [
        F.struct(F.lit("accuracy").alias("name"), *[F.col("weighted_recall").alias(c) for c in cols], "support"),
        F.struct(F.lit("macro avg").alias("name"), *[F.col(f"macro_{c}").alias(c) for c in cols], "support"),
        F.struct(F.lit("weighted avg").alias("name"), *[F.col(f"weighted_{c}").alias(c) for c in cols], "support"),
    ]
    return classes.unionByName(sums.select(F.inline(F.array(*lines))))


def metrics_from_confusion(cm: DataFrame) -> DataFrame:
    """Rows (scope, label, metric, value) from a confusion table alone, which may be sparse."""
    dense = dense_confusion(cm)
    per = per_class_metrics(dense)
    names = ["precision", "recall", "f1", "support"]
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in names])
    classes = per.select(F.lit("class").alias("scope"), "label", F.inline(cells))
    overall = overall_metrics(dense).select(F.lit("overall").alias("scope"), F.lit("").alias("label"), "metric", "value")
    pair = F.concat_ws(">", "label", "prediction")
    shares = confusion_normalized(dense).select(
        F.lit("confusion_share").alias("scope"), "label", pair.alias("metric"), F.col("share").alias("value"))
    return reduce(DataFrame.unionByName, [classes, overall, shares])


def evaluate(df: DataFrame, labels: list[str], label: str = LABEL, prediction: str = PREDICTION,
             probability: str | None = PROBABILITY, digits: int | None = None) -> DataFrame:
    """All metrics in rows (scope, label, metric, value); empty input raises ``ValueError``.

    ``labels`` names the entries of the probability array. Without
    probabilities the ranking metrics are left out.
    """
    if df.isEmpty():
        raise ValueError("no predictions to evaluate")
    counts = df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "confusion")
    parts = [metrics_from_confusion(counts)]
    parts.append(dense_confusion(counts).select(
        F.lit("confusion").alias("scope"), "label", F.concat_ws(">", "label", "prediction").alias("metric"),
        F.col("n").cast("double").alias("value")))
    if probability:
        parts.append(ranking_metrics(df, labels, label, probability, digits).select(
            F.lit("overall").alias("scope"), F.lit("").alias("label"), "metric", "value"))
    return reduce(DataFrame.unionByName, parts)


def error_summary(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """One row (n_rows, n_wrong, wrong_share)."""
    wrong = F.col(label) != F.col(prediction)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(wrong).alias("n_wrong"),
                  F.avg(wrong.cast("double")).alias("wrong_share"))


def holdout_accuracy(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """One row (accuracy, n_rows)."""
    right = (F.col(label) == F.col(prediction)).cast("double")
    return df.agg(F.avg(right).alias("accuracy"), F.count(F.lit(1)).alias("n_rows"))


def confused_pairs(cm: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Off-diagonal cells whose share of the true class is above the threshold."""
    return confusion_normalized(cm).filter(
        (F.col("label") != F.col("prediction")) & (F.col("share") > threshold))


def rank_classes(per_class: DataFrame, k: int = 3) -> DataFrame:
    """Rows (side, rank, label, f1): the ``k`` best and the ``k`` worst classes, ties by label."""
    best = per_class.orderBy(F.desc("f1"), F.asc("label")).limit(k)
    worst = per_class.orderBy(F.asc("f1"), F.desc("label")).limit(k)

    def ranked(rows: DataFrame, side: str, best_first: bool) -> DataFrame:
        sign = -F.col("f1") if best_first else F.col("f1")
        whole = rows.agg(F.sort_array(F.collect_list(F.struct(sign.alias("key"), "label", "f1"))).alias("rows"))
        at = whole.select(F.posexplode("rows").alias("pos", "r"))
        return at.select(F.lit(side).alias("side"), (F.col("pos") + 1).alias("rank"),
                         F.col("r.label").alias("label"), F.col("r.f1").alias("f1"))

    return ranked(best, "best", True).unionByName(ranked(worst, "worst", False))
