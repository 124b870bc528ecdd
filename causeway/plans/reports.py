"""Compositions: whole reports and end-to-end runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import diagnose, evaluate, mining
from ..operators.features import stratified_split
from ..operators.model import FeatureConfig, LogModel, ModelConfig, feature_importance, permutation_importance, score, train
from ..rules import DEFAULT_PACKS, RulePacks
from ..session import materialize
from ..sources.logs import write_json_report


def category_report(logs: DataFrame, packs: RulePacks = DEFAULT_PACKS, path: str | None = None) -> DataFrame:
    """The category report of a log table. The profile (one row per label) is computed once for
    all sections."""
    report = mining.category_report(materialize(mining.category_profile(logs, packs), "category-profile"))
    if path:
        write_json_report(report, path)
    return report


def train_and_test(logs: DataFrame, config: ModelConfig = ModelConfig(), test: float = 0.3,
                   feature_config: FeatureConfig = FeatureConfig(max_features=100),
                   packs: RulePacks = DEFAULT_PACKS, fit_on: str = "train",
                   key: str = "log_id") -> tuple[LogModel, DataFrame, DataFrame]:
    """Split, train and score the held-out rows: (model, scored test rows, their metrics).

    ``fit_on="all"`` also uses the test rows for the feature statistics.
    """
    split = stratified_split(logs, feature_config.label, test, config.seed, key)
    rows = materialize(split, "split")
    train_rows, test_rows = rows.filter("not is_test").drop("is_test"), rows.filter("is_test").drop("is_test")
    model = train(train_rows, config, feature_config, packs, rows if fit_on == "all" else None, key)
    scored = materialize(score(test_rows, model), "scored")
    metrics = evaluate.evaluate(scored, model.labels, label=feature_config.label)
    return model, scored, metrics


def insights(scored: DataFrame, model: LogModel, label: str = "root_cause_label", key: str = "log_id",
             features: list[str] | None = None, repeats: int = 10, path: str | None = None) -> DataFrame:
    """Rows (section, name, other, value, note): accuracy, error rates, confusions, importance,
    recommendations and patterns of scored rows.

    Importance per class is measured for the listed features, by default all.
    """
    spark = scored.sparkSession
    cm = materialize(evaluate.confusion(scored, label, "prediction"), "confusion")
    rates = materialize(diagnose.class_error_rate(cm), "rates")
    top = materialize(diagnose.top_misclassifications(cm), "confusions")
    pairs = diagnose.challenging_pairs(top)
    accuracy = evaluate.overall_metrics(cm).filter("metric = 'accuracy'").select(F.col("value").alias("accuracy"))
    importance = feature_importance(model, spark)
    listed = features or [r["feature"] for r in importance.collect()]
    per_class = permutation_importance(scored.drop("prediction", "probability", "confidence"), model, listed, repeats,
                                       model.config.seed, label, key)
    best = diagnose.top_features_per_class(per_class)
    common = diagnose.common_features(best)
    none = F.lit("")

    def rows(df: DataFrame, section: str, name, other, value, note) -> DataFrame:
        return df.select(F.lit(section).alias("section"), name.alias("name"), other.alias("other"),
                         value.cast("double").alias("value"), note.alias("note"))

    c = F.col
    parts = [
        rows(accuracy, "overall_accuracy", none, none, c("accuracy"), none),
        rows(diagnose.extreme_classes(rates), "extreme_classes", c("most_challenging_class"), c("easiest_class"),
             F.lit(None), none),
        rows(cm, "confusion", c("label"), c("prediction"), c("n"), none),
        rows(rates, "class_error_rate", c("label"), none, c("error_rate"), none),
        rows(top, "top_misclassifications", c("label"), c("prediction"), c("share"), c("n").cast("string")),
        rows(pairs, "challenging_pairs", c("pair"), none, c("share"), c("description")),
        rows(importance, "global_importance", c("feature"), none, c("importance"), none),
        rows(best, "top_features", c("label"), c("feature"), c("importance"), c("rank").cast("string")),
        rows(common, "common_features", c("feature"), none, c("n_classes"), none),
        rows(diagnose.recommendations(accuracy, rates, common, pairs), "recommendation", c("type"), c("priority"),
             c("ord"), F.concat_ws(" | ", "description", "action")),
        rows(diagnose.error_patterns(rates, top, importance), "pattern", c("type"), none, c("ord"),
             F.concat_ws(" | ", "description", "implication")),
    ]
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    if path:
        write_json_report(report, path)
    return report

