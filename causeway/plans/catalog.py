"""One registered query per operator, over the test tables.

Nested results are flattened to text and floats are rounded, so that results
can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import evidence, scalar, text
from ..functions.columns import sparse
from ..operators import diagnose, evaluate, features, mining, model, profile, summary
from ..rules import DEFAULT_PACKS
from ..session import materialize, scratch_path
from ..sources import fixture, logs as log_io
from ..streaming import scoring
from . import reports

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
LABELS = DEFAULT_PACKS.labels
RC = "root_cause_label"
c = F.col

# Labelled rows the classifiers of the model queries fit on, the first of each label by hash: a bound, not a share.
# Vocabulary, document counts, category codes and labels come from all rows.
FIT_ROWS = 4_000
FEATURES = model.FeatureConfig(max_features=100)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def logs(spark: SparkSession, sf: str) -> DataFrame:
    return fixture.read_fixture_logs(spark, sf)


def valid(spark: SparkSession, sf: str) -> DataFrame:
    return logs(spark, sf).filter(profile.scorable())


def preds(spark: SparkSession, sf: str) -> DataFrame:
    return fixture.preds_from_logs(logs(spark, sf))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return fixture.dealt(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))


def cm(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.confusion(preds(spark, sf))


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({k: F.round(k, digits) for k in columns})


def joined(col: Column | str, sep: str = "|") -> Column:
    return F.coalesce(F.array_join(col, sep), F.lit(""))


# --- sources and sinks -------------------------------------------------------

@query
def read_logs(spark, sf):
    """Files of one folder with different headers and ways of escaping; messages with quotes, commas and line breaks."""
    path = scratch_path(spark, "logs-csv")
    rows = logs(spark, sf).withColumn("log_message", F.when(c("log_message") != "", F.concat(
        "log_message", F.lit('\n"'), "service", F.lit('", end'))))
    for i, (escape, names) in enumerate((('"', rows.columns), ("\\", rows.columns[::-1]))):
        part = rows.filter(F.pmod(F.xxhash64("log_id"), F.lit(2)) == i).select(*names)
        part.write.mode("append").csv(path, header=True, quote='"', escape=escape)
    return log_io.read_logs(spark, path)


@query
def write_json_report(spark, sf):
    report = mining.category_profile(logs(spark, sf))
    path = log_io.write_json_report(report, scratch_path(spark, "report"))
    return flat_profile(spark.read.schema(report.schema).json(path))


@query
def write_per_class_csv(spark, sf):
    table = evaluate.per_class_metrics(cm(spark, sf))
    path = log_io.write_per_class_csv(table, scratch_path(spark, "per-class"))
    return rounded(spark.read.schema(table.schema).csv(path, header=True), "precision", "recall", "f1")


# --- profile -----------------------------------------------------------------

@query
def profile_shape(spark, sf):
    return profile.profile_shape(logs(spark, sf).drop("severity"))


@query
def profile_missing(spark, sf):
    return profile.profile_missing(logs(spark, sf))


@query
def profile_duplicates(spark, sf):
    # Critical rows occur twice.
    rows = logs(spark, sf)
    again = rows.filter("severity = 'CRITICAL'")
    return profile.profile_duplicates(rows.unionByName(again))


@query
def value_counts(spark, sf):
    rows = logs(spark, sf)
    parts = [profile.value_counts(rows, k).select(F.lit(k).alias("column_name"), "value", "n")
             for k in (RC, "service", "severity")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def class_balance(spark, sf):
    return profile.class_balance(logs(spark, sf))


@query
def sample_head(spark, sf):
    return profile.sample_head(logs(spark, sf), 3)


@query
def profile_summary(spark, sf):
    return profile.profile_summary(logs(spark, sf))


@query
def feature_profile(spark, sf):
    return rounded(profile.feature_profile(logs(spark, sf), n_features=107), "avg_service_patterns")


@query
def validate_for_scoring(spark, sf):
    good, bad = profile.validate_for_scoring(logs(spark, sf), mode="split")
    return good.select("log_id", F.lit(True).alias("accepted")).unionByName(
        bad.select("log_id", F.lit(False).alias("accepted")))


# --- projections -------------------------------------------------------------

@query
def normalize_text(spark, sf):
    return documents(spark, sf).select("doc_id", text.normalize_text(c("text")).alias("clean"))


@query
def classify_error(spark, sf):
    return logs(spark, sf).select("log_id", text.classify_error(c("log_message")).alias("error_class"))


@query
def tag_service_keywords(spark, sf):
    return logs(spark, sf).select("log_id", joined(text.tag_service_keywords(c("service"), c("log_message"))).alias("tags"))


@query
def combine_text(spark, sf):
    return logs(spark, sf).select("log_id", text.combined_message(c("service"), c("log_message")).alias("combined_text"))


@query
def parse_time(spark, sf):
    return logs(spark, sf).select("log_id", F.date_format(
        scalar.parse_time(c("timestamp")), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query
def time_features(spark, sf):
    return logs(spark, sf).select("log_id", *[v.cast("int").alias(k) for k, v in scalar.time_features(c("timestamp")).items()])


@query
def encode_severity(spark, sf):
    return logs(spark, sf).select("log_id", "severity", scalar.encode_severity(c("severity")).alias("severity_encoded"))


@query
def echo_inputs(spark, sf):
    echo = scalar.echo_inputs(c("log_message"), c("service"), c("severity"), c("timestamp"))
    return logs(spark, sf).select("log_id", echo.alias("echo")).select("log_id", "echo.*")


@query
def prediction_json(spark, sf):
    ranked = summary.top_n_labels(preds(spark, sf), LABELS)
    return summary.prediction_json(summary.summarize(ranked)).select("log_id", "json")


# --- feature fitting ---------------------------------------------------------

@query
def tokenize(spark, sf):
    return documents(spark, sf).select("doc_id", joined(text.tokenize(c("text")), " ").alias("tokens"))


@query
def remove_stop_words(spark, sf):
    return documents(spark, sf).select(
        "doc_id", joined(text.remove_stop_words(text.tokenize(c("text"))), " ").alias("tokens"))


@query
def ngrams(spark, sf):
    return features.add_terms(documents(spark, sf), "text").select("doc_id", joined("terms").alias("terms"))


@query
def fit_vocabulary(spark, sf):
    rows = documents(spark, sf)
    docs = features.add_terms(rows, "text")
    found = features.fit_vocabulary(docs, "terms", max_features=500, min_df=2, max_df=0.5, n_docs=rows.count())
    return found.to_df(spark).select("term", "total_count", "doc_count", c("idx").cast("bigint").alias("idx"))


@query
def tfidf(spark, sf):
    rows = documents(spark, sf)
    docs = features.add_terms(rows, "text")
    found = features.fit_vocabulary(docs, "terms", max_features=200, n_docs=rows.count())
    return rounded(features.vector_entries(features.tfidf(docs, "terms", found), "tfidf", found, "doc_id"), "weight")


@query
def index_category(spark, sf):
    rows = logs(spark, sf).withColumn("error_class", text.classify_error(c("log_message")))
    for k in ("service", "error_class", RC):
        rows = features.index_category(rows, k, features.fit_categories(rows, k))
    return rows.select("log_id", "service_encoded", "error_class_encoded", f"{RC}_encoded")


@query
def index_unseen(spark, sf):
    rows = logs(spark, sf)
    known = features.fit_categories(rows.filter(c("service").isin(list(DEFAULT_PACKS.service_keywords))), "service")
    return features.index_category(rows, "service", known).select("log_id", "service", "service_encoded")


@query
def assemble_features(spark, sf):
    rows = valid(spark, sf)
    fitted, names = model.fit_features(rows, FEATURES)
    lookup = spark.createDataFrame(list(enumerate(names)), "idx int, feature string")
    long = model.assemble_features(rows, fitted).select("log_id", *sparse("features")).select(
        "log_id", F.inline(F.arrays_zip(c("indices").alias("idx"), c("values").alias("value"))))
    return rounded(long.join(F.broadcast(lookup), "idx").select("log_id", "feature", "value"), "value")


@query
def stratified_split(spark, sf):
    return features.stratified_split(logs(spark, sf), test=0.3).select("log_id", RC, "is_test")


@query
def class_weights(spark, sf):
    return rounded(features.class_weights(logs(spark, sf)), "weight")


@query
def stratified_folds(spark, sf):
    return features.stratified_folds(logs(spark, sf), k=5).select("log_id", RC, "fold")


# --- models ------------------------------------------------------------------

def _config(kind: str) -> model.ModelConfig:
    return model.ModelConfig(model_type=kind, tune=False)


def _to_fit(rows: DataFrame) -> DataFrame:
    return features.bounded_sample(rows, FIT_ROWS)


def _train(rows: DataFrame, kind: str) -> model.LogModel:
    return model.train(_to_fit(rows), _config(kind), FEATURES, fit_on=rows.filter(c(RC).isNotNull()))


def _halves(spark, sf) -> tuple[DataFrame, DataFrame]:
    rows = materialize(features.stratified_split(valid(spark, sf), test=0.3), "split")
    return rows.filter("not is_test").drop("is_test"), rows.filter("is_test").drop("is_test")


def _scored(spark, sf, kind: str) -> tuple[model.LogModel, DataFrame]:
    train_rows, test_rows = _halves(spark, sf)
    fitted = _train(train_rows, kind)
    return fitted, model.score(test_rows, fitted)


def _flat_scores(scored: DataFrame) -> DataFrame:
    return rounded(scored.select("log_id", c(RC).alias("label"), "prediction", "confidence"), "confidence")


@query
def fit_random_forest(spark, sf):
    return _flat_scores(_scored(spark, sf, model.RANDOM_FOREST)[1])


@query
def fit_logistic(spark, sf):
    return _flat_scores(_scored(spark, sf, model.LOGISTIC)[1])


@query
def fit_boosted_trees(spark, sf):
    return _flat_scores(_scored(spark, sf, model.BOOSTED)[1])


@query
def save_pipeline(spark, sf):
    train_rows, test_rows = _halves(spark, sf)
    fitted = _train(train_rows, model.LOGISTIC)
    path = model.save_pipeline(fitted, scratch_path(spark, "model"), spark)
    return _flat_scores(model.score(test_rows, model.load_pipeline(path, spark)))


@query
def tune(spark, sf):
    rows = valid(spark, sf).filter(c(RC).isNotNull())
    fitted, _ = model.fit_features(rows, FEATURES)
    labels = features.fit_categories(rows, RC)
    ready = model.index_labels(features.with_class_weight(model.assemble_features(_to_fit(rows), fitted)), labels)
    return model.tune(ready.select("log_id", RC, "features", "label_index", "weight"), model.ModelConfig()).results


@query
def score(spark, sf):
    fitted, scored = _scored(spark, sf, model.RANDOM_FOREST)
    return scored.select("log_id", "prediction", F.round("confidence", 6).alias("confidence"),
                         F.size("probability").alias("n_labels"),
                         F.round(F.aggregate("probability", F.lit(0.0), lambda a, p: a + p), 6).alias("total"))


@query
def top_n_labels(spark, sf):
    ranked = summary.top_n_labels(preds(spark, sf), LABELS, 3)
    long = ranked.select("log_id", F.posexplode("top_n_predictions").alias("pos", "p"))
    return rounded(long.select("log_id", (c("pos") + 1).alias("rank"), "p.root_cause", "p.confidence"), "confidence")


@query
def hard_scores(spark, sf):
    hard = summary.hard_scores(preds(spark, sf), LABELS)
    return hard.select("log_id", *[F.get("probability", F.lit(i)).alias(f"p{i + 1}") for i in range(len(LABELS))])


@query
def holdout_accuracy(spark, sf):
    split = features.stratified_split(preds(spark, sf), label="label", test=0.3)
    return rounded(evaluate.holdout_accuracy(split.filter("is_test")), "accuracy")


@query
def compare_models(spark, sf):
    train_rows, test_rows = _halves(spark, sf)
    configs = [_config(k) for k in (model.LOGISTIC, model.RANDOM_FOREST, model.BOOSTED)]
    return model.compare_models(_to_fit(train_rows), test_rows, configs, FEATURES, fit_on=train_rows.filter(c(RC).isNotNull()))


@query
def feature_importance(spark, sf):
    fitted = _train(valid(spark, sf), model.RANDOM_FOREST)
    return rounded(model.feature_importance(fitted, spark), "importance")


@query
def score_stream(spark, sf):
    rows = logs(spark, sf)
    source, out = scratch_path(spark, "arriving"), scratch_path(spark, "scored")
    rows.drop(RC).repartition(4).write.parquet(source)
    fitted = _train(rows.filter(profile.scorable()), model.LOGISTIC)
    stream = scoring.read_log_stream(spark, source, schema=rows.drop(RC).schema)
    for q in scoring.score_stream(stream, fitted, out, scratch_path(spark, "rejected"), scratch_path(spark, "progress"), once=True):
        q.awaitTermination()
    return spark.read.parquet(out).select("log_id", "prediction", F.round("confidence", 6).alias("confidence"),
                                          c("summary.summary").alias("summary"))


# --- evidence and summaries --------------------------------------------------

@query
def label_evidence(spark, sf):
    return preds(spark, sf).select(
        "log_id", joined(evidence.label_evidence(c("prediction"), c("log_message"))).alias("evidence"))


@query
def general_evidence(spark, sf):
    return preds(spark, sf).select("log_id", joined(evidence.general_evidence(c("log_message"))).alias("evidence"))


@query
def evidence_(spark, sf):
    return summary.add_evidence(preds(spark, sf)).select("log_id", joined("evidence").alias("evidence"))


@query
def template_lookup(spark, sf):
    # Rows whose label is not in the pack get the default attributes.
    rows = preds(spark, sf).withColumn("prediction", F.when(c("severity") == "High", F.lit("RC-99")).otherwise(c("prediction")))
    found = summary.template_lookup(rows).select("log_id", "prediction", "incident.*")
    return found.withColumn("actions", joined("actions"))


@query
def summary_severity(spark, sf):
    found = summary.template_lookup(preds(spark, sf))
    return found.select("log_id", summary.summary_severity(c("incident.severity"), c("confidence")).alias("severity"))


@query
def summarize(spark, sf):
    flat = summary.summarize(preds(spark, sf)).select("log_id", "summary.*")
    return rounded(flat.withColumns({k: joined(k) for k in ("key_evidence", "recommended_actions")}), "confidence")


# --- category mining ---------------------------------------------------------

@query
def message_shapes(spark, sf):
    return mining.message_shapes(logs(spark, sf))


@query
def key_phrases(spark, sf):
    return mining.key_phrases(logs(spark, sf))


@query
def mined_error_types(spark, sf):
    return mining.mined_error_types(logs(spark, sf))


@query
def category_distribution(spark, sf):
    return mining.category_distribution(logs(spark, sf))


@query
def category_examples(spark, sf):
    return mining.category_examples(logs(spark, sf))


@query
def category_description(spark, sf):
    return mining.category_description(logs(spark, sf))


def flat_profile(df: DataFrame) -> DataFrame:
    def counts(name: str) -> Column:
        entries = F.sort_array(F.map_entries(name))
        return joined(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))))
    lists = ("common_patterns", "key_phrases", "error_types", "example_logs")
    maps = ("service_distribution", "severity_distribution")
    return df.select("label", "category_description", *[joined(k).alias(k) for k in lists], *[counts(k).alias(k) for k in maps])


@query
def category_profile(spark, sf):
    return flat_profile(mining.category_profile(logs(spark, sf)))


def _phrases(spark, sf) -> DataFrame:
    return materialize(mining.key_phrases(logs(spark, sf)), "phrases")


def _present(spark, sf) -> DataFrame:
    return logs(spark, sf).select(c(RC).alias("label")).distinct()


@query
def phrase_overlap(spark, sf):
    return mining.phrase_overlap(_phrases(spark, sf)).withColumn("phrases", joined("phrases", ", "))


@query
def distinctive_phrases(spark, sf):
    return mining.distinctive_phrases(_phrases(spark, sf)).withColumn("phrases", joined("phrases", ", "))


@query
def category_similarity(spark, sf):
    return mining.category_similarity(_phrases(spark, sf), _present(spark, sf))


@query
def similar_pairs(spark, sf):
    return mining.similar_pairs(mining.category_similarity(_phrases(spark, sf), _present(spark, sf)), 0.1)


@query
def category_report(spark, sf):
    return reports.category_report(logs(spark, sf))


@query
def score_categories(spark, sf):
    scored = mining.score_categories(valid(spark, sf))
    return scored.select("log_id", F.explode_outer("category_scores").alias("label", "score"))


# --- evaluation --------------------------------------------------------------

@query
def confusion(spark, sf):
    return cm(spark, sf)


@query
def confusion_normalized(spark, sf):
    return rounded(evaluate.confusion_normalized(cm(spark, sf)), "share")


@query
def per_class_metrics(spark, sf):
    return rounded(evaluate.per_class_metrics(cm(spark, sf)), "precision", "recall", "f1")


@query
def overall_metrics(spark, sf):
    return rounded(evaluate.overall_metrics(cm(spark, sf)), "value")


def _class_scores(spark, sf) -> DataFrame:
    return materialize(evaluate.class_scores(preds(spark, sf), LABELS), "class-scores")


@query
def roc_auc_ovr(spark, sf):
    return rounded(evaluate.roc_auc_ovr(_class_scores(spark, sf)), "auc")


@query
def roc_auc_ovo(spark, sf):
    return rounded(evaluate.roc_auc_ovo(_class_scores(spark, sf), LABELS), "auc")


@query
def average_precision(spark, sf):
    return rounded(evaluate.average_precision(_class_scores(spark, sf)), "average_precision")


@query
def classification_report(spark, sf):
    return rounded(evaluate.classification_report(cm(spark, sf)), "precision", "recall", "f1")


@query
def evaluate_(spark, sf):
    return rounded(evaluate.evaluate(preds(spark, sf), LABELS), "value")


@query
def metrics_from_confusion(spark, sf):
    stored = materialize(cm(spark, sf).filter("n > 0"), "confusion")
    return rounded(evaluate.metrics_from_confusion(stored), "value")


@query
def error_summary(spark, sf):
    return rounded(evaluate.error_summary(preds(spark, sf)), "wrong_share")


@query
def confused_pairs(spark, sf):
    return rounded(evaluate.confused_pairs(cm(spark, sf)), "share")


@query
def rank_classes(spark, sf):
    return rounded(evaluate.rank_classes(materialize(evaluate.per_class_metrics(cm(spark, sf)), "per-class")), "f1")


# --- diagnosis ---------------------------------------------------------------

@query
def class_error_rate(spark, sf):
    return rounded(diagnose.class_error_rate(cm(spark, sf)), "error_rate")


@query
def top_misclassifications(spark, sf):
    return rounded(diagnose.top_misclassifications(cm(spark, sf)), "share")


@query
def challenging_pairs(spark, sf):
    return rounded(diagnose.challenging_pairs(diagnose.top_misclassifications(cm(spark, sf))), "share")


@query
def misclassified_rows(spark, sf):
    sides = preds(spark, sf).select("log_id", "label", "prediction")
    return diagnose.misclassified_rows(sides, logs(spark, sf).drop(RC))


@query
def extreme_classes(spark, sf):
    return diagnose.extreme_classes(diagnose.class_error_rate(cm(spark, sf)))


def _importance(spark, sf) -> DataFrame:
    """Per label: the share of its messages that contain a phrase, as the importance of the phrase."""
    return materialize(mining.key_phrases(logs(spark, sf)).select(
        "label", c("phrase").alias("feature"), (c("n") / c("total").cast("double")).alias("importance"), "n"), "importance")


def _global_importance(rows: DataFrame) -> DataFrame:
    sums = rows.groupBy("feature").agg(F.sum("n").cast("double").alias("n"))
    whole = sums.agg(F.sum("n").alias("total"), F.collect_list(F.struct("feature", "n")).alias("rows"))
    return whole.select("total", F.inline("rows")).select("feature", (c("n") / c("total")).alias("importance"))


@query
def permutation_importance(spark, sf):
    rows = valid(spark, sf)
    fitted = _train(rows, model.RANDOM_FOREST)
    return rounded(model.permutation_importance(rows, fitted, fitted.feature_names), "importance")


@query
def top_features_per_class(spark, sf):
    return rounded(diagnose.top_features_per_class(_importance(spark, sf)), "importance")


@query
def common_features(spark, sf):
    return diagnose.common_features(diagnose.top_features_per_class(_importance(spark, sf)))


@query
def recommendations(spark, sf):
    table = materialize(cm(spark, sf), "confusion")
    accuracy = evaluate.overall_metrics(table).filter("metric = 'accuracy'").select(c("value").alias("accuracy"))
    top = diagnose.top_misclassifications(table)
    common = diagnose.common_features(diagnose.top_features_per_class(_importance(spark, sf)))
    return diagnose.recommendations(accuracy, diagnose.class_error_rate(table), common, diagnose.challenging_pairs(top))


@query
def error_patterns(spark, sf):
    table = materialize(cm(spark, sf), "confusion")
    top = materialize(diagnose.top_misclassifications(table), "top")
    return diagnose.error_patterns(diagnose.class_error_rate(table), top, _global_importance(_importance(spark, sf)))


@query
def insights(spark, sf):
    fitted, scored = _scored(spark, sf, model.RANDOM_FOREST)
    return rounded(reports.insights(materialize(scored, "scored"), fitted), "value")


@query
def confidence_stats(spark, sf):
    return rounded(diagnose.confidence_stats(preds(spark, sf)), "value")


@query
def confidence_buckets(spark, sf):
    return rounded(diagnose.confidence_buckets(preds(spark, sf)), "percent")


@query
def threshold_sweep(spark, sf):
    return rounded(diagnose.threshold_sweep(preds(spark, sf)), "percent")


@query
def sample_rows(spark, sf):
    return rounded(diagnose.sample_rows(preds(spark, sf), 20).select("log_id", "prediction", "confidence"), "confidence")


@query
def inference_check(spark, sf):
    rows = valid(spark, sf)
    return rounded(model.inference_check(rows, _train(rows, model.RANDOM_FOREST)), "confidence")
