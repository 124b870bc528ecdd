"""What must hold for fitted models, as queries: each runs its operator on the tables and counts what breaks a rule.

Fits have no SQL counterpart; these counts have one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import model, profile
from ..session import materialize, scratch_path
from ..streaming import scoring
from . import reports
from .catalog import LABELS, QUERIES, RC, _halves, _scored, _train, c, logs, query, valid

# One label in 13 is wrong on purpose, so that no model can do much better; boosting learns some of the wrong ones,
# most of all from few rows (0.88 of the held-out rows of 0.01 are right, less of those of 0.001).
ACCURATE, BOOSTED = 0.9, 0.7


def _is(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _fit_facts(scored: DataFrame, accurate: float = ACCURATE) -> DataFrame:
    """(n_rows, n_unknown, n_bad, accurate) of scored rows."""
    right = F.avg(_is(c("prediction") == c(RC)).cast("double"))
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~_is(c("prediction").isin(LABELS))).alias("n_unknown"),
                      F.count_if(~_is(c("confidence").between(0, 1 + 1e-9))).alias("n_bad"), (right > accurate).alias("accurate"))


@query
def fit_random_forest_check(spark, sf):
    return _fit_facts(_scored(spark, sf, model.RANDOM_FOREST)[1])


@query
def fit_logistic_check(spark, sf):
    return _fit_facts(_scored(spark, sf, model.LOGISTIC)[1])


@query
def fit_boosted_trees_check(spark, sf):
    return _fit_facts(_scored(spark, sf, model.BOOSTED)[1], BOOSTED)


@query
def save_pipeline_check(spark, sf):
    """A reloaded model scores every row as before."""
    train_rows, test_rows = _halves(spark, sf)
    fitted = _train(train_rows, model.LOGISTIC)
    again = model.load_pipeline(model.save_pipeline(fitted, scratch_path(spark, "model"), spark), spark)
    new = model.score(test_rows, again).select("log_id", c("prediction").alias("p"), c("probability").alias("q"))
    both = model.score(test_rows, fitted).join(new, "log_id", "left")
    return both.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.count_if(~_is((c("prediction") == c("p")) & (c("probability") == c("q")))).alias("n_changed"),
                    F.lit(len(again.labels)).cast("long").alias("n_labels"))


@query
def score_check(spark, sf):
    fitted, scored = _scored(spark, sf, model.RANDOM_FOREST)
    total = F.aggregate("probability", F.lit(0.0), lambda a, p: a + p)
    own = F.get("probability", F.array_position(F.array(*map(F.lit, fitted.labels)), c("prediction")).cast("int") - 1)
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~_is(F.abs(total - 1) < 1e-9)).alias("n_sum"),
                      F.count_if(~_is(F.size("probability") == len(LABELS))).alias("n_size"),
                      F.count_if(~_is((c("confidence") == own) & (own == F.array_max("probability")))).alias("n_confidence"))


@query
def tune_check(spark, sf):
    found = QUERIES["tune"](spark, sf)
    return found.groupBy("model_type").agg(
        F.count(F.lit(1)).alias("n_points"), F.count_distinct("params").alias("n_params"), F.max("n_folds").alias("n_folds"),
        F.count_if(~_is(c("macro_f1").between(0, 1))).alias("n_bad"), (F.max("macro_f1") > ACCURATE).alias("accurate"))


@query
def compare_models_check(spark, sf):
    found = QUERIES["compare_models"](spark, sf)
    return found.select("model_type", c("error").isNotNull().alias("failed"), _is(c("accuracy") > F.when(c("model_type") == model.BOOSTED, BOOSTED).otherwise(ACCURATE)).alias("accurate"))


@query
def feature_importance_check(spark, sf):
    fitted = _train(valid(spark, sf), model.RANDOM_FOREST)
    return model.feature_importance(fitted, spark).agg(
        F.count(F.lit(1)).alias("n_features"), F.count_distinct("feature").alias("n_names"),
        F.count_if(~_is(c("importance") >= 0)).alias("n_bad"), F.round(F.sum("importance"), 6).alias("total"))


@query
def permutation_importance_check(spark, sf):
    """All features, all labels, each once."""
    rows = valid(spark, sf)
    fitted = _train(rows, model.RANDOM_FOREST)
    found = model.permutation_importance(rows, fitted, fitted.feature_names)
    return found.groupBy("label").agg(F.count_distinct("feature").alias("n_features"),
                                      F.count_if(~_is(F.abs("importance") <= 1)).alias("n_bad"),
                                      (F.max("importance") > 0).alias("some_matter"))


@query
def insights_check(spark, sf):
    fitted, scored = _scored(spark, sf, model.RANDOM_FOREST)
    found = reports.insights(materialize(scored, "scored"), fitted)
    kept = ("overall_accuracy", "confusion", "class_error_rate", "global_importance", "extreme_classes", "top_features")
    return found.filter(c("section").isin(*kept)).groupBy("section").agg(F.count(F.lit(1)).alias("n"))


@query
def score_stream_check(spark, sf):
    """The stream scores what the batch scores, as the batch does, and rejects the rest."""
    rows = logs(spark, sf).drop(RC)
    source, out, bad = (scratch_path(spark, n) for n in ("arriving", "scored", "rejected"))
    rows.repartition(4).write.parquet(source)
    fitted = _train(logs(spark, sf).filter(profile.scorable()), model.LOGISTIC)
    stream = scoring.read_log_stream(spark, source, schema=rows.schema)
    for q in scoring.score_stream(stream, fitted, out, bad, scratch_path(spark, "progress"), once=True):
        q.awaitTermination()
    batch, _ = scoring.score_logs(rows, fitted, arrival_time=True)
    met = batch.select("log_id", c("prediction").alias("p"), c("confidence").alias("f")).join(
        spark.read.parquet(out).select("log_id", "prediction", "confidence"), "log_id", "full")
    counts = met.agg(F.count("prediction").alias("n_scored"),
                     F.count_if(~_is((c("prediction") == c("p")) & (F.abs(c("confidence") - c("f")) < 1e-9))).alias("n_differ"))
    rejected = spark.read.parquet(bad).agg(F.count(F.lit(1)).alias("n_rejected"))  # one row each
    return counts.join(F.broadcast(rejected))


@query
def inference_check_check(spark, sf):
    rows = valid(spark, sf)
    found = model.inference_check(rows, _train(rows, model.RANDOM_FOREST))
    return found.select("log_id", "label", c("prediction").isin(LABELS).alias("known"),
                        (c("correct") == (c("label") == c("prediction"))).alias("consistent"))
