import pytest
from pyspark.sql import functions as F

from causeway.operators import diagnose


@pytest.fixture(scope="module")
def cm(spark):
    cells = {("A", "A"): 5, ("A", "B"): 4, ("B", "A"): 1, ("B", "B"): 9, ("C", "A"): 3, ("C", "C"): 0}
    rows = [(a, b, cells.get((a, b), 0)) for a in "ABCD" for b in "ABCD"]
    return spark.createDataFrame(rows, "label string, prediction string, n bigint").cache()


def test_rates_and_extremes(cm):
    rates = diagnose.class_error_rate(cm)
    got = {r["label"]: r["error_rate"] for r in rates.collect()}
    assert got == {"A": pytest.approx(4 / 9), "B": pytest.approx(0.1), "C": 1.0, "D": 0.0}
    row = diagnose.extreme_classes(rates).first()
    assert (row["most_challenging_class"], row["easiest_class"]) == ("C", "D")


def test_top_confusions_and_pairs(cm):
    top = diagnose.top_misclassifications(cm)
    assert [(r["rank"], r["label"], r["prediction"], r["n"]) for r in top.collect()] == [
        (1, "A", "B", 4), (2, "C", "A", 3), (3, "B", "A", 1)]
    assert diagnose.top_misclassifications(cm, 1).count() == 1
    pairs = diagnose.challenging_pairs(top).collect()
    assert [r["pair"] for r in pairs] == ["A → B", "C → A"]
    assert pairs[0]["description"] == "A frequently misclassified as B"


def test_wrong_rows_with_and_without_join(spark):
    preds = spark.createDataFrame([("1", "A", "A"), ("2", "A", "B"), ("3", "B", "A")],
                                  "log_id string, label string, prediction string")
    logs = spark.createDataFrame([("1", "x"), ("2", "y"), ("3", "z")], "log_id string, log_message string")
    got = sorted(tuple(r) for r in diagnose.misclassified_rows(preds, logs).collect())
    assert got == [("2", "y", "A", "B"), ("3", "z", "B", "A")]
    assert diagnose.misclassified_rows(preds).columns == ["log_id", "true_label", "predicted_label"]


@pytest.fixture(scope="module")
def importance(spark):
    rows = [(k, f, v) for k in "ABC" for f, v in (("f1", 0.5), ("f2", 0.3), ("f3", 0.3), ("f4", 0.1), ("f5", 0.0), ("f6", -1.0))]
    return spark.createDataFrame(rows, "label string, feature string, importance double")


def test_features(importance):
    top = diagnose.top_features_per_class(importance)
    assert [r["feature"] for r in top.filter("label = 'A'").orderBy("rank").collect()] == ["f1", "f2", "f3", "f4", "f5"]
    assert sorted(r["feature"] for r in diagnose.common_features(top).collect()) == ["f1", "f2", "f3"]
    assert diagnose.common_features(top, min_classes=4).count() == 0


def test_recommendations(spark, cm, importance):
    top = diagnose.top_misclassifications(cm)
    common = diagnose.common_features(diagnose.top_features_per_class(importance))

    def rules(accuracy):
        acc = spark.createDataFrame([(accuracy,)], "accuracy double")
        rows = diagnose.recommendations(acc, diagnose.class_error_rate(cm), common, diagnose.challenging_pairs(top)).collect()
        return [(r["type"], r["priority"]) for r in sorted(rows, key=lambda r: (r["ord"], r["sub"]))], rows

    kinds, rows = rules(0.65)
    assert kinds == [("model_improvement", "high"), ("class_specific", "high"), ("class_specific", "high"),
                     ("feature_engineering", "medium"), ("confusion_resolution", "medium"), ("confusion_resolution", "medium")]
    assert any("A has a high error rate: 44.4%" == r["description"] for r in rows)
    assert any(r["description"].endswith("f1, f2, f3") for r in rows)
    assert rules(0.8)[0][0] == ("model_tuning", "medium")
    assert rules(0.85)[0][0][0] == "class_specific"


def test_patterns(spark, cm):
    importance = spark.createDataFrame([("hour_of_day", 0.07), ("tfidf_pool", 0.52), ("service", 0.41)], "feature string, importance double")
    rows = diagnose.error_patterns(diagnose.class_error_rate(cm), diagnose.top_misclassifications(cm), importance).collect()
    text = {r["type"]: r["description"] for r in rows}
    assert text["error_clustering"].endswith(": C") and "C is taken for A 3 times" in text["asymmetric_confusion"]
    assert "tfidf_pool carries 52.0%" in text["feature_dominance"] and len(rows) == 3
    flat = spark.createDataFrame([(f"t{i}", 0.25) for i in range(4)], "feature string, importance double")
    assert diagnose.error_patterns(diagnose.class_error_rate(cm), diagnose.top_misclassifications(cm), flat).filter(
        "type = 'feature_dominance'").count() == 0


@pytest.fixture(scope="module")
def confident(spark):
    values = [0.95, 0.9, 0.89, 0.7, 0.69, 0.5, 0.49, 0.1, 0.3, 0.4]
    return spark.createDataFrame([(str(i), v, "A" if i % 2 else "B") for i, v in enumerate(values)],
                                 "log_id string, confidence double, prediction string")


def test_confidence_tables(confident):
    stats = {(r["section"], r["name"]): r["value"] for r in diagnose.confidence_stats(confident).collect()}
    assert stats[("confidence", "average")] == pytest.approx(0.592) and stats[("confidence", "below_0.5")] == 4
    assert stats[("confidence", "minimum")] == 0.1 and stats[("predictions", "A")] == 5
    bands = {r["band"]: (r["n"], r["percent"]) for r in diagnose.confidence_buckets(confident).collect()}
    assert bands == {"very_high": (2, 20.0), "high": (2, 20.0), "medium": (2, 20.0), "low": (4, 40.0)}
    assert "0.3" in diagnose.confidence_buckets(confident).first()["advice"]
    assert "0.4" in diagnose.confidence_buckets(confident.filter("confidence >= 0.4 and confidence <> 0.49")).first()["advice"]
    assert "0.5" in diagnose.confidence_buckets(confident.filter("confidence >= 0.5")).first()["advice"]
    assert {r["threshold"]: r["n"] for r in diagnose.threshold_sweep(confident).collect()} == {
        0.3: 9, 0.4: 8, 0.5: 6, 0.6: 5, 0.7: 4}


def test_sample_is_repeatable(confident):
    a = [r["log_id"] for r in diagnose.sample_rows(confident, 4, seed=1).collect()]
    assert a == [r["log_id"] for r in diagnose.sample_rows(confident.repartition(3), 4, seed=1).collect()] and len(set(a)) == 4
    assert a != [r["log_id"] for r in diagnose.sample_rows(confident, 4, seed=2).collect()]
