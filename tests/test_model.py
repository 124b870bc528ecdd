import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from causeway.operators import evaluate, features, model
from causeway.plans import reports

CONFIG = model.FeatureConfig(max_features=40)
FOREST = model.ModelConfig(tune=False, forest_trees=5, forest_max_depth=6)
LOGISTIC = model.ModelConfig(model_type=model.LOGISTIC, tune=False, logistic_max_iter=20)
BOOSTED = model.ModelConfig(model_type=model.BOOSTED, tune=False, boost_rounds=2, boost_max_depth=2)


@pytest.fixture(scope="module")
def fitted(sample):
    return model.train(sample, FOREST, CONFIG)


def test_feature_names_and_widths(sample, fitted):
    stages, names = model.fit_features(sample, CONFIG)
    assert len(names) == 47 and names[-7:] == model.CATEGORICAL + model.TIME_FEATURES
    row = model.assemble_features(sample, stages).filter("log_id = 'L00'").select(vector_to_array("features").alias("v")).first()["v"]
    assert len(row) == 47 and sum(x * x for x in row[:40]) == pytest.approx(1.0)
    assert row[40:] == [0.0, 0.0, 0.0, 10.0, 4.0, 0.0, 1.0]
    assert fitted.feature_names == names and fitted.labels == [f"RC-0{k}" for k in range(1, 9)]


def test_unseen_values_get_minus_one(spark, sample):
    stages, names = model.fit_features(sample, CONFIG)
    new = spark.createDataFrame([("x", "network error now", "never-seen", "High")], "log_id string, log_message string, service string, severity string")
    row = model.assemble_features(new, stages).select(vector_to_array("features").alias("v")).first()["v"]
    named = dict(zip(names, row))
    assert named["service_encoded"] == -1.0 and named["error_class_encoded"] == -1.0 and named["hour_of_day"] == 0.0


@pytest.mark.parametrize("config", [FOREST, LOGISTIC, BOOSTED], ids=lambda c: c.model_type)
def test_each_kind_learns_scores_and_reloads(spark, sample, config, tmp_path):
    trained = model.train(sample, config, CONFIG)
    scored = model.score(sample, trained).orderBy("log_id").collect()
    assert sum(r["prediction"] == r["root_cause_label"] for r in scored) >= 36
    for r in scored:
        assert sum(r["probability"]) == pytest.approx(1.0) and len(r["probability"]) == 8
        assert r["confidence"] == max(r["probability"])
        assert r["probability"][trained.labels.index(r["prediction"])] == r["confidence"]
    again = model.load_pipeline(model.save_pipeline(trained, str(tmp_path / "m"), spark), spark)
    assert again.config == trained.config and again.labels == trained.labels
    assert model.score(sample, again).orderBy("log_id").collect() == scored
    importance = model.feature_importance(trained, spark, 10).collect()
    assert len(importance) == 10 and importance[0]["importance"] >= importance[9]["importance"] >= 0


def test_grids_have_the_expected_sizes():
    from math import prod
    sizes = {k: prod(len(v) for v in g.values()) for k, g in model.GRIDS.items()}
    assert sizes == {model.LOGISTIC: 8, model.RANDOM_FOREST: 54, model.BOOSTED: 54}
    with pytest.raises(ValueError):
        model.estimator(model.ModelConfig(model_type="magic"), None, 1.0)


def test_tuning_picks_the_best_point(sample):
    config = model.ModelConfig(folds=2, grid={"forest_trees": [1, 8], "forest_max_depth": [1, None], "balanced": [True]})
    trained = model.train(sample, config, CONFIG)
    grid = trained.notes["grid"]
    assert len(grid) == 4 and trained.notes["best_score"] == max(g["macro_f1"] for g in grid)
    assert trained.config.forest_max_depth is None


def test_macro_f1_evaluator(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0)], "label_index double, prediction double")
    assert model.MacroF1().evaluate(df) == pytest.approx((2 / 3 + 2 / 3) / 2)


def test_comparison_reports_failures(sample):
    rows = model.compare_models(sample, sample, [FOREST, model.ModelConfig(model_type="magic", tune=False)], CONFIG).collect()
    assert rows[0]["accuracy"] > 0.9 and rows[0]["error"] is None
    assert rows[1]["accuracy"] is None and "unknown model type" in rows[1]["error"]


def test_inference_check(sample, fitted):
    rows = model.inference_check(sample, fitted).collect()
    assert sorted(r["log_id"] for r in rows) == [f"L{k}0" for k in range(8)] and all(isinstance(r["correct"], bool) for r in rows)


def test_permutation_importance(sample, fitted):
    got = model.permutation_importance(sample, fitted, ["is_business_hours", "packet", "hour_of_day"], repeats=2)
    rows = {(r["label"], r["feature"]): r["importance"] for r in got.collect()}
    assert len(rows) == 24
    # All rows are within business hours: passing the value on changes nothing.
    assert all(v == pytest.approx(0.0) for (_, f), v in rows.items() if f == "is_business_hours")
    flat = model.permutation_importance(sample, fitted, ["packet"], repeats=1, per_class=False).collect()
    assert [r["label"] for r in flat] == [""]


def test_shuffled_values_are_a_permutation(sample, fitted):
    base = model.assemble_features(sample, fitted.feature_stages).select("log_id", F.col("root_cause_label").alias("truth"), "features")
    at = fitted.feature_names.index("hour_of_day")
    moved = model._shuffled(base, "log_id", [at], ["hour_of_day"], 3, 5)
    before = sorted(r[0] for r in base.select(F.get(vector_to_array("features"), F.lit(at))).collect())
    after = sorted(r[0] for r in moved.select(F.get(vector_to_array("features"), F.lit(at))).collect())
    assert before == after and moved.count() == 40


def test_train_test_and_insights(spark, sample, tmp_path):
    trained, scored, metrics = reports.train_and_test(sample, FOREST, feature_config=CONFIG, fit_on="all")
    assert scored.count() == 12
    assert metrics.filter("metric = 'macro_f1'").count() == 1
    report = reports.insights(scored, trained, features=["packet", "memory"], repeats=1, path=str(tmp_path / "i"))
    sections = {r["section"] for r in report.collect()}
    assert {"overall_accuracy", "confusion", "class_error_rate", "global_importance", "top_features"} <= sections
    cm = evaluate.confusion(scored, "root_cause_label", "prediction")
    assert cm.agg(F.sum("n")).first()[0] == 12


def test_splits_are_disjoint_and_complete(sample):
    rows = features.stratified_split(sample, test=0.3)
    assert rows.count() == 40 and rows.select("log_id").distinct().count() == 40
    assert rows.filter("is_test").select("root_cause_label").distinct().count() == 8


def test_registered_boosting_uses_the_default_rounds():
    from causeway.plans import catalog
    assert catalog._config(model.BOOSTED).boost_rounds == model.ModelConfig().boost_rounds == 100


def test_registered_models_know_rare_labels_and_services(spark, monkeypatch):
    from causeway.plans import catalog
    rows = spark.createDataFrame([(f"L{i}", "2024-03-01T10:00:00Z", f"svc-{i % 60}", "ERROR", f"word{i} failed",
                                   "RC-02" if i == 7 else "RC-01") for i in range(300)],
                                 "log_id string, timestamp string, service string, severity string, log_message string, root_cause_label string")
    monkeypatch.setattr(catalog, "FIT_ROWS", 20)
    taken = {r["root_cause_label"]: r["count"] for r in catalog._to_fit(rows).groupBy("root_cause_label").count().collect()}
    assert taken == {"RC-01": 19, "RC-02": 1}
    monkeypatch.setattr(catalog, "_config", lambda kind: model.ModelConfig(model_type=kind, tune=False, forest_trees=2, forest_max_depth=2))
    fitted = catalog._train(rows, model.RANDOM_FOREST)
    assert fitted.labels == ["RC-01", "RC-02"]
    indexer = next(s for s in fitted.pipeline.stages if s.hasParam("inputCol") and s.getOrDefault("inputCol") == "service")
    assert len(indexer.labels) == 60


def test_registered_tuning_searches_the_whole_grid(spark, monkeypatch):
    from causeway.plans import catalog
    seen = []

    def tune(df, config):
        seen.append((df.count(), config))
        return model.Tuned(None, config, 0.0, df)
    monkeypatch.setattr(model, "tune", tune)
    catalog.QUERIES["tune"](spark, "/root/testdata/sf0.001")
    (n, config), = seen
    assert model.parameter_grid(config) == model.GRIDS[model.RANDOM_FOREST] and config.folds == 5 and 0 < n <= catalog.FIT_ROWS


def test_permutation_of_all_features_equals_scoring_every_row(sample, fitted):
    names = fitted.feature_names
    base = model.assemble_features(sample, fitted.feature_stages).select("log_id", sample["root_cause_label"].alias("truth"), "features")
    every = model._predicted(model._shuffled(base, "log_id", list(range(len(names))), names, 1, 42), fitted).withColumn("_n", F.lit(1))
    plain = model._predicted(base, fitted).withColumn("_n", F.lit(1))
    for per_class in (True, False):
        before = {r["label"]: r["value"] for r in model._values(model._points(plain, fitted, [], per_class, None), [], per_class).collect()}
        want = {(r["label"], r["feature"]): before[r["label"]] - r["value"]
                for r in model._values(model._points(every, fitted, ["feature"], per_class, None), ["feature"], per_class).collect()}
        got = model.permutation_importance(sample, fitted, names, repeats=1, per_class=per_class).collect()
        assert {(r["label"], r["feature"]): r["importance"] for r in got} == pytest.approx(want)


def test_registered_importance_permutes_every_feature(spark, monkeypatch):
    from causeway.plans import catalog
    seen = []
    trained = model.LogModel(None, [], ["a", "b", "c", "d", "e", "f"], model.ModelConfig())
    monkeypatch.setattr(model, "train", lambda *a, **b: trained)
    monkeypatch.setattr(catalog, "_scored", lambda *a: (trained, spark.range(1)))

    def importance(df, fitted, names, repeats=10):
        seen.append((names, repeats))
        return spark.createDataFrame([("x", "a", 0.5)], "label string, feature string, importance double")

    def insights(df, fitted, features=None, repeats=10):
        seen.append((features or fitted.feature_names, repeats))
        return spark.createDataFrame([(0.5,)], "value double")
    monkeypatch.setattr(model, "permutation_importance", importance)
    monkeypatch.setattr(catalog.reports, "insights", insights)
    for name in ("permutation_importance", "insights"):
        catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert seen == [(trained.feature_names, 10)] * 2
