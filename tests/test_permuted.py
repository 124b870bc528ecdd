import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from causeway.operators import model, permuted
from causeway.operators.prefixes import Tree
from causeway.sources import fixture
from test_model import BOOSTED, CONFIG, FOREST, LOGISTIC


def drops_by_scoring_every_row(df, fitted, names, seeds, per_class):
    base = model.assemble_features(df, fitted.feature_stages).select("log_id", df["root_cause_label"].alias("truth"), "features")
    at = [fitted.feature_names.index(n) for n in names]

    def values(rows, by):
        points = model._points(model._predicted(rows, fitted).withColumn("_n", F.lit(1)), fitted, by, per_class, None)
        return model._values(points, by, per_class).collect()
    before, sums = {r["label"]: r["value"] for r in values(base, [])}, {}
    for seed in seeds:
        for r in values(model._shuffled(base, "log_id", at, names, 1, seed), ["feature"]):
            drop = None if r["value"] is None else (before[r["label"]] - r["value"]) / len(seeds)
            sums[r["label"], r["feature"]] = None if drop is None else sums.get((r["label"], r["feature"]), 0.0) + drop
    return sums


@pytest.mark.parametrize("config", [FOREST, LOGISTIC, BOOSTED], ids=lambda c: c.model_type)
def test_blocks_and_ranges_equal_scoring_every_row(spark, sample, config, monkeypatch):
    fitted = model.train(sample, config, CONFIG)
    odd = sample.withColumn("root_cause_label", F.when(F.col("log_id") == "L12", "RC-99").otherwise(F.col("root_cause_label")))
    many = odd.unionByName(odd.withColumn("log_id", F.concat("log_id", F.lit("b"))).withColumn("service", F.lit("svc-1")))
    build = permuted.scorer

    def small_blocks(*a):
        judge = build(*a)
        judge.block = 7
        return judge
    monkeypatch.setattr(permuted, "scorer", small_blocks)
    monkeypatch.setattr(permuted, "IN_RANGE", 2)
    names = ["packet", "error", "service_encoded", "hour_of_day", "is_weekend"]
    for per_class in (True, False):
        got = model.permutation_importance(many, fitted, names, repeats=2, per_class=per_class).collect()
        want = drops_by_scoring_every_row(many, fitted, names, [42, 43], per_class)
        # Spark adds up the terms of a linear model in another order: scores that differ in the last bits alone count as half or whole pairs.
        assert {(r["label"], r["feature"]): r["importance"] for r in got} == pytest.approx(want, abs=0.003 if config is LOGISTIC else 1e-12)


def test_a_label_without_rows_has_no_area(sample, fitted):
    got = model.permutation_importance(sample.filter("root_cause_label <> 'RC-01'"), fitted, ["packet"], repeats=1).collect()
    assert [r["label"] for r in got if r["importance"] is None] == ["RC-01"] and len(got) == 8


@pytest.mark.parametrize("many, block", [(1 << 20, 1_000), (5, 40)])
def test_equal_rows_are_scored_once_in_a_block(monkeypatch, many, block):
    monkeypatch.setattr(permuted, "MANY", many)
    # x0 <= 1 ? (x1 <= 2 ? a : b) : c, and x1 <= 2 ? a : b
    deep = Tree(np.array([0, 1, -1, -1, -1]), np.array([1.0, 2.0, 0, 0, 0]), np.array([1, 2, -1, -1, -1]), np.array([4, 3, -1, -1, -1]),
                np.array([[0, 0], [0, 0], [1, 0], [0, 1], [.5, .5]]))
    flat = Tree(np.array([1, -1, -1]), np.array([2.0, 0, 0]), np.array([1, -1, -1]), np.array([2, -1, -1]), np.array([[0, 0], [1, 0], [0, 1]]))
    judge = permuted.ForestScorer.__new__(permuted.ForestScorer)
    permuted.TreeScorer.__init__(judge, [deep, flat], 3)
    judge.n_classes, judge.block, scored = 2, block, []
    score = judge.scores
    judge.scores = lambda leaves: scored.append(len(leaves)) or score(leaves)
    rng = np.random.default_rng(1)
    x, given = (rng.integers(0, 4, (500, 3)).astype(float) for _ in range(2))
    truth, repeat = rng.integers(-1, 2, 500), rng.integers(0, 2, 500)

    def codes(rows):
        batch = pa.RecordBatch.from_arrays([pa.array([np.flatnonzero(r).astype(np.int32) for r in rows], pa.list_(pa.int32())),
                                            pa.array([r[r != 0] for r in rows], pa.list_(pa.float64()))], names=["indices", "values"])
        return next(permuted.packed(iter([batch]), judge)).column("code")
    order = np.argsort(np.array(codes(x).to_pylist(), object))
    batch = pa.RecordBatch.from_arrays([pa.array(repeat[order].astype(np.int32)), pa.array(truth[order].astype(np.int32)), codes(x[order]), codes(given[order])],
                                       names=["repeat", "truth", "code", "given"])
    out = list(permuted.changed(iter([batch]), judge, judge.used, 2, {0: [], 1: []}, True, None))
    assert max(scored) <= 4  # a a, b b, c a, c b

    def plain(r):
        leaf = (([1, 0] if r[1] <= 2 else [0, 1]) if r[0] <= 1 else [.5, .5])
        return tuple((np.array(leaf) + ([1, 0] if r[1] <= 2 else [0, 1])) / 2)
    want = {}
    for r, g, t, i in zip(x, given, truth, repeat):
        for f in (0, 1):
            new = r.copy()
            new[f] = g[f]
            for scores, sign in ((plain(r), -1), (plain(new), 1)):
                for k in (0, 1):
                    spot = want.setdefault((k, 2 * f + i, scores[k]), [0, 0])
                    spot[0 if t == k else 1] += sign
    want = {k: tuple(v) for k, v in want.items() if any(v)}
    got = {}
    for b in out:
        for k, data in zip(b["label"].to_pylist(), b["counts"].to_pylist()):
            for s, v, p, n in np.frombuffer(data, permuted.COUNT).tolist():
                spot = got.setdefault((k, s, v), [0, 0])
                got[k, s, v] = [spot[0] + p, spot[1] + n]
    assert {k: tuple(v) for k, v in got.items() if any(v)} == want


def test_importance_over_many_rows_ends_soon(spark):
    n = F.col("id")
    kinds = F.array(*map(F.lit, ["view", "click", "purchase", "error", "signup"]))
    events = spark.range(48_000).select(
        n.alias("event_id"), F.timestamp_seconds(1_700_000_000 + n * 7_919).alias("ts"), (n * 31 % 1_500).alias("user_id"),
        F.get(kinds, (n * 17 % 11 % 5).cast("int")).alias("event_type"), (n * 13 % 997).cast("double").alias("value"))
    logs = fixture.logs_from_events(events.repartition(8)).filter("log_message <> ''").cache()
    config = model.ModelConfig(tune=False, forest_trees=30)
    fitted = model.train(logs.filter("log_id < 'LOG-00002000'"), config, model.FeatureConfig(max_features=100))
    begun = time.monotonic()
    got = model.permutation_importance(logs, fitted, fitted.feature_names).collect()
    taken = time.monotonic() - begun
    assert len(got) == 8 * len(fitted.feature_names) and max(r["importance"] for r in got) > 0.01
    assert taken < 60


@pytest.fixture(scope="module")
def fitted(sample):
    return model.train(sample, FOREST, CONFIG)
