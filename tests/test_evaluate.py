import itertools
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from causeway.operators import evaluate
from causeway.session import materialize

SCHEMA = "label string, prediction string, probability array<double>"


def frame(spark, rows):
    return spark.createDataFrame([(a, b, p) for a, b, p in rows], SCHEMA)


def random_rows(n, labels, seed=1, digits=2):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        raw = [rng.random() + 0.01 for _ in labels]
        p = [round(x / sum(raw), digits) for x in raw]
        truth = rng.choices(labels, weights=[4, 3, 3][:len(labels)])[0]
        rows.append((truth, labels[p.index(max(p))], p))
    return rows


def brute_auc(pos, neg):
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


LABELS = ["A", "B", "C"]


@pytest.fixture(scope="module", params=[2, 9])
def rows(request):
    return random_rows(300, LABELS, digits=request.param)


def test_confusion_is_dense_and_complete(spark, rows):
    cm = evaluate.confusion(frame(spark, rows)).collect()
    assert len(cm) == 9 and sum(r["n"] for r in cm) == 300
    for r in cm:
        assert r["n"] == sum(a == r["label"] and b == r["prediction"] for a, b, _ in rows)


def test_class_metrics(spark, rows):
    per = {r["label"]: r for r in evaluate.per_class_metrics(evaluate.confusion(frame(spark, rows))).collect()}
    for k in LABELS:
        hit = sum(a == b == k for a, b, _ in rows)
        pred, sup = sum(b == k for _, b, _ in rows), sum(a == k for a, _, _ in rows)
        assert per[k]["precision"] == pytest.approx(hit / pred) and per[k]["recall"] == pytest.approx(hit / sup)
        assert per[k]["f1"] == pytest.approx(2 * hit / (pred + sup)) and per[k]["support"] == sup


def test_areas_against_pairs(spark, rows):
    scores = evaluate.class_scores(frame(spark, rows), LABELS).cache()
    ovr = {r["class"]: r["auc"] for r in evaluate.roc_auc_ovr(scores).collect()}
    for i, k in enumerate(LABELS):
        expected = brute_auc([p[i] for a, _, p in rows if a == k], [p[i] for a, _, p in rows if a != k])
        assert ovr[k] == pytest.approx(expected)
    ovo = {(r["class_a"], r["class_b"]): r["auc"] for r in evaluate.roc_auc_ovo(scores, LABELS).collect()}
    for (i, a), (j, b) in itertools.combinations(enumerate(LABELS), 2):
        side_a = brute_auc([p[i] for t, _, p in rows if t == a], [p[i] for t, _, p in rows if t == b])
        side_b = brute_auc([p[j] for t, _, p in rows if t == b], [p[j] for t, _, p in rows if t == a])
        assert ovo[(a, b)] == pytest.approx((side_a + side_b) / 2)


def test_average_precision_against_thresholds(spark, rows):
    got = {r["class"]: r["average_precision"]
           for r in evaluate.average_precision(evaluate.class_scores(frame(spark, rows), LABELS)).collect()}
    for i, k in enumerate(LABELS):
        total = sum(a == k for a, _, _ in rows)
        area, before = 0.0, 0.0
        for t in sorted({p[i] for _, _, p in rows}, reverse=True):
            above = [a for a, _, p in rows if p[i] >= t]
            hit = sum(a == k for a in above)
            area += (hit / total - before) * hit / len(above)
            before = hit / total
        assert got[k] == pytest.approx(area)


def test_close_scores_are_dealt_evenly(spark, monkeypatch):
    """100,000 distinct scores in [0.49, 0.51]: no part has more than twice its share, sums are those of a plain loop."""
    from causeway.operators import ranking
    seen = []

    def kept(df, name):
        seen.append(materialize(df, name))
        return seen[-1]
    monkeypatch.setattr(ranking, "materialize", kept)
    r = random.Random(3)
    scores = np.array(sorted(r.sample(range(10 ** 9), 100_000))) / 10 ** 9 * 0.02 + 0.49
    pos, neg = (np.array([r.randint(0, 3) for _ in scores]) for _ in range(2))
    rows = pd.DataFrame({"class": np.where(np.arange(len(scores)) % 50 == 0, "b", "a"), "score": scores, "pos": pos, "neg": neg})
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        df = spark.createDataFrame(rows)
        for ascending in (True, False):
            got = ranking.sums_before(df, ["class"], "score", ["pos", "neg"], ascending).toPandas()
            want = rows.sort_values("score", ascending=ascending)
            for c in ("pos", "neg"):
                want[f"{c}_before"] = want.groupby("class")[c].cumsum() - want[c]
            key = ["class", "score"]
            pd.testing.assert_frame_equal(got.sort_values(key)[want.columns].reset_index(drop=True),
                                          want.sort_values(key).reset_index(drop=True), check_dtype=False)
    finally:
        spark.conf.unset(name)
    for dealt in seen:
        sizes = [x["count"] for x in dealt.groupBy("_part").count().collect()]
        assert len(sizes) > 3 and max(sizes) <= 2 * len(scores) / len(sizes)


def values(df):
    return {(r["scope"], r["label"], r["metric"]): r["value"] for r in df.collect()}


def one_hot(k):
    return [1.0 if x == k else 0.0 for x in LABELS]


def test_perfect_and_all_wrong(spark):
    good = values(evaluate.evaluate(frame(spark, [(k, k, one_hot(k)) for k in LABELS * 3]), LABELS))
    assert all(good[("overall", "", m)] == 1.0 for m in (
        "accuracy", "macro_f1", "weighted_precision", "roc_auc_ovr", "roc_auc_ovo", "average_precision"))
    turn = {"A": "B", "B": "C", "C": "A"}
    bad = values(evaluate.evaluate(frame(spark, [(k, turn[k], one_hot(turn[k])) for k in LABELS * 3]), LABELS))
    assert bad[("overall", "", "accuracy")] == 0.0 and bad[("overall", "", "macro_f1")] == 0.0


def test_single_class_leaves_areas_undefined(spark):
    got = values(evaluate.evaluate(frame(spark, [("A", "A", one_hot("A"))] * 4), LABELS))
    assert got[("overall", "", "accuracy")] == 1.0 and got[("overall", "", "roc_auc_ovr")] is None
    assert got[("overall", "", "average_precision")] is None


def test_imbalance(spark):
    rows = [("A", "A", one_hot("A"))] * 90 + [("B", "A", one_hot("A"))] * 10
    got = values(evaluate.evaluate(frame(spark, rows), LABELS, probability=None))
    assert got[("overall", "", "accuracy")] == pytest.approx(0.9)
    assert got[("class", "B", "recall")] == 0.0 and got[("class", "B", "precision")] == 0.0
    assert got[("overall", "", "macro_f1")] == pytest.approx((2 * 90 / 190) / 2)


def test_empty_input_raises(spark):
    with pytest.raises(ValueError):
        evaluate.evaluate(frame(spark, []), LABELS)


def test_stored_table_gives_the_same_metrics(spark, rows):
    cm = evaluate.confusion(frame(spark, rows))
    stored = cm.filter("n > 0")
    a, b = values(evaluate.metrics_from_confusion(stored)), values(evaluate.evaluate(frame(spark, rows), LABELS, probability=None))
    assert {k: v for k, v in b.items() if k[0] != "confusion"} == a


def test_report_and_ranks(spark, rows):
    cm = evaluate.confusion(frame(spark, rows))
    names = [r["name"] for r in evaluate.classification_report(cm).collect()]
    assert sorted(names) == ["A", "B", "C", "accuracy", "macro avg", "weighted avg"]
    per = spark.createDataFrame([("a", .9), ("b", .2), ("c", .9), ("d", .5)], "label string, f1 double")
    got = [(r["side"], r["rank"], r["label"]) for r in evaluate.rank_classes(per, 2).collect()]
    assert got == [("best", 1, "a"), ("best", 2, "c"), ("worst", 1, "b"), ("worst", 2, "d")]


def test_simple_counts(spark, rows):
    df = frame(spark, rows)
    wrong = sum(a != b for a, b, _ in rows)
    row = evaluate.error_summary(df).first()
    assert (row["n_rows"], row["n_wrong"]) == (300, wrong)
    assert evaluate.holdout_accuracy(df).first()["accuracy"] == pytest.approx(1 - wrong / 300)
    shares = evaluate.confusion_normalized(evaluate.confusion(df)).groupBy("label").agg(F.sum("share").alias("s"))
    assert all(r["s"] == pytest.approx(1.0) for r in shares.collect())
    assert all(r["share"] > 0.2 and r["label"] != r["prediction"]
               for r in evaluate.confused_pairs(evaluate.confusion(df), 0.2).collect())
