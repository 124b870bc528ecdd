import hashlib
import math
from collections import Counter

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from causeway.operators import features, ranking

DOCS = ["disk full disk", "disk error on node", "full full full", "", "node node error error disk"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(list(enumerate(DOCS)), "doc_id int, text string")
    return features.add_terms(df, "text", stop_words=["on"]).cache()


def brute_terms(doc):
    tokens = [t for t in doc.split() if t != "on"]
    return tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]


def test_term_statistics(docs):
    total, per_doc = Counter(), Counter()
    for d in DOCS:
        total.update(brute_terms(d))
        per_doc.update(set(brute_terms(d)))
    got = {r["term"]: (r["total_count"], r["doc_count"]) for r in features.term_statistics(docs, "terms").collect()}
    assert got == {t: (n, per_doc[t]) for t, n in total.items()}


def test_vocabulary_bounds_and_ties(docs):
    v = features.fit_vocabulary(docs, "terms", max_features=3)
    assert v.terms == ["disk", "error", "full"] and v.n_docs == 5
    assert features.fit_vocabulary(docs, "terms", min_df=3).terms == ["disk"]
    assert "disk" not in features.fit_vocabulary(docs, "terms", max_df=2).terms
    assert "disk" not in features.fit_vocabulary(docs, "terms", max_df=0.5).terms
    assert "disk" in features.fit_vocabulary(docs, "terms", max_df=1.0).terms


def test_tfidf_equals_brute_force(docs):
    v = features.fit_vocabulary(docs, "terms", max_features=6)
    idf = {t: math.log((1 + 5) / (1 + c)) + 1 for t, c in zip(v.terms, v.doc_counts)}
    got = {}
    for r in features.vector_entries(features.tfidf(docs, "terms", v), "tfidf", v, "doc_id").collect():
        got[(r["doc_id"], r["term"])] = r["weight"]
    for i, d in enumerate(DOCS):
        counts = Counter(t for t in brute_terms(d) if t in idf)
        w = {t: n * idf[t] for t, n in counts.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        for t in w:
            assert got.pop((i, t)) == pytest.approx(w[t] / norm)
    assert not got


def test_category_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), (None,), ("b",)], "s string")
    known = features.fit_categories(df, "s")
    assert known == ["a", "b", "c"]
    coded = features.index_category(df.unionByName(spark.createDataFrame([("zz",)], "s string")), "s", known)
    assert sorted((str(r["s"]), r["s_encoded"]) for r in coded.collect()) == [
        ("None", -1), ("a", 0), ("b", 1), ("b", 1), ("c", 2), ("zz", -1)]
    with pytest.raises(ValueError, match="distinct values"):
        features.fit_categories(df, "s", limit=2)


def labelled(spark, sizes):
    rows = [(f"{k}-{i}", f"RC-{k}") for k, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(rows, "log_id string, root_cause_label string")


@pytest.mark.parametrize("sizes, test, expected", [([5] * 8, 0.3, 12), ([2, 3] * 4, 0.4, 8), ([100, 7, 1], 0.2, 22)])
def test_split_sizes(spark, sizes, test, expected):
    rows = features.stratified_split(labelled(spark, sizes), test=test).collect()
    assert len(rows) == sum(sizes) and sum(r["is_test"] for r in rows) == expected
    for k, n in enumerate(sizes):
        got = sum(r["is_test"] for r in rows if r["root_cause_label"] == f"RC-{k}")
        assert math.floor(n * expected / sum(sizes)) <= got <= math.ceil(n * expected / sum(sizes))


def order(key, seed=42):
    return hashlib.md5(f"{key}|{seed}".encode()).hexdigest(), key


def test_split_takes_the_first_by_hash_also_in_a_hot_class(spark):
    df = labelled(spark, [9000, 30, 5])
    rows = features.stratified_split(df, test=0.25).collect()
    for k in range(3):
        mine = [r for r in rows if r["root_cause_label"] == f"RC-{k}"]
        ranked = sorted(mine, key=lambda r: order(r["log_id"]))
        flags = [r["is_test"] for r in ranked]
        assert flags == sorted(flags, reverse=True)


def test_bucket_digits_grow_with_the_data():
    assert [ranking.bucket_digits(n) for n in (0, 10 ** 5, 10 ** 7, 2 * 10 ** 11)] == [1, 1, 2, 6]


def test_hash_split_is_approximate(spark):
    share = features.stratified_split(labelled(spark, [4000, 1000]), test=0.3, mode="hash").agg(
        F.avg(F.col("is_test").cast("double"))).first()[0]
    assert 0.26 < share < 0.34


def test_hash_rank_equals_sorted_order(spark):
    df = labelled(spark, [3000, 10])
    # Told of more rows than there are, it cuts more buckets.
    ranked = ranking.hash_rank(df, "root_cause_label", "log_id", 7, "pos", n_rows=50_000_000).collect()
    for k in range(2):
        mine = sorted((r for r in ranked if r["root_cause_label"] == f"RC-{k}"), key=lambda r: order(r["log_id"], 7))
        assert [r["pos"] for r in mine] == list(range(1, len(mine) + 1))


def test_folds(spark):
    assert features.fold_count(120, 8, 5) == 5 and features.fold_count(40, 8, 5) == 2 and features.fold_count(10, 8, 5) == 2
    rows = features.stratified_folds(labelled(spark, [50, 31]), k=4).groupBy("root_cause_label", "fold").count().collect()
    sizes = {}
    for r in rows:
        sizes.setdefault(r["root_cause_label"], []).append(r["count"])
    assert sorted(sizes["RC-0"]) == [12, 12, 13, 13] and sorted(sizes["RC-1"]) == [7, 8, 8, 8]


def test_class_weights(spark):
    df = labelled(spark, [80, 5, 5, 5, 5])
    got = {r["label"]: r["weight"] for r in features.class_weights(df).collect()}
    assert got["RC-0"] == pytest.approx(100 / (5 * 80)) and got["RC-1"] == pytest.approx(4.0) and len(got) == 5
    total = features.with_class_weight(df).agg(F.sum("weight")).first()[0]
    assert total == pytest.approx(100)


def test_stop_word_argument_empty_vocabulary(spark):
    from causeway.operators import model
    from causeway.rules import RulePacks
    logs = spark.createDataFrame([("1", "the", "a", "INFO", "RC-01")],
                                 "log_id string, log_message string, service string, severity string, root_cause_label string")
    config = model.FeatureConfig(stop_words=["the", "other_error"])
    fitted, names = model.fit_features(logs, config, RulePacks())
    assert names == model.CATEGORICAL + model.TIME_FEATURES
    vector = model.assemble_features(logs, fitted).select(vector_to_array("features").alias("v")).first()["v"]
    assert len(vector) == 7
