import dataclasses
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from causeway.operators import mining
from causeway.plans import reports
from causeway.rules import DEFAULT_PACKS

SCHEMA = "log_id string, log_message string, service string, severity string, root_cause_label string"


@pytest.fixture(scope="module")
def logs(spark):
    texts = ["ERROR [a] 401 returned, bearer token missing", "ERROR [b] timeout after 30 ms", "error: null value",
             "CRITICAL [c] Memory LIMIT reached", "WARN [d] rate limit hit, retry-after 3", "fine",
             "wait time exceeded; timeout after all", "TLS handshake timeout on DNS resolution"]
    rows = [(f"{i:03d}", texts[(i * 7 + i // 8) % 8], f"s{i % 3}", "High" if i % 4 else "Low", f"RC-0{i % 3 + 1}")
            for i in range(60)]
    rows.append(("900", "ERROR [x] failed", "s0", "Low", "OTHER"))
    return spark.createDataFrame(rows, SCHEMA).cache()


def by_label(logs):
    out = {}
    for r in logs.filter("root_cause_label <> 'OTHER'").orderBy("log_id").collect():
        out.setdefault(r["root_cause_label"], []).append(r)
    return out


def test_shapes_against_brute_force(logs):
    expected = set()
    for label, rows in by_label(logs).items():
        for p, name in DEFAULT_PACKS.message_shapes:
            n = sum(bool(re.search(p, r["log_message"], re.I)) for r in rows)
            if n > len(rows) * 0.3:
                expected.add((label, name, n))
    got = {(r["label"], r["shape"], r["n"]) for r in mining.message_shapes(logs).collect()}
    assert got == expected and got


@pytest.mark.parametrize("fold", [False, True])
def test_phrases_against_brute_force(logs, fold):
    expected = set()
    for label, rows in by_label(logs).items():
        for term in DEFAULT_PACKS.technical_terms:
            t = term.lower() if fold else term
            n = sum(t in r["log_message"].lower() for r in rows)
            if n >= max(1, len(rows) * 0.2):
                expected.add((label, term, n))
    got = {(r["label"], r["phrase"], r["n"]) for r in mining.key_phrases(logs, fold_terms=fold).collect()}
    assert got == expected and any(t == "DNS" for _, t, _ in got) == fold


def test_error_types_count_each_pattern(logs):
    expected = set()
    for label, rows in by_label(logs).items():
        for name, ps in DEFAULT_PACKS.mined_error_types.items():
            n = sum(bool(re.search(p, r["log_message"], re.I)) for r in rows for p in ps)
            if n and n >= len(rows) * 0.3:
                expected.add((label, name, n))
    assert {(r["label"], r["error_type"], r["n"]) for r in mining.mined_error_types(logs).collect()} == expected


def test_many_terms_take_several_passes(logs):
    packs = dataclasses.replace(DEFAULT_PACKS, technical_terms=[f"t{i}" for i in range(200)] + ["timeout"])
    got = {r["label"]: r["n"] for r in mining.key_phrases(logs, packs).collect()}
    counts = {k: sum("timeout" in r["log_message"].lower() for r in rows) for k, rows in by_label(logs).items()}
    assert got == {k: n for k, n in counts.items() if n >= len(by_label(logs)[k]) * 0.2} and got


def test_profile(logs):
    got = {r["label"]: r for r in mining.category_profile(logs).collect()}
    assert sorted(got) == ["RC-01", "RC-02", "RC-03"]
    for label, rows in by_label(logs).items():
        r = got[label]
        assert r["service_distribution"] == dict(Counter(x["service"] for x in rows))
        assert r["severity_distribution"] == dict(Counter(x["severity"] for x in rows))
        assert r["example_logs"] == [x["log_message"] for x in rows[:3]]
        assert r["category_description"].startswith(DEFAULT_PACKS.categories[label].name + ". ")
        assert f"contains {len(rows)} log entries across" in r["category_description"]
        assert r["typical_system_issues"] == DEFAULT_PACKS.categories[label].issues
    phrases = [(r["phrase"], r["n"]) for r in mining.key_phrases(logs).filter("label = 'RC-01'").collect()]
    assert got["RC-01"]["key_phrases"] == [p for p, _ in sorted(phrases, key=lambda x: (-x[1], x[0]))]


def test_labels_without_hits_and_empty_input(spark, logs):
    quiet = spark.createDataFrame([("1", "fine", "s", "x", "RC-02"), ("2", "fine", None, None, "RC-04")], SCHEMA)
    got = {r["label"]: r for r in mining.category_profile(quiet).collect()}
    assert sorted(got) == ["RC-02", "RC-04"] and got["RC-02"]["key_phrases"] == []
    assert "various service with mixed severity" in got["RC-04"]["category_description"]
    assert mining.category_profile(logs.limit(0)).count() == 0


def test_overlap_distinctive_similarity(spark):
    rows = spark.createDataFrame([("RC-01", "a"), ("RC-01", "b"), ("RC-02", "b"), ("RC-02", "c"), ("RC-03", "z")],
                                 "label string, phrase string")
    labels = spark.createDataFrame([("RC-04",)], "label string")
    assert [tuple(r) for r in mining.phrase_overlap(rows).collect()] == [("RC-01-RC-02", ["b"])]
    assert {r["label"]: r["phrases"] for r in mining.distinctive_phrases(rows).collect()} == {
        "RC-01": ["a"], "RC-02": ["c"], "RC-03": ["z"]}
    sim = {(r["label_a"], r["label_b"]): r["similarity"] for r in mining.category_similarity(rows, labels).collect()}
    assert len(sim) == 16 and sim[("RC-01", "RC-02")] == 0.333 and sim[("RC-01", "RC-01")] == 1.0
    assert sim[("RC-04", "RC-04")] == 0.0 and sim[("RC-04", "RC-01")] == 0.0
    pairs = mining.similar_pairs(mining.category_similarity(rows), 0.3).collect()
    assert {(r["label_a"], r["label_b"]) for r in pairs} == {("RC-01", "RC-02"), ("RC-02", "RC-01")}


def test_score_categories(spark):
    df = spark.createDataFrame([("HMAC SIGNATURE, api key, 401",), ("nothing",), (None,)], "log_message string")
    rows = mining.top_categories(mining.score_categories(df)).collect()
    assert rows[0]["category_scores"]["RC-01"] == 0.375 and rows[0]["category_scores"]["RC-02"] == 0.0
    assert [t["label"] for t in rows[0]["top_categories"]] == ["RC-01"]
    assert rows[1]["top_categories"] == [] and len(rows[2]["category_scores"]) == 8


def test_texts_and_report(spark, logs, tmp_path):
    texts = {r["label"]: r["text"] for r in mining.category_texts(spark).collect()}
    assert texts["RC-07"].startswith("Resource Exhaustion: ") and len(texts) == 8
    report = reports.category_report(logs, path=str(tmp_path / "report"))
    rows = {(r["section"], r["label"], r["other"]): r["value"] for r in report.collect()}
    assert rows[("total_categories", "", "")] == "3"
    n = mining.key_phrases(logs).select("phrase").distinct().count()
    assert rows[("total_unique_key_phrases", "", "")] == str(n)
    assert spark.read.json(str(tmp_path / "report")).count() == len(rows)


def test_rule_scans_shuffle_partial_sums_only(logs):
    plan = mining.key_phrases(logs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan
