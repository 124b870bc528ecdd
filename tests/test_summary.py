import dataclasses
import json

import pytest

from causeway.operators import summary
from causeway.rules import DEFAULT_PACKS

SCHEMA = "prediction string, confidence double, log_message string, service string, severity string, timestamp string"


def summarized(spark, *row):
    return summary.summarize(spark.createDataFrame([row], SCHEMA)).first()["summary"]


@pytest.mark.parametrize("label, message, match", [
    ("RC-01", "401 was Unauthorized", "401 was Unauthorized"), ("RC-02", "the Connection is exhausted", "Connection is exhausted"),
    ("RC-03", "upstream provider X returned 502", "upstream provider X returned"), ("RC-04", "Rate limit now hit", "Rate limit now hit"),
    ("RC-05", "constraint key violation", "constraint key violation"), ("RC-06", "Privilege escalation", "Privilege escalation"),
    ("RC-07", "memory hard limit reached", "memory hard limit reached"), ("RC-08", "Packet big loss", "Packet big loss")])
def test_evidence_of_each_label(spark, label, message, match):
    assert match in summarized(spark, label, 0.9, message, "s", "High", None)["key_evidence"]


def test_full_sentence(spark):
    s = summarized(spark, "RC-07", 0.61, "memory limit reached on box, 503 sent to user_88", "cache", "Low", "2023-02-28T23:59:59Z")
    title = DEFAULT_PACKS.incidents["RC-07"]
    assert s["summary"].startswith(title.sentence.split(" {")[0]) and s["summary"].endswith(
        " Context: Service: cache, Severity: Low, Time: 2023-02-28 23:59:59 UTC.")
    assert "error_codes: 503" in s["key_evidence"] and "entities: user_88" in s["key_evidence"]
    assert (s["root_cause"], s["confidence"], s["severity"]) == ("RC-07", 0.61, title.severity)
    assert s["recommended_actions"] == title.actions and s["time_to_resolution"] == title.time_to_resolution


@pytest.mark.parametrize("confidence, marked", [(0.0, True), (0.499, True), (0.5, False), (1.0, False)])
def test_low_confidence_is_marked(spark, confidence, marked):
    plain = DEFAULT_PACKS.incidents["RC-05"].severity
    got = summarized(spark, "RC-05", confidence, "m", "s", None, None)["severity"]
    assert got == (plain + " (Low confidence prediction)" if marked else plain)


def test_label_outside_the_pack_takes_the_default(spark):
    other, given = DEFAULT_PACKS.incident_default, summarized(spark, "disk-array", 0.9, "spindle 4", None, None, None)
    assert given["recommended_actions"] == other.actions and given["severity"] == other.severity
    assert given["impact"] == other.impact and given["root_cause"] == "disk-array"


def test_pack_texts_are_an_input(spark):
    own = dataclasses.replace(DEFAULT_PACKS.incidents["RC-02"], actions=["call the night shift"], impact="till closed")
    packs = dataclasses.replace(DEFAULT_PACKS, incidents={"RC-02": own})
    row = spark.createDataFrame([("RC-02", 0.9, "x", "s", None, None)], SCHEMA)
    s = summary.summarize(row, packs=packs).first()["summary"]
    assert s["recommended_actions"] == ["call the night shift"] and s["impact"] == "till closed"


def test_context_skips_what_is_not_given(spark):
    assert summarized(spark, "RC-02", 0.9, "x" * 60, "", None, None)["summary"].endswith("Log excerpt: " + "x" * 50 + "...")
    assert summarized(spark, "RC-02", 0.9, "x", None, "High", "yesterday")["summary"].endswith(
        " Context: Severity: High, Timestamp: yesterday.")


def test_evidence_is_distinct_and_limited(spark):
    s = summarized(spark, "RC-04", 0.9, "429 429 500 501 502 503 504", "s", "High", None)
    assert s["key_evidence"] == [f"error_codes: {c}" for c in (429, 500, 501, 502, 503)]


def test_top_n_and_hard_scores(spark):
    df = spark.createDataFrame([([0.2, 0.5, 0.2, 0.1], "b")], "probability array<double>, prediction string")
    labels = ["a", "b", "c", "d"]
    top = summary.top_n_labels(df, labels, 3).first()["top_n_predictions"]
    assert [(p["root_cause"], p["confidence"]) for p in top] == [("b", 0.5), ("a", 0.2), ("c", 0.2)]
    assert len(summary.top_n_labels(df, labels, 9).first()["top_n_predictions"]) == 4
    assert summary.hard_scores(df, labels).first()["probability"] == [0.0, 1.0, 0.0, 0.0]


def test_json_record(spark):
    df = spark.createDataFrame([("RC-01", 0.8, "401 \"x\"", "s", "High", None, [0.8, 0.2])], SCHEMA + ", probability array<double>")
    df = summary.top_n_labels(df, ["RC-01", "RC-02"], 2)
    plain = json.loads(summary.prediction_json(df).first()["json"])
    assert "summary" not in plain and plain["features_used"]["timestamp"] == ""
    full = json.loads(summary.prediction_json(summary.summarize(df)).first()["json"])
    assert full["top_n_predictions"][1] == {"root_cause": "RC-02", "confidence": 0.2}
    assert full["features_used"]["log_message"] == '401 "x"' and len(full["summary"]) == 8
