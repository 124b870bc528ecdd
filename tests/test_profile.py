import json

import pytest
from pyspark.sql import functions as F

from causeway.operators import profile
from causeway.sources import logs as log_io

LOG = "log_id string, timestamp string, service string, severity string, log_message string, root_cause_label string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([
        ("1", "2024-01-01T00:00:00Z", "a", "INFO", "x", "RC-01"), ("1", "2024-01-01T00:00:00Z", "a", "INFO", "x", "RC-01"),
        ("2", None, "a", None, "", "RC-01"), ("2", None, "a", None, None, "RC-02"),
        (None, None, None, None, None, None), (None, None, None, None, None, None)], LOG)


def test_shape_and_absent_columns(odd):
    got = rows_of(profile.profile_shape(odd.drop("service"), ["log_id", "service"]))
    assert ("total_rows", "", "6") in got and ("total_columns", "", "5") in got and ("missing_column", "service", "") in got


def test_missing_counts_only_columns_with_nulls(odd, sample):
    assert dict(rows_of(profile.profile_missing(odd))) == {
        "log_id": 2, "timestamp": 4, "service": 2, "severity": 4, "log_message": 3, "root_cause_label": 2}
    assert rows_of(profile.profile_missing(sample)) == []


def test_duplicates_treat_nulls_as_equal(odd, sample):
    assert dict(rows_of(profile.profile_duplicates(odd))) == {"total_duplicate_rows": 2, "duplicate_log_ids": 3}
    assert dict(rows_of(profile.profile_duplicates(sample))) == {"total_duplicate_rows": 0, "duplicate_log_ids": 0}


def test_row_digest_keeps_field_borders(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("", None), (None, ""), ("-", None)], "log_id string, x string")
    assert dict(rows_of(profile.profile_duplicates(df)))["total_duplicate_rows"] == 0


def test_value_counts_order_and_balance(odd):
    assert [tuple(r) for r in profile.value_counts(odd, "root_cause_label").collect()] == [("RC-01", 3), ("RC-02", 1)]
    got = {r["label"]: r for r in profile.class_balance(odd).collect()}
    assert got["RC-01"]["percent"] == 50.0 and got["RC-02"]["percent"] == 16.67
    assert (got["RC-01"]["unique_classes"], got["RC-01"]["min_samples"], got["RC-01"]["max_samples"]) == (2, 1, 3)


def test_summary_agrees_with_parts(odd, sample):
    got = profile.profile_summary(sample)
    dist = {(r["section"], r["name"]): r["value"] for r in got.collect()}
    assert dist[("distribution severity", "INFO")] == "8" and dist[("distribution service", "svc-0")] == "24"
    assert dist[("shape", "total_rows")] == "40" and dist[("duplicates", "duplicate_log_ids")] == "0"
    assert json.loads(dist[("sample", "L00")])["root_cause_label"] == "RC-01"
    sections = {r["section"] for r in profile.profile_summary(odd).collect()}
    assert "missing" in sections


def test_feature_profile(sample):
    row = profile.feature_profile(sample, 107).first()
    assert row["total_samples"] == 40 and row["unique_services"] == 2 and row["has_timestamp"] and row["total_features"] == 107


def test_validation(spark, odd, sample):
    assert profile.validate_for_scoring(sample) is sample
    with pytest.raises(profile.InvalidLogs, match="4 log messages"):
        profile.validate_for_scoring(odd)
    good, bad = profile.validate_for_scoring(odd, mode="split")
    assert (good.count(), bad.count()) == (2, 4)
    with pytest.raises(profile.InvalidLogs, match="absent columns"):
        profile.validate_for_scoring(sample.drop("service"))
    with pytest.raises(profile.InvalidLogs, match="must be a string"):
        profile.validate_for_scoring(sample.withColumn("log_message", F.lit(7)))


def test_csv_quotes_commas_and_blanks(spark, tmp_path):
    path = tmp_path / "logs.csv"
    path.write_text('log_id,timestamp,service,severity,log_message,root_cause_label\n'
                    '1, 2024-01-01T00:00:00Z, a,INFO,"one, ""two"" three",RC-01\n2,,b,"","x",\n')
    got = [tuple(r) for r in log_io.read_logs(spark, str(path)).collect()]
    assert got[0] == ("1", "2024-01-01T00:00:00Z", "a", "INFO", 'one, "two" three', "RC-01")
    assert got[1] == ("2", None, "b", None, "x", None)
    slashed = tmp_path / "slashed.csv"
    slashed.write_text('log_id,timestamp,service,severity,log_message,root_cause_label\n1,t,a,INFO,"say \\"hi\\"",RC-01\n')
    assert log_io.read_logs(spark, str(slashed), escape="\\").first()["log_message"] == 'say "hi"'


def test_missing_path_and_unknown_format(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        log_io.read_logs(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError):
        log_io.read_logs(spark, str(tmp_path), fmt="xls")


def test_sinks_round_trip(spark, sample, tmp_path):
    nested = sample.select("log_id", F.struct("service", F.array("severity").alias("s")).alias("n"))
    path = log_io.write_json_report(nested, str(tmp_path / "r"))
    assert rows_of(spark.read.schema(nested.schema).json(path)) == rows_of(nested)
    table = spark.createDataFrame([("b", 0.5), ("a", 1.0)], "label string, f1 double")
    out = log_io.write_per_class_csv(table, str(tmp_path / "c"))
    assert [r["label"] for r in spark.read.csv(out, header=True).collect()] == ["a", "b"]
