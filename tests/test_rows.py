"""No row is lost: labels that are null, messages with line breaks, columns in another order."""

import pytest
from pyspark.sql import functions as F

from causeway.functions import scalar
from causeway.operators import features
from causeway.sources import logs


@pytest.fixture(scope="module")
def partly_labelled(spark):
    rows = [(f"K{i:03d}", None if i % 5 == 0 else f"c{i % 3}") for i in range(150)]
    return spark.createDataFrame(rows, "log_id string, root_cause_label string")


def test_split_keeps_rows_without_a_label(partly_labelled):
    rows = features.stratified_split(partly_labelled, test=0.2).collect()
    assert len(rows) == 150 and len({r["log_id"] for r in rows}) == 150
    assert sum(r["is_test"] for r in rows) == 30
    assert sum(r["is_test"] for r in rows if r["root_cause_label"] is None) == 6


def test_folds_keep_rows_without_a_label(partly_labelled):
    rows = features.stratified_folds(partly_labelled, k=3).collect()
    assert len(rows) == 150 and {r["fold"] for r in rows if r["root_cause_label"] is None} == {0, 1, 2}


def test_weights_keep_rows_without_a_label(partly_labelled):
    rows = features.with_class_weight(partly_labelled).collect()
    assert len(rows) == 150 and sum(r["weight"] is None for r in rows) == 30
    assert sum(r["weight"] or 0 for r in rows) == pytest.approx(120)


def test_csv_by_name_and_with_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('log_message,extra,log_id\n"first\nsecond ""quoted""",1,L1\nplain,2,L2\n')
    rows = logs.read_logs(spark, str(tmp_path / "a.csv")).orderBy("log_id").collect()
    assert [(r["log_id"], r["log_message"], r["root_cause_label"]) for r in rows] == [
        ("L1", 'first\nsecond "quoted"', None), ("L2", "plain", None)]
    assert rows[0].asDict().keys() == {f.name for f in logs.LOG_SCHEMA}
    with pytest.raises(ValueError, match="multi_line"):
        logs.read_logs(spark, str(tmp_path / "a.csv"), multi_line=False)
    (tmp_path / "b.csv").write_text("log_id,log_message\nL1,one\n")
    assert logs.read_logs(spark, str(tmp_path / "b.csv"), multi_line=False).count() == 1


@pytest.mark.parametrize("text, parsed", [
    ("2024/01/05 10:00", "2024-01-05 10:00:00"), ("Jan 5, 2024 10:00", "2024-01-05 10:00:00"),
    ("2024-01-05 10:00:00,123", "2024-01-05 10:00:00"), ("01/05/2024 10:00:00", "2024-01-05 10:00:00"),
    ("2024-01-05T10:00:00Z", "2024-01-05 10:00:00"), ("T12:30", None), ("12:30", None), ("", None), (None, None)])
def test_time_formats(spark, text, parsed):
    df = spark.createDataFrame([(text,)], "t string").select(
        F.date_format(scalar.parse_time(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("p"))
    assert df.first()["p"] == parsed
