from pyspark.sql import functions as F

from causeway.operators import model
from causeway.streaming import scoring


def test_stream_equals_batch_and_routes_bad_rows(spark, sample, tmp_path):
    trained = model.train(sample, model.ModelConfig(tune=False, forest_trees=5, forest_max_depth=6), model.FeatureConfig(max_features=40))
    rows = sample.drop("root_cause_label").withColumn(
        "log_message", F.when(F.col("log_id") == "L00", F.lit("")).otherwise(F.col("log_message")))
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = scoring.read_log_stream(spark, str(tmp_path / "in"), schema=rows.schema, max_files=1)
    assert stream.isStreaming
    for q in scoring.score_stream(stream, trained, str(tmp_path / "out"), str(tmp_path / "bad"),
                                  str(tmp_path / "check"), once=True):
        q.awaitTermination()
    columns = ["log_id", "prediction", "confidence", "top_n_predictions", "summary"]
    streamed = spark.read.parquet(str(tmp_path / "out")).select(columns).orderBy("log_id").collect()
    batch, bad = scoring.score_logs(rows, trained)
    assert streamed == batch.select(columns).orderBy("log_id").collect() and len(streamed) == 39
    assert [r["log_id"] for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["L00"] == [r["log_id"] for r in bad.collect()]


def test_absent_time_becomes_arrival_time(spark, sample):
    trained = model.train(sample, model.ModelConfig(tune=False, forest_trees=2, forest_max_depth=3), model.FeatureConfig(max_features=20))
    rows = sample.select("log_id", "log_message", "service", "severity").limit(2)
    live, _ = scoring.score_logs(rows, trained, arrival_time=True)
    assert all("Time: 2" in r["summary"]["summary"] for r in live.collect())
    batch, _ = scoring.score_logs(rows, trained)
    assert all("Time" not in r["summary"]["summary"] for r in batch.collect())
