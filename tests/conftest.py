import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from causeway.session import build_session
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


LOG = "log_id string, timestamp string, service string, severity string, log_message string, root_cause_label string"


@pytest.fixture(scope="session")
def sample(spark):
    """Eight labels, five rows each, with repeated phrases and odd values."""
    texts = ["401 Unauthorized for user_7", "connection pool exhausted after 90ms", "upstream provider returned 502",
             "rate limit hit, Retry-After: 5s", "schema validation failed", "privilege escalation by user_1",
             "memory limit reached, 900MB", "packet loss 12%"]
    rows = []
    for k, text in enumerate(texts):
        for i in range(5):
            rows.append((f"L{k}{i}", "2024-03-0%dT1%d:00:00Z" % (i + 1, i), f"svc-{i % 2}", "ERROR" if i else "INFO",
                         f"ERROR [box] {text}", f"RC-0{k + 1}"))
    return spark.createDataFrame(rows, LOG).cache()
