import re

import pytest
from pyspark.sql import functions as F

from causeway.functions import evidence, regex, scalar, text
from causeway.rules import DEFAULT_PACKS, RulePacks, rules_table


def one(spark, schema, values, expr):
    return spark.createDataFrame([tuple(values)], schema).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("raw, clean", [
    ("ERROR: Timeout #42 at 10:30!", "error timeout at"),
    ("  a\tB\n c  ", "a b c"), ("123 !!", ""), ("", ""), (None, ""), ("naïve-Test", "na ve test")])
def test_normalize_text(spark, raw, clean):
    assert one(spark, "t string", [raw], text.normalize_text(F.col("t"))) == clean


@pytest.mark.parametrize("raw, name", [
    ("Request TIMEOUT after 3s", "timeout"), ("connection to host failed", "connection_failed"),
    ("authentication of bob failed", "authentication_failed"), ("permission was denied", "permission_denied"),
    ("resource 4 not yet found", "resource_not_found"), ("invalid parameter", "invalid_parameter"),
    ("rate over limit", "rate_limit"), ("memory error", "memory_error"), ("disk is full", "disk_full"),
    ("network error", "network_error"), ("all fine", "other_error"), ("connection timeout, failed", "timeout"),
    ("connection\nfailed", "other_error"), (None, "other_error")])
def test_classify_error(spark, raw, name):
    assert one(spark, "t string", [raw], text.classify_error(F.col("t"))) == name


def test_tags_in_rule_order_and_unknown_service(spark):
    tag = text.tag_service_keywords(F.col("s"), F.col("m"))
    assert one(spark, "s string, m string", ["db-pool", "POOL of database connections"], tag) == [
        "db-pool_database", "db-pool_connection", "db-pool_pool"]
    assert one(spark, "s string, m string", ["nobody", "pool"], tag) == []
    assert one(spark, "s string, m string", ["db-pool", None], tag) == []


def test_combined_message_keeps_double_blank_without_tags(spark):
    both = text.combined_message(F.col("s"), F.col("m"))
    assert one(spark, "s string, m string", ["x", "Disk full"], both) == "disk full  disk_full"
    assert one(spark, "s string, m string", ["db-pool", "slow query"], both) == "slow query db-pool_query other_error"


def test_tokens_match_unicode_words(spark):
    samples = ["kyc-service_identity 42 a", "Çédille übergröße x1 _y", "", "日本語 テスト ok", "don't stop-me"]
    for s in samples:
        expected = re.findall(r"\b\w\w+\b", s.lower())
        assert one(spark, "t string", [s], text.tokenize(F.col("t"))) == expected


def test_stop_words_go_before_bigrams(spark):
    df = spark.createDataFrame([(["disk", "is", "full", "now"],), ([],), (["one"],)], "t array<string>")
    kept = df.select(text.remove_stop_words(F.col("t"), ["is"]).alias("k")).select(text.ngrams(F.col("k")).alias("g"))
    assert [r["g"] for r in kept.collect()] == [["disk", "full", "now", "disk full", "full now"], [], ["one"]]


def test_time_features(spark):
    rows = [("2024-01-01T09:00:00Z", (9, 0, 0, 1)), ("2024-01-06 17:59:59", (17, 5, 1, 1)),
            ("2024-01-07T18:00:00", (18, 6, 1, 0)), ("nonsense", (0, 0, 0, 0)), (None, (0, 0, 0, 0))]
    df = spark.createDataFrame([(t,) for t, _ in rows], "t string")
    cols = scalar.time_features(F.col("t"))
    got = [tuple(r) for r in df.select(*[cols[k] for k in scalar.TIME_FEATURES]).collect()]
    assert got == [e for _, e in rows]


def test_severity_codes_and_echo(spark):
    df = spark.createDataFrame([("INFO",), ("WARNING",), ("ERROR",), ("CRITICAL",), ("High",), (None,)], "s string")
    assert [r[0] for r in df.select(scalar.encode_severity(F.col("s"))).collect()] == [0, 1, 2, 3, 0, 0]
    echo = scalar.echo_inputs(F.col("m"), F.col("s"), F.lit("X"), F.lit(None))
    assert one(spark, "m string, s string", [None, "svc"], echo).asDict() == {
        "log_message": "", "service": "svc", "severity": "X", "timestamp": ""}


def test_required_fragment_never_rejects_a_match(spark):
    patterns = [p for ps in DEFAULT_PACKS.mined_error_types.values() for p in ps]
    patterns += [p for p, _ in DEFAULT_PACKS.message_shapes]
    texts = [re.sub(r"\\\[|\\\]", "[", re.sub(r"\\d\{3\}|\\d\+", "123", p.replace(".*", " x "))).replace("?", "") for p in patterns]
    texts += [t.upper() for t in texts] + [t.replace(" x ", "\n") for t in texts] + ["nothing", "RATE ſlimit"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("l", F.lower("t"))
    hits = df.select("t", *[regex.search_ignore_case(F.col("t"), F.col("l"), p).alias(f"p{i}") for i, p in enumerate(patterns)])
    for row in hits.collect():
        for i, p in enumerate(patterns):
            assert row[f"p{i}"] == bool(re.search(p, row["t"], re.IGNORECASE)), (p, row["t"])


def test_most_patterns_have_a_fragment():
    patterns = [p for ps in DEFAULT_PACKS.mined_error_types.values() for p in ps]
    assert all(regex.required_fragment(p) for p in patterns)
    assert regex.required_fragment(r"insufficient.*permissions?") in "insufficient permission"
    assert regex.required_fragment(r"a|b") is None


def test_evidence_matches_and_groups(spark):
    m = "ERROR [box] 401 x Unauthorized client_9 took 20ms at 7.5% of 2GB, user_a IP: 10.0.0.1"
    assert one(spark, "m string", [m], evidence.label_evidence(F.lit("RC-01"), F.col("m"))) == ["401 x Unauthorized"]
    assert one(spark, "m string", [m], evidence.label_evidence(F.lit("RC-99"), F.col("m"))) == []
    found = one(spark, "m string", [m], evidence.general_evidence(F.col("m")))
    expected = []
    for kind, p in DEFAULT_PACKS.general_evidence:
        expected += [f"{kind}: {x}" for x in re.findall(p, m)]
    assert found == expected and "services: box" in found


def test_packs_round_trip_and_table(spark):
    assert RulePacks.from_json(DEFAULT_PACKS.to_json()) == DEFAULT_PACKS
    table = rules_table(spark, DEFAULT_PACKS)
    counts = {r["pack"]: r["count"] for r in table.groupBy("pack").count().collect()}
    assert counts == {"error_class": 10, "service_keyword": 40, "label_evidence": 40, "general_evidence": 10,
                      "mined_error_type": 37, "message_shape": 10, "technical_term": 66, "category_phrase": 56}
