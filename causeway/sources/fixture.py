"""Log and prediction tables derived from the ``events`` table.

The test tables hold no log text, so messages are filled into templates by
event id. Every row of ``events`` becomes one log row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import computed_once
from ..functions.text import string_array
from ..operators.mining import category_scores
from ..operators.profile import scorable
from ..rules import DEFAULT_PACKS, RulePacks
SERVICES = ["kyc-service", "ml-inference", "oauth-handler", "data-export", "ingestion-service",
            "data-pipeline", "reporting-api", "transaction-validator", "db-pool", "payments-core",
            "cart-ui", "mail-relay"]
SEVERITIES = {"error": "CRITICAL", "purchase": "ERROR", "signup": "WARNING", "click": "INFO"}
SEVERITY_OTHER = "High"

# Three variants for each of the eight label groups; {u} user, {n} number, {e} event id.
TEMPLATES = [
    ["ERROR [login] 401 Unauthorized for user_{u}", "WARN [login] authentication of user_{u} failed",
     "ERROR [login] bearer token missing, client_{u}"],
    ["ERROR [store] connection pool exhausted after {n}ms", "WARN [store] slow query took {n}ms",
     "CRITICAL [store] database unreachable"],
    ["ERROR [proxy] upstream provider returned 502", "WARN [proxy] external service answered 503",
     "ERROR [proxy] dependency failure, failing over"],
    ["WARN [edge] rate limit hit, Retry-After: {n}s", "WARN [edge] 429 Too Many Requests from client_{u}",
     "ERROR [edge] quota exceeded for client_{u}"],
    ["ERROR [intake] schema validation failed, record {e}", "WARN [intake] null value in required field",
     "ERROR [intake] constraint violation, record {e}"],
    ["CRITICAL [audit] privilege escalation by user_{u}", "WARN [audit] scope mismatch for client_{u}",
     "ERROR [audit] insufficient role, user_{u}"],
    ["CRITICAL [node] memory limit reached, {n}MB", "ERROR [node] disk full at {n}%",
     "ERROR [node] file descriptor limit reached"],
    ["CRITICAL [net] packet loss {n}%", "ERROR [net] TLS handshake timeout after {n}ms",
     "WARN [net] DNS resolution failed"],
]


def _fill(template: str, slots: dict[str, Column]) -> Column:
    parts, rest = [], template
    while rest:
        at = min((rest.find(s) for s in slots if s in rest), default=-1)
        if at < 0:
            parts.append(F.lit(rest))
            break
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(slots[rest[at:at + 3]].cast("string"))
        rest = rest[at + 3:]
    return F.concat(*parts)


def logs_from_events(events: DataFrame) -> DataFrame:
    """The log table; some times and messages are unusable and some labels wrong, on purpose."""
    e, u = F.col("event_id"), F.col("user_id")
    n = F.floor("value").cast("bigint")
    group, variant = F.pmod(e, F.lit(8)), F.pmod(F.floor(e / 8).cast("bigint"), F.lit(3))
    slots = {"{u}": u, "{n}": n, "{e}": e}
    message = F.when(e % 103 == 0, F.lit(None).cast("string")).when(e % 101 == 0, F.lit(""))
    for k, variants in enumerate(TEMPLATES):
        for v, template in enumerate(variants):
            message = message.when((group == k) & (variant == v), _fill(template, slots))
    service = F.when(F.lit(False), F.lit(""))
    for i, name in enumerate(SERVICES):
        service = service.when(u % 12 == i, F.lit(name))
    severity = F.when(F.lit(False), F.lit(""))
    for kind, name in SEVERITIES.items():
        severity = severity.when(F.col("event_type") == kind, F.lit(name))
    code = F.when(e % 13 == 0, (group + 2) % 8 + 1).otherwise(group + 1)
    return events.select(
        F.concat(F.lit("LOG-"), F.lpad(e.cast("string"), F.greatest(F.lit(8), F.length(e.cast("string"))), F.lit("0"))).alias("log_id"),
        F.when(e % 97 == 0, F.lit("not-a-date")).otherwise(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("timestamp"),
        service.alias("service"),
        severity.otherwise(F.lit(SEVERITY_OTHER)).alias("severity"),
        message.alias("log_message"),
        F.concat(F.lit("RC-0"), code.cast("string")).alias("root_cause_label"))


def dealt(df: DataFrame) -> DataFrame:
    """The rows of a test table over all cores: those tables are single files of one split."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def read_fixture_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs_from_events(dealt(spark.read.parquet(f"{sf_dir}/events.parquet")))


def preds_from_logs(logs: DataFrame, packs: RulePacks = DEFAULT_PACKS) -> DataFrame:
    """Predictions without a trained model: the category whose phrases fit best.

    ``probability`` holds the category scores scaled to sum 1 (all equal when
    no phrase is found), in label order.
    """
    labels = packs.labels
    lowered = logs.filter(scorable()).withColumn("lowered", F.lower("log_message"))
    scores = category_scores(F.col("lowered"), packs)
    scored = computed_once(lowered, scores=F.array(*[scores[k] for k in labels])).withColumn(
        "total", F.aggregate("scores", F.lit(0.0), lambda total, s: total + s))
    equal = 1.0 / len(labels)
    scored = scored.withColumn("probability", F.transform(
        "scores", lambda s: F.when(F.col("total") == 0, F.lit(equal)).otherwise(F.try_divide(s, F.col("total")))))
    position = F.array_position("probability", F.array_max("probability")).cast("int")
    picked = computed_once(scored, confidence=F.array_max("probability"),
                           prediction=F.element_at(string_array(labels), position))
    return picked.select("log_id", "timestamp", "service", "severity", "log_message",
                         F.col("root_cause_label").alias("label"), "prediction", "probability", "confidence")
