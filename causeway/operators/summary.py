"""Incident summaries and prediction records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import evidence as ev
from ..functions.scalar import echo_inputs, parse_time
from ..functions.text import string_array
from ..rules import DEFAULT_PACKS, RulePacks
from ..rules.fixed_values import EVIDENCE_IN_SENTENCE, EVIDENCE_KEPT, EXCERPT_CHARS, LOW_CONFIDENCE

_TEMPLATE = "label string, title string, sentence string, severity string, impact string, ttr string, " \
            "actions array<string>"


def template_lookup(df: DataFrame, label: str = "prediction", packs: RulePacks = DEFAULT_PACKS) -> DataFrame:
    """Add ``incident``: the attributes of the label, or the default ones with the label in the title.

    The lookup table has one row per label of the pack.
    """
    rows = [(k, i.title, i.sentence, i.severity, i.impact, i.time_to_resolution, list(i.actions))
            for k, i in packs.incidents.items()]
    table = df.sparkSession.createDataFrame(rows, _TEMPLATE).select(
        F.col("label").alias("_label"), F.struct("title", "sentence", "severity", "impact", "ttr", "actions").alias("_found"))
    d = packs.incident_default
    title = F.replace(F.lit(d.title), F.lit("{label}"), F.coalesce(F.col(label), F.lit("")))
    other = F.struct(title.alias("title"), F.lit(d.sentence).alias("sentence"), F.lit(d.severity).alias("severity"),
                     F.lit(d.impact).alias("impact"), F.lit(d.time_to_resolution).alias("ttr"),
                     string_array(list(d.actions)).alias("actions"))
    return (df.join(F.broadcast(table), F.col(label) == F.col("_label"), "left")
            .withColumn("incident", F.coalesce("_found", other)).drop("_label", "_found"))


def add_evidence(df: DataFrame, label: str = "prediction", message: str = "log_message",
                 packs: RulePacks = DEFAULT_PACKS, out: str = "evidence") -> DataFrame:
    """Add the evidence list; the matches are computed once per row."""
    text = F.coalesce(F.col(message), F.lit(""))
    excerpt = F.concat(F.lit("Log excerpt: "), F.substring(text, 1, EXCERPT_CHARS), F.lit("..."))
    found = F.concat(ev.label_evidence(F.col(label), F.col(message), packs), ev.general_evidence(F.col(message), packs))
    return (df.withColumn("_found", F.slice(F.array_distinct(found), 1, EVIDENCE_KEPT))
            .withColumn(out, F.when(F.size("_found") == 0, F.array(excerpt)).otherwise(F.col("_found")))
            .drop("_found"))


def summary_severity(severity: Column, confidence: Column) -> Column:
    """The severity, marked when the confidence is below one half."""
    return F.when(confidence < LOW_CONFIDENCE, F.concat(severity, F.lit(" (Low confidence prediction)"))).otherwise(severity)


def _context(service: Column, severity: Column, timestamp: Column) -> Column:
    """`` Context: …`` from the parts that are given, or an empty text."""
    def given(value: Column, text: Column) -> Column:
        return F.when(value != "", text)

    when = parse_time(timestamp)
    parts = F.array_compact(F.array(
        given(service, F.concat(F.lit("Service: "), service)),
        given(severity, F.concat(F.lit("Severity: "), severity)),
        given(timestamp, F.coalesce(F.date_format(when, "'Time: 'yyyy-MM-dd HH:mm:ss' UTC'"),
                                    F.concat(F.lit("Timestamp: "), timestamp)))))
    return F.when(F.size(parts) > 0, F.concat(F.lit(" Context: "), F.array_join(parts, ", "), F.lit("."))).otherwise("")


def summarize(df: DataFrame, label: str = "prediction", confidence: str = "confidence",
              message: str = "log_message", service: str = "service", severity: str = "severity",
              timestamp: str = "timestamp", packs: RulePacks = DEFAULT_PACKS) -> DataFrame:
    """Add ``summary``: a struct of eight fields per row. No shuffle; one fixed-size lookup."""
    staged = template_lookup(add_evidence(df, label, message, packs, "_evidence"), label, packs)
    proof = F.concat(F.lit("Evidence includes: "), F.array_join(F.slice("_evidence", 1, EVIDENCE_IN_SENTENCE), "; "))
    sentence = F.concat(F.replace(F.col("incident.sentence"), F.lit("{evidence}"), proof),
                        _context(F.col(service), F.col(severity), F.col(timestamp)))
    return staged.withColumn("summary", F.struct(
        F.col(label).alias("root_cause"), F.col(confidence).alias("confidence"), sentence.alias("summary"),
        F.col("_evidence").alias("key_evidence"), F.col("incident.actions").alias("recommended_actions"),
        summary_severity(F.col("incident.severity"), F.col(confidence)).alias("severity"),
        F.col("incident.impact").alias("impact"), F.col("incident.ttr").alias("time_to_resolution"),
    )).drop("_evidence", "incident")


def top_n_labels(df: DataFrame, labels: list[str], n: int = 3, probability: str = "probability",
                 out: str = "top_n_predictions") -> DataFrame:
    """Add the ``n`` most probable labels with their probability, best first, ties by label."""
    pairs = F.array(*[F.struct((-F.get(F.col(probability), F.lit(i))).alias("minus"), F.lit(k).alias("label"))
                      for i, k in enumerate(labels)])
    best = F.slice(F.sort_array(pairs), 1, n)
    return df.withColumn(out, F.transform(best, lambda p: F.struct(
        p["label"].alias("root_cause"), (-p["minus"]).alias("confidence"))))


def hard_scores(df: DataFrame, labels: list[str], prediction: str = "prediction",
                out: str = "probability") -> DataFrame:
    """Add scores for a model without probabilities: 1 on the predicted label, 0 elsewhere."""
    return df.withColumn(out, F.array(*[
        F.coalesce((F.col(prediction) == k).cast("double"), F.lit(0.0)) for k in labels]))


def prediction_json(df: DataFrame, label: str = "prediction", confidence: str = "confidence",
                    message: str = "log_message", service: str = "service", severity: str = "severity",
                    timestamp: str = "timestamp", out: str = "json") -> DataFrame:
    """Add one JSON text per row: prediction, alternatives, inputs and, if present, the summary."""
    fields = [F.col(label).alias("root_cause"), F.col(confidence).alias("confidence"), F.col("top_n_predictions"),
              echo_inputs(F.col(message), F.col(service), F.col(severity), F.col(timestamp)).alias("features_used")]
    if "summary" in df.columns:
        fields.append(F.col("summary"))
    return df.withColumn(out, F.to_json(F.struct(*fields)))
