"""Rule packs: the taxonomy every rule-driven operator takes as an input."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import advice, fixed_values as fv


@dataclass(frozen=True)
class Incident:
    title: str
    sentence: str
    severity: str
    impact: str
    time_to_resolution: str
    actions: list[str]


@dataclass(frozen=True)
class Category:
    name: str
    text: str
    phrases: list[str]
    error_types: list[str]
    issues: list[str]


def _default_incidents() -> dict[str, Incident]:
    return {
        label: Incident(title, sentence, severity, advice.IMPACT, ttr, list(advice.ACTIONS))
        for label, (title, sentence, severity, ttr) in fv.INCIDENTS.items()
    }


def _default_incident() -> Incident:
    title, sentence, severity, ttr = fv.INCIDENT_DEFAULT
    return Incident(title, sentence, severity, advice.IMPACT, ttr, list(advice.ACTIONS))


def _default_categories() -> dict[str, Category]:
    return {
        label: Category(name, advice.CATEGORY_TEXT, phrases, types, list(advice.ISSUES))
        for label, (name, phrases, types) in fv.CATEGORIES.items()
    }


@dataclass(frozen=True)
class RulePacks:
    """All rule packs. Replace single fields with ``dataclasses.replace``."""

    error_classes: list[tuple[str, str]] = field(default_factory=lambda: list(fv.ERROR_CLASSES))
    error_class_default: str = fv.ERROR_CLASS_DEFAULT
    service_keywords: dict[str, list[str]] = field(default_factory=lambda: dict(fv.SERVICE_KEYWORDS))
    severity_codes: dict[str, int] = field(default_factory=lambda: dict(fv.SEVERITY_CODES))
    label_evidence: dict[str, list[str]] = field(default_factory=lambda: dict(fv.LABEL_EVIDENCE))
    general_evidence: list[tuple[str, str]] = field(default_factory=lambda: list(fv.GENERAL_EVIDENCE))
    incidents: dict[str, Incident] = field(default_factory=_default_incidents)
    incident_default: Incident = field(default_factory=_default_incident)
    categories: dict[str, Category] = field(default_factory=_default_categories)
    mined_error_types: dict[str, list[str]] = field(default_factory=lambda: dict(fv.MINED_ERROR_TYPES))
    message_shapes: list[tuple[str, str]] = field(default_factory=lambda: list(fv.MESSAGE_SHAPES))
    technical_terms: list[str] = field(default_factory=lambda: list(fv.TECHNICAL_TERMS))

    @property
    def labels(self) -> list[str]:
        return sorted(self.categories)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "RulePacks":
        raw = json.loads(text)
        raw["incidents"] = {k: Incident(**v) for k, v in raw["incidents"].items()}
        raw["incident_default"] = Incident(**raw["incident_default"])
        raw["categories"] = {k: Category(**v) for k, v in raw["categories"].items()}
        for name in ("error_classes", "general_evidence", "message_shapes"):
            raw[name] = [tuple(v) for v in raw[name]]
        return RulePacks(**raw)


RULES_SCHEMA = T.StructType([
    T.StructField("pack", T.StringType(), False),
    T.StructField("key", T.StringType(), False),
    T.StructField("ord", T.IntegerType(), False),
    T.StructField("pattern", T.StringType(), False),
])


def rules_table(spark: SparkSession, packs: RulePacks) -> DataFrame:
    """The pattern packs as rows ``(pack, key, ord, pattern)``; a few hundred at most."""
    rows = [("error_class", name, i, p) for i, (p, name) in enumerate(packs.error_classes)]
    rows += [("message_shape", name, i, p) for i, (p, name) in enumerate(packs.message_shapes)]
    rows += [("general_evidence", kind, i, p) for i, (kind, p) in enumerate(packs.general_evidence)]
    rows += [("technical_term", t, i, t) for i, t in enumerate(packs.technical_terms)]
    for pack, groups in (("service_keyword", packs.service_keywords),
                         ("label_evidence", packs.label_evidence),
                         ("mined_error_type", packs.mined_error_types),
                         ("category_phrase", {k: c.phrases for k, c in packs.categories.items()})):
        rows += [(pack, key, i, p) for key, ps in groups.items() for i, p in enumerate(ps)]
    return spark.createDataFrame(rows, RULES_SCHEMA)


DEFAULT_PACKS = RulePacks()
