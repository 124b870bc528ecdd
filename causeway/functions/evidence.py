"""Evidence expressions: what in a message supports a root cause."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import DEFAULT_PACKS, RulePacks
from .regex import find_all
from .text import prefixed, string_array


def label_evidence(label: Column, message: Column, packs: RulePacks = DEFAULT_PACKS) -> Column:
    """All case-insensitive matches of the label's patterns, in rule order.

    A ``CASE`` on the label: a row only pays for the patterns of its own label.
    """
    text = F.coalesce(message, F.lit(""))
    branches = F.when(F.lit(False), string_array([]))
    for name, patterns in packs.label_evidence.items():
        branches = branches.when(
            label == name, F.concat(*[find_all(text, p, ignore_case=True) for p in patterns]))
    return branches.otherwise(string_array([]))


def general_evidence(message: Column, packs: RulePacks = DEFAULT_PACKS) -> Column:
    """Case-sensitive matches that apply to any label, as ``kind: match``."""
    text = F.coalesce(message, F.lit(""))
    parts = [prefixed(find_all(text, p), f"{kind}: ") for kind, p in packs.general_evidence]
    return F.concat(*parts) if parts else string_array([])

