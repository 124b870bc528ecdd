"""Pattern helpers.

Rule patterns follow the usual Unicode regex meaning: ``.`` stops only at a
newline, character classes and case folding are Unicode-aware. Java needs
inline flags for that.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def java_pattern(pattern: str, ignore_case: bool = False) -> str:
    """``pattern`` with the Java flags that give it its Unicode meaning."""
    flags = "d"
    if re.search(r"\\[wWdDsSbB]", pattern):
        flags += "U"
    if ignore_case:
        flags += "iu"
    return f"(?{flags}){pattern}"


def required_fragment(pattern: str) -> str | None:
    """A lower-case text that every case-insensitive match must contain, or None.

    Letters with extra Unicode case partners (i, k, s) are left out, so a
    ``contains`` on the lower-cased text never rejects a real match.
    """
    literal = re.sub(r"\\.", "\n", pattern)
    if re.search(r"[|()\[\]\\^$]", literal):
        return None
    literal = re.sub(r"(?s).(?:[?*]|\{\d*,?\d*\})", "\n", literal).replace(".", "\n").replace("+", "\n")
    runs = [r for r in re.split(r"[^a-hjl-rt-z0-9 -]+", literal.lower()) if len(r.strip()) >= 3]
    return max(runs, key=len) if runs else None


def search_ignore_case(text: Column, lowered: Column, pattern: str) -> Column:
    """Does ``pattern`` occur in ``text``, ignoring case?

    A byte-level ``contains`` runs first, so the regex engine only sees texts
    that can match.
    """
    hit = text.rlike(java_pattern(pattern, ignore_case=True))
    fragment = required_fragment(pattern)
    return lowered.contains(fragment) & hit if fragment else hit


def find_all(text: Column, pattern: str, ignore_case: bool = False) -> Column:
    """Every match of ``pattern``; the group, if the pattern has exactly one."""
    groups = re.compile(pattern).groups
    if groups > 1:
        raise ValueError(f"pattern has {groups} groups, at most one is supported: {pattern}")
    return F.regexp_extract_all(text, F.lit(java_pattern(pattern, ignore_case)), F.lit(groups))
