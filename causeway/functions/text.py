"""Text expressions: cleaning, error class, service tags, tokens, n-grams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import DEFAULT_PACKS, RulePacks
from ..rules.stop_words import ENGLISH
from .regex import java_pattern

# A token is a run of two or more letters, digits or underscores.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def string_array(values: list[str]) -> Column:
    """Array literal; empty lists keep the element type."""
    if not values:
        return F.array().cast("array<string>")
    return F.array(*[F.lit(v) for v in values])


def prefixed(values: Column, prefix: str) -> Column:
    return F.transform(values, lambda v: F.concat(F.lit(prefix), v))


def normalize_text(col: Column) -> Column:
    """Lower case, every run of other characters than a-z as one blank, trimmed; null is ''."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(col, F.lit(""))), "[^a-z]+", " "))


def classify_error(col: Column, packs: RulePacks = DEFAULT_PACKS) -> Column:
    """Name of the first error class whose pattern occurs in the lower-cased text."""
    lowered = F.lower(F.coalesce(col, F.lit("")))
    branches = F.when(F.lit(False), F.lit(None).cast("string"))
    for pattern, name in packs.error_classes:
        branches = branches.when(lowered.rlike(java_pattern(pattern)), F.lit(name))
    return branches.otherwise(F.lit(packs.error_class_default))


def tag_service_keywords(service: Column, col: Column, packs: RulePacks = DEFAULT_PACKS) -> Column:
    """``service_keyword`` for each keyword of the row's service found in the text, in rule order."""
    lowered = F.lower(F.coalesce(col, F.lit("")))
    branches = F.when(F.lit(False), string_array([]))
    for name, keywords in packs.service_keywords.items():
        found = F.filter(string_array(keywords), lambda k: F.contains(lowered, k))
        branches = branches.when(service == name, prefixed(found, f"{name}_"))
    return branches.otherwise(string_array([]))


def combine_text(clean: Column, tags: Column, error_class: Column) -> Column:
    """Cleaned message, tags and error class with single blanks between the three parts."""
    return F.concat(clean, F.lit(" "), F.array_join(tags, " "), F.lit(" "), error_class)


def combined_message(service: Column, col: Column, packs: RulePacks = DEFAULT_PACKS) -> Column:
    """The text the vocabulary is learned from."""
    return combine_text(normalize_text(col), tag_service_keywords(service, col, packs),
                        classify_error(col, packs))


def tokenize(col: Column) -> Column:
    """Lower-cased tokens in text order."""
    return F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(0))


def remove_stop_words(tokens: Column, words: list[str] | tuple[str, ...] | None = None) -> Column:
    """Tokens that are not stop words, in order."""
    listed = list(ENGLISH if words is None else words)
    return F.filter(tokens, lambda t: ~t.isin(listed)) if listed else tokens


def _runs(tokens: Column, n: int) -> Column:
    if n == 1:
        return tokens
    starts = F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - (n - 1), F.lit(0)))
    return F.transform(starts, lambda t, i: F.concat_ws(" ", t, *[F.get(tokens, i + k) for k in range(1, n)]))


def ngrams(tokens: Column, low: int = 1, high: int = 2) -> Column:
    """All runs of ``low`` to ``high`` neighbouring tokens, joined with a blank.

    Pass a column, not an expression: the tokens are looked up once per n-gram.
    """
    return F.concat(*[_runs(tokens, n) for n in range(low, high + 1)])
