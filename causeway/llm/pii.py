"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust their score.

A proposal starts with the prior of its kind. A validator (Luhn, mod-97, number
ranges, the calendar) confirms or rejects it; words of its kind near it raise
the score and words of other kinds of numbers (order, version, ...) lower it.
Base findings (mail and network addresses, payment cards, international phone
numbers) are reported whatever their score; the other kinds from ``THRESHOLD``.

All patterns start at a character that is rare in prose and are matched in time
linear in the text, so one long run of digits or letters costs no more than prose.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from datetime import date

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_key

KINDS = ("email", "ip", "card", "phone", "iban", "embedded_card", "short_card", "social_security", "local_phone",
         "birth_date")
N_BASE = 4
# Before validators and context: (prior, rise by a confirming validator).
SCORES = {"email": (0.8, 0.1), "ip": (0.4, 0.2), "card": (0.3, 0.4), "phone": (0.5, 0.2), "iban": (0.1, 0.8),
          "embedded_card": (0.1, 0.45), "short_card": (0.1, 0.3), "social_security": (0.2, 0.25), "local_phone": (0.1, 0.1),
          "birth_date": (0.0, 0.1)}
THRESHOLD = 0.5
RISE, FALL = 0.4, 0.3
# Code points before and after a span that are searched for context words.
BEFORE, AFTER = 48, 24

# IBAN lengths by country.
IBAN_LENGTHS = dict(
    AD=24, AE=23, AL=28, AT=20, AZ=28, BA=20, BE=16, BG=22, BH=22, BR=29, BY=28, CH=21, CR=22, CY=28, CZ=24, DE=22, DK=18,
    DO=28, EE=20, EG=29, ES=24, FI=18, FO=18, FR=27, GB=22, GE=22, GI=23, GL=18, GR=27, GT=28, HR=21, HU=28, IE=22, IL=23,
    IQ=23, IS=26, IT=27, JO=30, KW=30, KZ=20, LB=28, LC=32, LI=21, LT=20, LU=20, LV=21, MC=27, MD=24, ME=22, MK=19, MR=27,
    MT=31, MU=30, NL=18, NO=15, PK=24, PL=28, PS=29, PT=25, QA=29, RO=24, RS=22, SA=24, SC=31, SE=24, SI=19, SK=24, SM=27,
    ST=25, SV=28, TL=23, TN=24, TR=26, UA=29, VA=22, VG=24, XK=20)
# Words near a kind, in the languages of the corpus.
CONTEXT = {kind: re.compile(rf"(?i)(?<![^\W_])(?:{words})(?![^\W\d_])") for kind, words in {
    "email": "e-?mail|mail|contact|correo|courriel|kontakt",
    "ip": "ip|address|host|server|login|adresse|direcci[oó]n",
    "card": "card|credit|debit|visa|mastercard|amex|pan|karte|kreditkarte|carte|tarjeta|cvv|cvc",
    "phone": "phone|telephone|tel|call|mobile|cell|fax|telefon|handy|t[eé]l[eé]phone|tel[eé]fono|m[oó]vil|portable",
    "iban": "iban|account|bank|konto|compte|cuenta|bic|swift",
    "social_security": "ssn|social security|social|taxpayer|tin",
    "birth_date": "born|birth|birthday|dob|birthdate|geboren|geburtsdatum|n[eé]e?|naissance|nacid[oa]|nacimiento"}.items()}
CONTEXT |= {"embedded_card": CONTEXT["card"], "short_card": CONTEXT["card"], "local_phone": CONTEXT["phone"]}
AGAINST = re.compile(r"(?i)(?<![^\W_])(?:order|invoice|version|isbn|serial|sku|part|chapter|page|figure|revision|"
                     r"bestellung|rechnung|commande|facture|pedido|factura)(?![^\W\d_])")

# The base patterns. Mail addresses are looked for from "@" and network addresses from their first dot,
# which gives the same leftmost matches in linear time.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOTTED = re.compile(r"\.[0-9]++\.[0-9]++\.[0-9]++")
DIGITS = "0123456789"
# Runs of 13 digits or more; the base wants 16 to 19. Shorter runs hold no longer one.
DIGIT_RUN = re.compile(r"[0-9](?:[ -]?[0-9]){12,}")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# The other proposals. Digit groups of printed card numbers.
CARD_GROUPS = (4, 4, 4, 4), (4, 6, 5)
IBAN_HEAD = re.compile(r"[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
SOCIAL = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
SOCIAL_HINT = re.compile(r"[0-9]-[0-9]{2}-[0-9]")
DATE = re.compile(r"(?<![0-9./-])(?:([0-9]{4})([./-])([0-9]{1,2})\2([0-9]{1,2})|([0-9]{1,2})([./-])([0-9]{1,2})\6([0-9]{4}))(?![0-9])")
DATE_HINT = re.compile(r"[0-9][./-][0-9]{1,2}[./-][0-9]")
PHONE_RUN = re.compile(r"[0-9][0-9()./ -]{5,}[0-9]")
LOCAL_PHONE = re.compile(r"(?<![0-9+./-])\(?[0-9]{2,5}\)?(?:[ ./-]?[0-9]{2,5}){1,4}(?![0-9])")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The account check of ISO 13616: the number with its head at the end leaves 1."""
    rest = 0
    for c in iban[4:] + iban[:4]:
        n = int(c, 36)
        rest = (rest * (100 if n > 9 else 10) + n) % 97
    return rest == 1


def small(number: str) -> bool:
    """Is a run of digits at most 255? It may be very long."""
    number = number.lstrip("0")
    return len(number) < 3 or len(number) == 3 and number <= "255"


def plain(run: str) -> str:
    return run.replace(" ", "").replace("-", "")


def emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    at = text.find("@")
    while at >= 0:
        head = text[end:at]
        n = len(head) - len(head.rstrip(LOCAL))
        m = DOMAIN.match(text, at) if n else None
        if m:
            yield at - n, m.end()
        end = m.end() if m else at + 1
        at = text.find("@", end)


def addresses(text: str) -> Iterator[tuple[int, int, bool]]:
    """Four dotted numbers: (start, end, parts are at most 255)."""
    end = at = 0
    while m := DOTTED.search(text, at):
        start = m.start()
        while start > end and text[start - 1] in DIGITS:
            start -= 1
        if start == m.start():
            at = m.start() + 1
            continue
        end = at = m.end()
        yield start, end, all(map(small, text[start:end].split(".")))


def embedded(run: str, start: int) -> Iterator[tuple[int, int]]:
    """Card numbers in a run that is none itself: one group of 13 to 19 digits, or groups as printed on cards."""
    groups = [(m.start(), m.end()) for m in re.finditer("[0-9]+", run)]
    sizes = [b - a for a, b in groups]
    i = 0
    while i < len(groups):
        n = next((len(f) for f in CARD_GROUPS if tuple(sizes[i:i + len(f)]) == f), 1 if 13 <= sizes[i] <= 19 else 0)
        if n and n < len(groups) and luhn(plain(run[groups[i][0]:groups[i + n - 1][1]])):
            yield start + groups[i][0], start + groups[i + n - 1][1]
            i += n
        else:
            i += 1


def ibans(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while m := IBAN_HEAD.search(text, at):
        start, at = m.start(), m.start() + 1
        size = IBAN_LENGTHS.get(m[0][:2])
        if not size or start and text[start - 1].isalnum():
            continue
        end, got = start, []
        while len(got) < size and end < len(text):
            c = text[end]
            if c in DIGITS or "A" <= c <= "Z":
                got.append(c)
            elif c != " " or text[end - 1] == " ":
                break
            end += 1
        if len(got) == size and not text[end:end + 1].isalnum() and mod97("".join(got)):
            yield start, end
            at = end


def on_calendar(year: str, month: str, day: str) -> bool:
    y, a, b = int(year), int(month), int(day)
    for m, d in ((a, b), (b, a)):
        try:
            date(y, m, d)
        except ValueError:
            continue
        return 1900 <= y <= 2100
    return False


def proposals(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind, start, end, confirmed) of all kinds; rejected ones of the base are left out."""
    for s, e in emails(text):
        yield 0, s, e, True
    if "." in text:
        for s, e, ok in addresses(text):
            if ok:
                yield 1, s, e, not text[s:e].startswith("0.")
    for m in DIGIT_RUN.finditer(text):
        digits = plain(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield 2, m.start(), m.end(), True
        elif len(digits) < 16 and luhn(digits):
            yield 6, m.start(), m.end(), digits[0] in "3456"
        else:
            for s, e in embedded(m[0], m.start()):
                yield 5, s, e, True
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c in DIGITS for c in m[0]) <= 15:
                yield 3, m.start(), m.end(), m[0][1] != "0"
    for s, e in ibans(text):
        yield 4, s, e, True
    if SOCIAL_HINT.search(text):
        for m in SOCIAL.finditer(text):
            if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
                yield 7, m.start(), m.end(), True
    for run in PHONE_RUN.finditer(text):
        for m in LOCAL_PHONE.finditer(text, max(0, run.start() - 1), run.end()):
            if 7 <= sum(c in DIGITS for c in m[0]) <= 12:
                yield 8, m.start(), m.end(), True
    if DATE_HINT.search(text):
        for m in DATE.finditer(text):
            parts = (m[1], m[3], m[4]) if m[1] else (m[8], m[7], m[5])
            if on_calendar(*parts):
                yield 9, m.start(), m.end(), True


def score_of(text: str, kind: int, start: int, end: int, confirmed: bool) -> float:
    """Prior, validator and context of one proposal, between 0 and 1."""
    prior, rise = SCORES[KINDS[kind]]
    near = text[max(0, start - BEFORE):start], text[end:end + AFTER]
    score = prior + rise * confirmed
    score += RISE * any(map(CONTEXT[KINDS[kind]].search, near))
    score -= FALL * any(map(AGAINST.search, near))
    return min(1.0, max(0.0, round(score, 6)))


def find_pii(text: str | None) -> list[tuple[int, int, int, float]]:
    """(kind, start, end, score) by kind and start; positions in code points, end exclusive.

    Of overlapping added spans the one with the higher score stays, then the
    earlier, then the longer; none overlaps a base span.
    """
    if not text:
        return []
    found = {(k, s, e): score_of(text, k, s, e, ok) for k, s, e, ok in proposals(text)}
    if not found:
        return []
    kept = [x for x in found if x[0] < N_BASE]
    taken: list[tuple[int, int]] = []  # disjoint and sorted
    for s, e in sorted((s, e) for _, s, e in kept):
        if taken and s < taken[-1][1]:
            taken[-1] = taken[-1][0], max(e, taken[-1][1])
        else:
            taken.append((s, e))
    added = [x for x in found if x[0] >= N_BASE and found[x] >= THRESHOLD]
    for x in sorted(added, key=lambda x: (-found[x], x[1], -x[2], x[0])):
        at = bisect_left(taken, (x[1], x[2]))
        if (not at or taken[at - 1][1] <= x[1]) and (at == len(taken) or taken[at][0] >= x[2]):
            taken.insert(at, (x[1], x[2]))
            kept.append(x)
    return [(*x, found[x]) for x in sorted(kept)]


SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):  # small slices bound what is held at once
            rows = batch.slice(at, 256)
            found = [[dict(zip(("kind", "start", "end", "score"), x)) for x in find_pii(t)]
                     for t in rows.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(found, SPANS)],
                                             names=["key", "text_key", "spans"])


def scan_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: (key, text_key, spans), spans sorted by kind, then start.

    Each span is (kind, start, end, score) in code points, end exclusive;
    ``kind`` is a position in ``KINDS``. Null and empty texts have none; texts
    are searched whole, however long. Rows that repeat a key and text have
    equal results; a null key is a key like any other. Other columns are not
    looked at. An empty table gives an empty result.
    """
    own = docs.select(F.col(key).alias("key"), text_key(F.col(text)).alias("text_key"), F.col(text).cast("string").alias("t"))
    kind = own.schema["key"].dataType.simpleString()
    found = own.mapInArrow(_spans, f"key {kind}, text_key long, "
                                   "spans array<struct<kind:int,start:int,end:int,score:double>>")
    return found.withColumnRenamed("key", key)


def of_base(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"] < N_BASE)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text", mask: str | None = None) -> DataFrame:
    """``docs`` with each reported span of its text replaced by ``mask``, by default the kind in brackets.

    Columns, rows and their order of columns stay; a null text stays null, an
    empty one empty. Of overlapping base spans the first one names the mask.
    """
    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            out, at = [], 0
            for kind, start, end, _ in sorted(find_pii(t), key=lambda x: (x[1], -x[2])):
                if start >= at:
                    out += [t[at:start], f"[{KINDS[kind]}]" if mask is None else mask]
                at = max(at, end)
            return t if not out else "".join([*out, t[at:]])
        return texts.map(one, na_action="ignore")
    return docs.withColumn(text, clean(F.col(text)))
