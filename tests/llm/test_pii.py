"""Personal data against the base patterns as written, planted cases and odd rows."""

import re
import time

import pytest

from causeway.llm import pii


def plainly(text):
    """The base findings by the patterns as they are written."""
    text = text or ""
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19:
            total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(digits[::-1]))
            if total % 10 == 0:
                out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


ODD = ["", None, " ", "a@b.c@d.e", "@x.y", "a@b", "a@b..c", "x..y@m-1.co.uk.", "1.2.3.4.5.6.7.8", "1..2.3.4", "256.1.1.1",
       "1.2.3.4.", "001.002.003.004 0000000256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111 1111 1111",
       "7536784127813050 4845168114407329", "+1 (017) 555-7713", "+12345678", "+1-", "++49 30 1234567 ", "+1234567890123456",
       "é😀 mail: ü@x.de, max.müller@post.example.com 😀 1.2.3.4", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "a" * 50 + "@" * 50,
       "5500-0000 0000-0004x@y.z 10.0.0.1", "12 4111111111111111", "1.2.3.4@5.6.7.8"]


@pytest.mark.parametrize("text", ODD)
def test_base_is_as_written(text):
    assert [x[:3] for x in pii.find_pii(text) if x[0] < pii.N_BASE] == plainly(text)


def test_base_on_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r["doc_id"]: plainly(r["text"]) for r in docs.collect()}
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] < pii.N_BASE]
           for r in pii.scan_pii(docs).collect()}
    assert got == want and any(want.values())


@pytest.mark.parametrize("text,kind,part", [
    ("Please pay to IBAN DE89 3704 0044 0532 0130 00 today", "iban", "DE89 3704 0044 0532 0130 00"),
    ("GB82WEST12345698765432", "iban", "GB82WEST12345698765432"),
    ("7536784127813050 4111111111111111", "embedded_card", "4111111111111111"),
    ("amex card 378282246310005 thanks", "short_card", "378282246310005"),
    ("his SSN is 219-09-9999.", "social_security", "219-09-9999"),
    ("Call me: (030) 901820 now", "local_phone", "(030) 901820"),
    ("born on 12/03/1984 in Rome", "birth_date", "12/03/1984"),
    ("née le 1984-03-12", "birth_date", "1984-03-12")])
def test_added_kinds(text, kind, part):
    assert (kind, part) in [(pii.KINDS[k], text[s:e]) for k, s, e, _ in pii.find_pii(text)]


@pytest.mark.parametrize("text", [
    "DE89 3704 0044 0532 0130 01", "378282246310005", "order 219-09-9999", "219-00-9999 ssn", "on 12/03/1984 in Rome",
    "born 32/13/1984", "number 030 901820", "XX12345678901234", "invoice date of birth"])
def test_without_validator_or_context(text):
    assert [x for x in pii.find_pii(text) if x[0] >= pii.N_BASE] == []


def test_context_moves_the_score():
    scores = [pii.find_pii(t)[0][3] for t in ("order 4111111111111111", "4111111111111111", "visa card 4111111111111111")]
    assert scores == sorted(scores) and len(set(scores)) == 3


def test_spans_do_not_meet_base_or_each_other():
    text = "tel +49 30 1234567 phone 030 1234567 card 4111 1111 1111 1111 iban DE89370400440532013000 born 01/02/1990 " * 50
    found = pii.find_pii(text)
    added = sorted((s, e) for k, s, e, _ in found if k >= pii.N_BASE)
    assert len(added) == 150 and all(a[1] <= b[0] for a, b in zip(added, added[1:]))
    assert not any(k < pii.N_BASE and s < b and a < e for k, s, e, _ in found for a, b in added)


@pytest.mark.parametrize("unit", ["1", "a", "1.", "a@", "1 ", "+1", "A1", "11-", "1.1.1.1 ", "x@y.z ", "(", "1/1/"])
def test_long_runs_take_linear_time(unit):
    start = time.process_time()
    pii.find_pii(unit * (400_000 // len(unit)))
    assert time.process_time() - start < 10


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, "a"), (None, "x@y.zz", "b"), (2, "", None), (2, "x@y.zz", "c"), (2, "x@y.zz", "c")],
                                 "doc_id long, text string, spans string").withColumn("key", docs_key())
    rows = sorted(((r["doc_id"] or 0, len(r["spans"])) for r in pii.scan_pii(docs).collect()))
    assert rows == [(0, 1), (1, 0), (2, 0), (2, 1), (2, 1)]
    assert pii.scan_pii(docs.limit(0)).collect() == []
    clean = pii.redact(docs)
    assert clean.columns == docs.columns
    assert sorted(str(r["text"]) for r in clean.collect()) == ["", "None", "[email]", "[email]", "[email]"]
    named = docs.select("doc_id", docs["text"].alias("spans_"), docs["spans"].alias("text_key"))
    assert pii.scan_pii(named, text="spans_").count() == 5


def docs_key():
    from pyspark.sql import functions as F
    return F.lit("clash")
