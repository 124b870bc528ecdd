"""Collocations against plain counting, with tiny tables of slots, many shards and odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from causeway.llm import collocations as col

SCHEMA = "doc_id long, text string, lang string"


def plainly(rows, least, longest=4, top=2000, inside=80):
    """By the definition, with Python's whole numbers."""
    f, total = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    f[lang, tuple(words[i:i + n])] += 1
    f = {k: v for k, v in f.items() if v >= least}
    cand = {k: v for k, v in f.items() if len(k[1]) > 1}
    drop = set()
    for (lang, q), fq in cand.items():
        for m in range(2, len(q)):
            for i in range(len(q) - m + 1):
                if 100 * fq >= inside * cand[lang, q[i:i + m]]:
                    drop.add((lang, q[i:i + m]))
    by = {}
    for (lang, p), a in cand.items():
        if (lang, p) not in drop:
            score, k = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            by.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for lang, found in by.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def made(seed, n=120):
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "é", "ß", "a b", "😀", "x", "y'z", "\x1f", "1"]
    rows = []
    for i in range(n):
        out = []
        for _ in range(rng.randint(0, 60)):
            out.append(rng.choice(["New York City", "of the", "a b a b", rng.choice(words), rng.choice(words)]))
            out.append(rng.choice([" ", " ", "  ", "\t", ". ", "\n", "\r\n", ",", " ", "\x0b"]))
        rows.append((i, "".join(out), rng.choice(["en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize("seed,shards,bits,least,longest", [(1, 3, 23, 5, 4), (2, 1, 10, 3, 4), (3, 5, 6, 8, 3), (4, 2, 8, 2, 5)])
def test_equals_plain_counting(spark, monkeypatch, seed, shards, bits, least, longest):
    rows = made(seed) + [(None, None, "en"), (1, "", None), (1, "...", "de"), (2, "a b", ""), (2, "a b", "")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = found(col.collocations(df, least=least, longest=longest, top=40, shards=shards, bits=bits))
    assert got == plainly(rows, least, longest, 40) and got


def test_long_text_is_cut_at_pieces(spark):
    rows = [(1, "one two three. " * 60_000 + "four " * 50 + "x" * 300_000, "en")]
    assert found(col.collocations(spark.createDataFrame(rows, SCHEMA))) == plainly(rows, 30)


def test_chunks_hold_all_words():
    data = "a b.c d . e\tf".encode().translate(col.PLAIN)
    chunk = col._encoded("en", data, 0)
    assert chunk.column("words")[0].as_py() == "a b c d e f"
    assert np.frombuffer(chunk.column("ids")[0].as_py(), np.int32).tolist() == [1, 2, 0, 3, 4, 0, 5, 6]


def test_interleaves_lengths():
    """A pair is counted from the scan after its words arrive, and for one cycle only."""
    words, ids = ["a", "b"], np.array([1, 2, 0, 1, 2], np.int32)
    slots = np.zeros(1 << 16, np.uint8)
    keys, phrases = col.count_chunk(0, 2, 4, slots, 16, "en", words, ids)
    assert [c.tolist() for _, c in keys] == [[2, 2]] and len(phrases[0][0]) == 0
    slots[(keys[0][0] >> np.uint64(48)).astype(int)] = 1
    for t, pairs, own in ((1, [2], ["a", "b"]), (2, [2], ["a", "b"]), (3, [], [])):
        keys, phrases = col.count_chunk(t, 2, 4, slots, 16, "en", words, ids)
        assert [n for _, c in keys[t < 2:] for n in c.tolist()] == pairs
        assert phrases[0][0].to_pylist() == own
    _, phrases = col.count_chunk(0, 2, 4, np.ones(1 << 16, np.uint8), 16, "en", words, ids)
    assert [(p.to_pylist(), c.tolist()) for p, c in phrases][1] == (["a b"], [2])


def test_exact_where_products_pass_64_bits(spark):
    row = spark.range(1).selectExpr("9000000000000000000 AS a", "9000000000000000001 AS l", "9000000000000000002 AS r")
    got = row.selectExpr(f"(CAST({col.SCALE} AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(20, 0))) "
                         "div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0))) AS s").first()["s"]
    assert got == 2000000 * 9000000000000000000 // (9000000000000000001 + 9000000000000000002)


def test_odd_tables(spark):
    assert found(col.collocations(spark.createDataFrame([], SCHEMA))) == []
    assert found(col.collocations(spark.createDataFrame([(1, None, None), (2, "", "en")], SCHEMA))) == []
    rows = [(1, "red fox " * 40, "en")]
    clash = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA + ", phrase string, n int, shard int")
    assert found(col.collocations(clash)) == plainly(rows, 30)
