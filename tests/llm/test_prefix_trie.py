"""The prefix trie against a plain one built turn by turn, and with SQL on the tables."""

import hashlib
import random
import zlib

import pytest

from causeway.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn int, role string, text string"


def plainly(rows):
    """All nodes of the rebuilt conversations, by sets of members."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}|{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    said = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}

    def whole(c):
        h = zlib.crc32(str(c).encode()) % 6
        root = c - (c % 100 if c >= 0 else -(-c % 100))
        return tuple(said.get(root, [])[:h] + said[c][h:])
    paths = {c: whole(c) for c in said}
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    below = {n: [0, 0] for n in members}
    children = {n: 0 for n in members}
    for n in members:
        if n:
            children[n[:-1]] += 1
    for n, ms in members.items():
        for d in range(len(n) + 1):
            below[n[:d]][0] += children[n] == 0
            below[n[:d]][1] += (len(ms) - 1) * len(n[-1][1]) if n else 0
    out = []
    for n, ms in members.items():
        ends = ",".join(str(c) for c in sorted(ms) if paths[c] == n)
        out.append((min(ms), len(n), min(members[n[:-1]]) if n else None, len(ms), children[n], *below[n],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(seed, convs=260, longest=9, kinds=3):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        c = c if rng.random() < 0.9 else -c
        for t in range(rng.randint(1, longest)):
            rows.append((c, rng.choice([t, t, t, None, 3]), rng.choice(["user", "bot", None]) if kinds > 2 else "user",
                         rng.choice(["a", "bé", "", None, "😀x"][:kinds + 1])))
    return rows


@pytest.mark.parametrize("seed,shard_bits,band", [(1, 10, 128), (2, 3, 2), (3, 2, 4)])
def test_equals_plain_trie(spark, monkeypatch, seed, shard_bits, band):
    monkeypatch.setattr(trie, "SHARD_BITS", shard_bits)
    monkeypatch.setattr(trie, "BAND", band)
    rows = made(seed, kinds=seed)
    assert found(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == plainly(rows)


def test_long_and_equal_conversations(spark):
    same = [(c, t, "user", f"turn {t}") for c in range(100, 180) for t in range(4)]
    long = [(7, t, "user", f"step {t % 5}") for t in range(700)] + [(8, t, "user", f"step {t % 5}") for t in range(650)]
    rows = same + long + [(1, 0, "user", "x" * 200_000), (2, 0, "user", "x" * 200_000), (None, 1, "user", "nobody")]
    assert found(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == plainly(rows)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert found(trie.prefix_trie(empty)) == []
    only_null = spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)
    assert found(trie.prefix_trie(only_null)) == []
    rows = [(5, None, None, None), (5, None, None, None), (5, 1, "user", None), (105, 0, "a", "b"), (105, 0, "a", "b")]
    clash = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA + ", depth int, shard string, z1 int")
    assert found(trie.prefix_trie(clash)) == plainly(rows)
    named = spark.createDataFrame([(c, t, r, x) for c, t, r, x in rows], "n int, pos int, digest string, conv_id string")
    assert found(trie.prefix_trie(named, "n", "pos", "digest", "conv_id")) == plainly(rows)
    with pytest.raises(ValueError, match="integers"):
        trie.prefix_trie(spark.createDataFrame([("a", 1, "x", "y")], "conv_id string, turn int, role string, text string"))


def test_long_chain_of_branches(spark):
    """Chains nested as deep as the conversations are long."""
    rows = [(c, t, "user", f"{min(t, c)}") for c in range(1, 60) for t in range(70)]
    rows = [(c * 100, t, r, x) for c, t, r, x in rows]
    assert found(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == plainly(rows)


def test_whole_table(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert found(trie.prefix_trie(turns)) == plainly(rows)
