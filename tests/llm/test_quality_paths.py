"""The cuts of the quality rules against a plain version over all labelled rows."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from causeway.llm import quality

N_GOOD, N_POOR = 24_000, 12_000


def place():
    """The share of rows dealt before a row."""
    return F.pmod(F.xxhash64("doc_id", F.lit("path")), F.lit(1 << 20)) / (1 << 20)


@pytest.fixture(scope="module")
def features(spark):
    """Poor rows that symbols give away if their place is low, else repeated lines; some good rows have either."""
    poor = F.col("doc_id") >= N_GOOD
    symbols = F.when(poor, place() < 0.36).otherwise(F.col("doc_id") % 64 == 1)
    lines = F.when(poor, place() >= 0.36).otherwise(F.col("doc_id") % 64 == 2)
    f = F.struct(F.lit(1000).cast("long").alias("n_words"), (5000 + F.col("doc_id") % 700).alias("word_chars"),
                 F.when(symbols, 500 + F.col("doc_id") % 90).otherwise(F.col("doc_id") % 9).alias("n_symbols"),
                 F.when(lines, 40).otherwise(0).cast("long").alias("n_dup_lines"), (F.col("doc_id") % 50).alias("n_repeat_words"),
                 F.lit(100).cast("long").alias("n_lines"))
    docs = spark.range(N_GOOD + N_POOR).withColumnRenamed("id", "doc_id")
    return docs.select("doc_id", F.lit("en").alias("lang"), f.alias("f"))


def plain_path(rows):
    """``layout`` with all rows gone through again for every stretch."""
    at, path = [quality.STEPS + 1] * len(quality.RULES), []
    while max(at) > 1:
        tried = []
        for r, k in itertools.product(range(len(quality.RULES)), range(quality.STEPS, 0, -1)):
            if k < at[r]:
                g, p = (sum(n[c] for s, n in rows if s[r] >= k) for c in (0, 1))
                even = (at[r] - k) / quality.STEPS
                tried.append(((p + even) / (g + even), r, k))
        best = None
        for x in tried:
            if best is None or x[0] > best[0] + 1e-9:
                best = x
        _, r, k = best
        path += [(r, j) for j in range(at[r] - 1, k - 1, -1)]
        at[r] = k
        rows = [x for x in rows if x[0][r] < k]
    return path


def test_layout_equals_a_plain_one():
    rng = np.random.default_rng(3)
    steps = rng.integers(0, quality.STEPS + 1, (60, len(quality.RULES))) // rng.integers(1, 9, (60, len(quality.RULES)))
    n = rng.integers(0, 5, (60, 2)).astype(float)
    assert quality.layout(steps, n[:, 0], n[:, 1]) == plain_path(list(zip(steps.tolist(), n.tolist())))


def test_every_labelled_row_decides_the_cuts(spark, features):
    labels = spark.range(N_GOOD + N_POOR).select(F.col("id").alias("doc_id"), (F.col("id") < N_GOOD).cast("int").alias("quality"))
    [got] = quality.fit_thresholds(features, labels).collect()
    steps = F.transform(quality.signals(F.col("f")), lambda v: F.floor(v * quality.STEPS + 1e-9))
    rows = features.select((F.col("doc_id") < N_GOOD).alias("good"), place().alias("place"), steps.alias("steps")).collect()
    assert len(rows) == N_GOOD + N_POOR
    good, lays = np.array([r["good"] for r in rows]), np.array([r["place"] < (quality.PATH_SHARE if r["good"] else 1) for r in rows])
    vectors = np.array([r["steps"] for r in rows])
    path = quality.layout(vectors[lays], (good * 1.0)[lays], (~good * 1.0)[lays])
    tests, passed = vectors[good & ~lays], 0
    assert (good & lays).sum() > 4_000 and len(tests) + lays.sum() == len(rows)  # each row has its part
    hit = np.zeros(len(tests), bool)
    for i, (r, k) in enumerate(path):
        hit |= tests[:, r] >= k
        n = int(hit.sum())
        if n > quality.LIMIT * len(tests) or quality.log_binomial_cdf(n, len(tests), quality.LIMIT) > np.log(quality.LEVEL):
            break
        passed = i + 1
    cuts = [None] * len(quality.RULES)
    for r, k in path[:passed]:
        cuts[r] = k / quality.STEPS
    assert (got["stratum"], got["cuts"]) == ("en", cuts)
    assert cuts[:2] == [0.12, 0.4]  # no row has so many symbols; repeated lines give away more poor rows for as many good ones


def test_size_does_not_change_the_share_of_rows():
    for n in (2_000, 2_000_000):
        sizes = [{"stratum": "en", "good": good, "count": n} for good in (True, False)]
        assert quality._paths(sizes, 0.02, 0.05)[0] == [("en", 0, quality.PATH_SHARE, 1.0, True)]
