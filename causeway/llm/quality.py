"""Quality rules with risk-controlled thresholds.

Each rule is a signal between 0 and 1 that is high for poor texts, cut at some
value per stratum. Labelled documents decide the cuts of all rules together, every
one of them: a fifth of the good rows, and all poor ones, lay out a path of joint
cuts, each a step stricter than the one before in one rule; steps that reject many
poor rows for few good ones come first. All other good rows test the path from its
loose end, and the strictest joint cut is taken for which an exact binomial test still
shows that at most ``limit`` of the good documents are rejected by any rule. The
path does not depend on the rows that test it, and testing in a fixed order needs
no correction over the cuts, so only the level is divided, by the number of paths
(Bonferroni). Strata with too few good rows for a test of their own share one path;
where they are too few even together, all strata take part in it. The promise then
holds for those rows as a whole, and each of these strata stays on the path before
the cut that rejects more than ``limit`` of its own good rows.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, cut, shared_path

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

RULES = ("symbols", "repeated_lines", "repeated_words", "long_words", "short_words")
STEPS = 50  # cuts per rule: 1/STEPS, 2/STEPS, ... 1
LIMIT = 0.02  # good documents of a stratum that all rules together may reject
LEVEL = 0.05  # chance that any promise fails
PATH_SHARE = 0.2  # good rows that lay out the path; the others test it
POOL = -1  # number of the path that small strata share
BROADCAST_STRATA = 10_000

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def repeated_words(words: list) -> int:
    """Words that stand in a three-word window found twice or more, the first one included."""
    n = len(words)
    if n < 4:
        return 0
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__  # a new word gets the next number
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    k = len(number)
    pairs = ids[:-1] * k + ids[1:]
    if k ** 3 < 2 ** 62:
        triples = pairs[:-1] * k + ids[2:]
    else:
        triples = np.unique(pairs, return_inverse=True)[1][:-1] * k + ids[2:]
    _, at, count = np.unique(triples, return_inverse=True, return_counts=True)
    twice = count[at] > 1
    if not twice.any():
        return 0
    hit = np.zeros(n, bool)
    for shift in range(3):
        hit[shift:n - 2 + shift] |= twice
    return int(hit.sum())


def text_features(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``FEATURES``; a null text is empty."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at ASCII white space alone
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(lines))


@F.pandas_udf(T.StructType([T.StructField(name, T.LongType()) for name in FEATURES]))
def features_of(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_features(t) for t in texts], columns=list(FEATURES), dtype="int64")


def base_failed(f: Column) -> Column:
    return (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > MAX_REPEAT_PERCENT * f["n_words"])


def signals(f: Column) -> Column:
    """The signals of ``RULES`` from the counts, each from 0 to 1; 0 where there are no words."""
    def share(a: Column, b: Column) -> Column:
        return F.when(b > 0, F.least(a / b, F.lit(1.0))).otherwise(F.lit(0.0))
    length = f["word_chars"] / F.greatest(f["n_words"], F.lit(1))
    return F.array(share(f["n_symbols"], f["word_chars"]), share(f["n_dup_lines"], f["n_lines"]),
                   share(f["n_repeat_words"], f["n_words"]), F.least(length / 25, F.lit(1.0)),
                   share(f["n_words"], f["word_chars"]))


def log_binomial_cdf(k: int, n: int, p: float) -> float:
    """log P(X <= k) for n draws of chance p, summed exactly term by term."""
    i = np.arange(k + 1)
    lg = np.frompyfunc(math.lgamma, 1, 1)
    terms = (math.lgamma(n + 1) - lg(i + 1).astype(float) - lg(n - i + 1).astype(float)
             + i * math.log(p) + (n - i) * math.log1p(-p))
    top = terms.max()
    return float(top + math.log(np.exp(terms - top).sum()))


def strictest_cut(rejected: np.ndarray, n: int, limit: float, level: float) -> int | None:
    """Of cuts K, K-1, ... 1 (``rejected[k]``: good rows that cut k rejects; K is its last index), the last that passes.

    A cut passes if a false rejection rate of ``limit`` or more would give so
    few rejected good rows with a chance of ``level`` at most: the exact
    (Clopper-Pearson) upper bound of the rate lies below ``limit``.
    """
    best = None
    for k in range(len(rejected) - 1, 0, -1):
        if n == 0 or rejected[k] > limit * n or log_binomial_cdf(int(rejected[k]), n, limit) > math.log(level):
            break
        best = k
    return best


def rows_needed(limit: float, level: float) -> int:
    """Good rows without which no cut passes, even one that rejects none."""
    return math.ceil(math.log(level) / math.log1p(-limit))


def layout(steps: np.ndarray, good: np.ndarray, poor: np.ndarray) -> list[tuple[int, int]]:
    """The path of joint cuts: (rule, k) lowers the cut of the rule from k+1 to k; every rule ends at 1.

    ``steps`` has a row for each signal vector, ``good`` and ``poor`` count its
    rows. The next stretch is the one with the best ratio of poor to good rows
    not rejected before; one imagined row of each kind lies evenly along a rule.
    """
    at = [STEPS + 1] * len(RULES)
    path: list[tuple[int, int]] = []

    def spread(rows: np.ndarray) -> np.ndarray:
        """Good and poor rows by rule and step."""
        return np.array([[np.bincount(steps[rows, r], n[rows], STEPS + 1) for r in range(len(RULES))] for n in (good, poor)])
    left = np.arange(len(steps))
    counts = spread(left)  # kept up by what a stretch rejects: a vector is counted once and leaves once
    while max(at) > 1:
        best = None
        for r in range(len(RULES)):
            g, p = counts[:, r, ::-1].cumsum(axis=1)[:, ::-1]
            for k in range(at[r] - 1, 0, -1):
                even = (at[r] - k) / STEPS
                ratio = (p[k] + even) / (g[k] + even)
                if best is None or ratio > best[0] + 1e-9:
                    best = ratio, r, k
        _, r, k = best
        path += [(r, j) for j in range(at[r] - 1, k - 1, -1)]
        at[r] = k
        stays = steps[left, r] < k
        counts -= spread(left[~stays])
        left = left[stays]
    return path


def _paths(sizes: list, limit: float, level: float) -> tuple[list[tuple], float]:
    """Rows (stratum, path, good share, poor share, used) and the level of a path, from (stratum, good, count) rows.

    The shares are those of the rows that lay out the path, whatever the size of a
    stratum. Sizes alone decide which strata are tested on their own.
    """
    n_good = {r["stratum"]: r["count"] for r in sizes if r["good"]}
    tested = {s: int(n * (1 - PATH_SHARE)) for s, n in n_good.items()}
    order = sorted(n_good, key=lambda s: (-tested[s], s is None, str(s)))
    own = len(order)
    while own and tested[order[own - 1]] < rows_needed(limit, level / (own + (own < len(order)))):
        own -= 1
    level = level / max(1, own + (own < len(order)))
    member = [(s, i) for i, s in enumerate(order[:own])] + [(s, POOL) for s in order[own:]]
    if own < len(order) and sum(tested[s] for s in order[own:]) < rows_needed(limit, level):
        member += [(s, POOL) for s in order[:own]]
    return [(s, i, PATH_SHARE, 1.0, i != POOL or s in order[own:]) for s, i in member], level


def fit_thresholds(features: DataFrame, labels: DataFrame, stratum: str = "lang", key: str = "doc_id",
                   label: str = "quality", limit: float = LIMIT, level: float = LEVEL) -> DataFrame:
    """(stratum, cuts): for each stratum with good labelled rows, the cut of each rule or null.

    ``features`` holds (key, stratum, f). Every labelled row that passes the
    base rules counts; a key labelled 1 anywhere is good. What goes to one place
    are counts per signal vector, of which there are so many whatever the number
    of rows, and counts per path step.
    """
    marks = (labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("_l_key"))
             .agg((F.max(label) == 1).alias("good")))
    seen = cut(features.filter(~base_failed(F.col("f"))).join(marks, F.col(key) == F.col("_l_key"))
               .select(F.col(stratum).alias("stratum"), "good",
                       (F.pmod(F.xxhash64(key, F.lit("path")), F.lit(1 << 20)) / (1 << 20)).alias("place"),
                       F.transform(signals(F.col("f")), lambda v: F.floor(v * STEPS + 1e-9).cast("int")).alias("steps")))
    members, level = _paths(seen.groupBy("stratum", "good").count().collect(), limit, level)
    spark, kind = features.sparkSession, seen.schema["stratum"].dataType.simpleString()
    if not members:
        return spark.createDataFrame([], f"stratum {kind}, cuts array<double>")
    member = spark.createDataFrame(members, f"m_stratum {kind}, path int, good_share double, poor_share double, used boolean")
    if len(members) <= BROADCAST_STRATA:
        member = F.broadcast(member)
    dealt = seen.join(member, F.col("stratum").eqNullSafe(F.col("m_stratum"))).withColumn(
        "lays", F.col("place") < F.when(F.col("good"), F.col("good_share")).otherwise(F.col("poor_share")))

    def lay(pdf: pd.DataFrame) -> pd.DataFrame:
        steps = np.stack(np.unravel_index(pdf["vector"], (STEPS + 1,) * len(RULES)), axis=1).astype(np.int8)
        path = layout(steps, pdf["n_good"].to_numpy(float), pdf["n_poor"].to_numpy(float))
        fires = np.full((len(RULES), STEPS + 1), len(path))  # the first cut of the path that rejects a step
        for i, (r, k) in reversed(list(enumerate(path))):
            fires[r, k:] = i
        return pd.DataFrame({"l_path": [pdf["path"].iloc[0]], "moves": [[r * (STEPS + 1) + k for r, k in path]],
                             "fires": [fires.tolist()]})

    vector = F.aggregate("steps", F.lit(0), lambda v, k: v * (STEPS + 1) + k)
    laid = cut(dealt.filter("lays").groupBy("path", vector.alias("vector"))
               .agg(F.count_if("good").alias("n_good"), F.count_if(~F.col("good")).alias("n_poor")).groupBy("path").applyInPandas(
        lay, "l_path int, moves array<int>, fires array<array<int>>"))
    table = F.broadcast(laid) if len(members) <= BROADCAST_STRATA else laid
    first = F.array_min(F.zip_with("steps", "fires", lambda s, at: F.get(at, s)))
    counts = (dealt.filter("good and not lays").join(table, F.col("path") == F.col("l_path"))
              .select("path", "stratum", "used", first.alias("at")).groupBy("path", "stratum", "used", "at").count()
              .join(table.select("l_path", "moves"), F.col("path") == F.col("l_path")).drop("l_path"))

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        moves = [divmod(m, STEPS + 1) for m in pdf["moves"].iloc[0]]

        def rejected(rows: pd.DataFrame) -> np.ndarray:
            """By cuts from strict to loose, as ``strictest_cut`` takes them."""
            return np.append(0, np.bincount(rows["at"], rows["count"], len(moves) + 1)[:-1].cumsum()[::-1])
        k = strictest_cut(rejected(pdf), int(pdf["count"].sum()), limit, level)
        out = []
        for name, own in pdf[pdf["used"]].groupby("stratum", dropna=False):
            last = 0 if k is None else len(moves) - k + 1  # so many moves of the path are made
            while pdf["path"].iloc[0] == POOL and last and (own["count"][own["at"] < last].sum() > limit * own["count"].sum()):
                last -= 1
            cuts: list = [None] * len(RULES)
            for r, j in moves[:last]:
                cuts[r] = j / STEPS
            out.append((own["stratum"].iloc[0], cuts))
        return pd.DataFrame(out, columns=["stratum", "cuts"])

    return counts.groupBy("path").applyInPandas(choose, f"stratum {kind}, cuts array<double>")


def with_verdict(docs: DataFrame, thresholds: DataFrame, f: str, stratum: str = "lang") -> DataFrame:
    """``docs`` with (base_failed, kept), from the counts in column ``f``."""
    rules = thresholds.select(F.col("stratum").alias("_q_stratum"), F.col("cuts").alias("_q_cuts"))
    rules = cut(rules)
    if rules.count() <= BROADCAST_STRATA:
        rules = F.broadcast(rules)
    met = docs.join(rules, docs[stratum].eqNullSafe(rules["_q_stratum"]), "left")
    fires = F.exists(F.zip_with(signals(F.col(f)), F.coalesce("_q_cuts", F.array().cast("array<double>")),
                                lambda s, c: F.coalesce(F.floor(s * STEPS + 1e-9) >= F.floor(c * STEPS + 0.5), F.lit(False))),
                     lambda x: x)
    return (met.withColumn("base_failed", base_failed(F.col(f)))
            .withColumn("kept", ~F.col("base_failed") & ~fires).drop("_q_stratum", "_q_cuts"))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", key: str = "doc_id", text: str = "text",
          label: str = "quality", limit: float = LIMIT, level: float = LEVEL) -> DataFrame:
    """One row for each row of ``docs``: (key, n_words, the counts, base_failed, kept).

    Null and empty texts have no words and fail the base rules. A null stratum
    is a stratum of its own; a null key carries no label; rows that repeat a
    key are judged each by its text. Without labels only the base rules apply.
    Other columns are not looked at. An empty table gives an empty result.
    """
    own = cut(docs.select(F.col(key).alias("doc_id"), F.col(stratum).alias("lang"), features_of(F.col(text)).alias("f")))
    rules = fit_thresholds(own, labels.select(F.col(key).alias("doc_id"), F.col(label).alias("quality")),
                           limit=limit, level=level)
    done = with_verdict(own, rules, "f")
    return done.select(F.col("doc_id").alias(key), "f.n_words", "f.word_chars", "f.n_symbols", "f.n_dup_lines",
                       "f.n_repeat_words", "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", key: str = "doc_id", text: str = "text",
              label: str = "quality", limit: float = LIMIT, level: float = LEVEL) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns.

    The rows are written to the shared folder once with their counts, so Python
    sees each text once, the cuts are fitted on the counts alone, and no text
    is shuffled. Nulls, empty texts, repeated rows, empty tables and a missing
    label are judged as ``judge`` does; columns may have any name.
    """
    spark = docs.sparkSession
    path = shared_path(spark, "quality")
    with arrow_rows(spark, 256):  # few texts at a time beside each worker
        docs.select(F.struct(*docs.columns).alias("_q_row"), F.col(key).alias("_q_key"), F.col(stratum).alias("_q_lang"),
                    features_of(F.col(text)).alias("_q_f")).write.option("compression", "zstd").parquet(path)
    whole = spark.read.parquet(path)
    counts = whole.select(F.col("_q_key").alias("doc_id"), F.col("_q_lang").alias("lang"), F.col("_q_f").alias("f"))
    rules = fit_thresholds(counts, labels.select(F.col(key).alias("doc_id"), F.col(label).alias("quality")),
                           limit=limit, level=level)
    return with_verdict(whole, rules, "_q_f", "_q_lang").filter("kept").select("_q_row.*")
