"""Feature fitting: vocabulary, TF-IDF, category codes, split, folds, weights."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.columns import computed_once, sparse
from .ranking import first_by_hash, hash_rank

# Distinct values a category column may have to be coded.
MAX_CATEGORIES = 1_000_000


def add_terms(df: DataFrame, col: str, out: str = "terms",
              stop_words: list[str] | tuple[str, ...] | None = None, low: int = 1, high: int = 2) -> DataFrame:
    """Add the tokens without stop words, and their n-grams.

    Both are fixed before they are used: repeated inside a later filter or
    lambda, the tokens of a long text would be derived once per token.
    """
    tokens = text.remove_stop_words(text.tokenize(F.col(col)), stop_words)
    staged = computed_once(df, _tokens=tokens)
    return computed_once(staged, **{out: text.ngrams(F.col("_tokens"), low, high)}).drop("_tokens")


def _bound(limit: int | float, n_docs: int) -> float:
    """A document-frequency bound: whole numbers are counts, fractions are shares."""
    return float(limit) if isinstance(limit, int) else limit * n_docs


def term_statistics(df: DataFrame, terms_col: str) -> DataFrame:
    """Rows (term, total_count, doc_count) over all documents.

    Each document's terms are sorted inside the row, so the first of equal
    neighbours marks the document count. One shuffle by term, after partial
    sums; no shuffle by document.
    """
    ordered = computed_once(df.select(terms_col), _sorted=F.sort_array(terms_col))
    marked = F.transform("_sorted", lambda t, i: F.struct(
        t.alias("term"),
        F.when(i == 0, F.lit(1)).when(F.get("_sorted", i - 1) != t, F.lit(1)).otherwise(F.lit(0)).alias("first")))
    return (ordered.select(F.inline(marked)).groupBy("term")
            .agg(F.count(F.lit(1)).alias("total_count"), F.sum("first").alias("doc_count")))


@dataclass(frozen=True)
class Vocabulary:
    """Terms in alphabetical order, their document and total counts, and the number of documents."""

    terms: list[str]
    doc_counts: list[int]
    total_counts: list[int]
    n_docs: int

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = list(zip(range(len(self.terms)), self.terms, self.doc_counts, self.total_counts))
        return spark.createDataFrame(rows, "idx int, term string, doc_count bigint, total_count bigint")


def fit_vocabulary(df: DataFrame, terms_col: str, max_features: int = 1000,
                   min_df: int | float = 1, max_df: int | float = 1.0, n_docs: int | None = None) -> Vocabulary:
    """The ``max_features`` terms with the highest total count (ties by term) inside the
    document-frequency bounds. Only those terms reach the driver.

    Pass ``n_docs`` where it is cheaper to count before the terms are derived.
    """
    n_docs = df.count() if n_docs is None else n_docs
    kept = (term_statistics(df, terms_col)
            .filter((F.col("doc_count") >= _bound(min_df, n_docs)) & (F.col("doc_count") <= _bound(max_df, n_docs)))
            .orderBy(F.desc("total_count"), F.asc("term")).limit(max_features))
    rows = sorted((tuple(r) for r in kept.select("term", "doc_count", "total_count").collect()),
                  key=lambda r: r[0].encode())
    return Vocabulary([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], n_docs)


def idf_weights(vocabulary: Vocabulary) -> list[float]:
    """ln((1 + documents) / (1 + documents with the term)) + 1."""
    import math
    return [math.log((1 + vocabulary.n_docs) / (1 + c)) + 1 for c in vocabulary.doc_counts]


def tfidf_stages(vocabulary: Vocabulary, terms_col: str = "terms", out: str = "tfidf") -> list:
    """Fitted ML stages: term counts, times the inverse document frequency, to unit length."""
    counts = CountVectorizerModel.from_vocabulary(vocabulary.terms, inputCol=terms_col, outputCol=f"{out}_counts")
    scale = ElementwiseProduct(scalingVec=Vectors.dense(idf_weights(vocabulary)),
                               inputCol=f"{out}_counts", outputCol=f"{out}_weighted")
    unit = Normalizer(p=2.0, inputCol=f"{out}_weighted", outputCol=out)
    return [counts, scale, unit]


def tfidf(df: DataFrame, terms_col: str, vocabulary: Vocabulary, out: str = "tfidf") -> DataFrame:
    """Add a sparse TF-IDF vector of unit length; no shuffle."""
    for stage in tfidf_stages(vocabulary, terms_col, out):
        df = stage.transform(df)
    return df.drop(f"{out}_counts", f"{out}_weighted")


def vector_entries(df: DataFrame, vector: str, vocabulary: Vocabulary, *keep: str) -> DataFrame:
    """Rows (keep…, term, weight) of the non-zero entries of a TF-IDF vector."""
    names = df.sparkSession.createDataFrame([(vocabulary.terms,)], "names array<string>")
    long = df.select(*keep, *sparse(vector, "_at", "_weights")).select(
        *keep, F.inline(F.arrays_zip(F.col("_at").alias("idx"), F.col("_weights").alias("weight")))).filter("weight > 0")
    lookup = names.select(F.posexplode("names").alias("idx", "term"))
    return long.join(F.broadcast(lookup), "idx").select(*keep, "term", "weight")


def fit_categories(df: DataFrame, col: str, limit: int = MAX_CATEGORIES) -> list[str]:
    """The distinct non-null values in alphabetical order; their positions are the codes.

    The list is the state of a code, so it has to fit the driver: more than
    ``limit`` values raise an error instead of being cut.
    """
    rows = df.select(F.col(col).cast("string").alias("v")).filter("v is not null").distinct().take(limit + 1)
    if len(rows) > limit:
        raise ValueError(f"{col} has more than {limit} distinct values, it cannot be used as a category")
    return sorted((r["v"] for r in rows), key=lambda v: v.encode())


def category_codes(spark: SparkSession, values: list[str]) -> DataFrame:
    """Rows (value, code)."""
    return spark.createDataFrame(list(zip(values, range(len(values)))), "value string, code int")


def index_category(df: DataFrame, col: str, values: list[str], out: str | None = None) -> DataFrame:
    """Add the alphabetical code of a category; −1 for null and for values not in ``values``."""
    out = out or f"{col}_encoded"
    codes = category_codes(df.sparkSession, values)
    return (df.join(codes.select(F.col("value").alias(col), F.col("code").alias("_code")), col, "left")
            .withColumn(out, F.coalesce("_code", F.lit(-1))).drop("_code"))


def label_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_weights(df: DataFrame, label: str = "root_cause_label") -> DataFrame:
    """Rows (label, n, weight): rows / (classes × rows of the class)."""
    counts = label_counts(df.filter(F.col(label).isNotNull()), label)
    whole = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("k"))  # one row
    return counts.join(F.broadcast(whole)).select(
        F.col(label).alias("label"), "n", (F.col("total") / (F.col("k") * F.col("n"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str = "root_cause_label", out: str = "weight") -> DataFrame:
    """Add the balanced weight of the row's class; rows without a class stay and get no weight."""
    weights = class_weights(df, label).select(F.col("label").alias(label), F.col("weight").alias(out))
    return df.join(weights, label, "left")


def bounded_sample(df: DataFrame, n: int, label: str = "root_cause_label", seed: int = 42, key: str = "log_id") -> DataFrame:
    """At most about ``n`` labelled rows, the first of each label by hash: small labels whole, the others up to one bound.

    Every label keeps a row at least, however many labels there are.
    """
    labelled = df.filter(F.col(label).isNotNull())
    counts = sorted((r["n"], r[label]) for r in label_counts(labelled, label).collect())
    left, bound = n, 1
    for i, (size, _) in enumerate(counts):
        bound = max(1, left // (len(counts) - i))
        left -= min(size, bound)
    quotas = df.sparkSession.createDataFrame([(name, min(size, bound)) for size, name in counts], f"{label} string, quota long")
    return first_by_hash(labelled, label, key, seed, quotas, "_taken", sum(c[0] for c in counts)).filter("_taken").drop("_taken")


def split_quotas(df: DataFrame, label: str, test: float) -> DataFrame:
    """Rows (label, n, quota): test rows per class, largest remainders first, ties by label."""
    rows = label_counts(df, label).collect()
    rows.sort(key=lambda r: (r[label] is None, r[label] or ""))  # rows without a class are a class, the last
    total = sum(r["n"] for r in rows)
    whole = -int(-total * test // 1)
    exact = [r["n"] * whole / total for r in rows] if total else []
    floors = [int(x) for x in exact]
    spare = whole - sum(floors)
    by_rest = sorted(range(len(rows)), key=lambda i: (-(exact[i] - floors[i]), i))
    for i in by_rest[:spare]:
        floors[i] += 1
    return df.sparkSession.createDataFrame(
        [(r[label], r["n"], q) for r, q in zip(rows, floors)], f"{label} string, n bigint, quota bigint")


def stratified_split(df: DataFrame, label: str = "root_cause_label", test: float = 0.2, seed: int = 42,
                     key: str = "log_id", mode: str = "exact") -> DataFrame:
    """Add a flag ``is_test``, proportional per class.

    ``exact``: the class shares are met to the row. ``hash``: each row is
    decided by its own hash, so shares are met approximately, in one pass
    without any statistics.
    """
    if mode == "hash":
        share = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1_000_000)) / 1_000_000.0
        return df.withColumn("is_test", share < test)
    if mode != "exact":
        raise ValueError(f"unknown mode {mode}")
    quotas = split_quotas(df, label, test)
    n_rows = quotas.agg(F.sum("n")).first()[0] or 0
    return first_by_hash(df, label, key, seed, quotas.select(label, "quota"), "is_test", n_rows)


def fold_count(n_rows: int, n_classes: int, wanted: int = 5) -> int:
    """At least two rows per class in each fold, never fewer than two folds."""
    return max(2, min(wanted, n_rows // (2 * max(n_classes, 1))))


def stratified_folds(df: DataFrame, label: str = "root_cause_label", k: int = 5, seed: int = 42,
                     key: str = "log_id", mode: str = "exact") -> DataFrame:
    """Add ``fold`` in 0…folds−1, each class spread evenly over the folds.

    ``k`` is reduced for small data (``fold_count``). ``hash`` spreads the
    classes approximately, without ranks.
    """
    facts = label_counts(df, label).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).first()
    folds = fold_count(facts["n"] or 0, facts["k"], k)
    if mode == "hash":
        return df.withColumn("fold", F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(folds)).cast("int"))
    if mode != "exact":
        raise ValueError(f"unknown mode {mode}")
    ranked = hash_rank(df, label, key, seed, "_position", facts["n"] or 0)
    return ranked.withColumn("fold", ((F.col("_position") - 1) % folds).cast("int")).drop("_position")
