"""Language identification with a string kernel.

Two texts are as similar as the sets of n-grams (one to four characters) they
share, divided by the geometric mean of the sets' sizes. Nystroem landmarks
turn that kernel into features, and one-versus-rest kernel ridge regression
gives a score per language. The kernel against the landmarks is linear in a
text's presence vector, so landmarks and weights multiply into one matrix of
n-grams by languages, and a batch of texts is scored by one sparse product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1 << 16  # n-grams are told apart by hash
ORDERS = 4
PER_LANGUAGE = 300  # labelled texts of each language to fit on
MAX_ROWS = 6_000  # labelled texts in all
LANDMARKS = 60  # of each language
RIDGE = 1e-2
UNDETERMINED = "und"

_MULTIPLY = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


class Presence:
    """The sorted buckets of the n-grams present in a text."""

    def __init__(self) -> None:
        self.flags = np.zeros(BUCKETS, bool)

    def __call__(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        self.flags[:] = False
        for at in range(0, len(points), 1 << 20):  # slices of very long texts, with the characters that run over
            some = points[at:at + (1 << 20) + ORDERS - 1]
            run = np.zeros(len(some), np.uint32)
            for n in range(min(ORDERS, len(some))):
                run = (run[:len(some) - n] ^ (some[n:] * _MULTIPLY[n])) * np.uint32(0x2C1B3C6D)
                self.flags[(run ^ (run >> np.uint32(15))) & np.uint32(BUCKETS - 1)] = True
        return np.flatnonzero(self.flags)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # (BUCKETS, languages)
    bias: np.ndarray

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """(texts, languages) for presence rows, none of them empty."""
        out = []
        for at in range(0, len(rows), 64):  # bounds the weights that are gathered at once
            some = rows[at:at + 64]
            sizes = np.array([len(r) for r in some])
            sums = np.add.reduceat(self.weights[np.concatenate(some)], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0)
            out.append(sums / np.sqrt(sizes)[:, None] + self.bias)
        return np.concatenate(out)


def fit_language(texts: list[str], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel:
    """Fit on texts in a fixed order; the first ``landmarks`` texts of each language are its landmarks."""
    names = sorted(set(langs))
    present = Presence()
    rows = [present(t) for t in texts]
    kept = [i for i, r in enumerate(rows) if len(r)]
    rows, langs = [rows[i] for i in kept], [langs[i] for i in kept]
    if not rows:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    marks = [i for name in names for i in [k for k, x in enumerate(langs) if x == name][:landmarks]]
    landmark = np.zeros((BUCKETS, len(marks)), np.float32)
    for c, i in enumerate(marks):
        landmark[rows[i], c] = 1 / np.sqrt(len(rows[i]))
    kernel = np.stack([landmark[r].sum(axis=0) / np.sqrt(len(r)) for r in rows]).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel[marks])
    large = values > 1e-6 * values.max()
    whiten = vectors[:, large] / np.sqrt(values[large])  # Nystroem features: kernel @ whiten
    x = kernel @ whiten
    y = np.array([[1.0 if x == name else -1.0 for name in names] for x in langs])
    share = np.array([langs.count(x) for x in langs], float)
    w = (1 / share)[:, None]  # every language weighs the same
    mean = (w * x).sum(axis=0) / w.sum()
    centred = x - mean
    y_mean = (w * y).sum(axis=0) / w.sum()
    beta = np.linalg.solve(centred.T @ (w * centred) + ridge * w.mean() * np.eye(x.shape[1]), centred.T @ (w * (y - y_mean)))
    return LanguageModel(names, (landmark @ (whiten @ beta)).astype(np.float32), y_mean - mean @ beta)


def training_rows(docs: DataFrame, train, per_language: int = PER_LANGUAGE, max_rows: int = MAX_ROWS,
                  key: str = "doc_id", text: str = "text", lang: str = "lang") -> list:
    """A bounded sample of labelled rows in hash order of their ids: (text, lang).

    Ranking sees ids and languages alone; texts are fetched for the chosen ids.
    Of rows that repeat an id and language the smallest text counts; rows with a
    null id, text or language do not. Empty tables give no rows.
    """
    own = docs.filter(train & F.col(lang).isNotNull() & F.col(text).isNotNull())
    order = F.md5(F.concat(F.lit("language|"), F.coalesce(F.col(key).cast("string"), F.lit("null"))).cast("binary"))
    ranked = (own.select(F.col(key).alias("k"), F.col(lang).alias("l"), order.alias("o"))
              .withColumn("n", F.row_number().over(Window.partitionBy("l").orderBy("o")))
              .filter(F.col("n") <= per_language).orderBy("n", "l").limit(max_rows).select("k"))
    ids = [r["k"] for r in ranked.collect()]  # max_rows ids at most
    rows = (own.filter(F.col(key).isin([i for i in ids if i is not None]) if ids else F.lit(False))
            .groupBy(order.alias("o"), F.col(lang).alias("l")).agg(F.min(text).alias("t")).collect())  # one row an id and language
    rows.sort(key=lambda r: (r["o"], r["l"], r["t"]))
    return [(r["t"], r["l"]) for r in rows]


def predict(docs: DataFrame, model: LanguageModel, keep: list | None = None, text: str = "text") -> DataFrame:
    """The columns ``keep`` (default: all) with (lang_pred, score) for each row of ``docs``.

    A null text and one without a letter is ``und`` with score 0, and so is
    every text if nothing could be learned. Columns of these two names are replaced.
    """
    names = [c for c in (keep or docs.columns) if c not in ("lang_pred", "score")]
    own = docs.select(*names, F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present = Presence()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                texts = rows.column(len(names)).to_pylist()
                known = [i for i, t in enumerate(texts) if model.languages and t and any(map(str.isalpha, t))]
                labels, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
                if known:
                    s = model.scores([present(texts[i]) for i in known])
                    best = s.argmax(axis=1)
                    scores[known] = np.clip((s[np.arange(len(known)), best] + 1) / 2, 0, 1)
                    for i, b in zip(known, best):
                        labels[i] = model.languages[b]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:len(names)], pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                    names=[*names, "lang_pred", "score"])

    return own.mapInArrow(run, f"{schema}, lang_pred string, score double")
