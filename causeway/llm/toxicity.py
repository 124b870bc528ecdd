"""Toxicity of texts: a recurrent network over all overlapping windows, trained in numpy.

Texts are read in windows of 40 words that overlap by half; a text scores as
its worst window. Labels are known for texts, not for windows: after a first
round in which windows carry their text's label, only the worst window of each
text is trained on, with the windows chosen anew each round. Training sees a
bounded sample of labelled rows; scoring covers every window of every text.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bigru import PAD, Adam, BiGru

WINDOW, STRIDE = 40, 20
PER_LABEL = 700  # labelled rows of each label to fit on
FIRST_WINDOWS = 10_000  # windows of the first round
ROUNDS = 5
BATCH = 64
LEAST_UPDATES = 40  # of a round: small samples are gone through again
VOCABULARY = 4_000
DROP_WORD = 0.5
PREDICTED = 0.7

_WORD = re.compile(r"\w+")


def numbered(texts: list[str | None]) -> tuple[list[str], list[np.ndarray]]:
    """(distinct words, word numbers of each text)."""
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__  # a new word gets the next number
    lists = [_WORD.findall((t or "").lower()) for t in texts]
    ids = [np.fromiter(map(number.__getitem__, words), np.int32, len(words)) for words in lists]
    return list(number), ids


def windows_of(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(windows padded to ``WINDOW``, the text each belongs to); the last window may be short, none is left out."""
    rows, owner = [], []
    for i, x in enumerate(ids):
        if not len(x):
            continue
        n = max(1, -(-(len(x) - WINDOW) // STRIDE) + 1) if len(x) > WINDOW else 1
        padded = np.full((n - 1) * STRIDE + WINDOW, PAD, np.int32)
        padded[:len(x)] = x
        rows.append(np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE])
        owner.append(np.full(n, i))
    if not rows:
        return np.zeros((0, WINDOW), np.int32), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(owner)


def scores_of(model: BiGru, texts: list[str | None], chunk: int = 4096) -> np.ndarray:
    """The score of each text; one without words scores 0."""
    words, ids = numbered(texts)
    out = np.zeros(len(texts))
    windows, owner = windows_of(ids)
    if len(windows):
        table = model.table(words)
        for at in range(0, len(windows), chunk):
            np.maximum.at(out, owner[at:at + chunk], model.forward(table, windows[at:at + chunk]).astype(float))
    return out


def fit_toxicity(texts: list[str], labels: list[int], rounds: int = ROUNDS, first_windows: int = FIRST_WINDOWS,
                 seed: int = 7) -> BiGru | None:
    """Train on labelled texts in a fixed order; None if a label is absent."""
    r = np.random.default_rng(seed)
    words, ids = numbered(texts)
    y = np.asarray(labels, np.float32)
    if not len(words) or not (0 < y.sum() < len(y)):
        return None
    spread = Counter(w for x in ids for w in set(x.tolist()))
    common = [words[k] for k, n in sorted(spread.items(), key=lambda kv: (-kv[1], words[kv[0]])) if n >= 3][:VOCABULARY]
    model = BiGru.fresh({w: i + 1 for i, w in enumerate(common)}, seed)
    windows, owner = windows_of(ids)
    adam = Adam(model.p, 0.01)

    def train(chosen: np.ndarray) -> None:
        n_all, n_bad = len(chosen), max(1, int(y[owner[chosen]].sum()))
        passes = -(-LEAST_UPDATES * BATCH // len(chosen))
        chosen = np.concatenate([r.permutation(chosen) for _ in range(passes)])
        for at in range(0, len(chosen), BATCH):
            some = chosen[at:at + BATCH]
            used, local = np.unique(windows[some], return_inverse=True)
            local = local.reshape(len(some), WINDOW)
            if used[0] == PAD:
                used, local = used[1:], local - 1
            table = model.table([words[k] for k in used], r.random(len(used)) < DROP_WORD)
            target = y[owner[some]]
            weight = np.where(target > 0, max(1, n_all - n_bad) / n_bad, 1.0).astype(np.float32)
            adam.update(model.p, model.gradients(table, local, target, weight))

    train(r.choice(len(windows), min(first_windows, len(windows)), replace=False))
    for k in range(rounds):
        adam.rate = 0.01 if k < rounds // 2 else 0.004
        table = model.table(words)
        s = np.concatenate([model.forward(table, windows[a:a + 4096]) for a in range(0, len(windows), 4096)])
        order = np.lexsort((-s, owner))
        worst = order[np.unique(owner[order], return_index=True)[1]]
        # Clean texts also give their other windows that look bad: none of them may score high.
        false = np.flatnonzero((y[owner] == 0) & (s > 0.3))
        train(np.concatenate([worst, np.setdiff1d(false, worst)]))
    return model


def training_rows(docs: DataFrame, labels: DataFrame, train, per_label: int = PER_LABEL, key: str = "doc_id",
                  text: str = "text", label: str = "toxic") -> tuple[list[str], list[int]]:
    """A bounded sample of labelled rows, the first of each label in hash order of their ids.

    Of rows that repeat an id the smallest text counts; null texts, null ids and
    labels other than 0 and 1 do not, and an id labelled 1 anywhere is toxic. Empty tables give no rows.
    """
    order = F.md5(F.concat(F.lit("toxicity|"), F.col(key).cast("string")).cast("binary"))
    known = labels.filter(F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).alias("y"))
    rows = []
    for y in (0, 1):
        # A top-k: each task keeps its first rows, and only those meet.
        top = (known.filter(F.col("y") == y).filter(train).withColumn("o", order).orderBy("o").limit(per_label).select(key))
        ids = [r[0] for r in top.collect()]
        found = (docs.filter(F.col(key).isin(ids) & F.col(text).isNotNull() if ids else F.lit(False))
                 .groupBy(order.alias("o")).agg(F.min(text).alias("t")).collect())  # one row an id
        rows += [(r["o"], r["t"], y) for r in found]
    rows.sort()
    return [r[1] for r in rows], [r[2] for r in rows]


def score_texts(docs: DataFrame, model: BiGru | None, keep: list | None = None, text: str = "text",
                predicted: float = PREDICTED) -> DataFrame:
    """The columns ``keep`` (default: all) with (score, predicted) for each row of ``docs``; no shuffle.

    Null, empty and wordless texts score 0, and so does every text without a
    model. Very long texts are scored in all their windows. Columns of these
    two names are replaced. An empty table gives an empty result.
    """
    names = [c for c in (keep or docs.columns) if c not in ("score", "predicted")]
    own = docs.select(*names, F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                texts = rows.column(len(names)).to_pylist()
                s = scores_of(model, texts) if model else np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:len(names)], pa.array(s, pa.float64()), pa.array((s >= predicted).astype(np.int32))],
                    names=[*names, "score", "predicted"])

    return own.mapInArrow(run, f"{schema}, score double, predicted int")
