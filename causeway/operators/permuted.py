"""Rows of which one feature has taken another row's value, scored by fitted classifiers inside tasks.

A classifier says what of a value counts: trees only where it lies between their thresholds, a linear model the value
itself. Rows travel as these entries. Equal rows, equal changes of a row, and trees that end in the same leaves are
each evaluated once in a block of rows; of a changed row only the trees whose path meets the feature are walked
again, from there on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import SparkSession

from .prefixes import Tree, stored_trees

# Dense entries (rows x features, or rows x trees) of a block.
ENTRIES = 1 << 21
# Counts after which those of the same score are added up.
MANY = 1 << 20
# Different scores of a label in a range of them.
IN_RANGE = 2_000
COUNT = np.dtype([("spot", "<i4"), ("score", "<f8"), ("pos", "<i8"), ("neg", "<i8")])


def in_order(shares: np.ndarray) -> np.ndarray:
    """Rows scaled to sum 1, summed from the first class to the last."""
    total = np.zeros(len(shares))
    for c in range(shares.shape[1]):
        total = total + shares[:, c]
    return np.divide(shares, total[:, None], out=np.zeros_like(shares), where=total[:, None] != 0)


class TreeScorer:
    """Trees laid end to end. What counts of a value is its place: how many thresholds of its feature lie below it."""

    def __init__(self, trees: list[Tree], width: int):
        size = np.array([len(t.left) for t in trees], np.int64)
        self.roots, self.width = np.cumsum(size) - size, width
        shift = np.repeat(self.roots, size)
        left, right, feature, threshold = (np.concatenate([getattr(t, k) for t in trees]) for k in ("left", "right", "feature", "threshold"))
        inner = left >= 0
        self.left, self.right = np.where(inner, left + shift, -1), np.where(inner, right + shift, -1)
        self.feature, self.value = np.where(inner, feature, -1), np.concatenate([t.value for t in trees])
        self.cuts = [np.unique(threshold[self.feature == f]) for f in range(width)]
        self.cut = np.zeros(len(left), np.int64)
        for f, cuts in enumerate(self.cuts):
            at = self.feature == f
            self.cut[at] = np.searchsorted(cuts, threshold[at])
        self.used = np.array([len(c) > 0 for c in self.cuts], bool)
        self.zero = np.array([np.searchsorted(c, 0.0) for c in self.cuts], np.int64)
        self.kind = "u2" if max(map(len, self.cuts), default=0) <= 0xFFFF else "u4"
        # Sums of random marks tell sets of leaves apart.
        self.mark = np.random.default_rng(42).integers(0, 1 << 64, len(left), np.uint64)
        self.block = max(1_000, ENTRIES // max(width, len(trees)))

    def counting(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        """What counts of the ``values`` of the features ``at``."""
        out, order = np.zeros(len(at), np.int64), np.argsort(at, kind="stable")
        ends = np.searchsorted(at[order], np.arange(self.width + 1))
        for f in np.flatnonzero(self.used):
            part = order[ends[f]:ends[f + 1]]
            out[part] = np.searchsorted(self.cuts[f], values[part])
        return out

    def cells(self, base: np.ndarray, at: np.ndarray, feature: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(state of each row of ``base``, state of each cell, scores of each state); a cell is row ``at`` with another ``value`` of a feature."""
        n, t = len(base), len(self.roots)
        leaf, keys, nodes = np.tile(self.roots, n), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        going = np.flatnonzero(self.feature[leaf] >= 0)
        while len(going):
            here = leaf[going]
            f = self.feature[here]
            keys.append(f * (n * t) + going)
            nodes.append(here)
            leaf[going] = here = np.where(base[going // t, f] <= self.cut[here], self.left[here], self.right[here])
            going = going[self.feature[here] >= 0]
        # The node at which the path of a row in a tree first meets a feature, by feature, row and tree.
        key, first = np.unique(np.concatenate(keys), return_index=True)
        start = np.concatenate(nodes)[first]
        low = np.searchsorted(key, (feature * n + at) * t)
        count = np.searchsorted(key, (feature * n + at + 1) * t) - low
        ends = np.cumsum(count)
        met = np.repeat(low - (ends - count), count) + np.arange(count.sum())
        slot, other, f, v = key[met] % (n * t), start[met], np.repeat(feature, count), np.repeat(value, count)
        going = np.arange(len(met))
        while len(going):
            here, split = other[going], self.feature[other[going]]
            x = np.where(split == f[going], v[going], base[slot[going] // t, split])
            other[going] = here = np.where(x <= self.cut[here], self.left[here], self.right[here])
            going = going[self.feature[here] >= 0]
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.mark[other] - self.mark[leaf[slot]])])
        own = self.mark[leaf].reshape(n, t).sum(axis=1)
        _, sample, state = np.unique(np.concatenate([own, own[at] + run[ends] - run[ends - count]]), return_index=True, return_inverse=True)
        cell = np.maximum(sample - n, 0)
        leaves = leaf.reshape(n, t)[np.where(sample < n, sample, at[cell] if len(at) else 0)]
        moved = np.where(sample < n, 0, count[cell] if len(at) else 0)
        rows = np.repeat(np.arange(len(sample)), moved)
        pairs = np.repeat((ends - count)[cell] - (np.cumsum(moved) - moved), moved) + np.arange(len(rows)) if len(at) else rows
        leaves[rows, slot[pairs] % t] = other[pairs]
        return state[:n], state[n:], self.scores(leaves)


class ForestScorer(TreeScorer):
    """Class probabilities of a forest."""

    def __init__(self, spark: SparkSession, model):
        super().__init__(stored_trees(spark, model, shares=True), model.numFeatures)
        self.n_classes = model.numClasses

    def scores(self, leaves: np.ndarray) -> np.ndarray:
        # Sums in the order in which Spark forms them, so that equal scores stay equal.
        votes = np.zeros((len(leaves), self.n_classes))
        for k in range(leaves.shape[1]):
            votes = votes + self.value[leaves[:, k]]
        return in_order(votes)


class BoostedScorer(TreeScorer):
    """Class probabilities of one boosted model for each class."""

    def __init__(self, spark: SparkSession, models: list):
        self.weights = [m.treeWeights for m in models]
        super().__init__([t for m in models for t in stored_trees(spark, m, shares=False)], models[0].numFeatures)
        self.n_classes = len(models)

    def scores(self, leaves: np.ndarray) -> np.ndarray:
        shares, k = [], 0
        for weights in self.weights:
            margin = np.zeros(len(leaves))
            for w in weights:
                margin, k = margin + w * self.value[leaves[:, k]], k + 1
            shares.append(1 / (1 + np.exp(-2 * margin)))
        return in_order(np.array(shares).T)


class LinearScorer:
    """Class probabilities of a multinomial logistic model."""

    def __init__(self, model):
        self.coefficients, self.intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
        self.n_classes, self.width = self.coefficients.shape
        self.used = self.coefficients.any(axis=0)
        self.zero, self.kind = np.zeros(self.width), "f8"
        self.block = max(1_000, ENTRIES // (4 * self.width))

    def counting(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        return values

    def scores(self, x: np.ndarray) -> np.ndarray:
        margin = np.einsum("ij,kj->ik", x, self.coefficients) + self.intercepts
        return in_order(np.exp(margin - margin.max(axis=1, keepdims=True)))

    def cells(self, base: np.ndarray, at: np.ndarray, feature: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As for trees; every row and cell has a state of its own."""
        found = [self.scores(base)]
        for a in range(0, len(at), self.block):
            x = base[at[a:a + self.block]]
            x[np.arange(len(x)), feature[a:a + self.block]] = value[a:a + self.block]
            found.append(self.scores(x))
        state = np.arange(len(base) + len(at))
        return state[:len(base)], state[len(base):], np.concatenate(found)


def scorer(spark: SparkSession, classifier):
    """What evaluates a fitted classifier of one of the three kinds."""
    if hasattr(classifier, "coefficientMatrix"):
        return LinearScorer(classifier)
    if hasattr(classifier, "treeWeights"):
        return ForestScorer(spark, classifier)
    return BoostedScorer(spark, [m for m in classifier.stages if hasattr(m, "treeWeights")])


# --- rows as bytes -------------------------------------------------------------

def _entry(judge) -> np.dtype:
    # The high byte first, so that rows sorted by their bytes lie beside similar ones.
    return np.dtype([("at", ">u2" if judge.width <= 0xFFFF else ">u4"), ("value", f">{judge.kind}")])


def packed(batches: Iterator[pa.RecordBatch], judge) -> Iterator[pa.RecordBatch]:
    """Rows with ``code`` in place of ``indices`` and ``values``: the entries that count and do not count as 0."""
    for batch in batches:
        lists = batch.column("indices")
        at = lists.flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        value = judge.counting(at, batch.column("values").flatten().to_numpy(zero_copy_only=False))
        kept = judge.used[at] & (value != judge.zero[at])
        entries = np.zeros(int(kept.sum()), _entry(judge))
        entries["at"], entries["value"] = at[kept], value[kept]
        ends = np.concatenate([[0], np.cumsum(np.bincount(row[kept], minlength=len(lists)))]) * entries.itemsize
        code = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(entries.tobytes())])
        names = [n for n in batch.schema.names if n not in ("indices", "values")]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], code], names=[*names, "code"])


def _dense(column: pa.Array, judge) -> np.ndarray:
    """Rows of what counts, one entry for each feature."""
    entry, (_, offsets, data) = _entry(judge), column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1] if offsets else np.zeros(1, np.int32)
    entries = np.frombuffer(data[int(ends[0]):int(ends[-1])] if data else b"", entry)
    out = np.empty((len(column), judge.width), judge.kind)
    out[:] = judge.zero
    out[np.repeat(np.arange(len(column)), np.diff(ends) // entry.itemsize), entries["at"].astype(np.int64)] = entries["value"]
    return out


def passed_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to the ordered rows of a part: ``given``, the code of the next row of the repeat, null for the last one;
    ``part``; ``head`` for the first row of a repeat."""
    part, held, before = TaskContext.get().partitionId(), None, None

    def ended(rows: pa.RecordBatch, given: pa.Array, first: int | None) -> pa.RecordBatch:
        repeat = rows.column("repeat").to_numpy(zero_copy_only=False)
        head = np.concatenate([[first is None or repeat[0] != first], repeat[1:] != repeat[:-1]])
        return pa.RecordBatch.from_arrays([*rows.columns, given, pa.array(np.full(len(rows), part, np.int32)), pa.array(head)],
                                          names=[*rows.schema.names, "given", "part", "head"])

    for batch in batches:
        if not len(batch):
            continue
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        held = rows.slice(len(rows) - 1)
        if len(rows) > 1:
            repeat = rows.column("repeat").to_numpy(zero_copy_only=False)
            given = rows.column("code").take(pa.array(np.arange(1, len(rows)), mask=repeat[1:] != repeat[:-1]))
            yield ended(rows.slice(0, len(rows) - 1), given, before)
            before = int(repeat[-2])
    if held is not None:
        yield ended(held, pa.nulls(1, pa.binary()), before)


# --- counts by score -----------------------------------------------------------

def _added(key: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys in order with the sums of both counts, those of nothing left out."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=key[:1] - 1))
    if len(first):
        key, pos, neg = key[first], np.add.reduceat(pos[order], first), np.add.reduceat(neg[order], first)
    kept = (pos != 0) | (neg != 0)
    return key[kept], pos[kept], neg[kept]


def _counts(spot, score, pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
    out = np.empty(len(pos), COUNT)
    out["spot"], out["score"], out["pos"], out["neg"] = spot, score, pos, neg
    return out


class Held:
    """Counts, those of the same spot and score added up when they have become many, so that only different ones pile up."""

    def __init__(self):
        self.parts, self.size, self.most = [np.empty(0, COUNT)], 0, MANY

    def add(self, counts: np.ndarray) -> None:
        self.parts.append(counts)
        self.size += len(counts)
        if self.size > self.most:
            self.most = max(MANY, 2 * len(self.summed()))

    def summed(self) -> np.ndarray:
        """All of them by spot and score."""
        rows = np.concatenate(self.parts)
        rows = rows[np.lexsort((rows["score"], rows["spot"]))]
        new = np.ones(len(rows), bool)
        new[1:] = (rows["spot"][1:] != rows["spot"][:-1]) | (rows["score"][1:] != rows["score"][:-1])
        first = np.flatnonzero(new)
        out = rows[first]
        for k in ("pos", "neg") if len(first) else ():
            out[k] = np.add.reduceat(rows[k], first)
        out = out[(out["pos"] != 0) | (out["neg"] != 0)]
        self.parts, self.size = [out], len(out)
        return out


def _by_label(scores: np.ndarray, state: np.ndarray, spot: np.ndarray, truth: np.ndarray, n: np.ndarray, per_class: bool,
              digits: int | None) -> Iterator[tuple[int, np.ndarray]]:
    """(label, counts) of ``n`` rows in a state: for each class by its score, or of right and wrong predictions."""
    if not per_class:
        own = scores.argmax(axis=1)[state] == truth
        found, pos, neg = _added(spot, np.where(own, n, 0), np.where(own, 0, n))
        yield 0, _counts(found, 0.0, pos, neg)
        return
    value = scores if digits is None else np.round(scores, digits)
    for k in range(value.shape[1]):
        levels, rank = np.unique(value[:, k], return_inverse=True)
        own = truth == k
        found, pos, neg = _added(spot * len(levels) + rank[state], np.where(own, n, 0), np.where(own, 0, n))
        yield k, _counts(found // len(levels), levels[found % len(levels)], pos, neg)


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for batch in batches:
        held, n = [*held, batch], n + len(batch)
        if n >= rows:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            yield from (whole.slice(a, rows) for a in range(0, n // rows * rows, rows))
            held, n = [whole.slice(n // rows * rows)], n % rows
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in names]


def plain(batches: Iterator[pa.RecordBatch], judge, per_class: bool, digits: int | None) -> Iterator[pa.RecordBatch]:
    """Rows (label, score, pos, neg) of ``n`` equal rows (truth, code)."""
    none = np.zeros(0, np.int64)
    for block in _blocks(batches, judge.block):
        state, _, scores = judge.cells(_dense(block.column("code"), judge), none, none, none)
        truth, n = _numbers(block, "truth", "n")
        for k, rows in _by_label(scores, state, np.zeros_like(truth), truth, n, per_class, digits):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), k, np.int32)), *(pa.array(np.ascontiguousarray(rows[c])) for c in ("score", "pos", "neg"))],
                                             names=["label", "score", "pos", "neg"])


def _dealt(label: int, counts: np.ndarray, splits: list[float], whole: bool) -> pa.RecordBatch:
    """Counts of a label by ranges of its scores, as bytes: rows (label, range, whole, counts)."""
    at = np.searchsorted(splits, counts["score"], side="right")
    order = np.argsort(at, kind="stable")
    counts = counts[order]
    ranges, first = np.unique(at[order], return_index=True)
    parts = [counts[a:b].tobytes() for a, b in zip(first, [*first[1:], len(at)])]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(parts), label, np.int32)), pa.array(ranges.astype(np.int32)),
                                       pa.array(np.full(len(parts), whole)), pa.array(parts, pa.binary())], names=["label", "range", "whole", "counts"])


def graded(batches: Iterator[pa.RecordBatch], splits: dict[int, list[float]]) -> Iterator[pa.RecordBatch]:
    """Rows (label, score, pos, neg) by ranges."""
    for batch in batches:
        label, pos, neg = _numbers(batch, "label", "pos", "neg")
        score = batch.column("score").to_numpy(zero_copy_only=False)
        for k in np.unique(label).tolist():
            own = label == k
            yield _dealt(k, _counts(0, score[own], pos[own], neg[own]), splits[k], True)


def range_sums(batches: Iterator[pa.RecordBatch], splits: dict[int, list[float]]) -> Iterator[pa.RecordBatch]:
    """Rows (label, range, pos, neg) of the counts of a batch."""
    for batch in batches:
        label, pos, neg = _numbers(batch, "label", "pos", "neg")
        score = batch.column("score").to_numpy(zero_copy_only=False)
        at = np.zeros(len(label), np.int64)
        for k in np.unique(label).tolist():
            at[label == k] = np.searchsorted(splits[k], score[label == k], side="right")
        key, pos, neg = _added(label << 32 | at, pos, neg)
        yield pa.RecordBatch.from_arrays([pa.array((key >> 32).astype(np.int32)), pa.array((key & 0xFFFFFFFF).astype(np.int32)), pa.array(pos), pa.array(neg)],
                                         names=["label", "range", "pos", "neg"])


def changed(batches: Iterator[pa.RecordBatch], judge, listed: np.ndarray, repeats: int, splits: dict[int, list[float]], per_class: bool,
            digits: int | None) -> Iterator[pa.RecordBatch]:
    """What the counts lose and gain when rows (repeat, truth, code) take each of the ``listed`` features from ``given``,
    by ranges of the scores; a spot is a feature and a repeat."""
    held: dict[int, Held] = {}
    for block in _blocks(batches, judge.block):
        code, given = (_dense(block.column(k), judge) for k in ("code", "given"))
        repeat, truth = _numbers(block, "repeat", "truth")
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]).any(axis=1)
        base, which = code[new], np.cumsum(new) - 1
        row, f = np.nonzero((code != given) & listed)
        if not len(row):
            continue
        values, taken = np.unique(given[row, f], return_inverse=True)
        cells, cell = np.unique((f * len(base) + which[row]) * len(values) + taken, return_inverse=True)
        changes, taken = np.divmod(cells, len(values))
        before, after, scores = judge.cells(base, changes % len(base), changes // len(base), values[taken])
        before, after = before[which[row]], after[cell]
        moves = before != after
        # Many rows come to the same leaves: those of a spot and a class of truth are added up first.
        own = (f[moves] * repeats + repeat[row[moves]]) * (judge.n_classes + 1) + truth[row[moves]] + 1
        key, n, _ = _added(np.concatenate([own * len(scores) + before[moves], own * len(scores) + after[moves]]),
                           np.repeat([-1, 1], len(own)), np.zeros(2 * len(own), np.int64))
        own, state = np.divmod(key, len(scores))
        spot, own = np.divmod(own, judge.n_classes + 1)
        for k, counts in _by_label(scores, state, spot, own - 1, n, per_class, digits):
            held.setdefault(k, Held()).add(counts)
        # Blocks side by side hold similar rows, so that much of their counts is of the same scores.
        if sum(h.size for h in held.values()) > 2 * MANY and sum(len(h.summed()) for h in held.values()) > MANY:
            yield from (_dealt(k, held.pop(k).summed(), splits[k], False) for k in list(held))
    yield from (_dealt(k, h.summed(), splits[k], False) for k, h in held.items())


def settled(batches: Iterator[pa.RecordBatch], label: int, part: int, below: int, above: int, repeats: int) -> pa.RecordBatch:
    """What a range of the scores of a label adds to the pairs in the right order: rows (label, range, feature, repeat, twice, pos, neg).

    ``below`` negatives have lower and ``above`` positives higher scores than the range. ``twice`` the pairs are those of
    moved rows with all, of all with moved ones and of moved ones with each other, as far as these lie in the range.
    """
    held = {True: Held(), False: Held()}
    for batch in batches:
        for w, counts in zip(batch.column("whole").to_pylist(), batch.column("counts")):
            held[w].add(np.frombuffer(counts.as_buffer(), COUNT).copy())
    whole, moved = held[True].summed(), held[False].summed()
    score, pos, neg = (moved[k] for k in ("score", "pos", "neg"))
    low, high = (np.searchsorted(whole["score"], score, side=s) for s in ("left", "right"))
    all_pos, all_neg = (np.concatenate([[0], np.cumsum(whole[k])]) for k in ("pos", "neg"))
    spots, first, size = np.unique(moved["spot"], return_index=True, return_counts=True)
    run = np.cumsum(neg) - neg
    before = run - np.repeat(run[first], size)
    twice = (pos * (2 * below + all_neg[low] + all_neg[high] + 2 * before + neg)
             + neg * (2 * above + 2 * all_pos[-1] - all_pos[low] - all_pos[high]))
    sums = [np.add.reduceat(v, first) if len(first) else v for v in (twice, pos, neg)]
    keys = [np.full(len(spots), label), np.full(len(spots), part), *np.divmod(spots, repeats)]
    return pa.RecordBatch.from_arrays([*(pa.array(v.astype(np.int32)) for v in keys), *(pa.array(np.ascontiguousarray(v)) for v in sums)],
                                      names=["label", "range", "feature", "repeat", "twice", "pos", "neg"])
