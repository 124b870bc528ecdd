"""Near-duplicates by ProbMinHash: classes of texts whose shingles overlap by 0.8 or more.

A text is the bag of its five-word shingles. Elements arrive in Poisson
processes with their counts as rates; each arrival picks a register, a register
keeps its first arrival, and the process ends once no arrival can change a
register. Two registers are equal with the probability Jaccard similarity of
the bags. Bands of registers give candidates, and the similarity of a candidate
pair is computed from both bags.

Equal word sequences are one node from the start. The nodes of a band bucket go
to one place with their bags, which returns the links that join what belongs
together, not its pairs. A bucket of many shingles is dealt twice to chunks of
bounded size, by two hashes: copies in one chunk of either deal join, so a group
of thousands costs one chunk of comparisons each. Where such a bucket then still
holds several classes, the nodes outside the largest one meet all others in
blocks. So no pair that shares a bucket and is similar enough ends up in
different classes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bags import shingle_bags, word_lists
from .common import arrow_rows, cut, lean, text_key

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
CHUNK_ELEMENTS = 1 << 18
# Chunks of buckets, and each side of a block, hold about so many shingles.
BLOCK_SHINGLES = 1 << 18
LINKS_PER_BATCH = 1 << 14

GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64: well-mixed 64-bit values from 64-bit values."""
    x = x + GOLD
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, m: int = BANDS * ROWS) -> np.ndarray:
    """(n, m) registers of ``n`` bags, each the element that came first. ``owner`` says which bag an element is in; every bag has an element."""
    first = np.full(n * m, np.inf)
    kept = np.zeros(n * m, np.uint64)
    at = np.zeros(len(elements))
    state, weight, own, element = elements.copy(), weights.astype(np.float64), owner, elements
    while len(state):
        state = mix64(state)
        uniform = ((state >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
        at = at - np.log(uniform) / weight
        place = own * m + (mix64(state ^ GOLD) % np.uint64(m)).astype(np.int64)
        better = np.flatnonzero(at < first[place])
        np.minimum.at(first, place[better], at[better])
        won = better[at[better] == first[place[better]]]
        kept[place[won]] = element[won]
        # Later arrivals of an element only come later: it ends once it is behind every register of its bag.
        alive = np.flatnonzero(at < first.reshape(n, m).max(axis=1)[own])
        state, at, weight, own, element = state[alive], at[alive], weight[alive], own[alive], element[alive]
    return kept.reshape(n, m)


def band_keys(registers: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """(n, bands) 64-bit keys; the band number is part of the key."""
    n, m = registers.shape
    parts = registers.reshape(n, bands, m // bands)
    out = np.broadcast_to(np.arange(bands, dtype=np.uint64), (n, bands)).copy()
    for r in range(m // bands):
        out = mix64(out ^ parts[:, :, r])
    return out.astype(np.int64)


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Exact similarity of two bags: sorted distinct elements ``a``, ``b`` with counts ``x``, ``y``.

    The sum over shared elements i of 1 / sum_j max(x_j / x_i, y_j / y_i). With
    elements in the order of x_j / y_j, the inner sum is a tail of x and a head of y.
    """
    if not len(a) or not len(b):
        return 0.0
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    x, y = x.astype(np.float64), y.astype(np.float64)
    if not len(at_a):
        return 0.0
    if x.max() == 1 and y.max() == 1:
        return len(at_a) / (len(a) + len(b) - len(at_a))
    sx, sy = x[at_a], y[at_b]
    only_x, only_y = x.sum() - sx.sum(), y.sum() - sy.sum()
    ratio = sx / sy
    order = np.argsort(ratio, kind="stable")
    sx, sy, ratio = sx[order], sy[order], ratio[order]
    start = np.searchsorted(ratio, ratio, "left")  # elements from here on have as high a ratio
    head_y = np.concatenate([[0.0], np.cumsum(sy)])[start]
    tail_x = sx.sum() - np.concatenate([[0.0], np.cumsum(sx)])[start]
    return float((1 / ((tail_x + only_x) / sx + (head_y + only_y) / sy)).sum())


def sketch(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, text_key, digest, width, bands): ``width`` distinct shingles; null but for the keys where a text has no words."""
    own = docs.select(F.col(key).cast("long").alias("key"), text_key(F.col(text)).alias("text_key"), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                yield _sketched(rows.column(0), rows.column(1), word_lists(rows.column(2).to_pylist()))

    return own.mapInArrow(lean(run), "key long, text_key long, digest binary, width int, bands array<long>")


def _sketched(keys: pa.Array, text_keys: pa.Array, lists: list[list[str]]) -> pa.RecordBatch:
    n = len(lists)
    digests = [hashlib.blake2b(" ".join(w).encode("utf-8", "surrogatepass"), digest_size=16).digest() if w else None
               for w in lists]
    widths: list = [None] * n
    bands: list = [None] * n
    some, held = [], 0

    def flush() -> None:
        bags = [shingle_bags(lists[i], SHINGLE) for i in some]
        owner = np.repeat(np.arange(len(some)), [len(b[0]) for b in bags])
        sig = signatures(np.concatenate([b[0] for b in bags]), np.concatenate([b[1] for b in bags]), owner, len(some))
        for i, bag, k in zip(some, bags, band_keys(sig)):
            widths[i], bands[i] = len(bag[0]), k
        some.clear()

    for i, w in enumerate(lists):
        if w:
            some.append(i)
            held += len(w)
            if held >= CHUNK_ELEMENTS:
                flush()
                held = 0
    if some:
        flush()
    return pa.RecordBatch.from_arrays(
        [keys.cast(pa.int64()), text_keys.cast(pa.int64()), pa.array(digests, pa.binary()),
         pa.array(widths, pa.int32()), pa.array(bands, pa.list_(pa.int64()))],
        names=["key", "text_key", "digest", "width", "bands"])


def shorter(e: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A bag with the upper half of each element; elements that fall together add up.

    Two texts of a thousand shingles share one more by chance in one of 4,000
    cases, which moves their similarity by a thousandth.
    """
    half = (e >> np.uint64(32)).astype(np.uint32)  # sorted like the elements
    starts = np.flatnonzero(np.concatenate([[True], half[1:] != half[:-1]]))
    return half[starts], np.add.reduceat(c, starts)


def bags_of(ids: DataFrame, nodes: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, elements, counts) of the nodes ``ids``, made from their texts: elements of 32 bits; no counts where all are one."""
    places = nodes.select("id", "key", "text_key").join(ids, "id")
    source = docs.select(F.col(key).cast("long").alias("d_key"), text_key(F.col(text)).alias("d_text"), F.col(text).alias("t"))
    texts = source.join(places, source["d_key"].eqNullSafe(places["key"]) & (source["d_text"] == places["text_key"]))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                made = [shorter(*shingle_bags(w, SHINGLE)) for w in word_lists(rows.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).cast(pa.int64()), pa.array([e.tobytes() for e, _ in made], pa.binary()),
                     pa.array([b"" if c.max() == 1 else c.astype("<u4").tobytes() for _, c in made], pa.binary())],
                    names=["id", "elements", "counts"])

    # Rows that repeat a key and text give one bag.
    return cut(texts.select("id", "t").mapInArrow(lean(bags), "id long, elements binary, counts binary").dropDuplicates(["id"]))


def bag_from(elements: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    e = np.frombuffer(elements, "<u4")
    return e, np.frombuffer(counts, "<u4") if counts else np.ones(len(e), np.uint32)


def components(edges: DataFrame) -> DataFrame:
    """(id, label): each node of the edges (a, b) with the smallest node it is connected to.

    Every round hooks labels along edges and then follows labels of labels, so
    chains halve in length; edges inside a label are left out of the next round.
    """
    ends = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    labels = cut(ends.select("id", F.col("id").alias("label")))
    live = edges.select("a", "b")
    while True:
        a = labels.select(F.col("id").alias("a"), F.col("label").alias("la"))
        b = labels.select(F.col("id").alias("b"), F.col("label").alias("lb"))
        live = cut(live.join(a, "a").join(b, "b").filter("la <> lb")
                   .select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct())
        if live.isEmpty():
            return labels
        # Labels are nodes: the larger of two met labels takes the smallest one it meets.
        hook = live.groupBy(F.greatest("a", "b").alias("id")).agg(F.min(F.least("a", "b")).alias("to"))
        step = cut(labels.filter("id = label").join(hook, "id", "left")
                   .select("id", F.coalesce("to", "id").alias("to")))
        changed = True
        while changed:  # roots of the hooks
            up = step.select(F.col("id").alias("to"), F.col("to").alias("up"))
            step = cut(step.join(up, "to").select("id", F.col("up").alias("to"), (F.col("up") < F.col("to")).alias("moved")))
            changed = not step.filter("moved").isEmpty()
        roots = step.select(F.col("id").alias("label"), F.col("to").alias("root"))
        labels = cut(labels.join(roots, "label").select("id", F.col("root").alias("label")))


def joined_labels(side: np.ndarray, start: np.ndarray, bags: list, similarity: float) -> np.ndarray:
    """Labels after the nodes of side 0 have met those of side 1; side 2 is on both.

    A node is compared with all nodes that can still add a link: those of other
    classes it has not met. A class is gone through before the next one is
    begun, so whoever joined it leaves the comparisons of its members.
    """
    label = start.copy()
    mine, other = side != 1, side > 0
    if len(label) <= 3:
        for u in np.flatnonzero(mine):
            for v in np.flatnonzero(other):
                if label[u] != label[v] and probability_jaccard(*bags[u], *bags[v]) >= similarity:
                    label[label == label[v]] = label[u]
        return label
    # Shingles numbered in the block, so that a table of counts answers which of them a node shares.
    kinds, number = np.unique(np.concatenate([e for e, _ in bags]), return_inverse=True)
    own = np.split(number, np.cumsum([len(e) for e, _ in bags])[:-1])
    count_of = np.zeros(len(kinds))
    total = np.array([c.sum() for _, c in bags], np.float64)
    plain = np.array([c.max() == 1 for _, c in bags])
    done, held = np.zeros(len(label), bool), np.zeros(len(label), bool)
    current = None
    while True:
        left = np.flatnonzero(mine & ~done)
        if not len(left):
            return label
        same = left[label[left] == current] if current is not None else left[:0]
        u = same[0] if len(same) else left[0]
        current, done[u] = label[u], True
        open_ = other & (label != current)
        if other[u]:
            open_ &= ~done
        if not open_.any():
            continue
        if 2 * open_.sum() < held.sum() or (open_ & ~held).any():
            held = open_.copy()
            at = np.flatnonzero(held)
            flat = np.concatenate([own[v] for v in at])
            weight = np.concatenate([bags[v][1] for v in at]).astype(np.float64)
            starts = np.cumsum([0] + [len(own[v]) for v in at])[:-1]
        e, c = bags[u]
        count_of[own[u]] = c
        got = count_of[flat]
        count_of[own[u]] = 0
        shared = np.add.reduceat(got, starts)
        if plain[u]:  # for two bags without repeats this is the similarity
            bound = shared / (total[u] + total[at] - shared)
        if not (plain[u] and plain[at].all()):
            # No similarity exceeds the share of either bag that the other one has.
            most = np.minimum((shared + 1e-9) / total[u], (np.add.reduceat(np.where(got > 0, weight, 0), starts) + 1e-9) / total[at])
            bound = np.where(plain[at], bound, most) if plain[u] else most
        near = np.flatnonzero(open_[at] & (bound >= similarity))
        for k in near[np.argsort(-bound[near], kind="stable")]:
            v = at[k]
            if label[v] != current and (plain[u] and plain[v] or probability_jaccard(e, c, *bags[v]) >= similarity):
                label[label == label[v]] = current


def links(dealt: DataFrame, similarity: float) -> DataFrame:
    """(a, b), a > b: links between the labels that meet in the blocks (bucket, i, j) of ``dealt``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
        a: list[int] = []
        b: list[int] = []
        for _, block in groupby(rows, lambda r: r[:3]):
            _, _, _, side, label, elements, counts = zip(*block)
            start = np.array(label, np.int64)
            if (start == start[0]).all():
                continue
            end = joined_labels(np.array(side), start, [bag_from(*x) for x in zip(elements, counts)], similarity)
            least = {}
            for x, y in zip(start.tolist(), end.tolist()):
                least[y] = min(x, least.get(y, x))
            for x, y in set(zip(start.tolist(), end.tolist())):
                if x != least[y]:
                    a.append(x)
                    b.append(least[y])
            if len(a) >= LINKS_PER_BATCH:
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
                a, b = [], []
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return (dealt.select("bucket", "i", "j", "side", "label", "elements", "counts")
            .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
            .mapInArrow(lean(run), "a long, b long").distinct())


def dealt_chunks(shared: DataFrame) -> DataFrame:
    """Rows of the buckets dealt to chunks of bounded size, once where one chunk is enough, else twice by two hashes."""
    n = F.ceil(F.col("width") / BLOCK_SHINGLES).cast("int")

    def chunk(deal: int) -> Column:
        return F.struct(F.pmod(F.xxhash64("id", F.lit(deal)), n).cast("int").alias("i"), F.lit(deal).alias("j"))
    return (shared.withColumn("spot", F.explode(F.when(n > 1, F.array(chunk(0), chunk(1))).otherwise(F.array(chunk(0)))))
            .select("bucket", "spot.*", "id", F.lit(2).alias("side"), F.col("id").alias("label")))


def dealt_blocks(rows: DataFrame) -> DataFrame:
    """Rows of buckets with several classes dealt to the blocks (i, j) of their bucket.

    Nodes outside the largest class are side 0, all nodes are side 1, and side
    2 is both; every node of the one meets every node of the other in one block.
    """
    placed = (rows.withColumn("n_left", F.ceil((F.col("width") - F.col("major_width")) / BLOCK_SHINGLES).cast("int"))
              .withColumn("n_right", F.ceil(F.col("width") / BLOCK_SHINGLES).cast("int"))
              .withColumn("place", F.abs(F.xxhash64("id", "bucket"))))
    i, j = (F.col("place") % F.col("n_left")).cast("int"), (F.col("place") % F.col("n_right")).cast("int")
    left = F.transform(F.sequence(F.lit(0), F.col("n_right") - 1),
                       lambda k: F.struct(F.when(k == j, 2).otherwise(0).alias("side"), i.alias("i"), k.alias("j")))
    right = F.transform(F.sequence(F.lit(0), F.col("n_left") - 1),
                        lambda k: F.struct(F.lit(1).alias("side"), k.alias("i"), j.alias("j")))
    spots = F.when(F.col("label") != F.col("major"), F.concat(left, F.filter(right, lambda s: s["i"] != i))).otherwise(right)
    return placed.select("bucket", "id", "label", F.explode(spots).alias("spot")).select("bucket", "spot.*", "id", "label")


def _several(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several classes: (id, bucket, label, width), and the largest class and its shingles."""
    placed = shared.drop("width").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    whole = (placed.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("own_width").alias("width"))
             .groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("width").alias("width"),
                                    F.max(F.struct("n", "label", "width")).alias("m")).filter("m.n < n")
             .select("bucket", "width", F.col("m.label").alias("major"), F.col("m.width").alias("major_width")))
    return placed.join(whole, "bucket")


def _classes(docs: DataFrame, similarity: float, key: str, text: str) -> DataFrame:
    """Rows (key, text_key, node, class_id, class_rows), one for each row of ``docs``."""
    with arrow_rows(docs.sparkSession, 1_000):  # texts and bags are large: few at a time beside each worker
        return _joined(docs, similarity, key, text)


def _joined(docs: DataFrame, similarity: float, key: str, text: str) -> DataFrame:
    rows = cut(sketch(docs, key, text))
    one = F.first(F.struct("key", "text_key", "width", "bands")).alias("one")
    nodes = cut(rows.filter(F.col("digest").isNotNull()).groupBy("digest")
                .agg(one, F.min("key").alias("least"), F.count(F.lit(1)).alias("copies"))
                .select("digest", "one.*", "least", "copies").withColumn("id", F.monotonically_increasing_id()))
    dealt = nodes.select("id", F.col("width").cast("long").alias("own_width"), F.explode("bands").alias("bucket"))
    several = (dealt.groupBy("bucket").agg(F.sum("own_width").alias("width"), F.count(F.lit(1)).alias("n"))
               .filter("n > 1").drop("n"))
    shared = cut(dealt.join(several, "bucket"))  # only buckets of two or more nodes
    bag = bags_of(shared.select("id").distinct(), nodes, docs, key, text)
    labels = components(cut(links(dealt_chunks(shared).join(bag, "id"), similarity)))
    # Buckets of several chunks whose classes did not all meet.
    open_ = cut(_several(shared.filter(F.col("width") > BLOCK_SHINGLES), labels))
    if not open_.isEmpty():
        joined = components(cut(links(dealt_blocks(open_).join(bag, "id"), similarity)))
        labels = (shared.select("id").distinct().join(labels, "id", "left")
                  .select("id", F.coalesce("label", "id").alias("label"))
                  .join(joined.select(F.col("id").alias("label"), F.col("label").alias("to")), "label", "left")
                  .select("id", F.coalesce("to", "label").alias("label")))
    final = (nodes.select("id", "digest", "least", "copies").join(labels, "id", "left")
             .select("digest", "least", "copies", F.coalesce("label", "id").alias("node")))
    # Fixed before it is joined, so that the rows of a large class can be split among tasks.
    classes = cut(final.groupBy("node").agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_rows")))
    found = final.select("digest", "node").join(classes, "node")
    return (rows.select("key", "text_key", "digest").join(found, "digest", "left")
            .select("key", "text_key", "node",
                    F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("class_rows", F.lit(1)).alias("class_rows")))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: (key, text_key, class_id, class_rows).

    ``class_id`` is the smallest key of the class, ``class_rows`` its number of
    rows. A text of fewer than five words is one shingle. A text without words
    (null, empty, signs only) is in no class: its ``class_id`` is its own key.
    Rows with a null key take part; a class of such rows alone has a null
    ``class_id``. Rows that repeat a key are compared by their texts like any
    others. Other columns are not looked at. An empty table gives an empty result.
    """
    return _classes(docs, similarity, key, text).select(F.col("key").alias(key), "text_key", "class_id", "class_rows")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class with the columns of ``docs``: the one of the smallest key, of equal keys the first text.

    Texts without words (null, empty, signs only) stay as they are. A null key is
    smaller than no key: a class keeps a row with a key if it has one. Of rows that
    repeat a key and text one stays. Columns may have any name. An empty table gives an empty result.
    """
    found = cut(_classes(docs, similarity, key, text))
    # The rows that stay, by key and text: of each class its smallest key, there its smallest text key.
    alone = found.filter("class_rows = 1").select(F.col("key").alias("n_key"), F.col("text_key").alias("n_text"))
    chosen = (found.filter((F.col("class_rows") > 1) & F.col("key").eqNullSafe(F.col("class_id"))).groupBy("node")
              .agg(F.first("key").alias("n_key"), F.min("text_key").alias("n_text")).select("n_key", "n_text"))
    stay = alone.withColumn("n_many", F.lit(False)).union(chosen.withColumn("n_many", F.lit(True))).distinct()
    match = docs[key].eqNullSafe(stay["n_key"]) & (text_key(docs[text]) == stay["n_text"])
    once = docs.join(stay.filter("n_many"), match, "left_semi").dropDuplicates([key, text])
    return docs.join(stay.filter("NOT n_many"), match, "left_semi").unionByName(once)
