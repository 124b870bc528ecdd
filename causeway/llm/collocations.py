"""Phrase collocations by dynamic itemset counting.

The corpus is dealt to shards that are scanned in turn, over and over. A scan
counts phrases of all lengths side by side: words from the first scan on, a
longer phrase from the scan after its first and its last words (all but the last
and all but the first) have both reached the threshold. A phrase that has not
reached it is counted under a 64-bit key for one cycle of the shards, then it is
given up; one that has reached it is counted under its words for one full cycle,
which is its exact count. The scans end when every phrase has completed its cycle.

What has reached the threshold, and after which scan, is a table of one byte for
each slot of a fixed number, which is all that is broadcast. A phrase counts as
arrived once its slot is taken: one that shares the slot of another is counted
under its words for a full cycle like any other, and dropped if that count is too
small. So neither slots nor keys can lose a phrase or change a count, and the
number of slots is a matter of speed alone.

Texts are encoded once: chunks of one language with their distinct words and the
numbers of their words, written to the shared folder. All counts are summed
before they are shuffled; no task holds a language, a phrase or a shard.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_rows, cut, shared_path
from .near_dup import mix64

LEAST = 30
LONGEST = 4
TOP = 2_000
SHARDS = 3
SLOT_BITS = 23
# A candidate goes if a longer one around it is found in so many of a hundred of its places.
INSIDE = 80
SCALE = 2_000_000
CHUNK_BYTES = 4 << 20
# Keys a task sums up before it hands them on.
HELD_KEYS = 2_000_000

STEP = np.uint64(0xD6E8FEB86659FD93)
# A-Z in lower case, all ends of pieces as a full stop.
PLAIN = bytes(46 if b in b".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))

ENCODED = "lang string, n_words long, words string, ids binary, shard int"
COUNTED = "key long, lang string, phrase string, c long"


def _encoded(lang: str, data: bytes, shard: int) -> pa.RecordBatch:
    """One chunk: its distinct words in order of first use, and the number of each word; 0 ends a piece."""
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__
    number[b"."]
    tokens = data.replace(b".", b" . ").split()
    ids = np.fromiter(map(number.__getitem__, tokens), np.int32, len(tokens))
    words = b" ".join(list(number)[1:]).decode("utf-8", "surrogatepass")
    return pa.RecordBatch.from_arrays(
        [pa.array([lang]), pa.array([int((ids > 0).sum())], pa.int64()), pa.array([words]),
         pa.array([ids.tobytes()], pa.binary()), pa.array([shard], pa.int32())],
        names=["lang", "n_words", "words", "ids", "shard"])


def encode(docs: DataFrame, path: str, shards: int, lang: str = "lang", text: str = "text") -> None:
    """Write the chunks of all texts, dealt to ``shards``."""
    own = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                      F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = defaultdict(list)
        size: dict[str, int] = defaultdict(int)
        made = TaskContext.get().partitionId()

        def flush(k: str) -> Iterator[pa.RecordBatch]:
            nonlocal made
            data = b".".join(held.pop(k))
            del size[k]
            at = 0
            while at < len(data):  # a long text is cut where a piece ends
                end = len(data) if len(data) - at <= 2 * CHUNK_BYTES else data.find(b".", at + CHUNK_BYTES)
                end = len(data) if end < 0 else end
                yield _encoded(k, data[at:end], made % shards)
                made += 1
                at = end + 1

        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = t.as_py().translate(PLAIN)
                if data:
                    held[k].append(data)
                    size[k] += len(data) + 1
                    if size[k] >= CHUNK_BYTES or len(size) > 64 and sum(size.values()) >= CHUNK_BYTES:
                        yield from flush(max(size, key=size.get))
        for k in list(held):
            yield from flush(k)

    with arrow_rows(docs.sparkSession, 1_000):
        own.mapInArrow(run, ENCODED).write.partitionBy("shard").option("compression", "zstd").parquet(path)


def merged(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their summed counts."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[starts], np.add.reduceat(c, starts) if len(k) else c


def exact_phrases(ids: np.ndarray, starts: np.ndarray, n: int, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct phrases of ``n`` words at ``starts`` and how often each begins there."""
    kinds = len(words)
    code = ids[starts].astype(np.int64)
    for k in range(1, n):
        if k > 1 and kinds ** (k + 1) >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
        code = code * kinds + ids[starts + k]
    _, first, counts = np.unique(code, return_index=True, return_counts=True)
    at = starts[first]
    parts = [words.take(pa.array(ids[at + k])) for k in range(n)]
    return (pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]), counts


def count_chunk(t: int, shards: int, longest: int, slots: np.ndarray, bits: int, lang: str, words: list[str], ids: np.ndarray):
    """What scan ``t`` counts in one chunk: (keys, counts) of phrases still short of the threshold, and (phrases, counts) of arrived ones.

    ``slots`` has 0 for a free slot, else one more than the scan after which it was taken.
    """
    import xxhash
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))
    hashes = np.zeros(len(words) + 1, np.uint64)
    hashes[1:] = np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), seed) for w in words), np.uint64, len(words))
    shift = np.uint64(64 - bits)
    names = pa.array(["", *words])
    keys, phrases = [], []
    # Words: by kind, not by place.
    came = slots[hashes >> shift].astype(np.int32)
    came[0] = 0
    often = np.bincount(ids, minlength=len(hashes))
    often[0] = 0
    if t < shards:
        new = np.flatnonzero((came == 0) & (often > 0))
        keys.append((hashes[new], often[new]))
    now = np.flatnonzero((came > 0) & (t < came + shards) & (often > 0))
    phrases.append((names.take(pa.array(now)), often[now]))
    # Places of arrived phrases of the length before: where, since when, which hash.
    at = np.flatnonzero(came[ids] > 0)
    since, h = came[ids[at]], hashes[ids[at]]
    for n in range(2, longest + 1):
        j = np.flatnonzero(at[1:] == at[:-1] + 1)
        if not len(j):
            break
        begun = np.maximum(since[j], since[j + 1])
        at, h = at[j], mix64(h[j] * STEP + hashes[ids[at[j] + n - 1]])
        came_n = slots[h >> shift].astype(np.int32)
        new = (came_n == 0) & (t < begun + shards)
        k, c = np.unique(h[new], return_counts=True)
        keys.append((k, c))
        have = came_n > 0
        at, h, since = at[have], h[have], np.maximum(came_n, begun)[have]
        now = at[t < since + shards]
        if len(now):
            phrases.append(exact_phrases(ids, now, n, names))
    return keys, phrases


def scan(spark: SparkSession, path: str, t: int, shards: int, longest: int, slots, bits: int) -> DataFrame:
    """Rows (key, lang, phrase, c) of scan ``t``, which reads shard t modulo ``shards``; either key or phrase is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        held: list = []
        counts: list = []

        def rows(key, lang, phrase, c) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([key, lang, phrase, pa.array(c, pa.int64())], names=["key", "lang", "phrase", "c"])

        def summed() -> Iterator[pa.RecordBatch]:
            k, c = merged(held, counts)
            held.clear(), counts.clear()
            for a in range(0, len(k), 100_000):
                b = min(len(k), a + 100_000)
                yield rows(pa.array(k[a:b].view(np.int64)), pa.nulls(b - a, pa.string()), pa.nulls(b - a, pa.string()), c[a:b])

        for batch in batches:
            for lang, words, ids in zip(*(batch.column(c) for c in ("lang", "words", "ids"))):
                lang, words = lang.as_py(), words.as_py()
                keys, phrases = count_chunk(t, shards, longest, table, bits, lang, words.split(" ") if words else [],
                                            np.frombuffer(ids.as_buffer(), np.int32))
                for k, c in keys:
                    held.append(k), counts.append(c)
                if sum(map(len, held)) > HELD_KEYS:
                    yield from summed()
                for p, c in phrases:
                    for a in range(0, len(p), 100_000):
                        part = p.slice(a, 100_000)
                        yield rows(pa.nulls(len(part), pa.int64()), pa.array([lang] * len(part)), part, c[a:a + 100_000])
        if held:
            yield from summed()

    chunks = spark.read.schema(ENCODED).parquet(path).filter(F.col("shard") == t % shards).select("lang", "words", "ids")
    return chunks.mapInArrow(run, COUNTED)


def count_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, bits: int = SLOT_BITS,
                  lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of up to ``longest`` words that are found ``least`` times, and (lang, n) of all words."""
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    path = shared_path(spark, "chunks")
    encode(docs, path, shards, lang, text)
    table = np.zeros(1 << bits, np.uint8)
    state, steps, quiet, t = None, [], 0, 0
    while quiet < shards:
        if t == 255:
            raise ValueError("more scans than a slot can number; use fewer shards")
        slots = sc.broadcast(table)
        counted = scan(spark, path, t, shards, longest, slots, bits).select("key", "lang", "phrase", F.lit(t).alias("first"), "c")
        if state is not None:
            counted = counted.unionByName(state)
        steps.append(shared_path(spark, f"scan-{t}"))
        with arrow_rows(spark, 4):
            counted.groupBy("key", "lang", "phrase").agg(F.min("first").alias("first"), F.sum("c").alias("c")).write.parquet(steps[-1])
        slots.destroy()
        done = spark.read.parquet(steps[-1])
        # Newly taken slots as bits: at most one row for every 64 slots.
        slot = F.shiftrightunsigned("key", 64 - bits)
        taken = (done.filter((F.col("key").isNotNull()) & (F.col("c") >= least)).select(slot.alias("slot"))
                 .groupBy(F.shiftright("slot", 6).alias("word"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, int(slot & 63))")).alias("bits")).toArrow())
        marks = np.zeros(len(table) // 64, np.int64)
        marks[taken.column("word").to_numpy()] = taken.column("bits").to_numpy()
        new = np.unpackbits(marks.view(np.uint8), bitorder="little").astype(bool) & (table == 0)
        table[new] = t + 1
        quiet = 0 if new.any() else quiet + 1
        # A phrase that has not arrived is given up after a cycle.
        state = done.filter(F.col("key").isNotNull() & (F.col("c") < least) & (F.col("first") > t + 1 - shards))
        t += 1
    found = [spark.read.parquet(p).filter("phrase IS NOT NULL").select("lang", "phrase", "c") for p in steps]
    whole = found[0]
    for f in found[1:]:
        whole = whole.unionByName(f)
    counts = whole.groupBy("lang", "phrase").agg(F.sum("c").alias("f")).filter(F.col("f") >= least)
    return counts, spark.read.schema(ENCODED).parquet(path).groupBy("lang").agg(F.sum("n_words").alias("n"))


def _part(words: Column, start, size) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, inside: int = INSIDE,
                 shards: int = SHARDS, bits: int = SLOT_BITS, lang: str = "lang", text: str = "text") -> DataFrame:
    """The first ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    A null text is empty, a null language reads ``und``. Texts count whole,
    however long, and rows that repeat count each. Ties go by count, then by
    the phrase in byte order. Other columns are not looked at. An empty table
    gives an empty result.
    """
    counts, totals = count_phrases(docs, least, longest, shards, bits, lang, text)
    counts = cut(counts)
    words = F.split("phrase", " ")
    cand = counts.withColumn("w", words).withColumn("k_max", F.size("w")).filter("k_max > 1")
    cuts = cand.select("lang", "phrase", F.col("f").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.col("k_max") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(F.col("w"), 1, F.col("k")).alias("left"),
                       _part(F.col("w"), F.col("k") + 1, F.size("w")).alias("right"))

    def of(name: str, out: str) -> DataFrame:
        return counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(out))
    scored = cuts.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"]).withColumn(
        "score", F.expr(f"(CAST({SCALE} AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(20, 0))) "
                        "div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))"))
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # The most frequent candidate around each shorter phrase.
    spots = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k_max") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("k_max") - m + 1), lambda i: _part(F.col("w"), i, m))))
    around = (cand.filter("k_max > 2").select("lang", F.explode(F.array_distinct(spots)).alias("phrase"), "f")
              .groupBy("lang", "phrase").agg(F.max("f").alias("around")))
    kept = weakest.join(around, ["lang", "phrase"], "left").filter(
        F.col("around").isNull() | (F.expr("CAST(100 AS DECIMAL(3, 0)) * CAST(around AS DECIMAL(20, 0))")
                                    < F.expr(f"CAST({inside} AS DECIMAL(3, 0)) * CAST(a AS DECIMAL(20, 0))")))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = (kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
              .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
