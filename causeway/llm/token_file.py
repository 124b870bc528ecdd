"""Token ids in files of patched frame-of-reference blocks.

A file is a Parquet table whose rows are segments: some documents in order,
their ids cut into blocks. A block holds its minimum, a bit width and the
differences packed at that width; the width is chosen at a percentile of the
differences, and those that do not fit stand in an exception list. The segment
carries the byte offset at which each block starts, so one document can be read
without decoding what stands before it.

Documents are ordered by a range shuffle. Each task encodes and writes one range;
Spark's output commit makes a lost task start over without leaving parts behind.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .byte_bpe import ByteBpe
from .common import lean, shared_path

END_ID = 0
BLOCK = 1024
PERCENTILE = 90
SEGMENT_IDS = 1 << 16
ROWS = 32  # values of a lane; a block of n values has n / ROWS lanes
HEAD = struct.Struct("<IHBH")  # minimum, count, width, exceptions
_LENGTHS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)

SCHEMA = ("part int, segment long, part_start long, n_ids long, doc_ids array<long>, doc_sizes array<long>, "
          "block_starts binary, blocks binary")


def bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits that each value takes, as 8-bit integers."""
    if values.size and values.max() >= 1 << 16:
        return np.frexp(values.astype(np.float64))[1].astype(np.uint8)
    return _LENGTHS[values]


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """``width`` bits of each value of many blocks, (blocks, ROWS, lanes) to (blocks, width, lanes).

    The values of a lane fill 32-bit words from their low ends, so every step
    works on all lanes of all blocks.
    """
    out = np.zeros((len(values), width, values.shape[2]), np.uint32)
    for r in range(ROWS if width else 0):
        word, shift = divmod(r * width, 32)
        out[:, word] |= values[:, r] << np.uint32(shift)
        if shift + width > 32:
            out[:, word + 1] |= values[:, r] >> np.uint32(32 - shift)
    return out


def unpack(packed: np.ndarray) -> np.ndarray:
    """The values that ``pack`` has packed."""
    width = packed.shape[1]
    out = np.zeros((len(packed), ROWS, packed.shape[2]), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for r in range(ROWS if width else 0):
        word, shift = divmod(r * width, 32)
        part = packed[:, word] >> np.uint32(shift)
        if shift + width > 32:
            part |= packed[:, word + 1] << np.uint32(32 - shift)
        np.bitwise_and(part, mask, out=out[:, r])
    return out


def encode_blocks(values: np.ndarray, percentile: float = PERCENTILE) -> list[bytes]:
    """Blocks of equal size, one a row: head, packed low bits, then positions (2 bytes) and values (4 bytes) of the exceptions."""
    n, size = values.shape
    lanes = -(-size // ROWS)
    low = values.min(axis=1)
    rest = values - low[:, None]
    bits = bit_lengths(rest)
    at = min(size - 1, int(np.ceil((size - 1) * percentile / 100)))
    width = np.partition(bits, at, axis=1)[:, at]
    odd = bits > width[:, None]
    block, place = np.nonzero(odd)
    ends = np.searchsorted(block, np.arange(n + 1))
    strange = rest[odd].astype("<u4")
    kept = np.zeros((n, ROWS * lanes), np.uint32)
    kept[:, :size] = np.where(odd, np.uint32(0), rest)
    kept = kept.reshape(n, ROWS, lanes)
    packed: list = [None] * n
    for w in np.unique(width):
        which = np.flatnonzero(width == w)
        for i, words in zip(which, pack(kept[which], int(w)).astype("<u4")):
            packed[i] = words.tobytes()
    place = place.astype("<u2")
    return [b"".join((HEAD.pack(int(low[i]), size, int(width[i]), int(b - a)), packed[i], place[a:b].tobytes(), strange[a:b].tobytes()))
            for i, (a, b) in enumerate(zip(ends, ends[1:]))]


def decode_blocks(data: bytes, offsets: np.ndarray) -> np.ndarray:
    """The values of the blocks that start at ``offsets``, one after another."""
    heads = [HEAD.unpack_from(data, int(at)) for at in offsets]
    ends = np.cumsum([0] + [h[1] for h in heads])
    out = np.empty(ends[-1], np.uint32)
    alike: dict[tuple, list[int]] = {}
    for i, (_, n, width, _) in enumerate(heads):
        alike.setdefault((n, width), []).append(i)
    for (n, width), which in alike.items():
        lanes = -(-n // ROWS)
        words = np.empty((len(which), width, lanes), np.uint32)
        for k, i in enumerate(which):
            words[k] = np.frombuffer(data, "<u4", width * lanes, int(offsets[i]) + HEAD.size).reshape(width, lanes)
        values = unpack(words).reshape(len(which), -1)
        for k, i in enumerate(which):
            low, _, _, n_odd = heads[i]
            own = values[k, :n]
            if n_odd:
                at = int(offsets[i]) + HEAD.size + 4 * width * lanes
                own[np.frombuffer(data, "<u2", n_odd, at)] = np.frombuffer(data, "<u4", n_odd, at + 2 * n_odd)
            np.add(own, np.uint32(low), out=out[ends[i]:ends[i + 1]])
    return out


def encode_ids(ids: np.ndarray, block: int = BLOCK) -> tuple[bytes, bytes]:
    """(block starts as little-endian 8-byte offsets, blocks)."""
    ids = ids.astype(np.uint32, copy=False)
    whole = len(ids) // block * block
    blocks = encode_blocks(ids[:whole].reshape(-1, block)) if whole else []
    if whole < len(ids):
        blocks += encode_blocks(ids[None, whole:])
    starts = np.cumsum([0] + [len(b) for b in blocks])[:-1]
    return starts.astype("<u8").tobytes(), b"".join(blocks)


def decode_ids(starts: bytes, blocks: bytes) -> np.ndarray:
    return decode_blocks(blocks, np.frombuffer(starts, "<u8"))


def read_range(starts: bytes, blocks: bytes, start: int, n: int, block: int = BLOCK) -> np.ndarray:
    """Ids ``start`` to ``start + n`` of a segment; decodes only the blocks that hold them."""
    offsets = np.frombuffer(starts, "<u8")[start // block:(start + n + block - 1) // block]
    return decode_blocks(blocks, offsets)[start % block:][:n]


def _segments(batches: Iterator[pa.RecordBatch], coder: ByteBpe, end_id: int) -> Iterator[pa.RecordBatch]:
    """Encode one range of documents in order. A segment ends with the document that fills it."""
    part, segment, before = TaskContext.get().partitionId(), 0, 0
    ids: list[bytes] = []
    keys: list = []
    sizes: list[int] = []
    held = 0
    end = int(end_id).to_bytes(2, "little")

    def flush() -> pa.RecordBatch:
        nonlocal segment, before, held
        flat = np.frombuffer(b"".join(ids), "<u2").astype(np.uint32)
        starts, blocks = encode_ids(flat)
        out = pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([segment], pa.int64()), pa.array([before], pa.int64()),
             pa.array([len(flat)], pa.int64()), pa.array([list(keys)], pa.list_(pa.int64())),
             pa.array([list(sizes)], pa.list_(pa.int64())), pa.array([starts], pa.binary()), pa.array([blocks], pa.binary())],
            names=["part", "segment", "part_start", "n_ids", "doc_ids", "doc_sizes", "block_starts", "blocks"])
        segment, before, held = segment + 1, before + len(flat), 0
        ids.clear(), keys.clear(), sizes.clear()
        return out

    for batch in batches:
        # Small slices bound what is held at once, however long the texts are.
        for at in range(0, batch.num_rows, 256):
            rows = batch.slice(at, 256)
            texts = ["" if t is None else t for t in rows.column(1).to_pylist()]
            for key, data in zip(rows.column(0).to_pylist(), coder.encode_many(texts)):
                ids.append(data + end)
                keys.append(key)
                sizes.append(len(data) // 2 + 1)
                held += sizes[-1]
                if held >= SEGMENT_IDS:
                    yield flush()
    if ids:
        yield flush()


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, key: str = "doc_id",
                 text: str = "text", ranges: int | None = None) -> str:
    """Write the ids of all texts in ascending key order, each document ended by ``end_id``; returns ``path``.

    ``tokenizer`` is a file of the tokenizers library with at most 65,536 ids.
    Null texts are empty: just the end id. Null keys come first; rows that
    repeat a key are ordered by text. Other columns are not written.
    """
    with open(tokenizer, encoding="utf-8") as f:
        model = f.read()
    n = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
               .repartitionByRange(n, "k").sortWithinPartitions("k", "t"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _segments(batches, ByteBpe.shared(model), end_id)

    ordered.mapInArrow(lean(encode, keep=True), SCHEMA).write.parquet(path)
    return path


def read_tokens(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Rows (key, start, n_tokens, ids): the documents of a token file; ``start`` counts the ids before each.

    Only the ranges' totals are summed up in one place: one row a range.
    """
    rows = spark.read.schema(SCHEMA).parquet(path)
    return _decoded(spark, rows, _ids, f"{key} long, start long, n_tokens long, ids array<long>", key)


def token_digests(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Rows (key, start, n_tokens, ids_crc32): as ``read_tokens``, with the crc32 of the ids as 4-byte integers."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    return _decoded(spark, rows, _crc, f"{key} long, start long, n_tokens long, ids_crc32 long", key)


def _ids(ids: np.ndarray) -> list:
    return ids.tolist()


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4", copy=False))


def _decoded(spark: SparkSession, rows: DataFrame, value, schema: str, key: str) -> DataFrame:
    totals = rows.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = totals.select(F.col("part").alias("_part"), before.alias("_before"))
    met = rows.join(F.broadcast(offsets), F.col("part") == F.col("_part"))  # one row a written range
    names = [c.strip().split()[0] for c in schema.split(",")]
    kind = pa.list_(pa.int64()) if value is _ids else pa.int64()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):  # a segment at a time
                row = {n: c[r] for n, c in zip(batch.schema.names, batch.columns)}
                ids = decode_ids(row["block_starts"].as_py(), row["blocks"].as_py())
                sizes = np.asarray(row["doc_sizes"].as_py(), np.int64)
                ends = np.cumsum(sizes)
                start = row["_before"].as_py() + row["part_start"].as_py() + ends - sizes
                values = [value(ids[e - s:e]) for s, e in zip(sizes, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"].as_py(), pa.int64()), pa.array(start, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(values, kind)], names=names)

    return met.mapInArrow(lean(decode, keep=True), schema)


def tokens_of(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``docs`` to a token file in the shared folder and give the digests read back from it."""
    spark = docs.sparkSession
    path = write_tokens(docs, shared_path(spark, "tokens"), tokenizer, key=key, text=text)
    return token_digests(spark, path, key)
