"""Helpers of the corpus operators: shared storage, words, row identity, column names."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word of decontamination, licences and near-duplicates: letters, digits and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same before A-Z are lower-cased.
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# A word of quality rules and mixing: whatever stands between ASCII white space.
BLANK_WORD = r"[^\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``; where that is unset (tests), a local master sets its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="causeway-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/causeway-llm/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Fix ``df`` in the shared folder by ``checkpoint()``: later readers neither recompute nor lose it."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_path(df.sparkSession, "checkpoints"))
    return df.checkpoint()


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Rows that go to Python at once, for what is run inside: few where rows are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


_kept: list = []  # (name, thing): what this Python worker keeps for its later tasks


def kept(name: tuple, make: Callable[[], Any]) -> Any:
    """``make()``, kept by the Python worker under ``name`` for later tasks; one such thing at a time."""
    if not _kept or _kept[0][0] != name:
        _kept[:] = []
        _kept.append((name, make()))
    return _kept[0][1]


def let_go() -> None:
    """Drop what the Python worker keeps."""
    if _kept:
        _kept.clear()
        gc.collect()
        give_back()


def give_back() -> None:
    """Give memory that the Python worker has freed back to the system, so that it does not add up over the operators."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
         keep: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, in a worker that gives back what a task no longer needs.

    What another operator keeps in the worker goes first, unless ``keep``.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keep:
            let_go()
        yield from run(batches)
        give_back()
    return task


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is. Texts of ASCII alone take the fast built-in way."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower()))


def words(text: Column) -> Column:
    """The words of a text in order; a null text has none."""
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def text_key(text: Column) -> Column:
    """Tells rows of one doc_id apart that have different texts."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def crc32_of(doc_id: Column) -> Column:
    """Unsigned crc32 of a doc_id as text; a null doc_id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
