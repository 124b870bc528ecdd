"""CSV with quoted line breaks, read in splits.

Spark splits text files at line ends, but a line may end inside a quoted field.
Whether it does depends on all lines before, yet only through one bit: is a
quote open? So a first pass finds for each split where it ends for either
answer, the answers are chained along each file, and in a second pass every
split starts with its first true record. A record that crosses into later splits
is put together from its pieces; these are all that is shuffled.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

OUTSIDE, INSIDE = 0, 1


class Dialect:
    """How a quote stands inside a quoted field: doubled, behind a backslash, or either."""

    def __init__(self, doubled: bool = True, backslash: bool = True):
        self.doubled, self.backslash = doubled, backslash
        inner = r'[^"\\]' if backslash else '[^"]'
        skip = r"|\\." if backslash else ""
        twice = '|""' if doubled else ""
        plain = r"[^,\\]" if backslash else "[^,]"
        body, tail = f'(?:{inner}{skip}{twice})*+', f"(?:{plain}{skip})*+"
        quoted = f' *+"{body}"{tail}'
        bare = f'(?! *+"){tail}'
        # Whole fields, then one whose quote is still open at the end.
        self.opens = re.compile(rf'(?s:(?:(?:{quoted}|{bare}),)*+ *+"{body}\\?+\Z)')
        self.closes = re.compile(rf'(?s:{body}"{tail}\\?+(?:,|\Z))')

    def after(self, line: str, state: int) -> int:
        """Is a quote open after ``line``, if it is (``INSIDE``) or is not before?"""
        if '"' not in line:
            return state
        at = 0
        if state == INSIDE:
            m = self.closes.match(line)
            if not m:
                return INSIDE
            at = m.end()
        return INSIDE if self.opens.match(line, at) else OUTSIDE

    def fields(self, record: str) -> list[str]:
        """The fields of one record; a carriage return in a field without quotes is a blank."""
        csv.field_size_limit(1 << 31)
        record = record.lstrip("\ufeff").rstrip("\r")
        for text in (record, record.replace("\r", " ")):
            try:
                return next(csv.reader([text], quotechar='"', doublequote=self.doubled, skipinitialspace=True,
                                       escapechar="\\" if self.backslash else None), [])
            except csv.Error:
                if "\r" not in text:
                    raise
        return []


def _line(raw: bytes | None) -> str:
    return (raw or b"").decode("utf-8", "replace")


def _is_blank(text: str) -> bool:
    return not text.strip(" \t\r\ufeff")


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], str]]:
    for batch in batches:
        for file, start, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            yield (file, start), _line(raw)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all files, in order inside each split; a split begins at ``start``."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("line"))


def _ends(lines: DataFrame, dialect: Dialect) -> DataFrame:
    """(file, start, outside, inside, broken, head): where a split ends if it begins outside or inside a quote, how many
    lines end inside one in the first case, and the first record of a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A partition may hold several splits, one after another.
        found: dict[tuple[str, int], list] = {}
        for split, line in _by_split(batches):
            state = found.setdefault(split, [OUTSIDE, INSIDE, 0, [], split[1] == 0])
            if state[4] and (state[3] or not _is_blank(line)):
                state[3].append(line)
            state[0], state[1] = dialect.after(line, state[0]), dialect.after(line, state[1])
            state[2] += state[0]
            if state[3] and state[0] == OUTSIDE:
                state[4] = False
        if found:
            v = list(found.values())
            yield pa.RecordBatch.from_pydict({
                "file": [f for f, _ in found], "start": pa.array([s for _, s in found], pa.int64()),
                "outside": pa.array([x[0] for x in v], pa.int32()), "inside": pa.array([x[1] for x in v], pa.int32()),
                "broken": pa.array([x[2] for x in v], pa.int64()),
                "head": pa.array(["\n".join(x[3]) if x[3] else None for x in v], pa.string())})

    return lines.mapInArrow(run, "file string, start long, outside int, inside int, broken long, head string")


def _records(lines: DataFrame, begun: dict[tuple[str, int], int], dialect: Dialect) -> DataFrame:
    """(file, start, place, text): records that begin and end in a split (place null), the end of one begun earlier
    (place 0) and one still open at the split's end (place 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held: list[str] = []
        now, state, place, head = None, OUTSIDE, None, False

        def closed() -> None:
            # What a split leaves open: the head of a record, or nothing but the middle of a longer one.
            if held:
                out.append((*now, 1 if place is None else 0, "\n".join(held)))
                held.clear()

        def rows() -> pa.RecordBatch:
            file, start, kind, text = zip(*out)
            out.clear()
            return pa.RecordBatch.from_pydict({"file": list(file), "start": pa.array(start, pa.int64()),
                                               "place": pa.array(kind, pa.int32()), "text": list(text)})

        for split, line in _by_split(batches):
            if split != now:
                closed()
                if split not in begun:
                    raise ValueError(f"{split[0]} has changed, or is split otherwise than when it was opened; read it again")
                now, state = split, begun[split]
                place = 0 if state == INSIDE else None
                head = split[1] == 0
            if not held and state == OUTSIDE and _is_blank(line):
                continue
            held.append(line)
            state = dialect.after(line, state)
            if state == OUTSIDE:
                if not head:
                    out.append((*now, place, "\n".join(held)))
                held.clear()
                place, head = None, False
            if len(out) >= 4096:
                yield rows()
        closed()
        if out:
            yield rows()

    return lines.mapInArrow(run, "file string, start long, place int, text string")


def read_quoted(spark: SparkSession, path: str, names: list[str], dialect: Dialect, breaks: bool = True) -> DataFrame:
    """Rows of the named columns, all text, of the CSV files below ``path``; each file's header says where they stand.

    Null where a file lacks a column, a row is too short or a field is empty.
    Further columns are left out, blank lines skipped, a byte order mark
    ignored, bytes that are no UTF-8 replaced. A header ends in the first split of its file. Without ``breaks`` a line that ends inside
    a quote raises ``ValueError``.
    """
    lines = _lines(spark, path)
    splits = _ends(lines, dialect).collect()  # one row a split, a millionth of the input
    if not breaks and any(r["broken"] for r in splits):
        raise ValueError(f"{sum(r['broken'] for r in splits)} lines of {path} end inside a quoted field; read it with multi_line=True")
    begun: dict[tuple[str, int], int] = {}  # of every split: is a quote open where it begins?
    state, file = OUTSIDE, None
    for r in sorted(splits, key=lambda r: (r["file"], r["start"])):
        state = state if r["file"] == file else OUTSIDE
        file = r["file"]
        begun[file, r["start"]] = state
        state = r["inside"] if state == INSIDE else r["outside"]
    found = _records(lines, begun, dialect)
    if INSIDE in begun.values():
        # Heads and the pieces that follow them, in the order of their file: each head opens a record.
        pieces = found.filter("place IS NOT NULL")
        order = Window.partitionBy("file").orderBy("start", "place")
        grouped = pieces.withColumn("opened", F.sum("place").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        joined = (grouped.groupBy("file", "opened").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "place", "text"))), lambda p: p["text"]), "\n").alias("text"),
            F.min("start").alias("start")))
        found = found.filter("place IS NULL").select("file", "start", "text").unionByName(joined.select("file", "start", "text"))
    else:
        found = found.select("file", "start", "text")
    heads = {r["file"]: [n.strip() for n in dialect.fields(r["head"])] for r in splits if r["head"] is not None}
    return _parsed(found, heads, names, dialect)


def _parsed(found: DataFrame, heads: dict[str, list[str]], names: list[str], dialect: Dialect) -> DataFrame:
    places = {file: [head.index(n) if n in head else None for n in names] for file, head in heads.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            for file, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fields = dialect.fields(text)
                for out, at in zip(columns, places[file]):
                    out.append(fields[at] or None if at is not None and at < len(fields) else None)
            yield pa.RecordBatch.from_pydict({n: pa.array(c, pa.string()) for n, c in zip(names, columns)})

    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return found.select("file", "text").mapInArrow(run, schema)
