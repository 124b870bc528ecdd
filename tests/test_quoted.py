"""CSV in splits against a reader of whole files."""

import csv
import random

import pytest

from causeway.sources.logs import LOG_SCHEMA, read_logs
from causeway.sources.quoted import INSIDE, OUTSIDE, Dialect

NAMES = LOG_SCHEMA.names


def plainly(path):
    """A file read from its start to its end."""
    with open(path, newline="", encoding="utf-8-sig") as f:
        rows = [r for r in csv.reader(f, quotechar='"', doublequote=True, escapechar="\\", skipinitialspace=True) if any(x.strip() for x in r)]
    head = [n.strip() for n in rows[0]]
    return [tuple((r[head.index(n)] or None) if n in head and head.index(n) < len(r) else None for n in NAMES) for r in rows[1:]]


def written(path, rows, names, seed, end="\n"):
    rng = random.Random(seed)

    def field(v):
        if v is None:
            return rng.choice(["", '""'])
        if rng.random() < 0.5 or any(c in v for c in ',"\n\r\\') or v.startswith(" ") or not v:
            quote = '""' if rng.random() < 0.5 else '\\"'
            return '"' + v.replace("\\", "\\\\").replace('"', quote) + '"'
        return v
    lines = [",".join(names)] + [rng.choice(["", " "]).join(["", (", " if rng.random() < 0.3 else ",").join(field(v) for v in r)]) for r in rows]
    path.write_text(end.join(lines) + (end if seed % 2 else ""), encoding="utf-8", newline="")


def made(n, seed, long=0):
    rng = random.Random(seed)
    words = ["error", 'say "hi"', "a,b", "line\nbreak", "back\\slash", "é😀", "", "5\" pipe", "x" * 50, "\n\n", '"', "end\\"]
    return [tuple([f"L{seed}-{i:05d}"] + [rng.choice(["ERROR", "INFO", None])] * 3
                  + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 6))) + "y" * (long if rng.random() < 0.02 else 0)]
                  + [rng.choice(["RC-01", None])]) for i in range(n)]


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("bytes_", [97, 1000, 50_000])
def test_splits_equal_whole_files(spark, tmp_path, bytes_):
    folder = tmp_path / "logs"
    folder.mkdir()
    order = [NAMES, NAMES[::-1], ["extra", *NAMES[2:], "log_id"]]
    want = []
    for k, names in enumerate(order):
        rows = made(40 if bytes_ < 500 else 400, k, long=400)
        by = [dict(zip(NAMES, r), extra="z") for r in rows]
        written(folder / f"{k}.csv", [[b.get(n) for n in names] for b in by], names, k, "\r\n" if k == 1 else "\n")
        want += plainly(folder / f"{k}.csv")
        lost = [n for n in NAMES if n not in names]
        assert [tuple(None if n in lost else (v or None) for n, v in zip(NAMES, r)) for r in rows] == plainly(folder / f"{k}.csv")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(bytes_))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = read_logs(spark, str(folder))
        assert got.rdd.getNumPartitions() > 3
        assert found(got) == sorted(want, key=str)
        with pytest.raises(ValueError, match="multi_line"):
            read_logs(spark, str(folder), multi_line=False)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("line,state,after", [
    ('a,b', OUTSIDE, OUTSIDE), ('a,"b', OUTSIDE, INSIDE), ('a,"b"', OUTSIDE, OUTSIDE), ('a,"b""', OUTSIDE, INSIDE),
    ('a,"b\\"', OUTSIDE, INSIDE), ('a,"b\\\\"', OUTSIDE, OUTSIDE), ('5" pipe,"x', OUTSIDE, INSIDE), ('5" pipe,x"', OUTSIDE, OUTSIDE),
    ('x', INSIDE, INSIDE), ('x",y', INSIDE, OUTSIDE), ('x","y', INSIDE, INSIDE), ('x""', INSIDE, INSIDE), ('x"" ","', INSIDE, INSIDE),
    ('"a" b,"c', OUTSIDE, INSIDE), ('', INSIDE, INSIDE), ('  "a', OUTSIDE, INSIDE), ('a, "b', OUTSIDE, INSIDE), ('"\\', OUTSIDE, INSIDE)])
def test_open_quotes(line, state, after):
    assert Dialect().after(line, state) == after


def test_one_way_of_escaping(spark, tmp_path):
    (tmp_path / "a.csv").write_text('log_id,log_message\n1,"C:\\temp ""x"""\n2,\n\n3, "" \n')
    assert found(read_logs(spark, str(tmp_path / "a.csv"), escape='"').select("log_id", "log_message"))[0] == ("1", 'C:\\temp "x"')
    assert found(read_logs(spark, str(tmp_path / "a.csv")).select("log_id", "log_message"))[0] == ("1", 'C:temp "x"')
    with pytest.raises(ValueError, match="escape"):
        read_logs(spark, str(tmp_path / "a.csv"), escape="x")


def test_odd_files(spark, tmp_path):
    folder = tmp_path / "odd"
    folder.mkdir()
    (folder / "empty.csv").write_text("")
    (folder / "head.csv").write_text("log_id,log_message\n")
    (folder / "mark.csv").write_bytes(b"\xef\xbb\xbf log_id ,log_message\r\nlog_id,log_message\r\n7,\xff\r\n8\r\n")
    assert found(read_logs(spark, str(folder)).select("log_id", "log_message")) == [
        ("7", "�"), ("8", None), ("log_id", "log_message")]
    (folder / "mark.csv").unlink()
    assert read_logs(spark, str(folder)).count() == 0
