"""Benchmark decontamination: windows of benchmark words found in documents.

The windows of all items form a hash relation that is broadcast while its size
is below a checked bound; beyond it, the same join is a shuffle join. A place of
a document is looked up if the hash of its first words is in the set of those of
the benchmark windows, so few windows are put together; a hit is a hit only if
all words are equal, not their hash alone. All is built-in expressions: one scan
of the documents, and only hits (and one row a document) are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, text_key, words

WINDOW = 10
# Windows of all items, counted once for each item that has them, that may be broadcast: some 100 bytes each.
BROADCAST_WINDOWS = 500_000
# First words of a window whose hash is looked up before the window is put together.
HEAD = 3


def starts_of(tokens: Column, n: int | Column) -> Column:
    """The places at which ``n`` words begin."""
    last = F.size(tokens) - n
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def windows_of(tokens: Column, n: int | Column, starts: Column | None = None) -> Column:
    """Struct (pos, window) for each run of ``n`` words, words joined with a blank."""
    return F.transform(starts_of(tokens, n) if starts is None else starts, lambda i: F.struct(
        i.alias("pos"), F.concat_ws(" ", F.slice(tokens, i + 1, n)).alias("window")))


def head_hash(tokens: str, n: int, start: str = "0") -> str:
    """Hash of the first words of a window of ``n`` words, as SQL text."""
    return f"xxhash64({', '.join(f'get({tokens}, {start} + {k})' for k in range(min(n, HEAD)))})"


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """Rows (n, window, items): the distinct windows of all items and the sorted items that have them.

    An item of fewer words than ``window`` is one window; one without words has none.
    """
    own = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"),
                           words(F.col(text)).alias("words")).filter(F.size("words") > 0)
    n = F.least(F.lit(window), F.size("words"))
    return (own.select("item", n.alias("n"), F.explode(windows_of(F.col("words"), n)).alias("w"))
            .groupBy("n", F.col("w.window").alias("window"))
            .agg(F.sort_array(F.collect_set("item")).alias("items")))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  broadcast_windows: int = BROADCAST_WINDOWS, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: (key, text_key, n_words, spans, items, n_hit, contaminated).

    ``spans`` are the hit word ranges (start, end exclusive), disjoint and in
    order; ``items`` the benchmark items found, as sorted texts.

    Null and empty texts have no words. Rows that repeat a key keep one result
    each; a null key is a key like any other, a null item id reads ``null``.
    Other columns of either table are not looked at. An empty benchmark or
    document table gives no hits.
    """
    bench = cut(benchmark_windows(benchmark, item, item_text, window))
    sizes = bench.groupBy("n").agg(F.sum(F.size("items")).alias("size")).collect()  # at most ``window`` rows
    small = sum(r["size"] for r in sizes) <= broadcast_windows
    own = docs.select(F.col(key).alias("_key"), text_key(F.col(text)).alias("_text"), words(F.col(text)).alias("_words"))
    kind = "array<struct<n:int,pos:int,window:string>>"
    parts = [F.array().cast(kind)]

    def numbered(n: int, starts: Column | None) -> Column:
        return F.transform(windows_of(F.col("_words"), n, starts), lambda w: F.struct(
            F.lit(n).alias("n"), w["pos"].alias("pos"), w["window"].alias("window"))).cast(kind)
    for n in sorted(r["n"] for r in sizes):
        starts = None
        if small:
            heads = bench.filter(F.col("n") == n).select(F.expr(head_hash("split(window, ' ')", n)).alias("h")).distinct().collect()
            # As SQL text, which takes many literals quickly; Spark looks them up in a hash set.
            known = ", ".join(f"{r['h']}L" if r["h"] != -1 << 63 else "(-9223372036854775807L - 1L)" for r in heads)
            starts = F.expr(
                f"filter(CASE WHEN size(_words) >= {n} THEN sequence(0, size(_words) - {n}) ELSE array() END, "
                f"i -> {head_hash('_words', n, 'i')} IN ({known}))")
        parts.append(numbered(n, starts))
    own = own.select("_key", "_text", F.size("_words").alias("_n"), F.concat(*parts).alias("_windows"))
    if small:
        # The first row of a document carries its number of words, be it a window or not.
        rows = own.select("_key", "_text", "_n", F.posexplode_outer("_windows").alias("_at", "_w")).select(
            "_key", "_text", "_n", (F.coalesce("_at", F.lit(0)) == 0).alias("_first"), "_w.*")
        met = rows.join(F.broadcast(bench), ["n", "window"], "left").filter(F.col("_first") | F.col("items").isNotNull())
    else:
        hits = own.select("_key", "_text", F.inline("_windows")).join(bench, ["n", "window"])
        ones = own.select("_key", "_text", "_n", F.lit(True).alias("_first"))
        met = ones.unionByName(hits.select("_key", "_text", "n", "pos", "items"), allowMissingColumns=True)
    hit = F.col("items").isNotNull()
    found = met.groupBy("_key", "_text").agg(
        F.sum(F.col("_first").cast("int")).alias("_copies"),
        F.max("_n").cast("long").alias("n_words"),
        F.sort_array(F.collect_set(F.when(hit, F.struct(
            F.col("pos").alias("start"), (F.col("pos") + F.col("n")).alias("end"))))).alias("_hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    span = "struct<start:int,end:int>"
    merged = F.aggregate(
        "_hits", F.struct(F.array().cast(f"array<{span}>").alias("done"), F.lit(None).cast(span).alias("open")),
        lambda acc, h: F.when(acc["open"].isNull(), F.struct(acc["done"].alias("done"), h.alias("open")))
        .when(h["start"] <= acc["open"]["end"], F.struct(acc["done"].alias("done"), F.struct(
            acc["open"]["start"].alias("start"), F.greatest(acc["open"]["end"], h["end"]).alias("end")).alias("open")))
        .otherwise(F.struct(F.concat(acc["done"], F.array(acc["open"])).alias("done"), h.alias("open"))),
        lambda acc: F.when(acc["open"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))))
    out = found.withColumn("spans", merged).withColumn("n_hit", F.aggregate(
        "spans", F.lit(0).cast("long"), lambda acc, s: acc + (s["end"] - s["start"])))
    return (out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
            .select(F.col("_key").alias(key), F.col("_text").alias("text_key"), "n_words", "spans", "items", "n_hit",
                    (F.col("n_hit") > 0).alias("contaminated")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW,
                  key: str = "doc_id", text: str = "text", **names: str) -> DataFrame:
    """``docs`` without contaminated documents (``remove="documents"``) or without the hit words (``"spans"``).

    A removed span takes the characters between its words along; the rest of
    the text stays as it is. Columns and the number of rows (for spans) stay;
    a null text stays null.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"unknown way of removal {remove}")
    bad = (contamination(docs, benchmark, window, key=key, text=text, **names).filter("contaminated")
           .select(F.col(key).alias("_c_key"), F.col("text_key").alias("_c_text"), F.col("spans").alias("_c_spans"))
           .dropDuplicates(["_c_key", "_c_text"]))
    match = docs[key].eqNullSafe(bad["_c_key"]) & (text_key(docs[text]) == bad["_c_text"])
    if remove == "documents":
        return docs.join(bad, match, "left_anti")
    joined = docs.join(bad, match, "left")
    # Each piece is a word with what stands before it; what follows the last word is the tail.
    piece = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    kept = F.filter(F.regexp_extract_all(F.col(text), F.lit(piece), F.lit(0)), lambda w, i: ~F.exists(
        "_c_spans", lambda s: (i >= s["start"]) & (i < s["end"])))
    tail = F.regexp_extract(F.col(text), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\z", 0)
    cleaned = F.when(F.col("_c_spans").isNull(), F.col(text)).otherwise(F.concat(F.array_join(kept, ""), tail))
    return joined.withColumn(text, cleaned).select(*docs.columns)
