"""Prefix trie of conversations by vertical bitmaps.

Conversations in id order are dealt to shards, and their turns to bands of
positions. A shard's band is indexed vertically: each (position, turn) has the
bitset of the conversations that have this turn there. A depth-first walk
intersects a node's bitset with the postings of the next position: each
intersection is a child, its population count the conversations below, its
lowest bit their smallest id, and the bitset of conversations that end there
the end list. Nodes of different shards are the same if their prefixes are: a
prefix is named by two 64-bit sums (xor) of the hashes of its placed turns, which
also tell a band where its walk begins without the bands before it.

A node belongs to its smallest member, so the nodes of one conversation form a
chain, and sums over subtrees are running sums along chains plus the totals of
the chains that branch off. Totals are found by doubling pointers from chain to
chain, in as many rounds as the logarithm of the deepest nesting.

No task holds a whole conversation, node or shard: a conversation of many turns
is ranked by ranges and walked by bands, and the ids that end at one node come
as one text a shard and are hashed as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc32_of, cut

# Conversations of a shard, positions of a band.
SHARD_BITS = 10
BAND = 128
# Turns that a conversation may take from the first one of its group, and the size of a group.
MOST_SHARED = 5
GROUP = 100


def ordered_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """(conv_id, pos, digest, chars): the turns of each conversation in order, numbered from 1.

    Sorted by ranges of (conversation, turn), so a conversation may spread over
    many tasks; ranks are places inside a range plus the counts of the ranges before.
    """
    if not isinstance(turns.schema[conv].dataType, T.IntegralType):
        raise ValueError(f"conversation ids must be integers, {conv} is {turns.schema[conv].dataType.simpleString()}")
    by, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    own = turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.md5(F.concat(F.length(by).cast("string"), F.lit("|"), by, said).cast("binary")).alias("digest"),
        F.length(said).alias("chars"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest"]
    placed = cut(own.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", "digest", "chars", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    parts = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("conv_id", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return placed.join(offsets, ["conv_id", "part"]).select("conv_id", (F.col("at") + F.col("shift")).alias("pos"), "digest", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) with the shared first turns of each group put in front.

    Conversation c starts with the first h turns of conversation c - c % 100 (the remainder
    has the sign of c), h = crc32(c) % 6, and goes on with its own turns after the first h. Rows
    (conv_id, shard, len), shards in id order, and (conv_id, pos, digest, chars).
    """
    turns = cut(turns)
    lengths = cut(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own_len")))
    heads = lengths.filter(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("root"), F.col("own_len").alias("root_len"))
    h = crc32_of(F.col("conv_id")) % (MOST_SHARED + 1)
    convs = (lengths.withColumn("root", F.col("conv_id") - F.col("conv_id") % GROUP).withColumn("h", h)
             .join(heads, "root", "left")
             .withColumn("shared", F.least("h", F.coalesce("root_len", F.lit(0))))
             .withColumn("len", F.col("shared") + F.greatest(F.col("own_len") - F.col("h"), F.lit(0))))
    numbered = convs.repartitionByRange("conv_id").sortWithinPartitions("conv_id").withColumn(
        "shard", F.shiftright(F.monotonically_increasing_id(), SHARD_BITS))
    convs = cut(numbered.select("conv_id", "root", "h", "shared", "len", "shard"))
    first = turns.filter((F.col("pos") <= MOST_SHARED) & (F.col("conv_id") % GROUP == 0)).withColumnRenamed("conv_id", "root")
    taken = (convs.filter("shared > 0").select("conv_id", "root", "shared").join(first, "root").filter("pos <= shared")
             .select("conv_id", "pos", "digest", "chars"))
    own = (turns.join(convs.filter("len > shared").select("conv_id", "h", "shared"), "conv_id").filter("pos > h")
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("shared")).alias("pos"), "digest", "chars"))
    return convs.select("conv_id", "shard", "len"), own.unionByName(taken)


def walk(ids: np.ndarray, last: np.ndarray, first_pos: int, start: list, columns: dict) -> Iterator[tuple]:
    """Nodes of one band of one shard, depth first: (depth, z1, z2, parent z1, parent z2, smallest id, members, chars, end ids).

    ``ids`` are the shard's conversations in ascending order, ``last`` their
    lengths, ``start`` the name (z1, z2) of the prefix each comes with, or None
    where it has no turn in this band. ``columns`` maps a position to the (turn,
    chars) of each conversation that reaches it, by number.
    """
    postings: dict[tuple, int] = {}
    ended: dict[int, int] = {}
    for pos, said in columns.items():
        for i, (turn, _) in said.items():
            postings[pos, turn] = postings.get((pos, turn), 0) | 1 << i
            if last[i] == pos:
                ended[pos] = ended.get(pos, 0) | 1 << i
    roots: dict[tuple, int] = {}
    for i, z in enumerate(start):
        if z is not None:
            roots[z] = roots.get(z, 0) | 1 << i
    stack = [(first_pos - 1, z, bits) for z, bits in roots.items()]
    while stack:
        depth, z, bits = stack.pop()
        said = columns.get(depth + 1, {})
        left = bits & ~ended.get(depth, 0) if depth >= first_pos else bits
        while left:
            i = (left & -left).bit_length() - 1  # the smallest member not yet under a child
            if i not in said:
                break
            turn, chars = said[i]
            child = bits & postings[depth + 1, turn]
            left &= ~child
            name = z[0] ^ turn[0], z[1] ^ turn[1]
            ends, here = [], child & ended.get(depth + 1, 0)
            while here:
                k = (here & -here).bit_length() - 1
                ends.append(str(ids[k]))
                here &= here - 1
            yield (depth + 1, *name, *z, int(ids[i]), child.bit_count(), chars, ",".join(ends) or None)
            stack.append((depth + 1, name, child))


LOCAL = ("depth long, z1 long, z2 long, p1 long, p2 long, shard long, conv_id long, n long, chars long, ends string")


def _walked(pdf: pd.DataFrame) -> pd.DataFrame:
    ids, number = np.unique(pdf["conv_id"].to_numpy(np.int64), return_inverse=True)
    last = np.zeros(len(ids), np.int64)
    last[number] = pdf["len"].to_numpy(np.int64)
    start: list = [None] * len(ids)
    columns: dict[int, dict] = {}
    for i, pos, h1, h2, s1, s2, chars in zip(number.tolist(), *(pdf[c].tolist() for c in ("pos", "h1", "h2", "s1", "s2", "chars"))):
        columns.setdefault(pos, {})[i] = (h1, h2), chars
        start[i] = s1, s2
    shard, first = pdf["shard"].iloc[0], int(pdf["pos"].min())  # every one of them has a turn where the band begins
    rows = [(d, a, b, p, q, shard, c, n, k, e) for d, a, b, p, q, c, n, k, e in walk(ids, last, first, start, columns)]
    return pd.DataFrame(rows, columns=[c.split()[0] for c in LOCAL.split(", ")])


def local_nodes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes below the root, once for each shard that has members of them."""
    def placed(k: int) -> Column:
        return F.xxhash64(F.lit(k), "pos", "digest")
    band = F.floor((F.col("pos") - 1) / BAND).cast("long")
    hashed = cut(turns.select("conv_id", "pos", band.alias("band"), placed(1).alias("h1"), placed(2).alias("h2"),
                              F.col("chars").cast("long").alias("chars")))
    # The prefix that a conversation brings into a band: the sum over its bands before.
    earlier = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    before = hashed.groupBy("conv_id", "band").agg(F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")).select(
        "conv_id", "band", F.coalesce(F.bit_xor("h1").over(earlier), F.lit(0).cast("long")).alias("s1"),
        F.coalesce(F.bit_xor("h2").over(earlier), F.lit(0).cast("long")).alias("s2"))
    met = hashed.join(before.join(convs, "conv_id"), ["conv_id", "band"])
    return met.groupBy("shard", "band").applyInPandas(_walked, LOCAL)


def end_hashes(ends: DataFrame) -> DataFrame:
    """(depth, z1, z2, ends_sha256) from rows (depth, z1, z2, shard, ends): one SHA-256 over the texts of a node in shard order.

    The texts stream through the hash; a node that many conversations share is never held whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("depth", "z1", "z2", "ends"))))
        out: list[tuple] = []
        for node, texts in groupby(rows, lambda r: r[:3]):
            state, mark = hashlib.sha256(), b""
            for t in texts:
                state.update(mark + t[3].encode())
                mark = b","
            out.append((*node, state.hexdigest()))
            if len(out) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["depth", "z1", "z2", "ends_sha256"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["depth", "z1", "z2", "ends_sha256"])

    return (ends.select("depth", "z1", "z2", "shard", "ends").repartition("depth", "z1", "z2")
            .sortWithinPartitions("depth", "z1", "z2", "shard")
            .mapInArrow(run, "depth long, z1 long, z2 long, ends_sha256 string"))


def chain_totals(chains: DataFrame) -> DataFrame:
    """(conv_id, leaves, saved): sums over each chain and all chains below it, from (conv_id, up, leaves, saved).

    After round k a chain holds the sums of those less than 2^k steps below,
    and points 2^k steps up.
    """
    now = cut(chains)
    while not now.filter("up IS NOT NULL").isEmpty():
        gift = (now.filter("up IS NOT NULL").groupBy(F.col("up").alias("conv_id"))
                .agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s")))
        above = now.select(F.col("conv_id").alias("up"), F.col("up").alias("far"))
        now = cut(now.join(above, "up", "left").join(gift, "conv_id", "left").select(
            "conv_id", F.col("far").alias("up"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")))
    return now.select("conv_id", "leaves", "saved")


def sums_below(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, leaves, saved): sums over the rows (conv_id, depth, leaves, saved) of a chain from each depth on.

    Inside bands of the chain, plus the bands below, so a long chain is no single sort.
    """
    banded = rows.withColumn("band", F.floor(F.col("depth") / BAND))
    deeper = Window.partitionBy("conv_id").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("conv_id", "band").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    below = banded.groupBy("conv_id", "band").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s")).select(
        "conv_id", "band", F.coalesce(F.sum("l").over(deeper), F.lit(0)).alias("l"),
        F.coalesce(F.sum("s").over(deeper), F.lit(0)).alias("s"))
    summed = banded.select("conv_id", "band", "depth", F.sum("leaves").over(inside).alias("leaves"),
                           F.sum("saved").over(inside).alias("saved"))
    return summed.join(below, ["conv_id", "band"]).select(
        "conv_id", "depth", (F.col("leaves") + F.col("l")).alias("leaves"), (F.col("saved") + F.col("s")).alias("saved"))


def prefix_trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    A null role or text is empty; null turn numbers come first, turns of equal
    number in the order of their digest; repeated rows are turns of their own. A
    null conversation id names no conversation: its rows take no part. Turns of
    the same role and text are equal, however long. Other columns are not
    looked at. An empty table has no conversation and no node.
    """
    convs, placed = rebuilt(ordered_turns(turns, conv, turn, role, text))
    local = cut(local_nodes(convs, placed))
    name, parent = ["depth", "z1", "z2"], [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("z1"), F.col("p2").alias("z2")]
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n")).filter("n > 0").select(
        zero.alias("depth"), zero.alias("z1"), zero.alias("z2"), F.lit(None).cast("long").alias("p1"),
        F.lit(None).cast("long").alias("p2"), "conv_id", "n", zero.alias("chars"))
    nodes = cut(local.groupBy(*name).agg(F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.min("conv_id").alias("conv_id"),
                                         F.sum("n").alias("n"), F.first("chars").alias("chars")).unionByName(root))
    turnless = convs.filter("len = 0").groupBy("shard").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ends"))
    ends = local.filter("ends IS NOT NULL").select(*name, "shard", "ends").unionByName(
        turnless.select(zero.alias("depth"), zero.alias("z1"), zero.alias("z2"), "shard", "ends"))
    children = nodes.filter("depth > 0").groupBy(*parent).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("z1").alias("p1"), F.col("z2").alias("p2"),
                         F.col("conv_id").alias("parent_conv_id"))
    known = cut(nodes.join(children, name, "left").join(end_hashes(ends), name, "left").join(above, ["depth", "p1", "p2"], "left")
                .select("conv_id", "depth", "parent_conv_id", "n", F.coalesce("n_children", zero).alias("n_children"),
                        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
                        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
                        ((F.col("n") - 1) * F.col("chars")).alias("saved")))
    tops = known.filter("parent_conv_id IS NULL OR parent_conv_id <> conv_id").select(
        "conv_id", F.col("parent_conv_id").alias("up"), F.col("depth").alias("top"))
    own = known.groupBy("conv_id").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    totals = chain_totals(own.join(tops, "conv_id").select("conv_id", "up", "leaves", "saved"))
    # What branches off a chain counts for the node where it does and those above.
    branches = totals.join(tops, "conv_id").filter("up IS NOT NULL").groupBy(
        F.col("up").alias("conv_id"), (F.col("top") - 1).alias("depth")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
    given = known.select("conv_id", "depth", "leaves", "saved").join(branches, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", (F.col("leaves") + F.coalesce("l", zero)).alias("leaves"), (F.col("saved") + F.coalesce("s", zero)).alias("saved"))
    return known.drop("leaves", "saved").join(sums_below(given), ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), "ends_sha256")
