"""Conversation prefix trie by bursting.

A conversation is a sequence of turn codes; every distinct prefix of the sequences is a node.
Method (burst trie over shards): a *container* holds the distinct sequences below one trie head as
suffixes, each with its members counted. Containers above ``limit`` suffixes burst: the run of
turns that all their suffixes share and the turn after it are taken off, the shared run becomes a
*segment* of trie heads, and each next turn id gets a container of its own. Rounds of bursting go
on until no container is oversized. Spark then shards the remaining containers by their head and
sorts their suffixes, and one pass over the sorted rows sweeps them into nodes with a stack.
Segments get their figures from the containers below them by grouped sums along the path of heads.

Why it scales: equal conversations become one suffix with a count before any container is made
(their ids are joined to text in ranges of 4096, and hashed as a stream), so thousands of copies
cannot keep a container oversized; a first turn that a third of all conversations share is a head,
and its containers are spread over tasks; shared runs are taken off whole, so a round never spends
itself on one turn. A sweep holds the open path and the finished children of its nodes: at most
``limit`` records and one conversation. Nothing is collected to the driver but row counts.
Every round is stored, so that a lost executor repeats one round at most.

Turn codes are 20 bytes: the first 16 of the SHA-256 of role and text, then the code points of the
text. Equal codes mean equal turns (up to SHA-256), byte order of sequences is an order of turns,
and prefixes of sequences are prefixes of bytes.

Defined results: null roles and texts are empty; turns are ordered by turn (null first), ties by
their code; repeated rows are repeated turns; rows without conv_id take no part; a sequence
without turns is a member of the root only; without sequences there are no nodes; further columns
are ignored. Texts become codes where they are read, so very long ones are never moved; a sequence
must fit one value (100 million turns).
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

common.by_value(__name__)

WIDTH = 20                   # bytes of a turn code
ID_BYTES = 16
LIMIT = 20_000               # suffixes of a container
BROADCAST_HEADS = 100_000    # heads of a round that are sent to all tasks; more are joined
RUN_BITS = 12                # member ids are joined to text in ranges of 2^12
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string")


def turn_code(role: Column, text: Column) -> Column:
    """Code of a turn: identity and length of its text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.concat(F.substring(F.sha2(whole, 256), 1, 2 * ID_BYTES),
                            F.lpad(F.hex(F.length(text)), 8, "0")))


def sequences(conversations: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, seq (its turn codes in order)."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", F.struct("turn", turn_code(F.col("role"), F.col("text")).alias("code"))
        .alias("row"))
    ordered = F.sort_array(F.collect_list("row"))
    return rows.groupBy("conv_id").agg(F.unhex(F.array_join(
        F.transform(ordered, lambda r: F.hex(r["code"])), "")).alias("seq"))


def turns(seq: Column, start: Column | int, n: Column | int | None = None) -> Column:
    """``n`` turns of a sequence (all by default) after the first ``start``."""
    at = (F.lit(start) * WIDTH + 1).cast("int")
    size = F.octet_length(seq) if n is None else (F.lit(n) * WIDTH)
    return F.substring(seq, at, size.cast("int"))


def _n_turns(seq: Column) -> Column:
    return F.floor(F.octet_length(seq) / WIDTH).cast("int")


def _shared_turns(a: Column, b: Column) -> Column:
    """Turns of the longest common prefix of two sequences."""
    n = F.least(_n_turns(a), _n_turns(b))
    differ = F.transform(F.sequence(F.lit(0), n - 1), lambda i: turns(a, i, 1) != turns(b, i, 1))
    first = F.array_position(differ, F.lit(True)).cast("int")
    return F.when(n == 0, 0).when(first == 0, n).otherwise(first - 1)


def _id(*parts: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, ID_BYTES)


def _digests(batches):
    """Sorted runs of member ids to one row a sequence, its ids hashed as one stream."""
    now, row, digest, out = None, None, None, []

    def batch():
        cols = list(zip(*out))
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()),
             pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string())],
            names=["suffix", "first", "n", "ends"])

    for b in batches:
        for seq, ids, first, n in zip(*(b.column(c).to_pylist()
                                        for c in ("seq", "ids", "first", "n"))):
            if row is None or seq != now:
                if row is not None:
                    out.append((*row, digest.hexdigest()))
                now, row, digest = seq, [seq, first, 0], hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
            row[2] += n
            if len(out) >= 10_000:
                yield batch()
                out = []
    if row is not None:
        out.append((*row, digest.hexdigest()))
        yield batch()


def distinct_sequences(seqs: DataFrame) -> DataFrame:
    """One row a distinct sequence: suffix, first (smallest member), n (members), ends (SHA-256 of
    the members' ids in ascending order, joined by commas)."""
    runs = seqs.groupBy("seq", F.shiftright("conv_id", RUN_BITS).alias("run")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",")
        .alias("ids"), F.min("conv_id").alias("first"), F.count("*").alias("n"))
    return runs.repartition("seq").sortWithinPartitions("seq", "run") \
        .select("seq", "ids", "first", "n") \
        .mapInArrow(_digests, "suffix binary, first long, n long, ends string")


class _Node:
    __slots__ = ("depth", "size", "first", "n", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, depth: int, size: int):
        self.depth, self.size, self.first, self.n = depth, size, None, 0
        self.children = self.leaves = self.saved = 0
        self.ends, self.waiting = NO_ENDS, []

    def add(self, first: int, n: int) -> None:
        self.first = first if self.first is None else min(self.first, first)
        self.n += n


def _sweep(batches):
    """Rows of whole containers, sorted by head and suffix, to their nodes. The top node of a
    container has its path; its parent is a head, known later."""
    head, before, path, stack, out = None, b"", [], [], []

    def emit(node, parent, top):
        out.append((top, path if top else None, node.first, node.depth, parent, node.n,
                    node.children, node.leaves, node.saved, node.ends))

    def close(to: int):
        while len(stack) > to:
            node = stack.pop()
            node.leaves = node.leaves or 1
            node.saved += (node.n - 1) * node.size
            for child in node.waiting:
                emit(child, node.first, False)
            node.waiting = None
            if stack:
                up = stack[-1]
                up.add(node.first, node.n)
                up.children += 1
                up.leaves += node.leaves
                up.saved += node.saved
                up.waiting.append(node)
            else:
                emit(node, None, True)

    def batch():
        kinds = [pa.bool_(), pa.list_(pa.binary()), *[pa.int64()] * 7, pa.string()]
        names = ["top", "path", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                 "n_leaves", "saved_tokens", "ends_sha256"]
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                          names=names)
        out.clear()
        return made

    columns = ("head", "depth", "top_size", "path", "suffix", "first", "n", "ends")
    for b in batches:
        for h, depth, size, p, suffix, first, n, ends in zip(
                *(b.column(c).to_pylist() for c in columns)):
            if h != head or not stack:
                close(0)
                head, before, path = h, b"", p
                stack.append(_Node(depth, size))
            at, least = 0, min(len(before), len(suffix))
            while at < least and before[at:at + WIDTH] == suffix[at:at + WIDTH]:
                at += WIDTH
            close(at // WIDTH + 1)
            for i in range(at, len(suffix), WIDTH):
                stack.append(_Node(stack[-1].depth + 1,
                                   int.from_bytes(suffix[i + ID_BYTES:i + WIDTH], "big")))
            stack[-1].add(first, n)
            stack[-1].ends = ends
            before = suffix
            if len(out) >= 20_000:
                yield batch()
    close(0)
    if out:
        yield batch()


def _segment_nodes(batches):
    """Segments with their figures to one row a head of them."""
    for b in batches:
        for r in b.to_pylist():
            chain = r["chain"]
            sizes = [r["top_size"], *(int.from_bytes(chain[i + ID_BYTES:i + WIDTH], "big")
                                      for i in range(0, len(chain), WIDTH))]
            saved, last, rows = r["saved"], len(sizes) - 1, []
            for i in range(last, -1, -1):
                saved += (r["n"] - 1) * sizes[i]
                rows.append({
                    "conv_id": r["first"], "depth": r["depth"] + i,
                    "parent_conv_id": r["first"] if i else r["parent_first"], "n_convs": r["n"],
                    "n_children": 1 if i < last else r["children"], "n_leaves": r["leaves"],
                    "saved_tokens": saved,
                    "ends_sha256": r["ends"] if i == last and r["ends"] else NO_ENDS})
                if len(rows) >= 20_000:
                    yield pa.RecordBatch.from_pylist(rows, schema=_NODE_SCHEMA)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=_NODE_SCHEMA)


_NODE_SCHEMA = pa.schema([
    pa.field(name, pa.string() if kind == "string" else pa.int64())
    for name, kind in (f.split() for f in NODE.split(", "))])


def _burst(items: DataFrame, limit: int):
    """All containers made small: (items of small containers, segments, rows that end at the last
    head of a segment); the latter two are None when nothing was oversized."""
    small, segments, ended = [], [], []
    while True:
        sizes = items.groupBy("head").agg(
            F.count("*").alias("n"), F.min("suffix").alias("lo"), F.max("suffix").alias("hi"),
            F.first("depth").alias("depth"), F.first("top_size").alias("top_size"),
            F.first("path").alias("path"))
        big = sizes.where(F.col("n") > limit).withColumn("shared", _shared_turns(
            F.col("lo"), F.col("hi")))
        chain = turns(F.col("lo"), 0, F.col("shared"))
        big = common.stored(big.select("head", "depth", "top_size", "path", "shared",
                                       chain.alias("chain"),
                                       _id(F.col("head"), chain).alias("segment")), "trie-heads")
        n_big = big.count()
        if n_big == 0:
            small.append(items)
            break
        heads = big.select("head", "shared", "segment")
        if n_big <= BROADCAST_HEADS:
            heads = F.broadcast(heads)
        met = items.join(heads, "head", "left")
        inner = F.col("segment").isNotNull()
        small.append(met.where(~inner).drop("shared", "segment"))
        segments.append(big)
        below = met.where(inner).withColumn("rest", turns(F.col("suffix"), F.col("shared"))) \
            .withColumn("path", F.concat("path", F.array("segment")))
        ends_here = F.octet_length("rest") == 0
        ended.append(below.where(ends_here).select("segment", "path", "first", "n", "ends"))
        turn = turns(F.col("rest"), 0, 1)
        size = F.conv(F.hex(F.substring(turn, ID_BYTES + 1, WIDTH - ID_BYTES)), 16, 10)
        items = common.stored(below.where(~ends_here).select(
            _id(F.col("segment"), turn).alias("head"),
            (F.col("depth") + F.col("shared") + 1).alias("depth"),
            size.cast("long").alias("top_size"), "path", turns(F.col("rest"), 1).alias("suffix"),
            "first", "n", "ends"), "trie-containers")

    def union(parts):
        whole = parts[0]
        for p in parts[1:]:
            whole = whole.unionByName(p)
        return whole
    return union(small), *((union(x) if x else None) for x in (segments, ended))


def trie(seqs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The nodes of the trie of sequences (conv_id, seq), conv_id not null and unique.

    A node is known by (conv_id, depth): its smallest member and its turns. Columns: conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    ``limit`` is the largest container that is swept by one task; it changes the plan only.
    """
    if limit < 1:
        raise ValueError("a container holds at least one suffix")
    items = distinct_sequences(seqs).select(
        F.expr("X''").alias("head"), F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("top_size"), F.array().cast("array<binary>").alias("path"),
        "suffix", "first", "n", "ends")
    small, segments, ended = _burst(common.stored(items, "trie-sequences"), limit)
    swept = small.repartition("head").sortWithinPartitions("head", "suffix").mapInArrow(
        _sweep, f"top boolean, path array<binary>, {NODE}")
    columns = [f.split()[0] for f in NODE.split(", ")]
    if segments is None:
        return swept.select(*columns)
    swept = common.stored(swept, "trie-nodes")
    tops = swept.where("top").withColumn("segment", F.element_at("path", -1))
    # every container and every end counts for all segments above it
    below = tops.select("path", "n_convs", F.col("conv_id").alias("first"),
                        F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")) \
        .unionByName(ended.select("path", F.col("n").alias("n_convs"), "first",
                                  F.lit(0).cast("long").alias("leaves"),
                                  F.lit(0).cast("long").alias("saved")))
    sums = below.withColumn("segment", F.explode("path")).groupBy("segment").agg(
        F.sum("n_convs").alias("n"), F.min("first").alias("first"),
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    parent = F.when(F.size("path") > 0, F.element_at("path", -1)).alias("segment")
    children = tops.select("segment").unionByName(segments.select(parent)) \
        .groupBy("segment").agg(F.count("*").alias("children"))
    lengths = F.transform(F.sequence(F.lit(0), F.col("shared")), lambda i: F.when(
        i == 0, F.col("top_size")).otherwise(F.conv(F.hex(F.substring(
            turns(F.col("chain"), i - 1, 1), ID_BYTES + 1, WIDTH - ID_BYTES)), 16, 10).cast("long")))
    total = F.aggregate(lengths, F.lit(0).cast("long"), lambda s, x: s + x)
    known = segments.join(sums, "segment").join(children, "segment") \
        .join(ended.select("segment", "ends"), "segment", "left") \
        .withColumn("own", (F.col("n") - 1) * total)
    known = common.stored(known, "trie-segments")
    deeper = known.select("own", F.explode("path").alias("segment")).groupBy("segment").agg(
        F.sum("own").alias("deeper"))
    firsts = known.select("segment", F.col("first").alias("parent_first"))
    if known.count() <= BROADCAST_HEADS:
        firsts = F.broadcast(firsts)
    whole = known.withColumn("up", F.when(F.size("path") > 0, F.element_at("path", -1))) \
        .join(deeper, "segment", "left") \
        .join(firsts.withColumnRenamed("segment", "up"), "up", "left") \
        .withColumn("saved", F.col("saved") + F.coalesce("deeper", F.lit(0)))
    heads = whole.select("depth", "top_size", "chain", "first", "n", "children", "leaves", "saved",
                         "ends", "parent_first").mapInArrow(_segment_nodes, NODE)
    topped = tops.drop("parent_conv_id").join(firsts, "segment") \
        .withColumnRenamed("parent_first", "parent_conv_id")
    return heads.unionByName(topped.select(*columns)) \
        .unionByName(swept.where("NOT top").select(*columns))
