"""Sharding on a consistent-hash ring with bounded loads (operator 5), DataFrame functions only.

Every shard owns ``vnodes`` points on a ring of 2^32 positions; a key belongs to the first point
clockwise of its own position. Shards have a fixed capacity: rows / shards, the remainder spread
one by one over the first shards, so that counts differ by one at most. Keys that arrive at a full
shard go on clockwise to the next point whose shard has room.

The walk is done in bulk. Rows are counted by arc (at most shards * vnodes counts, a bound set by
parameters). From the counts alone follows, for each arc, how many of its rows in ring order stay
and how many go on to which shard: a short list of segments. A row then finds its segment by its
rank within its arc. Ranks come from fine slices of the ring (their number follows the row count)
plus a running sum over the slice counts, so that no task ranks more than a slice. Equal keys share
a position; a second hash over all fields and the row number within the scan spreads them over
sub-slices, so a key that holds a third of all rows is ranked by many tasks.

Adding a shard adds points only: a key moves if one of the new points takes over its arc or if the
changed capacities shift an overflow. ``assign`` on n + 1 shards measures that.

Defined results: null and empty texts have size 1 (null: no bytes); null ids hash as empty text;
repeated rows are rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common

RING = 1 << 32


def points(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(position, shard) of all virtual nodes in ring order; depends on nothing but the names."""
    out: dict[int, int] = {}
    for s in range(shards):
        for v in range(vnodes):
            digest = hashlib.sha256(f"shard-{s}/{v}".encode()).digest()
            out.setdefault(int.from_bytes(digest[:4], "big"), s)
    return sorted(out.items())


def segments(owner: list[int], counts: dict[int, int], capacity: list[int]) -> list[tuple]:
    """(arc, first rank, rows, shard) for rows that arrive arc by arc in ring order and go on
    clockwise past full shards. All arcs first fill their own shard, then overflow moves on, as
    long as there is any: each step is one sweep of the ring, and a sweep places rows or ends."""
    room, n = list(capacity), len(owner)
    rest = {a: (0, c) for a, c in sorted(counts.items()) if c}    # arc -> next rank, rows left
    at = {a: a for a in rest}                                     # arc whose shard is tried
    out = []
    while rest:
        for a in sorted(rest):
            rank, left = rest[a]
            shard = owner[at[a] % n]
            take = min(left, room[shard])
            if take:
                out.append((a, rank, take, shard))
                room[shard] -= take
            if take == left:
                del rest[a]
            else:
                rest[a] = (rank + take, left - take)
                at[a] += 1
    return out


def _capacity(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]



def _place(rows: DataFrame, shards: int, vnodes: int, total: int, per_slice: int) -> DataFrame:
    """``rows(_pos, _tie, ...)`` with ``shard`` and ``slot``."""
    spark = rows.sparkSession
    ring = points(shards, vnodes)
    n = len(ring)
    # arc a holds the positions after point a-1 up to point a; those beyond the last go to arc 0
    bits = max(0, min(24, (total // per_slice).bit_length() - 1))
    table = []                                   # (slice of the ring, first position, last, arc)
    width = RING >> 10
    for i in range(1 << 10):                     # each of 1024 sectors lists the arcs it meets
        lo, hi = i * width, (i + 1) * width - 1
        p = lo
        while p <= hi:
            a = bisect.bisect_left(ring, (p, -1))
            end = ring[a][0] if a < n else RING - 1
            table.append((i, p, min(end, hi), a % n))
            p = min(end, hi) + 1
    arcs = spark.createDataFrame(table, "_sector int, _lo long, _hi long, _arc int")
    keyed = rows.withColumn("_sector", F.shiftright("_pos", 22).cast("int")).join(
        F.broadcast(arcs), "_sector").where(F.col("_pos").between(F.col("_lo"), F.col("_hi")))
    # slices of an arc by position; where one is heavy, its rows spread over sub-slices
    fine = F.shiftright("_pos", 32 - bits) if bits else F.lit(0).cast("long")
    keyed = keyed.withColumn("_slice", fine)
    heavy = (keyed.groupBy("_arc", "_slice").agg(F.count("*").alias("n"))
             .where(F.col("n") > 4 * per_slice)
             .select("_arc", "_slice", (F.col("n") / per_slice).cast("int").alias("_split")))
    keyed = keyed.join(heavy, ["_arc", "_slice"], "left").withColumn(
        "_sub", F.when(F.col("_split").isNull(), F.lit(0).cast("long"))
        .otherwise(F.pmod("_tie", F.col("_split").cast("long"))))
    slice_key = ["_arc", "_slice", "_sub"]
    counts = keyed.groupBy(*slice_key).agg(F.count("*").alias("_n"))
    order = W.partitionBy("_arc").orderBy("_slice", "_sub")
    before = counts.withColumn(
        "_before", F.sum("_n").over(order.rowsBetween(W.unboundedPreceding, -1))).select(
        *slice_key, F.coalesce("_before", F.lit(0)).alias("_before"))
    per_arc = {r["_arc"]: r["n"] for r in
               counts.groupBy("_arc").agg(F.sum("_n").alias("n")).collect()}
    plan, slots, used = segments([s for _, s in ring], per_arc, _capacity(total, shards)), [], {}
    for a, rank, count, shard in plan:
        slots.append((a, rank, rank + count, shard, used.get(shard, 0)))
        used[shard] = used.get(shard, 0) + count
    plan_df = spark.createDataFrame(
        slots, "_arc int, _first long, _end long, shard int, _slot long")
    inner = W.partitionBy(*slice_key).orderBy("_pos", "_tie", "_row")
    ranked = keyed.withColumn("_in", F.row_number().over(inner) - 1).join(before, slice_key) \
        .withColumn("_rank", F.col("_before") + F.col("_in"))
    return ranked.join(F.broadcast(plan_df), "_arc").where(
        (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end"))).withColumn(
        "slot", F.col("_slot") + F.col("_rank") - F.col("_first"))


def assign(docs: DataFrame, shards: int = 8, vnodes: int = 64,
           per_slice: int = 50_000) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 within each shard)."""
    data = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_row"))
    rows = common.stored(rows, "shard-rows")       # slim rows; the texts are read once
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    pos = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("_pos", pos).withColumn(
        "_tie", F.xxhash64("doc_id", "text_crc32", "size", "_row"))
    placed = _place(rows, shards, vnodes, rows.count(), per_slice)
    return placed.select("doc_id", "size", "text_crc32", "shard", "slot")
