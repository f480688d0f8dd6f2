import bisect
import collections
import hashlib
import zlib

from cases import AWKWARD, frame, prose
from ledgerspark.llm import sharding


def shard(spark, texts, ids=None, **options):
    return sharding.assign(frame(spark, texts, ids), **options).collect()


def check(rows, texts, shards):
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts)
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == want
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_counts_and_slots(spark):
    texts = AWKWARD + [prose(k, 5) for k in range(300)]
    check(shard(spark, texts, per_slice=20), texts, 8)
    check(shard(spark, texts[:5]), texts[:5], 8)
    assert shard(spark, []) == []


def test_a_hot_key_spreads(spark):
    texts = [prose(k, 4) for k in range(400)]
    ids = [7] * 200 + [None] * 50 + list(range(150))
    check(shard(spark, texts, ids, per_slice=10), texts, 8)


def test_repeatable_and_little_movement(spark):
    texts = [prose(k, 4) for k in range(3000)]
    a, again, b = ({r["doc_id"]: r["shard"] for r in shard(spark, texts, shards=n, vnodes=128)}
                   for n in (8, 8, 9))
    assert a == again
    moved = sum(a[k] != b[k] for k in a) / len(a)
    assert moved < 0.4                              # a fresh hash modulo 9 would move 8 of 9


def test_segments_follow_the_ring():
    plan = sharding.segments([0, 1, 2], {0: 5, 1: 1, 2: 0}, [2, 2, 2])
    assert plan == [(0, 0, 2, 0), (1, 0, 1, 1), (0, 2, 1, 1), (0, 3, 2, 2)]


def walked(ids, shards, vnodes):
    """doc_id -> shard, one key after the other: keys wait at their arc in order of position; in
    each sweep of the ring every waiting key tries the next point's shard."""
    ring = sharding.points(shards, vnodes)
    at = [p for p, _ in ring]
    waiting = collections.defaultdict(list)
    for i in sorted(ids, key=lambda i: hashlib.sha256(str(i).encode()).hexdigest()[:8]):
        pos = int(hashlib.sha256(str(i).encode()).hexdigest()[:8], 16)
        waiting[bisect.bisect_left(at, pos) % len(ring)].append(i)
    room = [len(ids) // shards + (s < len(ids) % shards) for s in range(shards)]
    out, step = {}, 0
    while len(out) < len(ids):
        for arc in sorted(waiting):
            shard = ring[(arc + step) % len(ring)][1]
            while waiting[arc] and room[shard]:
                out[waiting[arc].pop(0)] = shard
                room[shard] -= 1
        step += 1
    return out


def test_equals_a_walk_key_by_key(spark):
    ids = list(range(5, 1400, 3))
    texts = [prose(k, 3) for k in ids]
    for shards, vnodes, per_slice in ((8, 64, 50_000), (5, 3, 10), (3, 1, 7)):
        got = {r["doc_id"]: r["shard"] for r in shard(
            spark, texts, ids, shards=shards, vnodes=vnodes, per_slice=per_slice)}
        assert got == walked(ids, shards, vnodes)
