import hashlib
import random
import zlib

import pytest

from ledgerspark.llm import prefix_trie as T
from ledgerspark.llm.queries import rebuilt_conversations

SCHEMA = "conv_id long, turn long, role string, text string, depth int, path string"
COLUMNS = [f.split()[0] for f in T.NODE.split(", ")]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def ordered(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in convs.items()}


def brute(convs):
    """Every node of {conv_id: turns} from all prefixes, subtrees by scanning all nodes."""
    members = {}
    for c, w in convs.items():
        for d in range(len(w) + 1):
            members.setdefault(tuple(w[:d]), []).append(c)
    own = {p: (len(m) - 1) * (len(p[-1][1]) if p else 0) for p, m in members.items()}
    children, leaves, saved = {}, {}, {}
    for p in members:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    for p in members:
        for d in range(len(p) + 1):
            saved[p[:d]] = saved.get(p[:d], 0) + own[p]
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in children)
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(convs[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m),
                    children.get(p, 0), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def nodes(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def check(spark, rows, limits=(1, 3, 20_000)):
    want = brute(ordered(rows))
    for limit in limits:
        assert nodes(T.trie(T.sequences(table(spark, rows)), limit)) == want


def rebuild(convs):
    out = {}
    for c, w in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + w[h:]
    return out


AWKWARD = [(1, None, "user", "a"), (1, 0, None, None), (1, 1, "", ""), (2, 0, "user", "a"),
           (3, 0, "user", "a"), (3, 5, "user", "b"), (4, 0, "us", "era"), (5, 0, "user", "a"),
           (6, 7, "user", "long " * 40_000), (None, 0, "user", "no id"), (-7, 0, "user", "a"),
           (8, 1, "x", "same"), (8, 1, "x", "same"), (8, 1, "x", "same")]


def test_awkward_rows(spark):
    check(spark, AWKWARD)


def test_empty_table(spark):
    assert T.trie(T.sequences(table(spark, []))).collect() == []


def test_sequences_without_turns(spark):
    empty = spark.createDataFrame([(4, b""), (2, b"")], "conv_id long, seq binary")
    ends = hashlib.sha256(b"2,4").hexdigest()
    assert nodes(T.trie(empty, 1)) == [(2, 0, None, 2, 0, 1, 0, ends)]
    with pytest.raises(ValueError):
        T.trie(empty, 0)


@pytest.mark.parametrize("seed", range(3))
def test_random_tries_with_bursts(spark, seed):
    r = random.Random(seed)
    rows = [(c, t, r.choice(["user", "assistant"]), r.choice("abé" if t < 3 else "abcdefgh"))
            for c in range(120) for t in range(r.randrange(1, 8))]
    check(spark, rows, limits=(2, 7, 50) if seed else (1, 4))


def test_long_shared_run_is_one_burst(spark):
    shared = [("user", f"turn {i}") for i in range(60)]
    convs = {c: shared + [("user", f"own {c}"), ("assistant", "x")][:c % 3] for c in range(40)}
    rows = [(c, i, *t) for c, w in convs.items() for i, t in enumerate(w)]
    check(spark, rows, limits=(5, 100))


def test_copies_do_not_burst(spark):
    rows = [(c, t, "user", f"{t}") for c in range(0, 9000, 2) for t in range(2)]
    assert nodes(T.trie(T.sequences(table(spark, rows)), 1)) == brute(ordered(rows))


def test_rebuilt_conversations(spark):
    r = random.Random(9)
    rows = [(c, t, "user", r.choice("ab")) for c in [*range(98, 130), *range(250, 270), 300, 1000]
            for t in range(r.randrange(1, 9))]
    got = T.trie(rebuilt_conversations(T.sequences(table(spark, rows))), 6)
    assert nodes(got) == brute(rebuild(ordered(rows)))
