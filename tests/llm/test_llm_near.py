import collections
import random

from cases import AWKWARD, changed, frame, prose
from ledgerspark.llm import ngram_join


def shingles(text):
    w = (text or "").encode().lower().split()
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute(ids, texts):
    """{doc_id: (n, component)} for distinct ids, by comparing all pairs."""
    sets = [shingles(t) for t in texts]
    up = list(range(len(ids)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                up[max(find(i), find(j))] = min(find(i), find(j))
    least = collections.defaultdict(list)
    for k in range(len(ids)):
        least[find(k)].append(ids[k])
    return {ids[k]: (len(sets[k]), min(least[find(k)])) for k in range(len(ids))}


def result(spark, ids, texts):
    got = ngram_join.near_duplicates(frame(spark, texts, ids).repartition(3)).collect()
    stays = collections.Counter(r["component_id"] for r in got if r["stays"] and r["n_shingles"])
    assert all(n == 1 for n in stays.values())
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}


def test_families_chains_and_shared_passages(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK_BITS", 4)
    monkeypatch.setattr(ngram_join, "RANGE_SHINGLES", 500)
    texts, r = list(AWKWARD[:9]), random.Random(5)
    for f in range(6):                                   # near copies around the threshold
        base = prose(f, 120)
        texts += [changed(base, 100 * f + k, r.randrange(1, 9)) for k in range(9)]
    chain = prose(77, 200)                               # links only between neighbours
    for k in range(10):
        texts.append(chain)
        chain = changed(chain, 900 + k, 4)
    passage = prose(55, 60)                              # much text in common, but no link
    texts += [passage + " " + prose(300 + k, 6 + k) for k in range(25)]
    ids = r.sample(range(10_000), len(texts))
    assert result(spark, ids, texts) == brute(ids, texts)


def test_one_large_group_needs_no_pairs(spark):
    base = prose(3, 150)
    texts = [changed(base, k, 2) for k in range(300)]
    ids = list(range(5, 305))
    assert {c for _, c in result(spark, ids, texts).values()} == {5}


def test_exact_threshold(spark):
    # sets of 7 and 7 with 6 in common: 6 / 8 = 0.75 links; 5 / 9 does not
    a = " ".join("abcdefghijk")
    texts = [a, a[:-1] + "z", a[:-3] + "y z"]
    assert result(spark, [3, 1, 2], texts) == brute([3, 1, 2], texts)


def test_null_and_repeated_ids_and_no_rows(spark):
    texts = ["a b c d e f", "a b c d e f", "a b c d e f", "other words are in here"]
    got = ngram_join.near_duplicates(frame(spark, texts, [None, 9, 9, None])).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == [
        ("9", "9"), ("9", "9"), ("None", "9"), ("None", "None")]
    assert sum(r["stays"] for r in got) == 2
    assert ngram_join.near_duplicates(frame(spark, [])).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)]
    got = {r["node"]: r["comp"] for r in ngram_join.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 140)}}


def test_packed_blocks():
    import numpy as np
    v = np.unique(np.random.default_rng(0).integers(0, 1 << 48, 5000).astype(np.uint64))
    assert (ngram_join._unpack(ngram_join._pack(v)) == v).all()
