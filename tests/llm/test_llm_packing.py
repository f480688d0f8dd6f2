import zlib
from itertools import combinations_with_replacement

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import AWKWARD, frame, prose
from ledgerspark.llm import packing
from ledgerspark.llm.queries import word_bpe


def expected(texts, limit):
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(word_bpe())
    out = []
    for i, text in enumerate(texts):
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        out += [(i, k, s, len(ids[s:s + limit]), zlib.crc32(ids[s:s + limit].tobytes()))
                for k, s in enumerate(range(0, len(ids), limit))]
    return sorted(out)


@pytest.mark.parametrize("limit", [16, 2048])
def test_pieces_and_places(spark, limit):
    texts = AWKWARD + [prose(k, 30 * k) for k in range(30)]
    texts += ["it's <|endoftext|> don't", "Å é, x y 12,5 !!", "q" * 9000 + " z"]
    got = packing.pack_documents(frame(spark, texts), word_bpe(), limit, block=200).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
                  for r in got) == expected(texts, limit)
    used = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == used.get(r["sequence_id"], 0)
        used[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(used.values()) <= limit


def test_no_documents(spark):
    assert packing.pack_documents(frame(spark, []), word_bpe()).count() == 0


def fewest(lengths, limit):
    """Least number of bins by trying all placements."""
    best = len(lengths)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for k in {b: j for j, b in enumerate(bins)}.values():
            if bins[k] + lengths[i] <= limit:
                go(i + 1, bins[:k] + [bins[k] + lengths[i]] + bins[k + 1:])
        go(i + 1, bins + [lengths[i]])
    go(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_bins_hold_all_and_are_nearly_fewest(lengths):
    counts = {v: lengths.count(v) for v in lengths}
    bins = packing.bin_completion(counts, 20)
    assert sorted(v for b in bins for v in b) == sorted(lengths)
    assert all(sum(b) <= 20 for b in bins)
    assert len(bins) <= len(packing.best_fit(counts, 20))
    assert len(bins) <= fewest(sorted(lengths, reverse=True), 20) + 1


def test_beats_best_fit_decreasing():
    # best fit pairs 6 with 4; three full bins of 10 need 6+2+2, 5+5, 4+3+3
    lengths = [6, 5, 5, 4, 3, 3, 2, 2]
    counts = {v: lengths.count(v) for v in lengths}
    assert len(packing.bin_completion(counts, 10)) == 3
    found = any(
        len(packing.bin_completion(c, 20)) < len(packing.best_fit(c, 20))
        for parts in combinations_with_replacement([3, 5, 6, 7, 9, 11], 7)
        for c in [{v: parts.count(v) for v in parts}])
    assert found


@pytest.mark.parametrize("parts,copies", [([500, 450, 400, 380, 318], 1000),
                                          ([600, 500, 400, 248, 180, 120], 60)])
def test_full_bins_of_five_and_more_pieces(parts, copies):
    assert sum(parts) == 2048
    bins = packing.bin_completion({v: copies for v in parts}, 2048)
    assert len(bins) == copies and all(sum(b) == 2048 for b in bins)
    assert sorted(v for b in bins for v in b) == sorted(parts * copies)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 6), min_size=1, max_size=9))
def test_short_pieces_take_the_fewest_bins(lengths):
    bins = packing.bin_completion({v: lengths.count(v) for v in lengths}, 12)
    assert sorted(v for b in bins for v in b) == sorted(lengths)
    assert len(bins) == fewest(sorted(lengths, reverse=True), 12)
