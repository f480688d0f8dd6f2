import math
import random

import zstandard
from cases import AWKWARD, frame, prose
from ledgerspark.llm import common, quality


def corpus(n=400):
    r = random.Random(2)
    texts, labels = [], []
    for k in range(n):
        words = prose(k, r.randrange(20, 200), 900).split()
        good = k % 3 != 0
        texts.append(" ".join(words) + "." if good else
                     " ".join(w.upper() + r.choice(["!!", "$$$", "|"]) for w in words))
        labels.append((k, int(good), 5))
    return texts, labels


def test_held_out_accuracy(spark):
    texts, labels = corpus()
    lab = spark.createDataFrame(labels + [(1, None, 0), (None, 1, 0), (2, 7, 0)],
                                "doc_id long, quality int, score int")
    got = quality.classify(frame(spark, texts), lab).where(
        common.hash_mod("doc_id", 3) == 1).collect()
    truth = {k: y for k, y, _ in labels}
    right = [r["predicted"] == truth[r["doc_id"]] for r in got]
    assert len(right) > 80 and sum(right) / len(right) > 0.95


def test_awkward_texts_and_repeated_rows(spark):
    texts, labels = corpus(150)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = frame(spark, texts + AWKWARD + AWKWARD, list(range(150)) + [None] * 10 + [3] * 10)
    got = quality.classify(docs, lab, keep=["doc_id", "word"]).collect()
    assert len(got) == 170 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.5) and r["word"] == "w" for r in got)


def test_without_labels_of_both_classes(spark):
    lab = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(frame(spark, ["a", None]), lab).collect()
    assert [(r["score"], r["predicted"]) for r in got] == [(0.5, 1), (0.5, 1)]
    assert quality.classify(frame(spark, []), lab).count() == 0


def test_scores_match_a_second_compressor(spark):
    """Sizes taken with dictionaries and compressors made here, text by text."""
    texts, labels = corpus(150)
    texts = texts + AWKWARD
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = frame(spark, texts)
    model = quality.fit(docs, lab, common.hash_mod("doc_id", 3) != 1)
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}

    def size(block, data):
        kind = {} if data[:4] == bytes.fromhex("37a430ec") else {
            "dict_type": zstandard.DICT_TYPE_RAWCONTENT}
        made = zstandard.ZstdCompressionDict(data, **kind)
        return len(zstandard.ZstdCompressor(
            level=quality.LEVEL, dict_data=made, write_checksum=False, write_content_size=False,
            write_dict_id=False).compress(block))

    for i, t in enumerate(texts[:20] + texts[-10:]):
        i = i if i < 20 else len(texts) - 30 + i
        raw, x = (t or "").encode(), 0.0
        blocks = [raw[k:k + quality.BLOCK] for k in range(0, len(raw), quality.BLOCK)][:40]
        if len(raw) <= 40 * quality.BLOCK:
            if raw:
                x = sum(size(b, model.bad) - size(b, model.good) for b in blocks) / len(raw)
            want = 1 / (1 + math.exp(-(model.slope * x + model.intercept)))
            assert abs(got[i] - want) < 1e-9
