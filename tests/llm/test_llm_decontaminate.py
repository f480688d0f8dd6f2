import re

from cases import AWKWARD, frame, prose
from ledgerspark.llm import decontaminate as D

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(texts, items, width=10):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - width + 1)) if w else []:
            windows.setdefault(tuple(w[k:k + width]), set()).add(i)
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                got = windows.get(tuple(w[k:k + size]))
                if got:
                    hit |= set(range(k, k + size))
                    found |= got
        out.append((len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return out


def result(spark, texts, items):
    bench = spark.createDataFrame([(i, t, "w", 3) for i, t in items],
                                  "item_id long, text string, window string, word int")
    got = D.contamination(frame(spark, texts), bench).collect()
    return [(r["n_words"], r["n_hit"], r["items"]) for r in sorted(got, key=lambda r: r["doc_id"])]


ITEMS = [(1, prose(1, 40, 60)), (2, prose(2, 12, 60)), (3, "Tiny Item"), (4, None), (5, ""),
         (6, "!!!"), (7, prose(1, 40, 60)), (1, "again one"), (None, "no id here"), (8, "w1"),
         (9, "É Ü ß"), (10, "same same same same same same same same same same same same")]


def test_equals_brute_force(spark):
    a, b = ITEMS[0][1], ITEMS[1][1]
    texts = AWKWARD + [prose(k, 300, 60) for k in range(6)]
    texts += [f"x {a} y", f"{b.upper()}!", a.replace(" ", "--"), " ".join(a.split()[5:18]),
              " ".join(a.split()[:9]), f"tiny item, TINY-item {b} {b}", "no id here w1",
              "é ü ß É Ü ß", "same " * 40, " ".join(a.split()[3:]) + " " + a]
    assert result(spark, texts, ITEMS) == brute(texts, ITEMS)


def test_shuffled_benchmark_tables(spark, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    texts = [f"x {ITEMS[0][1]} y", prose(4, 200, 60), None]
    assert result(spark, texts, ITEMS) == brute(texts, ITEMS)


def test_no_benchmark_and_no_documents(spark):
    assert result(spark, ["a b"], []) == [(2, 0, [])]
    assert result(spark, [], ITEMS) == []


def test_proximity(spark):
    bench = spark.createDataFrame([(1, "rare1 the rare2")], "item_id long, text string")
    docs = frame(spark, ["the rare2 a b rare1 c", "rare1 " + "the " * 20 + "rare2", "rare1 the"])
    index = D.build(docs, bench)
    rows = {r["row"] for r in D.proximity_matches(index, 4).collect()}
    ids = {r["row"]: r["doc_id"] for r in index.postings.where("word = ''").collect()}
    assert {ids[r] for r in rows} == {0}
    assert D.phrase_matches(index).count() == 0
