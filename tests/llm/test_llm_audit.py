import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import filter_audit as A

DOCS = "doc_id long, text string, source string, part string, n long, content int, E boolean"


def frames(spark, docs, labels=()):
    return (spark.createDataFrame([(*d, "p", 9, 1, True) for d in docs], DOCS),
            spark.createDataFrame([(*x, "t") for x in labels],
                                  "doc_id long, quality int, toxic int, text string"))


def failing(docs):
    """The letters that each row fails, text by text."""
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    out = []
    for i, text, _ in docs:
        text = text or ""
        words = [w for w in re.split("[\x20\x09-\x0d]", text) if w]
        out.append({x for x, bad in (
            ("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)),
            ("C", 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text)),
            ("D", any(c in "#$%&*|" for c in text)),
            ("E", i is not None and first[text] < i)) if bad})
    return out


def brute(docs, labels):
    fails = failing(docs)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = {}
    parts = {s or "" for _, _, s in docs}
    for p in parts:
        rows = [(d[0], f) for d, f in zip(docs, fails) if (d[2] or "") == p]
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = rows
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                total[letter] += len(gone)
                out[p, order, step] = [
                    len(left), len(gone),
                    sum(letter in f and any(x in f for x in order[:step - 1]) for _, f in rows),
                    sum(f == {letter} for _, f in rows), sum(i in good for i, _ in gone),
                    sum(i in toxic for i, _ in gone), letter]
        for (q, _, _), v in out.items():
            if q == p:
                v[-1] = total[v[-1]]
    return {k: tuple(v) for k, v in out.items()}


def result(df):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in df.collect()}


def prose(r, n, vocabulary):
    return " ".join(r.choice(["w", "W", "é"]) + str(r.randrange(vocabulary)) for _ in range(n))


def test_documents_match_brute_force(spark):
    r = random.Random(1)
    texts = [prose(r, r.choice([50, 250, 400]), r.choice([20, 2000])) for _ in range(40)]
    texts += [t.lower() for t in texts[:20]] + ["a|b", "x " * 300, "#", " \t\n", "", None]
    docs = [(r.randrange(200), r.choice(texts), r.choice(["a", "b", "", None, "only one"]))
            for _ in range(150)] + [(None, texts[0], "a"), (None, texts[0], "a"), (500, "", "z")]
    docs += [(0, texts[0], "a")] * 3                       # rows that share the smallest id
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 200, 2)]
    labels += [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    d, m = frames(spark, docs, labels)
    got = result(A.audit_documents(d, m))
    assert got == brute(docs, labels)
    assert len(got) == 600 * len({s or "" for _, _, s in docs})


def test_copies_and_long_texts(spark):
    long = "Word " * 100_000
    docs = [(i, long if i % 3 else "same $", "hot") for i in range(60)] + [(99, "x", None)]
    d, m = frames(spark, docs)
    assert result(A.audit_documents(d, m)) == brute(docs, [])


def test_empty_tables(spark):
    d, m = frames(spark, [])
    assert A.audit_documents(d, m).count() == 0
    one, _ = frames(spark, [(1, None, None)])
    got = result(A.audit_documents(one, m))
    assert set(k[0] for k in got) == {""} and got["", "ABCDE", 1][:2] == (0, 1)


@pytest.mark.parametrize("k", [1, 3, 5])
def test_removal_steps_are_first_failing_filters(k):
    orders, steps = A.positions(k)
    fails = np.array(list(itertools.product([False, True], repeat=k)))
    got = A.removal_steps(fails, steps)
    for i, f in enumerate(fails):
        for o, order in enumerate(orders):
            assert got[i, o] == next((s for s, x in enumerate(order) if f[x]), k)


def test_general_interface_takes_any_filters(spark):
    df = spark.createDataFrame([("p", True, None, 2), ("p", True, True, 3), (None, False, True, 5)],
                               "g string, x boolean, y boolean, c long")
    got = result(A.audit(df, {"x": F.col("x"), "y": F.col("y")}, F.col("g"),
                         {"lost": F.col("x") & F.col("y")}, F.col("c"), parts_at_once=1))
    assert got["p", "xy", 1] == (0, 5, 0, 2, 3, 5 + 2)
    assert got["p", "xy", 2] == (0, 0, 3, 0, 0, 3)
    assert got["", "yx", 1] == (0, 5, 0, 5, 0, 10)
    with pytest.raises(ValueError):
        A.audit(df, {}, F.col("g"), {})
