"""Small tables with the cases that every operator has to bear."""

import random

DOCS = "doc_id long, text string, word string, row long, chunk long, pos int"


def frame(spark, texts, ids=None):
    """documents with further columns whose names operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "w", 7, 1, 2) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def changed(text, seed, n):
    """``text`` with n words replaced."""
    r, words = random.Random(seed), text.split()
    for i in r.sample(range(len(words)), n):
        words[i] = f"x{seed}y{i}"
    return " ".join(words)


AWKWARD = [None, "", "   \n\t ", "one", "two words here", "é É ß   Ä", "same text here now ok",
           "same text here now ok", "SAME text here now OK", "long " * 30_000 + "end"]
