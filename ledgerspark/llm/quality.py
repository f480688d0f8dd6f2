"""Quality classifier by compression (operator 8).

Two zstandard dictionaries are trained, one on texts labelled good and one on texts labelled
bad. A text is cut into blocks of ``BLOCK`` bytes, each block is compressed once with either
dictionary, and the feature is the difference of the two compressed sizes per byte of text:
positive when the good dictionary explains the text better. Blocks keep the dictionaries in play
along a whole long text (a single frame would soon refer to itself only). A logistic curve fitted
on labelled rows that the dictionaries have not seen turns the feature into a score from 0 to 1.

Fitting reads a bounded sample: at most ``sample_rows`` labelled rows of each class in hash order,
and of those as many whole texts as fit ``sample_bytes`` for each class. Scoring covers every row
and all bytes of its text.

Defined results: null and empty texts have feature 0 and so the score of the curve at 0; labels
that are null or not 0/1 are ignored; several labels of one id count by their mean (0.5 counts as
good); without labelled rows of both classes every score is 0.5. Rows keep their count, repeated
ids included, and further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .common import give_back, release_caches

common.by_value(__name__)

BLOCK = 2048
LEVEL = 3


@dataclass
class Model:
    """Dictionary bytes and the two coefficients of the logistic curve."""
    good: bytes
    bad: bytes
    slope: float
    intercept: float

    @property
    def blank(self) -> bool:
        return not (self.good and self.bad)


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    if data[:4] == b"\x37\xa4\x30\xec":                # magic number of a trained dictionary
        return zstandard.ZstdCompressionDict(data)
    return zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _train(texts: list[bytes], size: int) -> bytes:
    blocks = [t[i:i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]
    try:
        return zstandard.train_dictionary(size, blocks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:                        # too few samples to train on
        return b"".join(blocks)[-size:]


def _features(texts, good: bytes, bad: bytes) -> np.ndarray:
    """(size with bad - size with good) / bytes, for each text."""
    pair = []
    for data in (good, bad):
        d = _dictionary(data)
        d.precompute_compress(level=LEVEL)
        pair.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False,
                                             write_content_size=False, write_dict_id=False))
    by_good, by_bad = (c.compress for c in pair)


    def one(t: bytes) -> float:
        blocks = (t[j:j + BLOCK] for j in range(0, len(t), BLOCK))
        return sum(len(by_bad(b)) - len(by_good(b)) for b in blocks) / len(t) if t else 0.0
    return np.fromiter(map(one, texts), float)


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression in one variable by Newton steps, with a slight ridge so that
    separable samples keep a finite slope."""
    scale = float(np.std(x)) or 1.0
    X = np.stack([x / scale, np.ones_like(x)], axis=1)
    beta, ridge = np.zeros(2), np.diag([1e-3, 1e-6])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(X @ beta, -30, 30)))
        grad = X.T @ (w * (p - y)) + ridge @ beta
        hess = (X * (w * p * (1 - p))[:, None]).T @ X + ridge
        step = np.linalg.solve(hess, grad)
        beta -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, training: Column, sample_rows: int = 3000,
        sample_bytes: int = 6_000_000, dict_bytes: int = 65_536) -> Model:
    """Fit on the labelled rows of ``labels(doc_id, quality)`` that satisfy ``training`` (a
    condition on doc_id). Half of the sample trains the dictionaries, half the curve. The sample is
    ``sample_rows`` rows and ``sample_bytes`` of whole texts of each class at most; texts longer than
    an eighth of that are scored like all others, but not trained on."""
    lab = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & training)
           .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y")))
    counts = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count("*").alias("n")).collect()}
    blank = Model(b"", b"", 0.0, 0.0)
    if len(counts) < 2:
        return blank
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [r for y in (0, 1)
              for r in lab.where(F.col("y") == y).orderBy(*order).limit(sample_rows).collect()]
    label = {r["doc_id"]: r["y"] for r in picked}      # at most 2 * sample_rows ids
    chosen = docs.sparkSession.createDataFrame(list(label.items()), "doc_id long, y int")
    rows = (docs.select("doc_id", "text").where(F.length("text") > 0)
            .join(F.broadcast(chosen), "doc_id", "left_semi"))
    sizes: dict[int, int] = {}
    for r in rows.groupBy("doc_id").agg(F.min(F.octet_length("text")).alias("b")).collect():
        sizes[r["doc_id"]] = r["b"]
    left, keep = {0: sample_bytes, 1: sample_bytes}, []
    for i, y in label.items():                         # in hash order within each class
        if sizes.get(i, 0) and sizes[i] <= min(left[y], sample_bytes // 8):
            left[y] -= sizes[i]
            keep.append(i)
    if not keep:
        return blank
    kept = docs.sparkSession.createDataFrame([(i, sizes[i]) for i in keep], "doc_id long, b int")
    text = {r["doc_id"]: r["t"].encode() for r in
            rows.join(F.broadcast(kept), "doc_id").where(F.octet_length("text") == F.col("b"))
            .groupBy("doc_id").agg(F.min("text").alias("t")).collect()}
    keep = [i for i in keep if i in text]
    parts = {(y, h): [text[i] for i in [k for k in keep if label[k] == y][h::2]]
             for y in (0, 1) for h in (0, 1)}
    if not (parts[0, 0] and parts[1, 0]):
        return blank
    # equal training bytes for both classes, so that neither dictionary is merely richer
    most = min(sum(map(len, parts[y, 0])) for y in (0, 1))
    data = {}
    for y in (0, 1):
        used, own = 0, []
        for t in parts[y, 0]:
            if own and used + len(t) > most * 1.1:
                continue
            own.append(t)
            used += len(t)
        data[y] = _train(own, dict_bytes)
    held = {y: parts[y, 1] or parts[y, 0] for y in (0, 1)}
    x = np.concatenate([_features(held[y], data[1], data[0]) for y in (0, 1)])
    y = np.concatenate([np.full(len(held[y]), float(y)) for y in (0, 1)])
    share = {k: counts[k] / sum(counts.values()) / len(held[k]) for k in (0, 1)}
    w = np.where(y == 1, share[1], share[0]) * len(y)
    slope, intercept = _logistic(x, y, w)
    return Model(data[1], data[0], slope, intercept)


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (doc_id by default) of every row, with ``score`` and ``predicted``."""
    keep = keep or ["doc_id"]
    source = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields]
                       + ["score double", "predicted int"])

    if "text" not in keep:                       # a text that stays is sent once
        source = docs.select(*[F.col(f"`{c}`") for c in keep], "text")
    at, n = source.columns.index("text"), len(keep)

    def run(batches):
        release_caches()
        for b in batches:
            texts = (t.as_py().encode() if t.is_valid else b"" for t in b.column(at))
            if model.blank:
                s = np.full(b.num_rows, 0.5)
            else:
                z = model.slope * _features(texts, model.good, model.bad) + model.intercept
                s = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            cols = [*b.columns[:n], pa.array(s), pa.array((s >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, "score", "predicted"])
            give_back()

    return source.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1,
             keep: list[str] | None = None, **options) -> DataFrame:
    """Fit on the ids outside fold ``held`` of ``folds`` and score every row."""
    model = fit(docs, labels, common.hash_mod("doc_id", folds) != held, **options)
    return score(docs, model, keep)
