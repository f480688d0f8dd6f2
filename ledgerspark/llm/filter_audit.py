"""Filter interaction audit: what each filter removes under every order of the filters.

A document has a bit for each of k filters that it fails. Under an order of the filters it is
removed at the first step whose filter it fails. Method (min-plus removal ranks): the mask matrix
(documents x filters, 0 where a document fails, infinity elsewhere) is combined with the matrix of
inverse permutations (filters x orders, the step at which an order runs a filter) by min-plus
product: entry (i, o) = min over filters of mask + position = the step at which order o removes
document i. The steps then drive weighted scatter counts (removed, kept, losses) and the redundant
failures (a failed filter that comes after the removal step).

Only the mask matters, so documents are first counted per (part, mask) by Spark with map-side
partial aggregation; the matrices have at most 2^k rows a part however many documents it holds,
and the parts are dealt over tasks. Nothing is collected to the driver.

``document_failures`` computes the five text filters, ``audit`` works on any set of up to seven
boolean filter columns. Defined results: a null text is the empty text; a null part is the empty
string; a null failure bit counts as passed; without documents there are no rows. Labels are
looked up by doc_id; of several label rows of an id, any that says 1 counts; documents without
labels lose nothing. Repeated rows count as often as they occur. A document repeats (filter E) if
a row with a smaller doc_id has the same text; rows with the smallest id of a text, however many,
and rows without doc_id do not fail E. Texts are compared by SHA-256 of all their bytes. Further
columns, whatever their names, are ignored. Texts are split once and never collected, so very long
ones cost their own length only.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

common.by_value(__name__)

#: Failure conditions of ``document_failures``, by letter.
MIN_WORDS = 200            # A: fewer words
DISTINCT_PERCENT = 50      # B: distinct words below this share
CAPITAL_PERCENT = 2        # C: capitals A-Z above this share of code points
SYMBOLS = "[#$%&*|]"       # D: holds one of these
BLANKS = r"[\x20\x09-\x0D]+"

#: 7! = 5040 orders; more filters would make the result, k * k! rows a part, unusable.
MAX_FILTERS = 7

MEASURES = ("kept", "removed", "redundant", "unique_fails")


def positions(k: int) -> tuple[np.ndarray, np.ndarray]:
    """(orders x k) filters by step and (k x orders) steps by filter, the inverse permutations."""
    orders = np.array(list(itertools.permutations(range(k))), dtype=np.int64).reshape(-1, k)
    return orders, np.argsort(orders, axis=1).T


def removal_steps(fails: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Min-plus product of the mask matrix (0 or infinity) with the positions: for each row of
    ``fails`` and each order the step that removes it, k if none does."""
    k = steps.shape[0]
    infinity = np.where(fails, 0, k).astype(np.int64)
    return np.minimum((infinity[:, :, None] + steps[None]).min(axis=1), k)


def scatter(part: np.ndarray, masks: np.ndarray, weights: np.ndarray, n_parts: int,
            k: int) -> dict[str, np.ndarray]:
    """Counts by (part, order, step) of weighted masks. ``weights``: documents first, then one row
    a loss. 'losses' has a leading axis, 'shapley' is (part, filter)."""
    orders, steps = positions(k)
    fails = (masks[:, None] >> np.arange(k)) & 1 == 1
    at = removal_steps(fails, steps)                              # masks x orders
    o = np.arange(len(orders))
    taken = np.zeros((len(weights), n_parts, len(orders), k + 1), dtype=np.int64)
    for w, into in zip(weights, taken):
        np.add.at(into, (part[:, None], o[None], at), w[:, None])
    removed = taken[0, :, :, :k]
    failed = fails[:, orders]                                     # masks x orders x steps
    late = failed & (at[:, :, None] < np.arange(k))
    redundant = np.zeros((n_parts, len(orders), k), dtype=np.int64)
    unique = np.zeros_like(redundant)
    np.add.at(redundant, part, late * weights[0][:, None, None])
    only = failed & (fails.sum(axis=1) == 1)[:, None, None]
    np.add.at(unique, part, only * weights[0][:, None, None])
    total = taken[0].sum(axis=2, keepdims=True)
    shapley = np.zeros((n_parts, k), dtype=np.int64)
    np.add.at(shapley, (np.arange(n_parts)[:, None, None], orders[None]), removed)
    return {"kept": total - removed.cumsum(axis=2), "removed": removed, "redundant": redundant,
            "unique_fails": unique, "losses": taken[1:, :, :, :k], "shapley": shapley}


def _rows(names: str, losses: list[str], parts_at_once: int):
    """Function for mapInArrow: counted masks of whole parts to one row a part, order and step."""
    k = len(names)
    orders, _ = positions(k)
    labels = ["".join(names[f] for f in row) for row in orders]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, parts_at_once):
                piece = batch.slice(at, parts_at_once)
                lists = piece.column("masks")
                flat = lists.flatten()
                sizes = np.diff(lists.offsets.to_numpy())
                part = np.repeat(np.arange(piece.num_rows), sizes)
                weights = np.stack([flat.field(n).to_numpy(zero_copy_only=False)
                                    for n in ("n", *losses)])
                got = scatter(part, flat.field("mask").to_numpy(zero_copy_only=False), weights,
                              piece.num_rows, k)
                rows = len(orders) * k
                ids = np.repeat(np.arange(piece.num_rows), rows)
                yield pa.RecordBatch.from_pydict({
                    "part": piece.column("part").take(pa.array(ids)),
                    "filter_order": pa.array(np.tile(np.repeat(labels, k), piece.num_rows)),
                    "step": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32),
                                             len(orders) * piece.num_rows)),
                    **{m: pa.array(got[m].ravel()) for m in MEASURES},
                    **{n: pa.array(x.ravel()) for n, x in zip(losses, got["losses"])},
                    "shapley": pa.array(got["shapley"][:, orders].ravel())})
    return run


def audit(failures: DataFrame, filters: dict[str, Column], part: Column,
          losses: dict[str, Column], count: Column | None = None,
          parts_at_once: int = 50) -> DataFrame:
    """Counts of every (part, order of the filters, step).

    ``filters``: a boolean failure column by one-letter name, up to seven. ``losses``: boolean
    columns counted among the removed rows, by name of the result column. ``count``: how many
    documents a row of ``failures`` stands for (1 by default). Columns: part, filter_order, step,
    kept, removed, redundant, unique_fails, the losses, shapley.
    """
    names = "".join(filters)
    if not 1 <= len(filters) <= MAX_FILTERS or len(names) != len(filters):
        raise ValueError(f"1 to {MAX_FILTERS} filters with names of one letter")
    count = F.lit(1) if count is None else count
    mask = sum((F.when(F.coalesce(c, F.lit(False)), F.lit(1 << i)).otherwise(0)
                for i, c in enumerate(filters.values())), F.lit(0))
    rows = failures.select(
        F.coalesce(part.cast("string"), F.lit("")).alias("part"), mask.cast("long").alias("mask"),
        count.cast("long").alias("n"),
        *[F.when(F.coalesce(c, F.lit(False)), count).otherwise(0).cast("long").alias(n)
          for n, c in losses.items()])
    counted = rows.groupBy("part", "mask").agg(*[F.sum(n).alias(n) for n in ("n", *losses)])
    whole = counted.groupBy("part").agg(
        F.collect_list(F.struct("mask", "n", *losses)).alias("masks"))       # at most 2^k
    fields = ", ".join(f"{n} long" for n in (*MEASURES, *losses, "shapley"))
    return whole.mapInArrow(_rows(names, list(losses), parts_at_once),
                            f"part string, filter_order string, step int, {fields}")


def text_failures(text: Column) -> dict[str, Column]:
    """Failure columns A to D of a text that is not null."""
    words = F.array_remove(F.split(text, BLANKS), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    return {"A": n < MIN_WORDS, "B": 100 * distinct < DISTINCT_PERCENT * n,
            "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > CAPITAL_PERCENT * F.length(text),
            "D": text.rlike(SYMBOLS)}


def document_failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counted failures of documents: part, A to E, good, toxic, n (documents).

    Rows that agree in everything, such as copies of one text in one part, are one row with a
    count. The smallest id of a text comes from partial minima, so a text that a third of all
    documents share is a few rows a task before any shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("content"),
                       *[c.alias(n) for n, c in text_failures(text).items()])
    same = ["content", "part", *"ABCD"]
    rows = rows.groupBy("doc_id", *same).agg(F.count("*").alias("n"))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    marked = rows.join(marks, "doc_id", "left") \
        .withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    known = F.col("doc_id").isNotNull()
    groups = marked.groupBy(*same, "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("no_id"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("lowest"))
    # the tables meet again by content: stored once, so texts are read and split once
    groups = common.stored(groups, "audit-groups")
    first = groups.groupBy("content").agg(F.min("lowest.doc_id").alias("first_id"))
    both = groups.join(first, "content")
    passed = F.col("no_id") + F.when(F.col("lowest.doc_id") == F.col("first_id"),
                                     F.col("lowest.n")).otherwise(0)
    split = both.select("*", F.explode(F.array(
        F.struct(F.lit(False).alias("E"), passed.alias("rows")),
        F.struct(F.lit(True).alias("E"), (F.col("n") - passed).alias("rows")))).alias("half"))
    return split.where("half.rows > 0").select(
        "part", *"ABCD", "half.E", "good", "toxic", F.col("half.rows").alias("n"))


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over documents, by source."""
    failures = document_failures(docs, labels)
    return audit(failures, {f: F.col(f) for f in "ABCDE"}, F.col("part"),
                 {"good_lost": F.col("good"), "toxic_lost": F.col("toxic")}, F.col("n"))
