"""Benchmark decontamination by a positional inverted index (operator 7), DataFrame functions only.

The index holds postings (word, row, doc_id, pos) of the training documents, stored as Parquet in
the shared folder, for the words that searching needs. A test window is ``width`` consecutive words
of a benchmark item (all words of a shorter item). Search goes from the rarest terms:

1. occurrences of every benchmark word over all documents are counted;
2. each window takes its two rarest terms as anchors; a window with a term that occurs nowhere
   cannot match and is dropped;
3. the index is written for the anchors. Postings of rarest terms also keep the words around them,
   as far as a window can reach;
4. postings of the rarest term, moved by its offset, give possible starts (window, row, start);
   they are intersected with the postings of the second term at start + its offset;
5. what remains is compared word for word with the stored context, which makes matches exact.

Joins of step 4 go by (row, position), so frequent words and passages spread over all partitions.
Benchmark tables are broadcast if they have at most ``BROADCAST_ROWS`` rows, else they are joined
by shuffling. ``proximity_matches`` relaxes the phrase: both anchors of a window within a number
of words of one another.

Defined results: null texts, on either side, have no words; repeated documents are rows of their
own; an item with a null id marks words but is not listed; equal item ids are listed once; without
any benchmark text nothing is hit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common

#: ASCII characters that part words (after A-Z are lower-cased).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(common.ascii_lower(F.coalesce(text, F.lit(""))),
                                  SEPARATORS, -1), "")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


@dataclass
class Index:
    postings: DataFrame      # word, row, doc_id, pos, context; word "" at pos = number of words
    anchors: DataFrame       # window, words, size, word, offset, rank (0 rarest, 1 second)
    items: DataFrame         # window, item_id
    n_anchors: int


def windows(benchmark: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window, words) and the items they come from (window, item_id)."""
    w = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    each = w.select("item_id", F.explode(F.transform(
        starts, lambda s: F.slice("w", s, width))).alias("words"))
    each = common.stored(each.withColumn("window", F.sha2(F.concat_ws(" ", "words"), 256)),
                         "benchmark-windows")
    return each.dropDuplicates(["window"]).select("window", "words"), \
        each.select("window", "item_id").distinct()


def build(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> Index:
    """Count, choose anchors and store the index."""
    distinct, items = windows(benchmark, width)
    terms = distinct.select("window", "words", F.size("words").alias("size"),
                            F.posexplode("words").alias("offset", "word"))
    terms = common.stored(terms, "benchmark-terms")
    vocabulary = terms.select("word").distinct()
    n_words = vocabulary.count()
    tokens = docs.select(F.explode(words(F.col("text"))).alias("word"))
    counts = tokens.join(_small(vocabulary, n_words), "word", "left_semi") \
        .groupBy("word").agg(F.count("*").alias("n"))
    rarest = W.partitionBy("window").orderBy("n", "offset")
    ranked = (terms.join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
              .withColumn("least", F.min("n").over(W.partitionBy("window")))
              .withColumn("rank", F.row_number().over(rarest) - 1)
              .where((F.col("least") > 0) & (F.col("rank") < 2))
              .select("window", "words", "size", "word", "offset", "rank"))
    anchors = common.stored(ranked, "anchors")
    wanted = anchors.groupBy("word").agg((F.min("rank") == 0).alias("first"))
    marker = docs.sparkSession.createDataFrame([("", False)], "word string, first boolean")
    wanted = wanted.union(marker)
    n_anchors = anchors.count()
    own = docs.select("doc_id", words(F.col("text")).alias("w")).withColumn(
        "row", F.monotonically_increasing_id())
    # the last element, an empty word at pos = number of words, carries every document's length
    flat = own.select("row", "doc_id", "w",
                      F.posexplode(F.concat("w", F.array(F.lit("")))).alias("pos", "word"))
    begin = F.greatest(F.col("pos") - width + 1, F.lit(0))
    context = F.when(F.col("first"), F.concat_ws(
        " ", F.slice("w", begin + 1, F.col("pos") - begin + width)))
    postings = flat.join(_small(wanted, n_anchors + 1), "word").select(
        "word", "row", "doc_id", "pos", context.alias("context"))
    return Index(common.stored(postings, "postings"), anchors, items, n_anchors)


def phrase_matches(index: Index, width: int = 10) -> DataFrame:
    """Exact occurrences: window, size, row, start."""
    post, anchors = index.postings.where(F.col("word") != ""), index.anchors
    small = lambda df: _small(df, index.n_anchors)
    second = anchors.where("rank = 1").select(
        "window", F.col("word").alias("word2"), F.col("offset").alias("offset2"))
    first = small(anchors.where("rank = 0").join(second, "window", "left"))
    starts = post.select("word", "row", "pos").join(first, "word").select(
        "window", "words", "size", "row", (F.col("pos") - F.col("offset")).alias("start"),
        "pos", "word2", (F.col("pos") - F.col("offset") + F.col("offset2")).alias("pos2")
    ).where("start >= 0")
    at = post.select(F.col("word").alias("word2"), "row", F.col("pos").alias("pos2"))
    both = starts.where(F.col("word2").isNotNull()).join(at, ["row", "pos2", "word2"], "left_semi")
    left = both.select("window", "words", "size", "row", "start", "pos").unionByName(
        starts.where(F.col("word2").isNull())
        .select("window", "words", "size", "row", "start", "pos"))
    near = post.where(F.col("context").isNotNull()).select("row", "pos", "context")
    # the context begins width - 1 words before pos, or with the text
    begin = F.greatest(F.col("pos") - width + 1, F.lit(0))
    same = F.slice(F.split("context", " "), (F.col("start") - begin + 1).cast("int"),
                   F.col("size")) == F.col("words")
    return left.join(near, ["row", "pos"]).where(same).select("window", "size", "row", "start")


def proximity_matches(index: Index, within: int) -> DataFrame:
    """Windows whose two rarest terms stand at most ``within`` words apart, in either order:
    window, row, pos, pos2."""
    post, anchors = index.postings.where(F.col("word") != ""), index.anchors
    small = lambda df: _small(df, index.n_anchors)
    second = anchors.where("rank = 1").select("window", F.col("word").alias("word2"))
    first = small(anchors.where("rank = 0").join(second, "window"))
    # positions meet by blocks of ``within`` words, each looking into its neighbours
    step = within + 1
    seek = post.select("word", "row", "pos").join(first, "word").withColumn(
        "block", F.explode(F.array(*[F.floor(F.col("pos") / step) + d for d in (-1, 0, 1)])))
    at = post.select(F.col("word").alias("word2"), "row", F.col("pos").alias("pos2"),
                     F.floor(F.col("pos") / step).alias("block"))
    return seek.join(at, ["row", "block", "word2"]).where(
        (F.abs(F.col("pos") - F.col("pos2")) <= within) & (F.col("pos") != F.col("pos2"))
    ).select("window", "row", "pos", "pos2").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit (words inside any occurrence), ``items``
    (sorted ids of items with occurring windows) and ``row``, its number in the index."""
    index = build(docs, benchmark, width)
    found = common.stored(phrase_matches(index, width), "matches")
    order = W.partitionBy("row").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    spans = found.select("row", "start", (F.col("start") + F.col("size")).alias("end")).distinct()
    covered = spans.withColumn("seen", F.coalesce(F.max("end").over(order), F.lit(0))) \
        .groupBy("row").agg(F.sum(F.greatest(
            F.col("end") - F.greatest("start", "seen"), F.lit(0))).cast("long").alias("n_hit"))
    listed = found.select("row", "window").distinct().join(index.items, "window") \
        .where(F.col("item_id").isNotNull()).groupBy("row").agg(F.array_sort(
            F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    every = index.postings.where("word = ''").select(
        "row", "doc_id", F.col("pos").cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return every.join(covered, "row", "left").join(listed, "row", "left").select(
        "row", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", none).alias("items"))
