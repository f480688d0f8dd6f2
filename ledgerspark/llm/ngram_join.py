"""Near duplicates by an n-gram Jaccard join with several global orders (operator 4).

A document is the set of its distinct shingles of five words. Two documents link when
100 * |x and y| >= percent * |x or y|; a component is what links reach. Method:

1. Every set gets a 128-bit key; documents with equal sets form one class, and only the class
   (its smallest row) goes on. Keys and sizes are stored.
2. Document frequencies. Shingle hashes travel in packed blocks (range of the hash space, chunk of
   rows), a few bytes per shingle instead of a row. The task of a range counts how often each
   hash occurs, drops those that occur once (they can be in no intersection) and sends the others
   back to their chunks with their frequency.
3. Global orders. All orders put rare shingles first and break ties by different hashes. In a set
   of n shingles the first n - ceil(n*percent/100) + 1 of any one order are its prefix, and two sets that
   link share a prefix shingle under *every* order. Sets whose prefix holds only shingles that
   occur once have no partner and drop out here.
4. Candidates share a prefix shingle of the first order and pass the size filter and the positional
   filter there; before they are verified they must share prefix shingles under the other orders
   as well. Verification counts the exact intersection.
5. A list of sets that share a shingle is not expanded into pairs at once: each round pairs its
   members with one pivot of the list, drawn by hash, and links are contracted to components. Pairs
   inside a component need no test. When few pairs across components are left, all of these are
   verified, which makes the result exact. A group of n near copies costs n tests, not n^2.

Blocks, chunks and verification groups have bounded size; links and components are tables.

Hashes have 64 bits (sizes, keys) and 48 bits within a range of the hash space (intersections).
Rows are known by a number: the column ``row``, as ``monotonically_increasing_id`` gives it over
a stored table (rows of a partition in sequence, the same at each reading). Without that column a
numbered copy is stored first.

Defined results: null texts and texts without words have no shingles, link with nothing and are
their own component; fewer words than ``width`` are one shingle; repeated rows are copies of one
another; a row with null doc_id links as any other, and a component's id is the smallest id in it
that is not null.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import give_back, worker_cache

common.by_value(__name__)

CHUNK_BITS = 10                    # rows of a chunk: 1024
RANGE_SHINGLES = 1 << 19           # shingles counted by one task of step 2
RESIDUAL = 48                      # hash bits kept within a range
CACHE_WORDS = 50_000
ORDER_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
MIX1, MIX2 = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53


# -- shingles -----------------------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the result."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(MIX1)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(MIX2)
    return x ^ (x >> np.uint64(32))


def _shingles(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    cache = worker_cache("shingles").__dict__
    out = []
    for lo in range(0, len(texts), 256):
        split = [t.lower().split() for t in texts[lo:lo + 256]]
        if len(cache) > CACHE_WORDS:
            cache.clear()
        for w in set().union(*split):
            if w not in cache:
                cache[w] = xxhash.xxh64_digest(w)
        flat = np.frombuffer(b"".join(map(cache.__getitem__, chain.from_iterable(split))), ">u8")
        flat = flat.astype(np.uint64)
        grams = _mix(flat)
        for j in range(1, width):
            grams = _mix(grams[:-1] * np.uint64(31) + flat[j:]) if len(flat) > j else grams[:0]
        at = 0
        for words in split:
            n = len(words)
            if n >= width:
                out.append(np.unique(grams[at:at + n - width + 1]))
            elif n:
                whole = xxhash.xxh64_intdigest(b"\0".join(words), seed=n)
                out.append(np.array([whole], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
            at += n
    return out


def _texts(column) -> list[bytes]:
    return [t.as_py().encode() if t.is_valid else b"" for t in column]


def _keys(rows: DataFrame, width: int) -> DataFrame:
    """row, doc_id, key (128 bits of the set), n."""
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                sets = _shingles(_texts(part.column(2)), width)
                key = [xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets]
                give_back()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(key, pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64())],
                    names=["row", "doc_id", "key", "n"])
    return rows.mapInArrow(run, "row long, doc_id long, key binary, n long")


# -- packed blocks ------------------------------------------------------------------------------

def _pack(sorted_values: np.ndarray) -> bytes:
    """Sorted 64-bit integers as compressed byte planes of their differences."""
    d = np.diff(sorted_values, prepend=np.uint64(0))
    return zstandard.compress(d.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _blocks(rows: DataFrame, width: int, range_bits: int) -> DataFrame:
    """Step 2, outgoing: one row per (range, chunk) with the hashes and the rows they are from."""
    rest = np.uint64(64 - range_bits - RESIDUAL) if range_bits + RESIDUAL < 64 else np.uint64(0)

    def run(batches):
        for b in batches:
            numbers = b.column(0).to_numpy()
            chunks = numbers >> CHUNK_BITS
            edges = np.flatnonzero(np.diff(chunks)) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(chunks)]):
                sets = _shingles(_texts(b.column(1)[lo:hi]), width)
                seen, values, owners = set(), [], []
                for i, s in enumerate(sets):          # copies within the chunk send nothing
                    key = xxhash.xxh128_digest(s.tobytes())
                    if len(s) and key not in seen:
                        seen.add(key)
                        values.append(s >> rest)
                        owner = int(numbers[lo + i]) & ((1 << CHUNK_BITS) - 1)
                        owners.append(np.full(len(s), owner, np.uint16))
                if not values:
                    continue
                give_back()
                v, o = np.concatenate(values), np.concatenate(owners)
                order = np.argsort(v, kind="stable")
                v, o = v[order], o[order]
                part = (v >> np.uint64(RESIDUAL)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(part)) + 1
                bounds = list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(v)]))
                low = v & np.uint64((1 << RESIDUAL) - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(part[x]) for x, _ in bounds], pa.int64()),
                     pa.array([int(chunks[lo])] * len(bounds), pa.int64()),
                     pa.array([_pack(low[x:y]) for x, y in bounds], pa.binary()),
                     pa.array([o[x:y].tobytes() for x, y in bounds], pa.binary())],
                    names=["part", "chunk", "hashes", "owners"])

    return rows.select("row", "text").mapInArrow(
        run, "part long, chunk long, hashes binary, owners binary")


def _repeated(blocks: DataFrame) -> DataFrame:
    """Step 2, returning: per (chunk, range) the hashes that occur more than once, with owner and
    frequency (65535 stands for more)."""
    def run(table: pa.Table) -> pa.Table:
        give_back()                             # what the group before has left
        part = table.column("part")[0].as_py()
        chunk = table.column("chunk").to_numpy()
        values = [_unpack(x.as_py()) for x in table.column("hashes")]
        owners = [np.frombuffer(x.as_py(), np.uint16) for x in table.column("owners")]
        v, o = np.concatenate(values), np.concatenate(owners)
        c = np.repeat(np.arange(len(chunk)), [len(x) for x in values])
        order = np.argsort(v, kind="stable")
        s = v[order]
        first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        df = np.diff(np.r_[first, len(s)])
        count = np.empty(len(v), np.int64)
        count[order] = np.repeat(df, df)
        keep = np.flatnonzero(count > 1)
        v, o, c, count = v[keep], o[keep], c[keep], np.minimum(count[keep], 65535)
        out = {"chunk": [], "part": [], "hashes": [], "owners": [], "df": []}
        cuts = np.flatnonzero(np.diff(c)) + 1
        for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(c)]):
            if y > x:
                out["chunk"].append(int(chunk[c[x]]))
                out["part"].append(part)
                out["hashes"].append(_pack(v[x:y]))
                out["owners"].append(o[x:y].tobytes())
                out["df"].append(count[x:y].astype(np.uint16).tobytes())
        return pa.table(out, schema=pa.schema([
            ("chunk", pa.int64()), ("part", pa.int64()), ("hashes", pa.binary()),
            ("owners", pa.binary()), ("df", pa.binary())]))

    return blocks.groupBy("part").applyInArrow(
        run, "chunk long, part long, hashes binary, owners binary, df binary")


def _need(n: int, percent: int) -> int:
    """Least intersection of a set of n with any partner: ceil(n * percent / 100)."""
    return -(-n * percent // 100)


def _profiles(classes: DataFrame, repeated: DataFrame, percent: int) -> DataFrame:
    """Step 3: for each class that can have a partner: node, n, ``unique`` (shingles that occur
    once), ``shared`` (the others, sorted), and ``p0``, ``p1``, ...: the part of each order's
    prefix that lies among the shared shingles."""
    orders = len(ORDER_SEEDS)
    names = ["node", "n", "unique", "shared", *[f"p{k}" for k in range(orders)]]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        give_back()
        out = {c: [] for c in names}
        n_of = dict(zip(left.column("row").to_pylist(), left.column("n").to_pylist()))
        if right.num_rows and n_of:
            base = left.column("row")[0].as_py() >> CHUNK_BITS << CHUNK_BITS
            v = np.concatenate([_unpack(h.as_py()) | np.uint64(p.as_py() << RESIDUAL)
                                for h, p in zip(right.column("hashes"), right.column("part"))])
            o = np.concatenate([np.frombuffer(x.as_py(), np.uint16)
                                for x in right.column("owners")])
            f = np.concatenate([np.frombuffer(x.as_py(), np.uint16)
                                for x in right.column("df")])
            order = np.lexsort((v, o))
            v, o, f = v[order], o[order], f[order]
            cuts = np.flatnonzero(np.diff(o)) + 1
            for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(o)]):
                node = base + int(o[x])
                n = n_of.get(node)
                if n is None:                          # a copy of an earlier row
                    continue
                unique = max(0, n - (y - x))
                length = n - _need(n, percent) + 1 - unique
                if length <= 0:
                    continue
                shared, df = v[x:y], f[x:y]
                out["node"].append(node)
                out["n"].append(n)
                out["unique"].append(unique)
                out["shared"].append(shared.astype("<u8").tobytes())
                for k, seed in enumerate(ORDER_SEEDS):
                    first = np.lexsort((_mix(shared ^ np.uint64(seed)), df))[:length]
                    out[f"p{k}"].append(shared[first].view(np.int64).tolist() if k == 0
                                        else np.sort(shared[first]).astype("<u8").tobytes())
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()),
                 *[pa.binary()] * (orders - 1)]
        return pa.table(out, schema=pa.schema(list(zip(names, types))))

    schema = ("node long, n long, unique long, shared binary, p0 array<long>"
              + "".join(f", p{k} binary" for k in range(1, orders)))
    chunked = classes.select("row", "n", F.shiftright("row", CHUNK_BITS).alias("chunk"))
    return chunked.groupBy("chunk").cogroup(repeated.groupBy("chunk")).applyInArrow(run, schema)


# -- verification -------------------------------------------------------------------------------

def _verify(pairs: DataFrame, profiles: DataFrame, percent: int, per_group: int = 2000,
            per_pivot: int = 256) -> DataFrame:
    """The links among ``pairs`` (a, b), which is read more than once. Pairs are grouped by b with
    b's set shipped once per group; a ``b`` with many partners is split over several groups."""
    groups = max(1, pairs.count() // per_group)
    own = [f"p{k}" for k in range(1, len(ORDER_SEEDS))]
    split = pairs.groupBy("b").agg(F.ceil(F.count("*") / per_pivot).cast("int").alias("parts"))
    spread = pairs.join(split, "b").withColumn(
        "salt", F.pmod(F.xxhash64("a"), F.col("parts").cast("long")))
    block = F.pmod(F.xxhash64("b", "salt"), F.lit(groups)).alias("block")
    left = spread.join(profiles.select(F.col("node").alias("a"), "n", "shared", *own), "a") \
        .select(block, "a", "b", "n", "shared", *own)
    right = split.select("b", F.explode(F.sequence(F.lit(0).cast("long"),
                                                   F.col("parts").cast("long") - 1)).alias("salt")) \
        .join(profiles.select(F.col("node").alias("b"), F.col("n").alias("n_b"),
                              F.col("shared").alias("shared_b"),
                              *[F.col(p).alias(f"{p}_b") for p in own]), "b") \
        .select(block.alias("block_b"), F.col("b").alias("pivot"), "n_b", "shared_b",
                *[f"{p}_b" for p in own])

    def arrays(table: pa.Table, name: str) -> list[np.ndarray]:
        return [np.frombuffer(x.as_py(), "<u8") for x in table.column(name)]

    def run(x: pa.Table, y: pa.Table) -> pa.Table:
        pivots = {b: i for i, b in enumerate(y.column("pivot").to_pylist())}
        n_of, sets = y.column("n_b").to_pylist(), arrays(y, "shared_b")
        filters = [(arrays(x, p), arrays(y, f"{p}_b")) for p in own]
        keep_a, keep_b = [], []
        for i, (a, b, n, s) in enumerate(zip(x.column("a").to_pylist(), x.column("b").to_pylist(),
                                             x.column("n").to_pylist(), arrays(x, "shared"))):
            j = pivots[b]
            if not all(np.isin(f[i], g[j], assume_unique=True).any() for f, g in filters):
                continue
            both = len(np.intersect1d(s, sets[j], assume_unique=True))
            if 100 * both >= percent * (n + n_of[j] - both):
                keep_a.append(a)
                keep_b.append(b)
        return pa.table({"a": pa.array(keep_a, pa.int64()), "b": pa.array(keep_b, pa.int64())})

    return left.groupBy("block").cogroup(right.groupBy("block_b")).applyInArrow(
        run, "a long, b long")


# -- components ---------------------------------------------------------------------------------

def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """node, comp (smallest node reachable) of every node of ``edges`` (a, b): large-star and
    small-star steps until nothing changes. Only minima are aggregated, no neighbour lists, so a
    node of very many links does not gather in one task. ``rows`` bounds the edges, if known."""
    edges = common.stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b")
                                       .alias("b")).where("a <> b").distinct(), "edges", rows)
    def summary(e):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    state = summary(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"),
                                                            F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b") \
            .union(least.select("a", F.col("m").alias("b"))).distinct()
        edges = common.stored(small, "edges", rows)
        now = summary(edges)
        if now == state:
            break
        state = now
    heads = edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(heads)


# -- candidates ---------------------------------------------------------------------------------

def _filters(percent: int):
    """Size filter and positional filter for two postings x, y of one shingle."""
    def column(x, y):
        total = F.col(f"{x}.n") + F.col(f"{y}.n")
        need = F.ceil(total * percent / (100 + percent))
        rest = F.least(F.col(f"{x}.n") - F.col(f"{x}.pos"), F.col(f"{y}.n") - F.col(f"{y}.pos"))
        return ((F.col(f"{x}.n") * 100 >= F.col(f"{y}.n") * percent)
                & (F.col(f"{y}.n") * 100 >= F.col(f"{x}.n") * percent) & (rest >= need))
    return column


def links(profiles: DataFrame, percent: int = 75, rounds: int = 2,
          per_posting: int = 50) -> DataFrame:
    """Step 4 and 5: components (node, comp) of the classes in ``profiles`` (a stored table). After
    ``rounds`` rounds of pivots, or when at most ``per_posting`` pairs a posting are open, an eighth
    of the open pairs (drawn by hash) and then every pair that is still open is looked at; the
    filters decide which are verified."""
    post = profiles.select("node", "n", F.posexplode("p0").alias("i", "t"), "unique").select(
        "t", "node", "n", (F.col("i") + F.col("unique")).alias("pos"))
    lists = post.groupBy("t").agg(F.count("*").alias("m")).where("m > 1").select("t")
    post = common.stored(post.join(lists, "t", "left_semi"), "prefixes")
    passes = _filters(percent)
    spark = profiles.sparkSession
    none = "a long, b long"
    size = post.count()
    comps = spark.createDataFrame([], "node long, comp long")
    edges, tested = spark.createDataFrame([], none), spark.createDataFrame([], none)
    k, stage = 0, "pivots"
    while True:
        now = post.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        now = common.stored(now, "lists", size)
        per = now.groupBy("t", "comp").agg(F.count("*").cast("double").alias("m"))
        across = per.groupBy("t").agg((F.pow(F.sum("m"), F.lit(2)) - F.sum(F.col("m") * F.col("m")))
                                      .alias("x"), F.count("*").alias("comps")).where("comps > 1")
        open_lists = common.stored(across, "open-lists", size)
        left = open_lists.agg(F.coalesce(F.sum("x"), F.lit(0.0))).first()[0] / 2
        if not left:
            break
        if stage == "some":
            stage = "all"
        elif k == rounds or (k and left <= per_posting * size):
            stage = "some" if left > size else "all"
        x = now.join(open_lists.select("t"), "t", "left_semi")
        if stage == "pivots":
            pivot = x.groupBy("t").agg(F.min_by(
                F.struct("node", "n", "pos", "comp"),
                F.struct(F.xxhash64("node", F.lit(k)) if k else F.col("node"), F.col("node")))
                .alias("y"))
            pairs = x.alias("x").join(pivot, "t").where(
                (F.col("x.comp") != F.col("y.comp")) & passes("x", "y")).select(
                F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        else:
            met = passes("x", "y") & (F.col("x.comp") < F.col("y.comp"))
            if stage == "some":                       # one pair in eight contracts most links
                met = met & (F.pmod(F.xxhash64("x.node", "y.node"), F.lit(8)) == 0)
            pairs = x.alias("x").join(x.alias("y"), (F.col("x.t") == F.col("y.t")) & met)
            pairs = pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
            pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        fresh = pairs.distinct().join(tested, ["a", "b"], "left_anti")
        fresh = common.stored(fresh, "candidates", size)
        new = common.stored(_verify(fresh, profiles, percent), "links", size)
        if not new.isEmpty():
            edges = edges.union(new)
            comps = common.stored(components(edges, size), "components", size)
        if stage == "all":
            break
        tested = tested.union(fresh).union(fresh.select("b", "a"))
        k += 1
    return comps


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75,
                    row: str | None = None) -> DataFrame:
    """One row per document: row, doc_id, n_shingles, component_id, and ``stays``: true for one
    document of each component, the one with the smallest doc_id (then row number)."""
    own = docs.select(F.col(row) if row else F.monotonically_increasing_id().alias("row"),
                      F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = own.withColumnRenamed(row, "row") if row else common.stored(own, "documents")
    keys = common.stored(_keys(rows, width), "shingle-keys")
    first = F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "row")
    classes = common.stored(keys.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("row").alias("row"), F.min(first).alias("least"), F.first("n").alias("n")), "classes")
    total = keys.agg(F.sum("n")).first()[0] or 0
    bits = max(0, (total // RANGE_SHINGLES).bit_length())
    repeated = _repeated(_blocks(rows, width, bits))
    profiles = common.stored(_profiles(classes, repeated, percent), "profiles")
    comps = links(profiles, percent)
    joined = classes.join(comps.withColumnRenamed("node", "row"), "row", "left").withColumn(
        "comp", F.coalesce("comp", "row"))
    ids = joined.groupBy("comp").agg(F.min("least").alias("least"))
    named = joined.select("key", "comp").join(ids, "comp").select(
        "key", F.col("least.doc_id").alias("component_id"), F.col("least.row").alias("stay"))
    # copies of one set may hold a third of all rows: the class side has one row per key and is
    # the one that a skewed join copies
    return keys.join(named, "key", "left").select(
        "row", "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        (F.coalesce("stay", "row") == F.col("row")).alias("stays"))
