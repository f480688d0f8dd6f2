"""Packing documents into training sequences (operator 6): bin completion.

A document is its token ids followed by one end id; documents longer than ``limit`` are cut into
pieces of ``limit`` ids, the last may be shorter. Tokenising a text word by word (words parted by
ASCII white space, which the tokenizer drops) gives the ids of the whole text, so ids of words are
kept in a bounded cache of the Python worker and a text costs a lookup for most words.

Pieces are dealt round-robin into blocks of about ``block`` pieces and each block is packed by one
task, so memory is bounded and a copy group or source of any size spreads over all blocks. Within
a block (Martello and Toth's dominance, Korf's bin completion):

* incumbent: best-fit decreasing; the lower bound is ceil(tokens / limit);
* if the bound is not met, depth-first search for one bin less: take the longest piece left, and
  enumerate undominated fillings of the rest of its bin, of any number of pieces, full ones first.
  A single piece that fills it exactly dominates all others and is the only branch; a filling is
  dominated where a piece left would fit in, or in place of a shorter one. Lengths whose sums can't
  fill the rest within the waste are not tried;
* the target leaves a fixed waste; a node whose waste exceeds it is pruned, and its open remainder
  is finished by best fit, which may improve the incumbent;
* after ``nodes`` nodes, or ``NODE_TRIES`` times as many tries in fillings, the incumbent stands.

Defined results: null and empty texts are the end id alone; an empty table gives no rows; equal
documents, repeated or null ids are documents of their own; further columns are ignored.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import give_back, worker_cache

common.by_value(__name__)

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
CACHE_WORDS = 400_000            # units in a worker's cache
CACHED_LENGTH = 48               # longer words are not kept
CHUNK_BYTES = 4 << 20            # text that is encoded at once
NODE_TRIES = 50                  # tries in the enumeration of fillings for each node


def _tokenizer(definition: str):
    """The worker's tokenizer, which of its ids end a unit, and its word cache."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    store = worker_cache("tokens").__dict__
    key = zlib.crc32(definition.encode())
    if key not in store:
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_str(definition)
        ends = np.zeros(tokenizer.get_vocab_size(), bool)
        for token, i in tokenizer.get_vocab().items():
            ends[i] = token.endswith("</w>")
        store[key] = (tokenizer, ends, _Cache())
    return store[key]


def _letters(unit: str) -> bool:
    """Whether a unit is letters only, also in lower case: such a unit is one word of the
    tokenizer, and exactly its last id ends a word."""
    return unit.isalpha() and unit.lower().isalpha()


def _ids_of(units: list[str], tokenizer, ends: np.ndarray, into: dict) -> None:
    """Ids of each unit as bytes. Units of letters are encoded together, which saves a call for
    each, and parted again where a word ends."""
    plain = [u for u in units if _letters(u)]
    for lo in range(0, len(plain), 1000):
        group = plain[lo:lo + 1000]
        flat = np.array(tokenizer.encode(" ".join(group), add_special_tokens=False).ids, "<u4")
        cuts = np.flatnonzero(ends[flat]) + 1
        if len(cuts) == len(group):
            data, at = flat.tobytes(), 0
            for u, cut in zip(group, (4 * cuts).tolist()):
                into[u] = data[at:cut]
                at = cut
    rest = [u for u in units if u not in into]
    for u, e in zip(rest, tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
        into[u] = np.array(e.ids, "<u4").tobytes()


def _units(texts: pa.Array) -> pa.ListArray:
    """The units of each text: words between ASCII white space, A-Z in lower case (the tokenizer
    does the same) unless a special token may be there. A full stop or comma that ends a word
    after a letter or digit is a unit of its own."""
    texts = pc.fill_null(texts, "")
    lower = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
    parted = pc.replace_substring_regex(lower, r"([A-Za-z0-9])([.,])([\t-\r ]|$)", r"\1 \2\3")
    return pc.ascii_split_whitespace(parted)


class _Cache:
    """Ids of units, those not used lately leave: when the younger half is full it becomes the older
    one, and units found there move back."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def look_up(self, units: list[str], tokenizer, ends: np.ndarray) -> list[bytes]:
        """Ids of distinct units."""
        young, old = self.young, self.old
        missing = [u for u in units if u not in young]
        back = [u for u in missing if u in old]
        young.update((u, old[u]) for u in back)
        if back:
            missing = [u for u in missing if u not in old]
        long: dict[str, bytes] = {}
        if missing:
            _ids_of([u for u in missing if len(u) <= CACHED_LENGTH], tokenizer, ends, young)
            _ids_of([u for u in missing if len(u) > CACHED_LENGTH], tokenizer, ends, long)
        found = [young[u] if u in young else long[u] for u in units]
        if len(young) > CACHE_WORDS // 2:
            self.young, self.old = {}, young
        return found


def _encode(texts: pa.Array, tokenizer, ends: np.ndarray,
            cache: _Cache) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and where each text begins (one entry more than texts). Each
    distinct unit is looked up once; the ids are then gathered by the numbers of the units."""
    listed = _units(texts)
    coded = listed.flatten().dictionary_encode()
    found = cache.look_up(coded.dictionary.to_pylist(), tokenizer, ends)
    size = np.fromiter(map(len, found), np.int64, len(found)) // 4
    flat = np.frombuffer(b"".join(found), "<u4")
    begin = np.cumsum(size) - size
    unit = coded.indices.to_numpy()
    n = size[unit]
    stop = np.cumsum(n)
    at = np.repeat((begin[unit] - stop + n), n) + np.arange(stop[-1] if len(stop) else 0)
    words = listed.offsets.to_numpy()
    return flat[at], np.concatenate(([0], stop))[words - words[0]]


def _chunks(texts: pa.Array, most: int):
    """Row ranges of about ``most`` bytes of text, at least one row each."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    lo = 0
    while lo < len(size):
        hi = lo + max(1, int(np.searchsorted(np.cumsum(size[lo:lo + 10_000]), most)))
        yield lo, min(hi, len(size))
        lo = hi


def pieces(docs: DataFrame, definition: str, limit: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32. ``definition`` is the text of a
    tokenizer file (a few MB; the caller passes its content, not a path of one machine)."""
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        tokenizer, ends, cache = _tokenizer(definition)
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            for lo, hi in _chunks(texts, CHUNK_BYTES):
                flat, bounds = _encode(texts[lo:hi], tokenizer, ends, cache)
                out = []
                for i in range(hi - lo):
                    data = flat[bounds[i]:bounds[i + 1]].tobytes() + end
                    n = len(data) // 4
                    for k, s in enumerate(range(0, n, limit)):
                        piece = data[4 * s:4 * (s + limit)]
                        out.append((lo + i, k, s, len(piece) // 4, zlib.crc32(piece)))
                row, k, s, n, crc = map(list, zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row)), pa.array(k, pa.int32()), pa.array(s, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])
            give_back()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


# -- one block -------------------------------------------------------------------------------

class _Bag:
    """A multiset of lengths with a bit for each length present."""

    def __init__(self, counts: dict[int, int]):
        self.count = dict(counts)
        self.mask = 0
        for v in counts:
            self.mask |= 1 << v

    def take(self, v: int) -> None:
        self.count[v] -= 1
        if not self.count[v]:
            self.mask &= ~(1 << v)

    def put(self, v: int) -> None:
        self.count[v] = self.count.get(v, 0) + 1
        self.mask |= 1 << v

    def best(self, most: int) -> int:
        """The longest length present up to ``most``, 0 if none."""
        return (self.mask & ((2 << most) - 1)).bit_length() - 1 if most > 0 and self.mask & (
            (2 << most) - 1) else 0


def best_fit(counts: dict[int, int], limit: int) -> list[list[int]]:
    """Best-fit decreasing."""
    bins: list[list[int]] = []
    open_by: dict[int, list[int]] = {}
    mask = 0
    for v in sorted(counts, reverse=True):
        for _ in range(counts[v]):
            above = mask >> v
            if above:
                r = v + (above & -above).bit_length() - 1
                i = open_by[r].pop()
                if not open_by[r]:
                    mask &= ~(1 << r)
            else:
                r, i = limit, len(bins)
                bins.append([])
            bins[i].append(v)
            r -= v
            if r:
                open_by.setdefault(r, []).append(i)
                mask |= 1 << r
    return bins


def _reach(lengths, limit: int) -> dict[int, int]:
    """For each length the sums up to ``limit`` (as bits) of any numbers of shorter lengths."""
    out, sums, full = {}, 1, (2 << limit) - 1
    for v in sorted(lengths):
        out[v], step = sums, v
        while step <= limit:                        # 1, 2, 4, ... copies more
            sums |= (sums << step) & full
            step *= 2
    return out


def _fillings(bag: _Bag, top: int, room: int, most_waste: int, reach: dict[int, int],
              budget: list[int]):
    """Undominated fillings, of any number of pieces, of the ``room`` beside ``top`` that waste at
    most ``most_waste``: full ones first, then by classes of doubled waste. Each try is taken off
    the budget. The bag has to be the same at each step of the generator."""
    if bag.best(room) == room and room and bag.count[room] > (room == top):
        yield (room,)                               # it dominates all others
        return
    used = {top: 1}

    def spare(v: int) -> int:
        return bag.count[v] - used.get(v, 0)

    def dominated(waste: int) -> bool:
        """Whether a piece left fits in, or fits in place of a shorter one."""
        for x in (0, *used):
            y = bag.best(min(x + waste, limit)) if waste else 0
            while y > x:
                if spare(y):
                    return True
                y = bag.best(y - 1)
        return False

    def fill(most: int, space: int, low: int, high: int):
        """Fillings of ``space`` by lengths up to ``most`` that waste ``low`` to ``high``."""
        v = bag.best(min(most, space))
        if not v and low <= space <= high and not dominated(space):
            yield tuple(x for x, n in used.items() for _ in range(n - (x == top)))
        while v and budget[0] > 0:
            held = used.get(v, 0)
            for n in range(min(spare(v), space // v), -1 if v == top else 0, -1):
                budget[0] -= 1
                rest = space - n * v
                least = max(0, rest - high)
                wanted = rest - low - least + 1     # sums that leave a waste in bounds
                if wanted > 0 and reach[v] >> least & ((1 << wanted) - 1):
                    used[v] = held + n
                    yield from fill(v - 1, rest, low, high)
                    if held:
                        used[v] = held
                    else:
                        del used[v]
            if v == top:
                return                              # n = 0 has tried all lengths below
            v = bag.best(v - 1)

    limit, low, high = top + room, 0, 0
    while low <= min(most_waste, room) and budget[0] > 0:
        yield from fill(top, room, low, min(high, most_waste))
        low, high = high + 1, 2 * high + 1


def bin_completion(counts: dict[int, int], limit: int, nodes: int = 60_000) -> list[list[int]]:
    """Bins (lists of lengths) for the multiset ``counts`` of lengths up to ``limit``."""
    total = sum(v * c for v, c in counts.items())
    best = best_fit(counts, limit)
    bound = -(-total // limit)
    budget = [nodes * NODE_TRIES]
    reach = _reach(counts, limit) if len(best) > bound else {}
    while len(best) > bound and budget[0] > 0:
        allowed = (len(best) - 1) * limit - total
        bag, bins, waste, better = _Bag(counts), [], 0, None
        left = sum(counts.values())
        stack: list[tuple] = []                     # (longest piece, its fillings)
        tried_tail = False
        while True:
            budget[0] -= 1
            if not left:
                better = [list(b) for b in bins]
                break
            top = bag.best(limit)
            stack.append((top, _fillings(bag, top, limit - top, allowed - waste, reach, budget)))
            option = next(stack[-1][1], None)
            if option is None and not tried_tail:   # finish this node by best fit
                tried_tail = True
                tail = best_fit({v: c for v, c in bag.count.items() if c}, limit)
                if len(bins) + len(tail) < len(best):
                    better = [list(b) for b in bins] + tail
                    break
            while option is None and stack:         # nothing left here: undo the bin above
                stack.pop()
                if stack:
                    last = bins.pop()
                    waste -= limit - sum(last)
                    left += len(last)
                    for v in last:
                        bag.put(v)
                    option = next(stack[-1][1], None)
            if option is None or budget[0] <= 0:
                break
            own = (stack[-1][0], *option)
            for v in own:
                bag.take(v)
            left -= len(own)
            waste += limit - sum(own)
            bins.append(own)
        if better is None:
            break
        best = better
    return best


def _pack_block(lengths: np.ndarray, limit: int, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each piece."""
    values, counts = np.unique(lengths, return_counts=True)
    bins = bin_completion(dict(zip(values.tolist(), counts.tolist())), limit, nodes)
    order = np.argsort(lengths, kind="stable")
    nexts = dict(zip(values.tolist(), np.searchsorted(lengths[order], values).tolist()))
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, b in enumerate(bins):
        at = 0
        for v in b:
            k = order[nexts[v]]
            nexts[v] += 1
            number[k], offset[k] = i, at
            at += v
    return number, offset


def pack(pieces_df: DataFrame, limit: int = 2048, block: int = 20_000,
         nodes: int = 60_000) -> DataFrame:
    """``pieces_df`` (read more than once: pass a stored table) with sequence_id and offset."""
    blocks = max(1, round(pieces_df.count() / block))

    def run(batches):
        own = [b for b in batches if b.num_rows]
        if not own:
            return
        t = pa.Table.from_batches(own)
        number, offset = _pack_block(t.column("length").to_numpy(), limit, nodes)
        first = TaskContext.get().partitionId() << 32
        t = t.append_column("sequence_id", pa.array(number + first))
        t = t.append_column("offset", pa.array(offset))
        yield from t.to_batches()

    return pieces_df.repartition(blocks).mapInArrow(run, PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, definition: str, limit: int = 2048,
                   **options) -> DataFrame:
    return pack(common.stored(pieces(docs, definition, limit), "pieces"), limit, **options)
