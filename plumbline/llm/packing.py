"""Best-fit packing (operator 6): Martello-Toth reduction, then best fit of what is left.

Bin packing sees only how many pieces there are of each length, at most `capacity` numbers, so the driver solves it on that
histogram however many documents there are, with multiplicities instead of single items. The solution says which ranks
among the pieces of a length go to which sequences; ranks are counted per bucket of documents and added up, so a
length that very many pieces share isn't brought to one task.

Strings of the tokenizer's special tokens in a text count as these tokens, as its own encode has them.

Defined cases: null text counts as empty and is packed as the end id alone; repeated rows are packed each; a null id stays;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BoundedCache, id_and_text, materialize, slices

CAPACITY, END = 4096, 1
BUCKET_ROWS = 20_000


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit numbers. The tokenizer drops white space and never joins across it, so
    words are encoded one by one and remembered."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache = BoundedCache(1_000_000)

    def _known(self, words: list[str]) -> list[bytes]:
        out = list(map(self.cache.get, words))
        new = [w for w, ids in zip(words, out, strict=True) if ids is None]
        if new:
            self.cache.room_for(len(new))
            for lo in range(0, len(new), 4096):
                some = new[lo : lo + 4096]
                for w, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                    self.cache[w] = np.array(e.ids, dtype="<u4").tobytes()
            out = [self.cache[w] if ids is None else ids for w, ids in zip(words, out, strict=True)]
        return out

    def encode_all(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text. Words are cut and numbered by Arrow, so Python sees each distinct word of the array once.

        ASCII words that differ in case or in one ending stop or comma only are looked up as one: the tokenizer lowers case
        and cuts between letters and marks, but for special tokens, which are met before that. Other white space than ASCII's stays within words, where the tokenizer drops it."""
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        whole = coded.dictionary
        core = pc.ascii_rtrim(whole, ".,")
        cut = pc.subtract(pc.binary_length(whole), pc.binary_length(core))
        plain = pc.and_(pc.and_(pc.string_is_ascii(whole), pc.match_substring_regex(core, "[A-Za-z0-9]$")), pc.less_equal(cut, 1))
        for special in self.special:
            plain = pc.and_not(plain, pc.match_substring(core, special, ignore_case=True))
        core = pc.if_else(plain, pc.ascii_lower(core), whole).dictionary_encode()
        known = self._known([*core.dictionary.to_pylist(), "", ".", ","])
        n = len(known) - 3
        mark = np.where((plain.to_numpy(zero_copy_only=False)) & (cut.to_numpy() == 1), np.where(pc.ends_with(whole, ".").to_numpy(zero_copy_only=False), n + 1, n + 2), n)
        flat = np.frombuffer(b"".join(known), dtype="<u4")
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        begin = np.cumsum(sizes) - sizes
        at = coded.indices.to_numpy()
        codes = np.stack((core.indices.to_numpy()[at], mark[at]), axis=1).ravel()  # each word as its core and its ending mark
        each = sizes[codes]
        ends = np.cumsum(each)
        ids = flat[np.repeat(begin[codes] - ends + each, each) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.concatenate(([0], ends))[2 * (words.offsets.to_numpy() - words.offsets[0].as_py())]
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


@lru_cache(maxsize=2)
def load(path: str) -> WordIds:
    return WordIds(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and the end id, cut only beyond the capacity."""

    def each(batches):
        ids_of, end = load(path), np.array([END], "<u4")
        for part in slices(batches):
            out = []
            for doc, ids in zip(part.column(0).to_pylist(), ids_of.encode_all(part.column(1)), strict=True):
                ids = np.concatenate((ids, end))
                out += [(doc, lo // capacity, lo, len(ids[lo : lo + capacity]), zlib.crc32(ids[lo : lo + capacity])) for lo in range(0, len(ids), capacity)]
            a, b, c, d, e = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int32()), pa.array(c, pa.int64()), pa.array(d, pa.int64()), pa.array(e, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return id_and_text(docs, id_col, text_col).mapInArrow(each, "doc_id long, piece int, start long, length long, ids_crc32 long")


Pattern = tuple[int, tuple[tuple[int, int], ...]]  # how many sequences; (length, how often in each)


def reduce_instance(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Martello and Toth's reduction: takes out of counts (by length) all sets {j}, {j, i} and {j, a, b} that dominate every other
    feasible set with j, the largest j first, and returns them. A set dominates another one if that can be cut into parts that
    each fit in the place of an item of its own; a set that dominates goes on doing so as long as there are items for it."""
    fixed: list[Pattern] = []
    there = np.flatnonzero(counts)
    for j in there[::-1].tolist():
        while counts[j]:
            chosen = _dominating(counts, j, capacity)
            if chosen is None:
                break
            items = {x: chosen.count(x) for x in chosen}
            m = min(int(counts[x]) // n for x, n in items.items())
            fixed.append((m, tuple(items.items())))
            for x, n in items.items():
                counts[x] -= m * n
    return fixed


def _dominating(counts: np.ndarray, j: int, capacity: int) -> list[int] | None:
    """The set of three items at most, j among them, that dominates all others with j, if there is one."""
    room = capacity - j
    counts[j] -= 1
    try:
        left = np.flatnonzero(counts[: room + 1])  # lengths that fit beside one j
        if not len(left):
            return [j]
        i = int(left[-1])
        # the smallest lengths, repeated: how many further items fit at most, up to three
        small = np.repeat(left, np.minimum(counts[left], 3))[:3].tolist()
        most = sum(sum(small[: k + 1]) <= room for k in range(len(small)))
        # i alone is as large as any two that fit
        if i == room or most == 1 or most == 2 and _best_two(counts, left, room) <= i:
            return [j, i]
        if most > 2:
            return None
        counts[i] -= 1
        second = np.flatnonzero(counts[: room - i + 1])
        counts[i] += 1
        b = int(second[-1]) if len(second) else 0
        # two items that fit either have one for b's place and one for i's, or are no larger together than i
        return [j, i, b] if b and _best_two(counts, left[left > b], room) <= i else None
    finally:
        counts[j] += 1


def _best_two(counts: np.ndarray, left: np.ndarray, room: int) -> int:
    """The largest sum of two items of these lengths that is within the room, 0 if there is none."""
    best, sizes = 0, left.tolist()
    lo, hi = 0, len(sizes) - 1
    while lo <= hi:
        a, b = sizes[lo], sizes[hi]
        if a + b > room:
            hi -= 1
            continue
        if lo < hi:
            best = max(best, a + b)
        if counts[a] >= 2:
            best = max(best, 2 * a)
        lo += 1
    return best


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best fit decreasing on the histogram: each length in turn goes where the least room is left that holds it."""
    open_: dict[int, list[tuple[int, tuple]]] = {}  # room left -> sequences of that room
    for size in np.flatnonzero(counts)[::-1].tolist():
        c = int(counts[size])
        for room in sorted(r for r in open_ if r >= size):
            if not c:
                break
            each, groups, kept = room // size, open_.pop(room), []
            while groups:
                m, items = groups.pop()
                full = min(m, c // each)
                c -= full * each
                if full:
                    open_.setdefault(room - each * size, []).append((full, (*items, (size, each))))
                rest = m - full
                if rest and c:  # one more takes what is left
                    open_.setdefault(room - c * size, []).append((1, (*items, (size, c))))
                    rest, c = rest - 1, 0
                if rest:
                    kept.append((rest, items))
                if not c:
                    break
            kept += groups
            if kept:
                open_.setdefault(room, []).extend(kept)
        if c:
            each = capacity // size
            if c // each:
                open_.setdefault(capacity - each * size, []).append((c // each, ((size, each),)))
            if c % each:
                open_.setdefault(capacity - c % each * size, []).append((1, ((size, c % each),)))
    return [g for groups in open_.values() for g in groups]


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    return reduce_instance(counts, capacity) + best_fit(counts, capacity)


def _places(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Stretches of ranks by length: the ranks from `rank` on go `each` to a sequence, from `sequence` and `offset` on."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for m, items in patterns:
        offset = 0
        for length, each in items:
            rows.append((length, used.get(length, 0), sequence, each, offset))
            used[length] = used.get(length, 0) + m * each
            offset += length * each
        sequence += m
    rows.sort()
    length, rank, sequence, each, offset = (np.array(x, np.int64) for x in (zip(*rows, strict=True) if rows else [()] * 5))
    return {"key": length << 48 | rank, "rank": rank, "sequence": sequence, "each": each, "offset": offset}


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): one row per piece."""
    cut = materialize(pieces(docs, path, capacity, id_col, text_col))
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    buckets = max(1, sum(histogram.values()) // BUCKET_ROWS)
    rows = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    ranked = rows.withColumn("local", F.row_number().over(W.partitionBy("bucket", "length").orderBy("doc_id", "piece", "ids_crc32")) - 1)
    sums = rows.groupBy("bucket", "length").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(F.col("bucket").alias("b2"), F.col("length").alias("l2"), before.alias("base"))
    ranked = ranked.join(sums, (ranked.bucket == sums.b2) & (ranked.length == sums.l2))
    # a few stretches for each pattern, and patterns follow from at most `capacity` lengths: it doesn't grow with the documents
    places = docs.sparkSession.sparkContext.broadcast(_places(solve(histogram, capacity)))

    def each(batches):
        p = places.value
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            at = np.searchsorted(p["key"], length << 48 | rank, side="right") - 1
            nth = rank - p["rank"][at]
            sequence, offset = p["sequence"][at] + nth // p["each"][at], p["offset"][at] + nth % p["each"][at] * length
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)], [*b.schema.names[:5], "sequence_id", "offset"])

    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("local")).cast("long").alias("rank"))
    return ranked.mapInArrow(each, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
