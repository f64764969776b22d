"""Substring near-duplicates (operator 7): compact windows of word-shingle min-hashes.

For each of `hashes` functions, a position c of a text owns the compact window (l, c, r): in every stretch of at least
`window` shingles within l..r that holds c, c has the least hash. These windows are the nodes of the Cartesian tree over the
hashes whose span is at least `window` wide. Two passages share their minimum with probability equal to the similarity of their
shingle sets, an exact repetition always: both texts then own a window with that hash, and the two windows, laid over each
other at c, overlap in at least `window` shingles.

Windows meet by (function, hash). Pairs of such a group are never enumerated. An occurrence is laid over two others of each
class of rows that have the same surroundings as it has: the first of the class (smallest document) and the one before it.
Classes are made by the 8 or 24 shingles on the left, by those on the right, and by each combination of both, so that the
partners share with an occurrence whatever it shares with anyone on that scale; one before it that agrees on 24 shingles on both sides is left out, as
the first of that class tells the same. An exact repetition or one with a few changed
words has an equal side. Overlaps of less than `window` shingles are no candidates. The resulting intervals are joined by pair of
documents and diagonal, and verified on the texts: a passage counts if at least `matches` of `window` consecutive shingles
stand in the other text within `drift` words of the same place; with 42 of 47 shingles of five words that is a similarity of 0.8.

Groups have no bound, memory has: a task that meets more than `HELD_ROWS` different surroundings of one hash passes the rest of them on, to be
sorted by class over all tasks instead; and a document that very many ask for is handed out by as many tasks as that takes. The
partners of an occurrence follow from its hash, its surroundings and its place alone, so results don't depend on partitions, batches or
these limits.

Defined cases: null text counts as empty; texts shorter than window + shingle - 1 words have no passage; rows of a null id aren't
compared; rows that repeat an id count as one document, which is never compared with itself, but each has its own passages; ties
of hashes go to the leftmost position; further columns are ignored by `repeated_passages` and kept by `remove_repeats`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, WORD, id_and_text, materialize, slices

SHINGLE, WINDOW, MATCHES, DRIFT, HASHES = 5, 47, 42, 4, 4
SIDES = (8, 24)
HELD_ROWS, ASKERS = 500_000, 256
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], dtype=np.uint64)


class _WordHashes(dict):
    """XXH64 of words, remembered as far as there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_words = _WordHashes()


def _stretch_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """A polynomial hash of each stretch of `size` values, built by doubling."""
    have, power, out, done, rest = 1, _BASE, None, 0, size
    while True:
        if rest & 1:  # the bits of size, smallest first: what is done, then the next 2^k values
            out = h if out is None else out[: len(h) - done] + np.uint64(pow(int(_BASE), done, 2**64)) * h[done:]
            done += have
        rest >>= 1
        if not rest:
            return out[: max(0, len(out))]
        if len(h) <= have:
            return h[:0]
        h = h[:-have] + power * h[have:]
        have, power = 2 * have, np.uint64(int(power) ** 2 % 2**64)


def shingle_hashes(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """A hash of each shingle of lower-cased (A-Z) words, from the words' XXH64."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if len(words) < shingle:
        return np.zeros(0, np.uint64)
    return _mixed(_stretch_hashes(np.fromiter(map(_words.__getitem__, words), np.uint64, len(words)), shingle), 5)


def hashes_of(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word of many texts, end to end, the hash of the shingle that starts there, and where the shingles within each text begin and end;
    what stands between spans two texts. Words are cut and numbered by Arrow, so Python sees each distinct word once."""
    words = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts)))  # an empty text has one empty word
    coded = words.flatten().dictionary_encode()
    known = np.fromiter(map(_words.__getitem__, coded.dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(coded.dictionary))
    offsets = words.offsets.to_numpy() - words.offsets[0].as_py()
    h = known[coded.indices.to_numpy()]
    out = np.zeros(len(h), np.uint64)
    if len(h) >= shingle:
        out[: len(h) - shingle + 1] = _mixed(_stretch_hashes(h, shingle), 5)
    begin = offsets[:-1].astype(np.int64)
    return out, begin, np.maximum(offsets[1:] - (shingle - 1), begin)


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    g = h * _MULTIPLIERS[k]
    g ^= g >> np.uint64(29)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    return g ^ g >> np.uint64(32)


def _sliding(a: np.ndarray, width: int, best) -> np.ndarray:
    """best over each stretch of `width`, by doubling."""
    have = 1
    while 2 * have <= width:
        a, have = best(a[:-have], a[have:]), 2 * have
    return best(a[: len(a) - (width - have)], a[width - have :]) if have < width else a


def compact_windows(g: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(l, c, r), inclusive, of the Cartesian tree's nodes that span at least `window` positions, in order of c.

    A node spans that much just if its hash is the least of some stretch of `window`; its nearest smaller neighbours span even
    more, so the stack that finds l and r need only see such nodes."""
    if len(g) < window:
        none = np.zeros(0, np.int64)
        return none, none, none
    low = _sliding(g, window, np.minimum)
    rim = np.zeros(window - 1, np.uint64)
    c = np.flatnonzero(_sliding(np.concatenate((rim, low, rim)), window, np.maximum) == g)
    left, right, stack = [0] * len(c), [len(g) - 1] * len(c), []
    at, value = c.tolist(), g[c].tolist()
    for i, v in enumerate(value):
        while stack and value[stack[-1]] > v:
            right[stack.pop()] = at[i] - 1
        left[i] = at[stack[-1]] + 1 if stack else 0
        stack.append(i)
    left, right = np.array(left, np.int64), np.array(right, np.int64)
    wide = right - left + 1 >= window  # of ties, nodes behind an equal one may span less
    return left[wide], c[wide], right[wide]


def _fold32(a: np.ndarray) -> np.ndarray:
    return _mixed(a, 3) >> np.uint64(32)


def _sides(h: np.ndarray, c: np.ndarray, begin: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """32 bits of the hash of the `size` shingles that end at each c, above 32 bits of that of those that start there; where the text
    (begin to end) is too short for one, of the place itself."""
    stretch = _stretch_hashes(h, size)
    if not len(stretch):
        stretch = np.zeros(1, np.uint64)
    short = _mixed(c.astype(np.uint64) + h[begin], 5)
    left = np.where(c - size + 1 >= begin, stretch[np.clip(c - size + 1, 0, len(stretch) - 1)], short)
    right = np.where(c + size <= end, stretch[np.minimum(c, len(stretch) - 1)], short + np.uint64(1))
    return _fold32(left) << np.uint64(32) | _fold32(right)


_ROW = "key long, doc_id long, at long, s8 long, s24 long"


def _runs(order: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows in order of their codes, the first of each row's code and the one before it there (itself for the first)."""
    new = np.ones(len(order), bool)
    new[1:] = codes[order][1:] != codes[order][:-1]
    at = np.arange(len(order))
    return order[np.maximum.accumulate(np.where(new, at, 0))], order[np.where(new, at, at - 1)]


def _overlap(at_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
    """Reach to the left (times 256) and right of two windows that are laid over each other at their centres."""
    left = np.minimum(at_a >> 8 & 255, at_b >> 8 & 255)
    return left << 8 | np.minimum(at_a & 255, at_b & 255)


def _wide(reach: np.ndarray, window: int) -> np.ndarray:
    return (reach >> 8) + (reach & 255) + 1 >= window


def windows(docs: DataFrame, window: int = WINDOW, hashes: int = HASHES) -> DataFrame:
    """(key, doc_id, at, s8, s24): each compact window, with its centre and reach as at = c * 65536 + left * 256 + right (no
    further than a stretch of `window` about c goes), and its surroundings. Within a text, the first place stands for all that agree with it
    in 24 shingles on both sides."""
    reach = min(window - 1, 254)

    def of_texts(ids: pa.Array, texts: pa.Array) -> list[np.ndarray]:
        h, begin, end = hashes_of(texts)
        inside = np.zeros(len(h) + 1, np.int64)
        np.add.at(inside, begin, 1)
        np.add.at(inside, end, -1)
        inside = np.cumsum(inside)[:-1] > 0
        parts = []
        doc, known = ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False)
        for k in range(hashes):
            g = np.where(inside, np.maximum(_mixed(h, k), np.uint64(1)), np.uint64(0))  # zeros keep texts apart
            left, c, right = compact_windows(g, window)
            own = np.searchsorted(begin, c, side="right") - 1
            keep = (g[c] != 0) & known[own]
            left, c, right, own = left[keep], c[keep], right[keep], own[keep]
            if not len(c):
                continue
            at = (c - begin[own]) << 16 | np.minimum(c - left, reach) << 8 | np.minimum(right - c, reach)
            sides = [_sides(h, c, begin[own], end[own], size).view(np.int64) for size in SIDES]
            parts.append([(g[c] ^ np.uint64(k * 0x5851F42D4C957F2D % 2**64)).view(np.int64), doc[own], at, *sides, own])
        if not parts:
            return []
        *t, text = (np.concatenate(x) for x in zip(*parts, strict=True))
        same = _mixed(t[4].view(np.uint64), 4) ^ t[0].view(np.uint64)
        order = np.lexsort((t[2], text, same))
        new = np.ones(len(order), bool)
        new[1:] = (same[order][1:] != same[order][:-1]) | (text[order][1:] != text[order][:-1])
        return [x[order[new]] for x in t]

    def each(batches):
        for part in slices(batches):
            if made := of_texts(part.column(0), part.column(1)):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], ["key", "doc_id", "at", "s8", "s24"])

    return id_and_text(docs).mapInArrow(each, _ROW)


_LEFT, _RIGHT = -(1 << 32), (1 << 32) - 1  # the halves of s8 and s24
#: The classes: masks of s8 and s24.
CLASSES = [(a8 | b8, a24 | b24) for a8, a24 in ((0, 0), (_LEFT, 0), (0, _LEFT)) for b8, b24 in ((0, 0), (_RIGHT, 0), (0, _RIGHT)) if a8 | a24 | b8 | b24]


def candidate_intervals(found: DataFrame, window: int = WINDOW, held_rows: int = HELD_ROWS) -> DataFrame:
    """windows() -> (a, b, diag, lo, hi): document a has, at shingles lo..hi, what b < a may have `diag` further left."""
    names = ["a", "b", "diag", "lo", "hi", "code"]

    def intervals(a, at_a, b, at_b, reach) -> list[np.ndarray]:
        """Overlaps of one pair and diagonal, joined as long as they are within two windows of each other."""
        c, diag = at_a >> 16, (at_a >> 16) - (at_b >> 16)
        order = np.lexsort((c, diag, b, a))
        a, b, diag, c, reach = a[order], b[order], diag[order], c[order], reach[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (diag[1:] != diag[:-1]) | (c[1:] - c[:-1] > 2 * window)
        start = np.flatnonzero(new)
        if not len(start):
            return [a] * 6
        return [a[start], b[start], diag[start], np.minimum.reduceat(c - (reach >> 8), start), np.maximum.reduceat(c + (reach & 255), start), np.zeros(len(start), np.int64)]

    def laid_over(t: list[np.ndarray], row: np.ndarray, other: np.ndarray) -> list[np.ndarray]:
        _, doc, at, _, _ = t
        reach = _overlap(at[row], at[other])
        take = (doc[row] != doc[other]) & _wide(reach, window)
        row, other = row[take], other[take]
        return [doc[row], at[row], doc[other], at[other], reach[take]]

    def codes(t: list[np.ndarray]) -> Iterator[np.ndarray]:
        for k, (m8, m24) in enumerate(CLASSES):
            yield _mixed(_mixed((t[3] & m8).view(np.uint64), 0) + _mixed((t[4] & m24).view(np.uint64) + np.uint64(k), 1), 4) ^ t[0].view(np.uint64)

    def joined(t: list[np.ndarray], fresh: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """The intervals of the fresh ones of rows in order of key and document, and which rows later ones of each class may be joined with."""
        useful, pairs = np.zeros((len(CLASSES), len(t[0])), bool), []
        for k, code in enumerate(codes(t)):
            order = np.argsort(code, kind="stable")
            first, before = _runs(order, code)
            useful[k, first] = True
            last = np.ones(len(order), bool)
            last[:-1] = first[1:] != first[:-1]
            useful[k, order[last]] = True
            later = before != first
            later &= fresh[order] & (t[4][order] != t[4][before])  # one that agrees on 24 shingles on both sides adds nothing to the first
            pairs += [laid_over(t, order[fresh[order]], first[fresh[order]]), laid_over(t, order[later], before[later])]
        return intervals(*(np.concatenate(x) for x in zip(*pairs, strict=True))), useful

    def passed_on(t: list[np.ndarray], of: np.ndarray | None = None) -> list[np.ndarray]:
        """Rows to be sorted by class: document, centre and reach, surroundings, and the code of each class that `of` has the row for, if it is given."""
        take = np.ones((len(CLASSES), len(t[0])), bool) if of is None else of
        code = np.concatenate([c.view(np.int64) | 1 for c in codes(t)])[take.ravel()]
        return [*(np.tile(t[k], len(CLASSES))[take.ravel()] for k in (1, 2, 4)), *[np.zeros(len(code), np.int64)] * 2, code]

    def each(batches):
        held: list[np.ndarray] | None = None  # of the last key, the rows that later ones may be joined with
        full: int | None = None  # the key whose rows are passed on
        for batch in batches:
            if not batch.num_rows:
                continue
            t, out = [x.to_numpy() for x in batch.columns], []
            if full is not None and len(t[0]):
                over = t[0] == full
                if over.any():
                    out.append(passed_on([x[over] for x in t]))
                    t = [x[~over] for x in t]
                if len(t[0]):
                    full = None
            if len(t[0]):
                fresh = np.ones(len(t[0]), bool)
                if held is not None and held[0][0] == t[0][0]:
                    fresh = np.concatenate((np.zeros(len(held[0]), bool), fresh))
                    t = [np.concatenate((x, y)) for x, y in zip(held, t, strict=True)]
                again = np.flatnonzero(t[0][1:] == t[0][:-1])
                several = np.zeros(len(t[0]), bool)
                several[again], several[again + 1] = True, True
                several[t[0] == t[0][-1]] = True  # the last key may go on
                t = [x[several] for x in t]
                made, useful = joined(t, fresh[several])
                out.append(made)
                useful &= t[0] == t[0][-1]
                keep = useful.any(axis=0)
                keep[-1:] = True
                held = [x[keep] for x in t]
                if len(held[0]) > held_rows:
                    out.append(passed_on(held, useful[:, keep]))
                    held, full = None, int(t[0][-1])
            for made in out:
                if len(made[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names)

    rows = found.repartition("key").sortWithinPartitions("key", "doc_id", "at")
    made = materialize(rows.mapInArrow(each, "a long, b long, diag long, lo long, hi long, code long"))
    intervals_of = made.where("code = 0").drop("code")
    if not made.where("code <> 0").isEmpty():
        intervals_of = intervals_of.unionByName(_by_class(made, window))
    return intervals_of.groupBy("a", "b", "diag").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def _by_class(made: DataFrame, window: int) -> DataFrame:
    """Intervals of the rows that were passed on, each with the first of its class and with the one before it; a holds their document, b their centre and
    reach, diag their surroundings. They are sorted by range, so that a class lies in as many tasks as it takes; what a task has to know of the classes that begin ahead
    of it is one row for each task."""
    rows = made.where("code <> 0").select("code", F.col("a").alias("doc"), F.col("b").alias("at"), F.col("diag").alias("s24"))
    sorted_rows = materialize(rows.repartitionByRange("code", "doc", "at").sortWithinPartitions("code", "doc", "at"))
    numbered = sorted_rows.withColumn("part", F.spark_partition_id())
    ends = numbered.groupBy("part").agg(F.min("code").alias("start"), F.max(F.struct("code", "doc", "at", "s24")).alias("last"))
    tails = numbered.join(ends.withColumnRenamed("part", "_p"), (F.col("part") == F.col("_p")) & (F.col("code") == F.col("last.code")))
    tails = tails.groupBy("part").agg(F.first("start").alias("start"), F.first("last").alias("last"), F.min(F.struct("doc", "at")).alias("first"))
    ahead, open_code, first, last = {}, None, None, None
    for r in sorted(tails.collect(), key=lambda r: r.part):  # a row for each task
        if open_code == r.start:
            ahead[r.part] = (open_code, first, last)
        if open_code != r["last"].code:
            open_code, first = r["last"].code, (r["first"].doc, r["first"].at)
        last = (r["last"].doc, r["last"].at, r["last"].s24)

    def each(batches):
        held = ahead.get(TaskContext.get().partitionId())
        code0, first0, last0 = held if held else (None, (0, 0), (0, 0, 0))
        for batch in batches:
            if not batch.num_rows:
                continue
            code, doc, at, s24 = (batch.column(k).to_numpy() for k in range(4))
            goes_on = code[0] == code0
            if goes_on:  # as if they stood ahead
                code, doc, at, s24 = (np.concatenate((x, y)) for x, y in (([code0] * 2, code), ([first0[0], last0[0]], doc), ([first0[1], last0[1]], at), ([last0[2]] * 2, s24)))
            order = np.arange(len(code))
            first, before = _runs(order, code)
            later = s24[order] != s24[before]
            row, other = np.concatenate((order, order[later])), np.concatenate((first, before[later]))
            fresh = (row >= 2 * goes_on) & (doc[row] != doc[other])
            row, other = row[fresh], other[fresh]
            reach = _overlap(at[row], at[other])
            wide = _wide(reach, window)
            row, other, reach = row[wide], other[wide], reach[wide]
            c = at[row] >> 16
            start = int(np.flatnonzero(code == code[-1])[0])
            code0, first0, last0 = code[-1], (doc[start], at[start]), (doc[-1], at[-1], s24[-1])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[row], doc[other], c - (at[other] >> 16), c - (reach >> 8), c + (reach & 255))], ["a", "b", "diag", "lo", "hi"])

    return sorted_rows.mapInArrow(each, "a long, b long, diag long, lo long, hi long")


def _verified(ha: np.ndarray, hb: np.ndarray, diag: int, lo: int, b_start: int, window: int, matches: int, drift: int) -> list[tuple[int, int]]:
    """Stretches (first and last shingle, in a) that windows with enough matches cover, without unmatched shingles at their ends.
    ha begins at shingle lo of a, hb at b_start of b."""
    hit = np.zeros(len(ha), bool)
    for d in range(-drift, drift + 1):
        # shingle p of a stands at p - diag + d of b
        at = lo - diag + d - b_start
        x, y = max(0, -at), min(len(ha), len(hb) - at)
        if y > x:
            hit[x:y] |= ha[x:y] == hb[x + at : y + at]
    if len(hit) < window:
        return []
    total = np.concatenate(([0], np.cumsum(hit)))
    starts = np.flatnonzero(total[window:] - total[:-window] >= matches)
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > window)
    good = np.flatnonzero(hit)
    first = good[np.searchsorted(good, starts[np.concatenate(([0], cuts + 1))])]
    last = good[np.searchsorted(good, starts[np.concatenate((cuts, [len(starts) - 1]))] + window) - 1]
    return list(zip((first + lo).tolist(), (last + lo).tolist(), strict=True))


def _with_own_repeats(marks: list[tuple[int, int, int]], h: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """marks(first, last shingle, document) and the other places of the text where a window of theirs stands again: candidates name the
    first place of equal surroundings only."""
    stretch = _stretch_hashes(h, window)
    _, same = np.unique(stretch, return_inverse=True)
    if same.max(initial=-1) + 1 == len(stretch):
        return marks
    none = np.int64(2**63 - 1)
    owner = np.full(len(stretch), none)
    for x, y, b in marks:
        owner[x : max(x, y - window + 2)] = np.minimum(owner[x : max(x, y - window + 2)], b)
    least = np.full(same.max() + 1, none)
    np.minimum.at(least, same, owner)
    again = np.flatnonzero((owner == none) & (least[same] != none))
    if not len(again):
        return marks
    cuts = np.flatnonzero(np.diff(again) > 1)
    begin, end = np.concatenate(([0], cuts + 1)), np.concatenate((cuts, [len(again) - 1]))
    return marks + [(int(again[i]), int(again[j]) + window - 1, int(least[same[again[i : j + 1]]].min())) for i, j in zip(begin.tolist(), end.tolist(), strict=True)]


def _word_offsets(text: str) -> tuple[list[int], list[int]]:
    spans = [m.span() for m in re.finditer(WORD, text)]
    return [s[0] for s in spans], [s[1] for s in spans]


def _asked(found: DataFrame, askers: int) -> tuple[DataFrame, DataFrame]:
    """(b, salt, asked) with at most about `askers` documents in a row, and (b, salts) for the documents that more ask for. Of b a pair needs
    one stretch over all its diagonals."""
    pairs = found.groupBy("a", "b").agg(F.min(F.col("lo") - F.col("diag")).alias("b_lo"), F.max(F.col("hi") - F.col("diag")).alias("b_hi"), F.collect_list(F.struct("diag", "lo", "hi")).alias("at"))
    salts = found.groupBy("b").agg(F.ceil(F.count("*") / askers).cast("int").alias("salts")).where("salts > 1").select(F.col("b").alias("_b"), "salts")
    salt = F.pmod(F.xxhash64("a"), F.coalesce("salts", F.lit(1))).cast("int")
    asked = pairs.join(salts, pairs.b == salts["_b"], "left").groupBy("b", salt.alias("salt")).agg(F.collect_list(F.struct("a", "b_lo", "b_hi", "at")).alias("asked"))
    return asked, salts


def _passages(texts: DataFrame, window: int, matches: int, drift: int, hashes: int) -> DataFrame:
    """(doc_id, text_key, of_doc, start_word, end_word, start_char, end_char) of each row of texts(doc_id, text)."""
    found = materialize(candidate_intervals(windows(texts, window, hashes), window))
    asked, salts = _asked(found, ASKERS)
    spans = pa.list_(pa.struct([("diag", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())]))

    def hand_out(batches):
        for part in slices(batches):
            h, begin, end = hashes_of(part.column(1))
            small, rows, size = h.astype(np.uint32), [], 0

            def made():
                a, b, lo, data, at = zip(*rows, strict=True)
                return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(lo, pa.int64()), pa.array(data, pa.binary()), pa.array(at, spans)], ["a", "b", "b_start", "shingles", "at"])

            for i in range(part.num_rows):
                b, own = part.column(0)[i].as_py(), small[begin[i] : end[i]]
                for q in part.column(2)[i].as_py():
                    lo, hi = max(0, q["b_lo"] - drift), min(len(own), q["b_hi"] + 1 + drift)
                    if hi <= lo:
                        continue
                    rows.append((q["a"], b, lo, own[lo:hi].tobytes(), q["at"]))
                    size += 4 * (hi - lo)
                    if size > SLICE_BYTES:
                        yield made()
                        rows, size = [], 0
            if rows:
                yield made()

    copies = texts.join(salts, texts.doc_id == salts["_b"], "left").select("doc_id", "text", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("_salt"))
    handed = copies.join(asked, (F.col("doc_id") == F.col("b")) & (F.col("_salt") == F.col("salt"))).select("doc_id", "text", "asked")
    handed = handed.mapInArrow(hand_out, "a long, b long, b_start long, shingles binary, at array<struct<diag:long,lo:long,hi:long>>")
    # a document asks for a few partners for each class of its windows at most, so this list is bounded by its length
    for_a = handed.groupBy("a").agg(F.collect_list(F.struct("b", "b_start", "shingles", "at")).alias("with"))

    def verify(batches):
        for part in slices(batches):
            hashes, begin, end = hashes_of(part.column(1))
            out = []
            for i in range(part.num_rows):
                doc, text, whole = part.column(0)[i].as_py(), part.column(1)[i].as_py(), hashes[begin[i] : end[i]]
                h = whole.astype(np.uint32)
                marks: list[tuple[int, int, int]] = []
                for p in part.column(3)[i].as_py():
                    hb = np.frombuffer(p["shingles"], np.uint32)
                    for s in p["at"]:
                        lo, hi = max(0, s["lo"]), min(len(h), s["hi"] + 1)
                        marks += [(x, y, p["b"]) for x, y in _verified(h[lo:hi], hb, s["diag"], lo, p["b_start"], window, matches, drift)]
                if not marks:
                    continue
                begins, ends = _word_offsets(text)
                runs: list[list[int]] = []
                for x, y, b in sorted((x, y + SHINGLE, b) for x, y, b in _with_own_repeats(marks, whole, window)):
                    if runs and x <= runs[-1][1]:
                        runs[-1][1], runs[-1][2] = max(y, runs[-1][1]), min(runs[-1][2], b)
                    else:
                        runs.append([x, y, b])
                out += [(doc, part.column(2)[i].as_py(), b, x, y, begins[x], ends[y - 1]) for x, y, b in runs]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["doc_id", "text_key", "of_doc", "start_word", "end_word", "start_char", "end_char"])

    rows = texts.join(for_a, texts.doc_id == for_a.a).select("doc_id", "text", F.xxhash64("text").alias("text_key"), "with")
    return rows.mapInArrow(verify, "doc_id long, text_key long, of_doc long, start_word long, end_word long, start_char long, end_char long")


def repeated_passages(docs: DataFrame, window: int = WINDOW, matches: int = MATCHES, drift: int = DRIFT, hashes: int = HASHES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, of_doc, start_word, end_word, start_char, end_char): the longest stretches of each document that an earlier
    document (smaller id, of_doc) has as well; ends are exclusive, words as in the contracts' pattern, characters are code points."""
    return _passages(id_and_text(docs, id_col, text_col), window, matches, drift, hashes).drop("text_key")


def _without(text: Column, cuts: Column) -> Column:
    """text without the sorted, disjoint stretches of cuts(start_char, end_char)."""
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(cuts, lambda c: c["end_char"]))
    ends = F.concat(F.transform(cuts, lambda c: c["start_char"]), F.array(F.length(text).cast("long")))
    return F.array_join(F.zip_with(starts, ends, lambda a, b: F.substring(text, (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int"))), "")


def remove_repeats(docs: DataFrame, window: int = WINDOW, matches: int = MATCHES, drift: int = DRIFT, hashes: int = HASHES) -> DataFrame:
    """docs with every passage that an earlier document has cut out, so its first occurrence stays; n_chars, if there is one,
    follows the text. Documents of which no word is left go; those without repetition stay as they are, empty ones too. Rows that
    repeat an id with another text are cut each by its own passages."""
    found = _passages(id_and_text(docs), window, matches, drift, hashes).groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set(F.struct("start_char", "end_char"))).alias("_cuts"))
    found = found.select(F.col("doc_id").alias("_of"), F.col("text_key").alias("_of_text"), "_cuts")
    # the row travels as one value, so that no column of docs can clash with those in between
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64(F.col("text").cast("string")).alias("_text_key"))
    out = rows.join(found, (F.col("_id") == F.col("_of")) & (F.col("_text_key") == F.col("_of_text")), "left")
    cut, text = F.col("_cuts").isNotNull(), F.col("_row.text").cast("string")
    out = out.withColumn("_new", F.when(cut, _without(text, F.col("_cuts"))).otherwise(text))
    out = out.where(~cut | F.col("_new").rlike(r"[^\x20\x09-\x0D]"))
    changed = {"text": F.col("_new"), "n_chars": F.when(cut, F.length("_new").cast("long")).otherwise(F.col("_row.n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*[changed[c].alias(c) if c in changed else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
