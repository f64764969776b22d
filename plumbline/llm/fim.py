"""Fill-in-middle transformation (operator 13).

A text is cut into units, words with the blanks before them, and a run of blanks at the end is a unit too. One Aho-Corasick automaton
finds the characters that change the class (the six blanks) and the sentinels. These events are sparse and suffice: between two blanks
there's a word exactly if they aren't neighbours, so the number of units follows from the gaps. A first scan counts the units of
each block of characters and keeps the counts; the place of unit k is then looked up by scanning the one block that holds it.

Where a text is cut and how it is put together depends on its id and the seed alone, so a lost task gives the same rows again.

Defined cases: null text counts as empty and stays plain; a null id counts as an empty string in the hash; a text that holds a
sentinel stays plain, as it couldn't be restored; repeated rows each get a row; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, text_slices

BLANKS = " \t\n\x0b\x0c\r"
SENTINELS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle
BLOCK_CHARS = 1 << 20


@lru_cache(maxsize=8)
def _automaton(sentinels: tuple[str, ...]):
    a = ahocorasick.Automaton()
    for blank in BLANKS:
        a.add_word(blank, 0)
    for mark in sentinels:
        a.add_word(mark, 1)
    a.make_automaton()
    return a


class Units:
    """The units of a text, by events: `n` of them, `end(k)` characters in the first k, `marked` if there's a sentinel."""

    def __init__(self, text: str, sentinels: tuple[str, ...] = SENTINELS, block: int = BLOCK_CHARS):
        self.text, self.sentinels, self.block, self.marked = text, sentinels, block, False
        self.upto, self.before = [], []  # of each block: units that end in it or earlier, the last blank ahead of it
        blank, n = -1, 0
        for at in range(0, len(text), block):
            self.before.append(blank)
            ends, blank = self._scan(at, blank)
            n += len(ends)
            self.upto.append(n)
        self.n = n + (len(text) > 0)

    def _scan(self, at: int, blank: int) -> tuple[np.ndarray, int]:
        """Ends of the words that a blank of the block at `at` ends, and the last blank so far."""
        stop = min(at + self.block, len(self.text))
        reach = min(stop + max(map(len, self.sentinels)) - 1, len(self.text))  # a sentinel may lie across the end of the block
        events = np.fromiter((end << 1 | kind for end, kind in _automaton(self.sentinels).iter(self.text, at, reach)), np.int64)
        self.marked |= bool((events & 1).any())
        blanks = events[(events & 1) == 0] >> 1
        blanks = blanks[blanks < stop]
        if not len(blanks):
            return blanks, blank
        gaps = np.diff(blanks, prepend=blank)
        return blanks[gaps > 1], int(blanks[-1])

    def end(self, k: int) -> int:
        if k == 0:
            return 0
        if k == self.n:
            return len(self.text)
        b = bisect_left(self.upto, k)
        ends, _ = self._scan(b * self.block, self.before[b])
        return int(ends[k - 1 - (self.upto[b - 1] if b else 0)])


def transform(doc_id: int | None, text: str, seed: int = 42, fim_percent: int = 50, spm_percent: int = 80, sentinels: tuple[str, ...] = SENTINELS) -> tuple:
    """(n, form, prefix_chars, middle_chars, output)"""
    units = Units(text, sentinels)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[at : at + 8], 16) for at in (0, 8, 16, 24))
    if not text or units.marked or h3 % 100 >= fim_percent:
        return units.n, "plain", None, None, text
    first, second = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
    a, b = units.end(first), units.end(second)
    to_prefix, to_suffix, to_middle = sentinels
    if h4 % 100 < spm_percent:
        return units.n, "spm", a, b - a, "".join((to_suffix, text[b:], to_prefix, text[:a], to_middle, text[a:b]))
    return units.n, "psm", a, b - a, "".join((to_prefix, text[:a], to_suffix, text[b:], to_middle, text[a:b]))


_KINDS = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())


def fill_in_middle(docs: DataFrame, seed: int = 42, fim_percent: int = 50, spm_percent: int = 80, sentinels: tuple[str, ...] = SENTINELS) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, n units, form plain, psm or spm, prefix_chars, middle_chars, output); the two lengths are null where plain."""

    def each(batches):
        for ids, texts in text_slices(batches):
            made = [(i, *transform(i, t, seed, fim_percent, spm_percent, sentinels)) for i, t in zip(ids, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*made, strict=True), _KINDS, strict=True)], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return id_and_text(docs).mapInArrow(each, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str = "output", form: str = "form", sentinels: tuple[str, ...] = SENTINELS) -> Column:
    """The text of a row of fill_in_middle(). Its parts hold no sentinel, and none can begin within another, so they are what stands between them."""
    part = F.split(F.col(output), "|".join(re.escape(s) for s in sentinels), -1)
    psm, spm = F.concat(part[1], part[3], part[2]), F.concat(part[2], part[3], part[1])
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))


def fim_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of fill_in_middle()'s rows"""
    made = fill_in_middle(docs)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))
