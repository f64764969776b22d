"""Byte-level BPE (operator 1).

Pieces are cut by the tokenizer's pattern; only pieces that a worker hasn't met are merged. They are put in padded
matrices by length, and in each round every row merges its leftmost pair of least rank: pair ranks come from an open-addressed
hash table, and rows that have no pair left are taken out of the matrix (compaction). Pieces beyond `MATRIX_BYTES` bytes
merge with a heap and linked list, in the same order, so one enormous piece costs n log n rather than n squared.

Defined cases: null text counts as empty (no ids, digests of nothing); repeated rows each get a row; a null id stays;
further columns are ignored. Lone surrogates can't occur in Spark strings.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import BoundedCache, id_and_text, text_slices

MATRIX_BYTES = 128
CACHE_PIECES = 300_000
NONE = np.int32(2**31 - 1)


class PairTable:
    """(left id, right id) -> id of their merge, which is its rank; open addressing with linear probing, looked up in whole arrays."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.bits = max(4, (2 * len(pairs)).bit_length())
        self.mask = np.uint64((1 << self.bits) - 1)
        keys = np.array([a << 32 | b for a, b in pairs], dtype=np.uint64)
        values = np.array(list(pairs.values()), dtype=np.int32)
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << self.bits, NONE)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[slot[todo]] == np.uint64(2**64 - 1)
            at, first = np.unique(slot[todo[free]], return_index=True)
            won = todo[free][first]
            self.keys[at], self.values[at] = keys[won], values[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slot[todo] = (slot[todo] + np.uint64(1)) & self.mask
        self.exact = pairs

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        shape, keys = left.shape, (left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)).ravel()
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.values[slot], NONE)
        todo = np.flatnonzero((held != keys) & (held != np.uint64(2**64 - 1)))
        while len(todo):
            slot[todo] = (slot[todo] + np.uint64(1)) & self.mask
            held = self.keys[slot[todo]]
            hit = held == keys[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (held != np.uint64(2**64 - 1))]
        return out.reshape(shape)


class ByteBPE:
    """Ranks of a tiktoken file and the pattern that cuts text before the merges."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ids = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes_of = {i: t for t, i in self.ids.items()}
        self.pieces = regex.compile(pattern).findall
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)], dtype=np.int32)
        # all pairs of tokens that join to a token: every cut of every token into two tokens
        self.table = PairTable({(self.ids[t[:k]], self.ids[t[k:]]): i for t, i in self.ids.items() for k in range(1, len(t)) if t[:k] in self.ids and t[k:] in self.ids})
        self.cache = BoundedCache(CACHE_PIECES)  # piece -> (ids joined by a space, number of ids, decoded bytes)

    def _merge_matrix(self, rows: list[bytes]) -> list[list[int]]:
        """Rows of one length."""
        n, width = len(rows), len(rows[0])
        ids = self.byte_ids[np.frombuffer(b"".join(rows), np.uint8).reshape(n, width)]
        out: list = [None] * n
        alive, size = np.arange(n), np.full(n, width)
        rank = self.table.ranks(ids[:, :-1], ids[:, 1:]) if width > 1 else np.full((n, 0), NONE)
        while len(alive):
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(alive), np.int64)
            least = rank[np.arange(len(alive)), at] if rank.shape[1] else np.full(len(alive), NONE)
            done = least == NONE
            if done.any():
                for i, row, m in zip(alive[done].tolist(), ids[done].tolist(), size[done].tolist(), strict=True):
                    out[i] = row[:m]
                keep = ~done
                alive, ids, rank, size, at, least = alive[keep], ids[keep], rank[keep], size[keep], at[keep], least[keep]
                if not len(alive):
                    break
            r = np.arange(len(alive))
            # close the gap right of the merge, then renew the two pairs beside it
            cols = np.arange(ids.shape[1])
            source = np.minimum(cols[None, :] + (cols[None, :] > at[:, None]), ids.shape[1] - 1)
            ids = np.take_along_axis(ids, source, axis=1)
            ids[r, at] = least
            size -= 1
            width = int(size.max())
            ids = ids[:, :width]
            if width == 1:
                rank = np.full((len(alive), 0), NONE)
                continue
            source = np.minimum(np.arange(rank.shape[1])[None, :] + (np.arange(rank.shape[1])[None, :] >= at[:, None]), rank.shape[1] - 1)
            rank = np.take_along_axis(rank, source, axis=1)[:, : width - 1]
            rank = np.where(np.arange(width - 1)[None, :] < (size - 1)[:, None], rank, NONE)
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < size - 1)
            rank[left, at[left] - 1] = self.table.ranks(ids[left, at[left] - 1], ids[left, at[left]])
            rank[right, at[right]] = self.table.ranks(ids[right, at[right]], ids[right, at[right] + 1])
        return out

    def _merge_long(self, piece: bytes) -> list[int]:
        pairs, ids = self.table.exact, [int(self.byte_ids[b]) for b in piece]
        after, before = [*range(1, len(ids)), -1], list(range(-1, len(ids) - 1))
        heap = [(pairs[p], i, *p) for i, p in enumerate(zip(ids[:-1], ids[1:], strict=True)) if p in pairs]
        heapq.heapify(heap)
        while heap:
            new, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue  # one of the two has merged meanwhile
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (p := (ids[x], ids[y])) in pairs:
                    heapq.heappush(heap, (pairs[p], x, *p))
        return [i for i in ids if i >= 0]

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece, merged on its own."""
        out: list = [None] * len(pieces)
        by_length: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if p in self.ids:
                out[i] = [self.ids[p]]
            elif len(p) > MATRIX_BYTES:
                out[i] = self._merge_long(p)
            else:
                by_length.setdefault(len(p), []).append(i)
        for length, at in by_length.items():
            step = max(64, 400_000 // max(1, length))
            for lo in range(0, len(at), step):
                part = at[lo : lo + step]
                for i, ids in zip(part, self._merge_matrix([pieces[k] for k in part]), strict=True):
                    out[i] = ids
        return out

    def _learn(self, texts: list[list[str]]) -> None:
        new = list({p for pieces in texts for p in pieces if p not in self.cache})
        if len(new) + len(self.cache) > self.cache.limit:
            self.cache.clear()
            new = list({p for pieces in texts for p in pieces})
        for p, ids in zip(new, self.encode_pieces([p.encode("utf-8", "surrogatepass") for p in new]), strict=True):
            self.cache[p] = (" ".join(map(str, ids)), len(ids), self.decode(ids))

    def encode(self, text: str) -> list[int]:
        return [i for ids in self.encode_pieces([p.encode("utf-8", "surrogatepass") for p in self.pieces(text)]) for i in ids]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(number of ids, sha256 of the decimal ids, sha256 of the decoded bytes) of each text."""
        cut = [self.pieces(t) for t in texts]
        self._learn(cut)
        out, get = [], self.cache.__getitem__
        for pieces in cut:
            n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
            for at in range(0, len(pieces), 50_000):
                part = list(map(get, pieces[at : at + 50_000]))
                ids.update((" " * (at > 0) + " ".join([p[0] for p in part])).encode())
                decoded.update(b"".join([p[2] for p in part]))
                n += sum([p[1] for p in part])
            out.append((n, ids.hexdigest(), decoded.hexdigest()))
        return out


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBPE:
    """One per worker process; the file's path is a parameter that must hold on every executor."""
    return ByteBPE(path, pattern)


def encode_column(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>)"""

    def each(batches):
        bpe = load(path, pattern)
        for ids, texts in text_slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([bpe.encode(t) for t in texts], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(each, "doc_id long, ids array<int>")


def decode_column(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, bytes binary); null ids give null, an id outside the vocabulary raises."""

    def each(batches):
        bpe = load(path, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if x is None else bpe.decode(x) for x in b.column(1).to_pylist()], pa.binary())], ["doc_id", "bytes"])

    return encoded.select(encoded[id_col].cast("long").alias("doc_id"), encoded[ids_col].cast("array<int>").alias("ids")).mapInArrow(each, "doc_id long, bytes binary")


def encode_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encodes, decodes the ids again and digests both in one pass."""

    def each(batches):
        bpe = load(path, pattern)
        for ids, texts in text_slices(batches):
            n, a, b = zip(*bpe.digests(texts), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_and_text(docs, id_col, text_col).mapInArrow(each, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
