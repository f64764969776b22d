"""Running sums along groups of any size.

Rows are sorted by range over all tasks, so a group of a third of all rows lies in many of them. Each task sums its own part; what earlier
parts of a group that spans tasks add is one row for each task, which the driver chains, and is joined back. Sums can be plain or those
of a polynomial, sum of v[i] * base**i modulo a prime with i from 1 along the group, which names a sequence by its prefixes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


@dataclass(frozen=True)
class Running:
    """A running sum of column `value` as column `name`, and that ahead of the row as column `before`; with a modulus (below 2**31), of
    value * base**position."""

    name: str
    value: str
    before: str
    base: int = 1
    modulus: int | None = None

    def terms(self, values: np.ndarray, position: np.ndarray) -> np.ndarray:
        return values if self.modulus is None else values % self.modulus * powers(self.base, position, self.modulus) % self.modulus

    def joined(self, ahead: int, count: int, own: int) -> int:
        """The sum of a stretch of `count` rows and of one that follows it."""
        return ahead + own if self.modulus is None else (ahead + pow(self.base, count, self.modulus) * own) % self.modulus


def powers(base: int, exponents: np.ndarray, modulus: int) -> np.ndarray:
    """base ** exponents modulo a number below 2**31, by squaring."""
    out, square, e = np.ones(len(exponents), np.int64), base % modulus, exponents.copy()
    while e.any():
        out = np.where(e & 1, out * square % modulus, out)
        square, e = square * square % modulus, e >> 1
    return out


def running_sums(rows: DataFrame, group: str, order: list, sums: list[Running], keep: list[str]) -> DataFrame:
    """rows -> (group, keep..., position from 1 along the group, the running sums). `group` is a long without nulls. Order has to be total but
    for rows that are alike in all columns used, or equal rows may change places. The result is checkpointed."""
    used = list(dict.fromkeys([group, *keep, *(s.value for s in sums)]))
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).select(*used)
    fields = [f for f in dealt.schema.fields if f.name in (group, *keep)]
    names, results = [f.name for f in fields], [c for s in sums for c in (s.name, s.before)]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in fields] + ["position long", *(f"{c} long" for c in results), "_part int", "_at long"])

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, open_key, count, held = TaskContext.get().partitionId(), 0, None, 0, [0] * len(sums)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key = batch.column(used.index(group)).to_numpy()
            starts = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1))
            of = np.repeat(np.arange(len(starts)), np.diff(starts, append=n))
            goes_on = key[0] == open_key
            position = np.arange(n) - starts[of] + 1
            if goes_on:
                position[of == 0] += count
            made = []
            for k, s in enumerate(sums):
                term = s.terms(batch.column(used.index(s.value)).to_numpy().astype(np.int64), position)
                total = np.cumsum(term)
                total -= np.concatenate(([0], total[starts[1:] - 1]))[of]
                if goes_on:
                    total[of == 0] += held[k]
                before = total - term
                made += [total, before] if s.modulus is None else [total % s.modulus, before % s.modulus]
            open_key, count, held = key[-1], int(position[-1]), [int(m[-1]) for m in made[::2]]
            columns = [batch.column(used.index(c)) for c in names] + [pa.array(position), *map(pa.array, made), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))]
            at += n
            yield pa.RecordBatch.from_arrays(columns, [*names, "position", *results, "_part", "_at"])

    done = materialize(dealt.mapInArrow(each, schema))
    state = [group, "position", *(s.name for s in sums)]
    tails = done.groupBy("_part").agg(F.min_by(group, "_at").alias("first"), F.max_by(F.struct(*state), "_at").alias("last"))
    carried, open_key, count, held = [], None, 0, [0] * len(sums)
    for t in sorted(tails.collect(), key=lambda r: r["_part"]):  # one row for each task
        spans = open_key is not None and t.first == open_key
        if spans:
            carried.append((t["_part"], open_key, count, *held, *(pow(s.base, count, s.modulus) if s.modulus else 1 for s in sums)))
        own = [t.last[s.name] for s in sums]
        if spans and t.last[group] == open_key:
            held = [s.joined(h, count, o) for s, h, o in zip(sums, held, own, strict=True)]
            count += t.last.position
        else:
            open_key, count, held = t.last[group], t.last.position, own
    plain = done.drop("_part", "_at")
    if not carried:
        return plain
    kinds = ", ".join(["_p int", "_g long", "_n long", *(f"_h{k} long" for k in range(len(sums))), *(f"_f{k} long" for k in range(len(sums)))])
    ahead = F.broadcast(done.sparkSession.createDataFrame(carried, kinds))  # at most a row for each task
    joined = done.join(ahead, (F.col("_part") == F.col("_p")) & (F.col(group) == F.col("_g")), "left")
    zero = F.lit(0).cast("long")
    finished = [(F.col("position") + F.coalesce("_n", zero)).alias("position")]
    for k, s in enumerate(sums):
        for c in (s.name, s.before):
            whole = F.col(c) * F.coalesce(f"_f{k}", F.lit(1)) + F.coalesce(f"_h{k}", zero)
            finished.append((whole % s.modulus if s.modulus else whole).alias(c))
    return joined.select(*names, *finished)
