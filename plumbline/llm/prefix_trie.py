"""Prefix trie of conversations (operator 12), summed over its subtrees by heavy paths.

A node is named by a polynomial of the hashes of its turns modulo four primes (124 bits), so that all prefixes of all conversations are
one running sum (scans.py), and a conversation whose head is another one's is named by arithmetic on two prefixes of at most eight turns.

Nodes that all have the same members lie on one stretch of one conversation; they are one segment, found by grouping on
(smallest member, members). There are at most two segments for each different conversation, however long it is. Among the segments below a
segment the one with most members is heavy. Heavy ones are joined to paths by pointer doubling. A light segment has at most half of the
members of the one above, so the sums of light paths reach the root's in at most log2(conversations) rounds, each of them an
aggregation. Then running sums along the paths give every segment, and arithmetic within the segment every node, its subtree's sums.

Defined cases: rows of a null conv_id belong to no conversation and are left out; null role or text counts as empty; turns are ordered by
number, null first, those of equal number by role and then by a hash of the text; rows that are alike are turns of their own; an empty
table gives no rows; further columns are ignored. c - c % 5 takes the sign of c as Spark's % does.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .scans import Running, running_sums

#: The largest primes below 2**31, and a base for each.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (1103515245, 1566083941, 1812433253, 1664525017)
HEAD_TURNS = 9  # a head has fewer turns than this
COPY_ROWS = 1000
CHUNK_CHARS = 1 << 16
NOTHING = hashlib.sha256(b"").hexdigest()

_P, _Q = [f"p{k}" for k in range(4)], [f"q{k}" for k in range(4)]  # a prefix, and the one that is a turn shorter


def _turn_rows(turns: DataFrame) -> DataFrame:
    """(conv, turn, role, t0..t3 hashes, bytes, copy): a row for each turn, without its text; copy numbers rows that are alike."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    first, second = F.xxhash64(role, text), F.xxhash64(F.lit(11), role, text)
    # several rows that are alike are counted before they meet, and dealt again in short runs
    alike = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), first.alias("first"), second.alias("second"), F.octet_length(text).cast("long").alias("bytes"))
    alike = alike.groupBy(*alike.columns).agg(F.count("*").alias("n"))
    runs = alike.withColumn("run", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPY_ROWS).cast("long"))))
    each = runs.withColumn("copy", F.explode(F.sequence(F.col("run") * COPY_ROWS + 1, F.least("n", (F.col("run") + 1) * COPY_ROWS))))
    part = lambda c, k: F.shiftrightunsigned(c, 33 * k).bitwiseAND(0x7FFFFFFF)
    return each.select("conv", "turn", "role", "first", "bytes", "copy", *(part(F.col(c), k).alias(f"t{2 * j + k}") for j, c in enumerate(("first", "second")) for k in (0, 1)))


def _head_turns(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % HEAD_TURNS


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a row for each turn of each rebuilt conversation: conv, depth, p0..p3, q0..q3, bytes, upto; a row for each: conv, depth, p0..p3).
    upto: bytes of the texts so far."""
    sums = [Running(f"p{k}", f"t{k}", f"q{k}", BASES[k], PRIMES[k]) for k in range(4)] + [Running("upto", "bytes", "_ahead")]
    order = [F.col("turn").asc_nulls_first(), "role", "first", "bytes", "copy"]
    own = running_sums(_turn_rows(turns), "conv", order, sums, ["bytes"]).drop("_ahead")
    at = F.struct("position", *_P, *_Q, "bytes", "upto")
    heads = F.sort_array(F.collect_list(F.when(F.col("position") < HEAD_TURNS, at)))  # eight at most
    convs = materialize(own.groupBy("conv").agg(F.max("position").alias("n"), heads.alias("heads"), F.max_by(F.struct(*_P), "position").alias("last")))

    donors = convs.select(F.col("conv").alias("donor"), F.col("heads").alias("given"))
    held = convs.withColumn("h", _head_turns(F.col("conv"))).join(donors, F.col("conv") - F.col("conv") % 5 == F.col("donor"), "left")
    held = held.withColumn("hd", F.least("h", F.coalesce(F.size("given"), F.lit(0))).cast("long"))
    # the turns after the first h move to depth position - h + hd, which divides their part of the polynomial by base ** (h - hd)
    new, old = F.get("given", (F.col("hd") - 1).cast("int")), F.get("heads", (F.col("h") - 1).cast("int"))
    zero = F.lit(0).cast("long")
    moves = []
    for k, (p, b) in enumerate(zip(PRIMES, BASES, strict=True)):
        inverse = F.get(F.array(*(F.lit(pow(b, -e, p)).cast("long") for e in range(HEAD_TURNS))), (F.col("h") - F.col("hd")).cast("int"))
        moves.append(inverse.alias(f"i{k}"))
    held = held.select("conv", "n", "h", "hd", "given", "last", *moves, new.alias("new"), old.alias("old"))
    adds = [F.pmod(F.coalesce(F.col("new")[f"p{k}"], zero) - F.coalesce(F.col("old")[f"p{k}"], zero) * F.col(f"i{k}") % PRIMES[k], F.lit(PRIMES[k])).alias(f"a{k}") for k in range(4)]
    held = materialize(held.select("conv", "n", "h", "hd", "given", "last", *(f"i{k}" for k in range(4)), *adds, (F.coalesce(F.col("new.upto"), zero) - F.coalesce(F.col("old.upto"), zero)).alias("more"), F.struct(*(F.coalesce(F.col("new")[c], zero).alias(c) for c in _P)).alias("top")))

    front = held.select("conv", F.explode(F.slice("given", F.lit(1), F.col("hd").cast("int"))).alias("g")).select("conv", F.col("g.position").alias("depth"), *(f"g.{c}" for c in (*_P, *_Q, "bytes", "upto")))
    moved = lambda c, k: (F.col(c) * F.col(f"i{k}") % PRIMES[k] + F.col(f"a{k}")) % PRIMES[k]
    shifts = held.select(F.col("conv").alias("_c"), "h", "hd", "more", *(f"{x}{k}" for x in "ia" for k in range(4)))
    back = own.where(F.col("position") > _head_turns(F.col("conv"))).join(shifts, F.col("conv") == F.col("_c"))
    back = back.select("conv", (F.col("position") - F.col("h") + F.col("hd")).alias("depth"), *(moved(f"p{k}", k).alias(f"p{k}") for k in range(4)), *(moved(f"q{k}", k).alias(f"q{k}") for k in range(4)), "bytes", (F.col("upto") + F.col("more")).alias("upto"))

    ended = F.when(F.col("n") > F.col("h"), F.struct(*(moved(f"last.p{k}", k).alias(f"p{k}") for k in range(4)))).otherwise(F.col("top"))
    ends = held.select("conv", (F.col("hd") + F.greatest(F.col("n") - F.col("h"), zero)).alias("depth"), ended.alias("e")).select("conv", "depth", "e.*")
    return front.unionByName(back), ends


def _named(rows: DataFrame, names: list[str], first: str, second: str) -> DataFrame:
    """The four numbers as two longs."""
    pair = lambda a, b: F.shiftleft(F.col(a), 31).bitwiseOR(F.col(b))
    return rows.withColumns({first: pair(names[0], names[1]), second: pair(names[2], names[3])}).drop(*names)


def _id_digests(ends: DataFrame) -> DataFrame:
    """ends(k1, k2, depth, conv) -> (k1, k2, depth, ends_sha256). Ids are joined to chunks of text where they are sorted, over all tasks; only the
    digest, which can't be cut, takes the chunks of a node in turn."""
    key = ("k1", "k2", "depth")

    def chunks(batches):
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        made: list = []
        for name, group in groupby(rows, key=lambda r: r[:3]):
            ids, size, first = [], 0, None
            for r in group:
                first = r[3] if first is None else first
                ids.append(str(r[3]))
                size += len(ids[-1]) + 1
                if size >= CHUNK_CHARS:
                    made.append((*name, first, ",".join(ids)))
                    ids, size, first = [], 0, None
            if ids:
                made.append((*name, first, ",".join(ids)))
            if len(made) >= 500:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made, strict=True)], [*key, "first", "ids"])
                made = []
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made, strict=True)], [*key, "first", "ids"])

    def digests(batches):
        rows = (r for b in batches for at in range(0, b.num_rows, 64) for r in zip(*(c.to_pylist() for c in b.slice(at, 64).columns), strict=True))
        made: list = []
        for name, group in groupby(rows, key=lambda r: r[:3]):
            digest = hashlib.sha256()
            for k, r in enumerate(group):
                digest.update((("," if k else "") + r[4]).encode())
            made.append((*name, digest.hexdigest()))
            if len(made) >= 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made, strict=True)], [*key, "ends_sha256"])
                made = []
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made, strict=True)], [*key, "ends_sha256"])

    keys = "k1 long, k2 long, depth long"
    joined = ends.select(*key, "conv").repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv").mapInArrow(chunks, f"{keys}, first long, ids string")
    return joined.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(digests, f"{keys}, ends_sha256 string")


def _paths(segments: DataFrame) -> DataFrame:
    """segments(seg, up, conv_id, n_convs) -> (seg, head): the topmost segment of the heavy path that each is on."""
    heavy = segments.where("up is not null").groupBy("up").agg(F.max(F.struct("n_convs", F.bitwise_not("conv_id").alias("_order"), "seg")).alias("most")).select(F.col("most.seg").alias("_heavy"))
    found = segments.join(heavy, F.col("seg") == F.col("_heavy"), "left")
    found = materialize(found.select("seg", F.when(F.col("_heavy").isNull(), F.col("seg")).otherwise(F.col("up")).alias("head"), F.col("_heavy").isNull().alias("done")))
    while not found.where("not done").isEmpty():
        ahead = found.select(F.col("seg").alias("_s"), F.col("head").alias("_h"), F.col("done").alias("_d"))
        nearer = found.where("not done").join(ahead, F.col("head") == F.col("_s")).select("seg", F.col("_h").alias("head"), F.col("_d").alias("done"))
        found = materialize(found.where("done").unionByName(nearer))
    return found.select("seg", "head")


def _subtree_sums(segments: DataFrame) -> DataFrame:
    """segments(seg, up, top, conv_id, n_convs, leaves, saved) -> (seg, n_leaves, total): sums over the segment and all below it."""
    paths = _paths(segments)
    placed = materialize(segments.select("seg", "up", "top", "leaves", "saved").join(paths.withColumnRenamed("seg", "_s"), F.col("seg") == F.col("_s")).drop("_s"))
    above = placed.where("seg = head and up is not null").select(F.col("head").alias("path"), "up")
    above = materialize(above.join(placed.select(F.col("seg").alias("_s"), F.col("head").alias("parent")), F.col("up") == F.col("_s")).drop("_s"))
    # sums of the paths below, of those below them, and so on: as many rounds as light segments lie on the way from a leaf to the root
    level = materialize(placed.groupBy(F.col("head").alias("path")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    totals = level
    while True:
        level = materialize(level.join(above.withColumnRenamed("path", "_p"), F.col("path") == F.col("_p")).groupBy(F.col("parent").alias("path")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
        if level.isEmpty():
            break
        totals = totals.unionByName(level)
    totals = totals.groupBy("path").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    attached = totals.join(above.withColumnRenamed("path", "_p"), F.col("path") == F.col("_p")).groupBy(F.col("up").alias("_u")).agg(F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
    zero = F.lit(0).cast("long")
    arrays = placed.join(attached, F.col("seg") == F.col("_u"), "left").select("seg", "head", "top", (F.col("leaves") + F.coalesce("_leaves", zero)).alias("leaves"), (F.col("saved") + F.coalesce("_saved", zero)).alias("saved"))
    summed = running_sums(arrays, "head", [F.col("top").desc()], [Running("n_leaves", "leaves", "_l"), Running("total", "saved", "_t")], ["seg"])
    return summed.select("seg", "n_leaves", "total")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """turns(conv_id, turn, role, text) -> (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), a row for
    each node of the trie of rebuilt conversations; see the module for the defined cases."""
    steps, ends = _rebuilt(turns)
    steps = _named(_named(steps, _P, "k1", "k2"), _Q, "j1", "j2")
    nodes = steps.groupBy("k1", "k2", "depth").agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), *(F.first(c).alias(c) for c in ("j1", "j2", "bytes", "upto")))
    zero = F.lit(0).cast("long")
    root = ends.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("k1"), zero.alias("k2"), zero.alias("depth"), "conv_id", "n_convs", *(F.lit(None).cast("long").alias(c) for c in ("j1", "j2")), zero.alias("bytes"), zero.alias("upto"))
    nodes = materialize(nodes.unionByName(root))

    segments = nodes.groupBy("conv_id", "n_convs").agg(
        F.min_by(F.struct("depth", "j1", "j2", (F.col("upto") - F.col("bytes")).alias("ahead")), "depth").alias("a"), F.max_by(F.struct("depth", "k1", "k2", "upto"), "depth").alias("z")
    )
    segments = segments.select("conv_id", "n_convs", F.col("a.depth").alias("top"), "a.j1", "a.j2", "a.ahead", F.col("z.depth").alias("bottom"), "z.k1", "z.k2", "z.upto")
    segments = materialize(segments.withColumn("seg", F.monotonically_increasing_id()))
    above = segments.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("bottom").alias("_d"), F.col("seg").alias("up"), F.col("conv_id").alias("up_conv"))
    linked = segments.join(above, (F.col("j1") == F.col("_k1")) & (F.col("j2") == F.col("_k2")) & (F.col("top") - 1 == F.col("_d")), "left").drop("_k1", "_k2", "_d", "j1", "j2")
    linked = materialize(linked)
    below = linked.where("up is not null").groupBy(F.col("up").alias("_up")).agg(F.count("*").alias("n_below"))
    digests = _id_digests(_named(ends, _P, "k1", "k2")).withColumnsRenamed({"k1": "_k1", "k2": "_k2", "depth": "_d"})
    linked = linked.join(below, F.col("seg") == F.col("_up"), "left").join(digests, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")) & (F.col("bottom") == F.col("_d")), "left")
    linked = materialize(linked.select("seg", "up", "up_conv", "conv_id", "n_convs", "top", "bottom", "ahead", "upto", F.coalesce("n_below", zero).alias("n_below"), F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")))

    weights = linked.select("seg", "up", "top", "conv_id", "n_convs", F.when(F.col("n_below") == 0, 1).otherwise(0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * (F.col("upto") - F.col("ahead"))).alias("saved"))
    summed = linked.join(_subtree_sums(weights).withColumnRenamed("seg", "_s"), F.col("seg") == F.col("_s"))
    summed = summed.select(F.col("conv_id").alias("_c"), F.col("n_convs").alias("_n"), "up_conv", "top", "bottom", "ahead", "n_below", "ends_sha256", "n_leaves", "total")
    at_top, at_bottom = F.col("depth") == F.col("top"), F.col("depth") == F.col("bottom")
    return nodes.join(summed, (F.col("conv_id") == F.col("_c")) & (F.col("n_convs") == F.col("_n"))).select(
        "conv_id", "depth", F.when(at_top, F.col("up_conv")).otherwise(F.col("conv_id")).alias("parent_conv_id"), "n_convs", F.when(at_bottom, F.col("n_below")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        "n_leaves", (F.col("total") - (F.col("n_convs") - 1) * (F.col("upto") - F.col("bytes") - F.col("ahead"))).alias("saved_tokens"), F.when(at_bottom, F.col("ends_sha256")).otherwise(F.lit(NOTHING)).alias("ends_sha256"),
    )
