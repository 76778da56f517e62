"""Exact n-gram Jaccard join by universe partitions and the pigeonhole principle.

Sets of five-word shingles with similarity of 0.75 or more and sizes a <= b differ in at most (a + b) / 7 elements. Sets
are banded by size (powers of two). Each band cuts the universe of shingles into segments by hash; a set shows one
signature per segment that is not empty, in its own band and, if large enough to be the smaller partner there, in the
next. Two sets that differ in at most H elements agree in at least one of any H + 1 segments (a segment searched with
its one-deletion neighbourhood counts twice). That gives, in turn:

1. A set with H + 1 signatures that no other set has, in each of its bands, has no partner (`live` sets remain).
2. Members of a bucket (one signature) are held against its least member: those links alone make most components. Then
   buckets are dealt into cells of a few members, and what a set meets there most often, in another component, is
   looked at: sets of one large group find its component without meeting all of it. Rounds go on while they pay.
3. What is left is paid for by cost: a segment whose bucket has no member of a larger component is free; then come, by
   price, other buckets and second, one-deletion searches of free segments. Only sets of different components are
   paired, and of two components the smaller one searches.
4. A set has a centre, the set that shares most with those it meets. Sets of one centre are not paired by bucket: each is
   known by the elements in which it differs from the centre, and two that link must share so many of these that they meet
   among their rarest ones (`beside`).

All pairs found are verified on their whole sets. Equal sets are one node throughout, so copies are never paired. A
component names its smallest doc_id.

Words: A-Z in lower case, cut at ASCII white space. Fewer than five words are one shingle; a text without words, or null,
is an empty set and linked with nothing. Rows of one doc_id count as one document for reachability and give a row each;
a null doc_id takes part in links, and its component is named by the smallest other doc_id, or null. Shingles and sets are
known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sundial.llm.arrays import STEP, by_text, mixed, shingles, words
from sundial.llm.components import components
from sundial.llm.shared import SENT_ROWS, bounded, discard, lean, pieces, saved, text_slices

ROWS_PER_TASK = 1_000_000
FLUSH = 1 << 19
#: Dealt rounds: members of a cell, partners that a set looks at in a round, and the part of the asking sets that must find one for another round.
CELL, LOOKS, PAYS = 8, 3, 0.05


def band(n: int) -> int:
    """The band of a set: 2^(k - 1) < n <= 2^k."""
    return max(1, (n - 1).bit_length())


def bands(n: int) -> list[int]:
    """The own band, and the next one if a set in it can be a partner."""
    k = band(n)
    return [k, k + 1] if 4 * n >= 3 * ((1 << k) + 1) else [k]


def most_apart(n: int, k: int) -> int:
    """Elements in which a set of n and a partner in band k, at least as large or in the same band, can differ."""
    largest = min(1 << k, 4 * n // 3)
    return (n + largest) // 7


def segment_count(k: int) -> int:
    """Segments of a band. Short sets get so many that most segments hold one element: they have few, and each counts."""
    return 4 << k if k <= 8 else (1 << k) * 34 // 100 + 64


def segments(own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment of every element in band k, the elements' terms, and the sum of terms of every segment."""
    salted = mixed(own + np.uint64(k * int(STEP) % (1 << 64)))
    count = segment_count(k)
    at = ((salted >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)
    sums = np.zeros(count, np.uint64)
    np.add.at(sums, at, salted)
    return at, salted, sums


def named(sums: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Signatures of segments by the sum of their terms."""
    return mixed(sums + (at.astype(np.uint64) * np.uint64(64) + np.uint64(k)) * STEP)


def signatures(own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Signature and size of each segment that is not empty."""
    at, _, sums = segments(own, k)
    sizes = np.bincount(at, minlength=len(sums))
    held = np.flatnonzero(sizes)
    return named(sums[held], held, k), sizes[held]


def deletions(own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each element in a segment of two or more: the signature of the segment, and that of the segment without it."""
    at, terms, sums = segments(own, k)
    many = np.bincount(at, minlength=len(sums))[at] > 1
    at, terms = at[many], terms[many]
    return named(sums[at], at, k), named(sums[at] - terms, at, k)


def node(own: np.ndarray) -> int:
    """Name of a set: the same for equal sets, even, not 0 unless empty."""
    if not len(own):
        return 0
    total = np.add.reduce(mixed(own ^ STEP)) + np.uint64(len(own))
    return int(mixed(np.array([total])).view(np.int64)[0]) & ~1 or 2


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    for first, last, data, offsets in text_slices(batch, "text"):
        hashes, start, _ = words(data, offsets)
        yield first, last, shingles(hashes, by_text(start, offsets))


def described(documents: DataFrame) -> DataFrame:
    """doc_id, node, n_shingles and the number of signatures in its bands, for every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, sets in _sets(batch):
                counts = [[len(signatures(s, k)[0]) for k in bands(len(s))] if len(s) else [0] for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first), pa.array([node(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([c[0] for c in counts], pa.int32()), pa.array([c[1] if len(c) > 1 else None for c in counts], pa.int32())],
                    ["doc_id", "node", "n_shingles", "own", "next"])

    return documents.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, node long, n_shingles long, own int, next int")


def packed_by_part(held: list[np.ndarray], owners: list[int], parts: int) -> pa.RecordBatch:
    """A row for each part: its signatures, 6 bytes each, and their owners, 8 bytes each. held (emptied): the signatures of each owner."""
    sizes = [len(h) for h in held]
    sig = np.concatenate(held)
    held.clear()
    part = _part(sig, parts).astype(np.uint16)
    counts = np.bincount(part, minlength=parts)
    order = np.argsort(part, kind="stable").astype(np.int32)
    own = np.flatnonzero(counts)
    ends = np.concatenate([[0], np.cumsum(counts[own])])
    short = np.ascontiguousarray(sig[order].view(np.uint8).reshape(-1, 8)[:, :6])
    del sig, part
    owner = np.repeat(np.array(owners, np.int64), sizes)[order]
    binary = lambda data, width: pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer((width * ends).astype(np.int32)), pa.py_buffer(data)])
    return pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), binary(short, 6), binary(owner, 8)], ["part", "sigs", "nodes"])


def _sent(held: list[np.ndarray], owners: list[int], parts: int) -> Iterator[pa.RecordBatch]:
    count = sum(map(len, held))
    whole = packed_by_part(held, owners, parts)
    return pieces(whole, max(1, whole.num_rows * SENT_ROWS // count))


def _blobs(documents: DataFrame, parts: int) -> DataFrame:
    """Signatures of all sets, packed by the part they belong to: 48 bits of signature, and the node with bit 0 set for the next band."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        owners: list[int] = []
        count = 0
        for batch in batches:
            for _, _, sets in _sets(batch):
                for own in sets:
                    name = node(own)
                    if name in seen or not name:
                        continue
                    seen.add(name)
                    for i, k in enumerate(bands(len(own))):
                        sig, _ = signatures(own, k)
                        held.append(sig)
                        owners.append(name | i)
                        count += len(sig)
                if count >= FLUSH:
                    yield from _sent(held, owners, parts)
                    owners, count = [], 0
        if held:
            yield from _sent(held, owners, parts)

    return documents.select("text").mapInArrow(lean(run), "part int, sigs binary, nodes binary")


def _shared(blobs: DataFrame, parts: int) -> DataFrame:
    """Signatures that two or more nodes have: sig, node, next (shown in its next band)."""

    def found(part: int, sigs: list[bytes], nodes: list[bytes]) -> pa.RecordBatch:
        packed = np.zeros((sum(map(len, sigs)) // 6, 8), np.uint8)
        packed[:, :6] = np.frombuffer(b"".join(sigs), np.uint8).reshape(-1, 6)
        sig, owner = packed.view(np.uint64).ravel(), np.frombuffer(b"".join(nodes), np.int64)
        order = np.argsort(sig, kind="stable")
        ordered = sig[order]
        same = ordered[1:] == ordered[:-1]
        del ordered
        order = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])] if len(order) else order
        sig, owner = sig[order], owner[order]
        order = np.lexsort((owner, sig))
        sig, owner = sig[order], owner[order]
        new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (owner[1:] != owner[:-1])]) if len(sig) else np.zeros(0, bool)
        sig, owner = sig[new], owner[new]
        same = sig[1:] == sig[:-1]
        many = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(sig) else np.zeros(0, bool)
        sig, owner = (sig[many] | np.uint64(part << 48)).view(np.int64), owner[many]
        return pa.RecordBatch.from_arrays([pa.array(sig), pa.array(owner & ~1), pa.array((owner & 1).astype(bool))], ["sig", "node", "next"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sigs, nodes = -1, [], []
        for batch in batches:
            for p, s, n in zip(*(batch.column(c).to_pylist() for c in ("part", "sigs", "nodes")), strict=True):
                if p != part and sigs:
                    yield from pieces(found(part, sigs, nodes))
                    sigs, nodes = [], []
                part = p
                sigs.append(s)
                nodes.append(n)
        if sigs:
            yield from pieces(found(part, sigs, nodes))

    return blobs.repartitionById(parts, "part").mapInArrow(lean(run), "sig long, node long, next boolean")


def whole_sets(documents: DataFrame) -> DataFrame:
    """node and set (sorted hashes as bytes) of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, sets in _sets(batch):
                yield pa.RecordBatch.from_arrays([pa.array([node(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "members"])

    return documents.select("text").mapInArrow(lean(run), "node long, members binary")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes with 100 * intersection >= 75 * union."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                good.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    joined = (pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("x")), "a")
              .join(sets.select(F.col("node").alias("b"), F.col("members").alias("y")), "b"))
    return joined.select("a", "b", "x", "y").mapInArrow(lean(run), "a long, b long")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct()


def _searched(sets: DataFrame, parts: int, removing: bool) -> DataFrame:
    """sig, without, node and next of the segments of all bands.

    removing: a row for each element of the segments of two and more, `without` being the signature less that element;
    else a row for each segment.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, members in zip(batch.column("node").to_pylist(), batch.column("members").to_pylist(), strict=True):
                own = np.frombuffer(members, np.uint64)
                for i, k in enumerate(bands(len(own))):
                    sig, without = deletions(own, k) if removing else signatures(own, k)
                    columns = [_packed(sig, parts), _packed(without, parts) if removing else without, np.full(len(sig), name, np.int64)]
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array(np.full(len(sig), bool(i)))], ["sig", "without", "node", "next"])

    return sets.select("node", "members").mapInArrow(lean(run), "sig long, without long, node long, next boolean")


def _part(sig: np.ndarray, parts: int) -> np.ndarray:
    return (sig >> np.uint64(48)) * np.uint64(parts) >> np.uint64(16)


def _packed(sig: np.ndarray, parts: int) -> np.ndarray:
    """The form in which signatures are kept: 48 bits, and the part above them."""
    return (sig & np.uint64((1 << 48) - 1) | _part(sig, parts) << np.uint64(48)).view(np.int64)


def dealt(near: DataFrame, roots: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of different components for a round of looks, as many as `LOOKS` for a set b.

    Members of a bucket go to cells of about `CELL` by a hash that differs by bucket and round, so no bucket is gathered; each is
    held against the member of its cell with the largest component, and those met in most buckets are taken.
    """
    weight = roots.groupBy("root").agg(F.count("*").alias("weight"))
    rooted = bounded(saved(roots.join(weight, "root"), "dealt-roots"))
    own = F.struct(F.coalesce("weight", F.lit(1)).alias("weight"), F.xxhash64("node", F.lit(turn)).alias("draw"), F.coalesce("root", "node").alias("root"), "node")
    cell = F.pmod(F.xxhash64("sig", "node", F.lit(turn)), F.ceil(F.col("times") / CELL)).alias("cell")
    cells = near.join(rooted, "node", "left").select("sig", cell, own.alias("own")).groupBy("sig", "cell").agg(F.collect_list("own").alias("members"))
    met = (cells.where(F.size("members") > 1).select(F.array_max("members").alias("top"), F.explode("members").alias("own")).where("own.root != top.root")
           .groupBy(F.col("own.node").alias("b"), F.col("top.node").alias("a")).agg(F.count("*").alias("n")))
    turns = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("n"), "a"))  # as many rows as the set has segments, at most
    return met.withColumn("turn", turns).where(F.col("turn") <= LOOKS).select("a", "b")


def central(near: DataFrame) -> DataFrame:
    """node and centre, written: of the sets that have most in common with others in each bucket of a node, the one met most often."""
    scores = saved(near.groupBy("node").agg(F.sum("times").alias("score")), "scores")
    top = near.join(bounded(scores), "node").groupBy("sig").agg(F.max(F.struct("score", "node"))["node"].alias("centre"))
    met = near.join(top, "sig").groupBy("node", "centre").agg(F.count("*").alias("n"))
    written = saved(met.groupBy("node").agg(F.max(F.struct("n", "centre"))["centre"].alias("centre")), "centres")
    discard(scores)
    return written


def from_centre(centres: DataFrame, sets: DataFrame) -> DataFrame:
    """node, centre, their sizes n and m, and the elements that one of them lacks, for nodes that are not their own centre."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [[np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(c)] for c in ("x", "y")]
            apart = [np.setxor1d(x, y, assume_unique=True).view(np.int64) for x, y in zip(*own, strict=True)]
            counts = [pa.array([len(v) for v in side], pa.int64()) for side in own]
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("centre"), *counts, pa.array(apart, pa.list_(pa.int64()))], ["node", "centre", "n", "m", "apart"])

    joined = (centres.where("node != centre").join(sets.select("node", F.col("members").alias("x")), "node")
              .join(sets.select(F.col("node").alias("centre"), F.col("members").alias("y")), "centre"))
    return joined.select("node", "centre", "x", "y").mapInArrow(lean(run), "node long, centre long, n long, m long, apart array<long>")


def beside(differing: DataFrame, asking: DataFrame, rooted: DataFrame) -> DataFrame:
    """Pairs (a, b) of one centre, a of `asking` and b in a larger component, that may link.

    With u = 7 * elements apart - size, two sets link only if they share t >= (u + u) / 14 of the elements apart, so they have one in
    common among the first (elements - t + 1) of each, the rarest first. Where t is 0 both are linked with the centre itself.
    """
    known = differing.join(rooted, "node").join(asking.withColumn("asks", F.lit(True)), "node", "left").select(
        "node", "centre", "root", "weight", F.col("asks").isNotNull().alias("asks"), F.size("apart").alias("gap"), (7 * F.size("apart") - F.col("n")).alias("u"), "apart")
    least = known.groupBy("centre").agg(F.min("u").alias("any"), F.min(F.when(F.col("asks"), F.col("u"))).alias("asking")).where("asking IS NOT NULL")
    first = lambda other: F.col("gap") + 1 - F.greatest(F.lit(1), F.ceil((F.col("u") + F.col(other)) / 14))
    rows = saved(known.join(least, "centre").select("node", "centre", "root", "weight", "gap", "u", F.when(F.col("asks"), first("any")).alias("as_a"), first("asking").alias("as_b"),
                                                    F.explode("apart").alias("element")), "apart")
    often = rows.groupBy("centre", "element").agg(F.count("*").alias("often"))
    turn = F.row_number().over(Window.partitionBy("node").orderBy("often", "element"))  # as many rows as the two sets have elements
    ranked = saved(rows.join(often, ["centre", "element"]).withColumn("turn", turn).where("often > 1 AND turn <= greatest(as_a, as_b)"), "ranked")
    side = lambda name: ranked.where(f"turn <= as_{name}").select("centre", "element", *[F.col(c).alias(f"{c}_{name}") for c in ("node", "root", "weight", "gap", "u")])
    larger = "(weight_b > weight_a OR weight_b = weight_a AND root_b < root_a) AND 14 * least(gap_a, gap_b) >= u_a + u_b"
    written = saved(side("a").join(side("b"), ["centre", "element"]).where(larger).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct(), "beside")
    discard(rows, ranked)
    return written


def residual(near: DataFrame, sets: DataFrame, roots: DataFrame, sizes: DataFrame, differing: DataFrame, parts: int) -> DataFrame:
    """Pairs of different components that the allocation of some set still has to look at, written.

    Of two components the smaller one searches (ties: that with the larger root), so a large one never pays for the
    strangers among its copies. near: signatures that two live sets share; roots: components so far; sizes: node, n and the
    number of signatures in the own and next band; differing: what sets have apart from their centres, with which they are linked.
    """
    weight = roots.groupBy("root").agg(F.count("*").alias("weight"))
    rooted = saved(sizes.select("node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).join(weight, "root", "left")
                   .select("node", "root", F.coalesce("weight", F.lit(1)).alias("weight")), "rooted")
    few = bounded(rooted)
    centres = bounded(saved(differing.select("node", "centre"), "centred"))
    placed = saved(near.join(few, "node").join(centres, "node", "left").withColumn("centre", F.coalesce("centre", "node")), "placed")
    by_root = placed.groupBy("sig", "root", "weight").agg(F.count("*").alias("n"))
    above = Window.partitionBy("sig").orderBy(F.desc("weight"), "root").rowsBetween(Window.unboundedPreceding, -1)  # a row per component
    by_root = saved(by_root.withColumn("cost", F.coalesce(F.sum("n").over(above), F.lit(0))), "by-root")
    costly = saved(placed.drop("centre").join(by_root.where("cost > 0").select("sig", "root", "cost"), ["sig", "root"]), "costly")
    paid = costly.groupBy("node", "next").agg(F.count("*").alias("costly"))
    k = F.greatest(F.lit(1), F.ceil(F.log2(F.col("n").cast("double"))))
    schemes = sizes.select("node", F.explode(F.array(
        F.struct(F.lit(False).alias("next"), F.col("own").alias("held"), _most_apart(k).alias("apart")),
        F.struct(F.lit(True).alias("next"), F.col("next").alias("held"), _most_apart(k + 1).alias("apart")))).alias("s")).select("node", "s.*").where("held IS NOT NULL")
    short = saved(schemes.join(paid, ["node", "next"], "left").select(
        "node", "next", (F.col("apart") + 1 - (F.col("held") - F.coalesce("costly", F.lit(0)))).alias("short")).where("short > 0"), "short")
    units = costly.join(bounded(short), ["node", "next"]).select("node", "next", "sig", "short", F.lit(1).alias("search"), F.col("cost").alias("price"))
    if short.limit(1).count():
        units = units.unionByName(_second_searches(near, sets, costly, short, parts))
    turn = F.row_number().over(Window.partitionBy("node", "next").orderBy("price", "search", "sig"))  # as many rows as the set has segments, twice
    chosen = saved(units.withColumn("turn", turn).where("turn <= short").join(few, "node").select("node", "next", "sig", "search", F.col("root").alias("mine"), F.col("weight").alias("own_weight")), "chosen")
    given = chosen.groupBy("node", "next").agg(F.count("*").alias("given"))
    if short.join(given, ["node", "next"], "left").where("short > coalesce(given, 0)").limit(1).count():
        raise ArithmeticError("a set has too few segments for the pigeonhole principle; use more segments in its band")
    used = [rooted, placed, by_root, costly, short, chosen]
    searches = lambda n: bounded(chosen.where(F.col("search") == n).select("sig", F.col("node").alias("a"), "mine", "own_weight"))
    higher = (F.col("weight") > F.col("own_weight")) | ((F.col("weight") == F.col("own_weight")) & (F.col("root") < F.col("mine")))
    asking = chosen.where("search = 1").join(centres, "node", "left").select("sig", F.col("node").alias("a"), "mine", "own_weight", F.coalesce("centre", "node").alias("own_centre"))
    asking = saved(asking, "asking")
    askers = saved(chosen.where("search = 1").select("node").distinct(), "askers")
    pairs = (placed.select("sig", "root", "weight", "centre").distinct().join(bounded(asking), "sig").where(higher & (F.col("centre") != F.col("own_centre")))
             .join(placed.select("sig", "root", "centre", F.col("node").alias("b")), ["sig", "root", "centre"]).select("a", "b"))
    one_centre = beside(differing, bounded(askers), few)
    pairs = pairs.unionByName(one_centre)
    used += [asking, askers, one_centre, centres]
    if chosen.where("search = 2").limit(1).count():
        again = searches(2)
        probing = saved(_searched(sets.join(bounded(short.select("node").distinct()), "node", "left_semi"), parts, True).withColumnRenamed("node", "a")
                        .join(again, ["sig", "a"]).select(F.col("without").alias("sig"), "a", "mine", "own_weight"), "probing")
        known = lambda df: df.join(few, "node").where(higher).select("a", F.col("node").alias("b"))
        less = known(_searched(sets, parts, False).select("sig", "node").join(bounded(probing), "sig"))
        more = known(_searched(sets, parts, True).select(F.col("without").alias("sig"), "node").join(again, "sig"))
        pairs = pairs.unionByName(less).unionByName(more)
        used.append(probing)
    written = saved(_ordered(pairs), "residual")
    discard(*used)
    return written


def _most_apart(k):
    """`most_apart` for the column n."""
    return F.floor((F.col("n") + F.least(F.pow(F.lit(2.0), k), F.floor(4 * F.col("n") / 3))) / 7)


def _second_searches(near: DataFrame, sets: DataFrame, costly: DataFrame, short: DataFrame, parts: int) -> DataFrame:
    """Free segments of two and more elements that may be searched with one deletion, at the price of the buckets met."""
    removed = (_searched(sets.join(bounded(short.select("node").distinct()), "node", "left_semi"), parts, True)
               .join(bounded(short), ["node", "next"]).join(costly.select("sig", "node"), ["sig", "node"], "left_anti"))
    met = near.groupBy(F.col("sig").alias("without")).agg(F.count("*").alias("n"))
    return removed.join(met, "without", "left").groupBy("node", "next", "sig", "short").agg((F.sum(F.coalesce("n", F.lit(0))) + 1).alias("price")).select(
        "node", "next", "sig", "short", F.lit(2).alias("search"), "price")


def join(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    rows = saved(described(documents), "described")
    nodes = saved(rows.where("n_shingles > 0").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("own").alias("own"), F.first("next").alias("next")), "nodes")
    total = rows.agg(F.sum(F.col("own") + F.coalesce("next", F.lit(0)))).first()[0] or 0
    parts = min(1 << 16, max(1, -(-int(total) // ROWS_PER_TASK)))
    shared = saved(_shared(_blobs(documents, parts), parts), "shared")
    links = _links(documents, nodes, shared, parts)
    roots = saved(components(links), "roots")
    named_nodes = nodes.select("node", F.col("doc_id").alias("least_id")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named_nodes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = named_nodes.join(least, "root").select("node", "component_id")
    return (rows.join(classes, "node", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def _links(documents: DataFrame, nodes: DataFrame, shared: DataFrame, parts: int) -> DataFrame:
    """Links (a, b) that make the components; `shared` and what is written on the way is deleted once it is read."""
    met = shared.groupBy("node").agg(F.sum(F.expr("IF(next, 0, 1)")).alias("met_own"), F.sum(F.expr("IF(next, 1, 0)")).alias("met_next"))
    k = F.greatest(F.lit(1), F.ceil(F.log2(F.col("n").cast("double"))))
    lone = (F.col("own") - F.col("met_own") > _most_apart(k)) & (F.col("next").isNull() | (F.col("next") - F.col("met_next") > _most_apart(k + 1)))
    live = saved(nodes.join(met, "node", "left").fillna(0, ["met_own", "met_next"]).where(~lone).select("node", "n", "own", "next", "doc_id"), "live")
    ids = bounded(live.select(F.col("doc_id").alias("id")))
    texts = documents.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    sets = saved(whole_sets(texts).join(bounded(live.select("node")), "node", "left_semi").dropDuplicates(["node"]), "sets")
    near = shared.join(bounded(live.select("node")), "node", "left_semi")
    least = near.groupBy("sig").agg(F.min("node").alias("least"), F.count("*").alias("times")).where("times > 1")
    near = saved(near.join(least, "sig").select("sig", "node", "next", "least", "times"), "near")
    discard(shared)
    stars = near.where("node != least").groupBy(F.col("node").alias("b"), F.col("least").alias("a")).agg(F.count("*").alias("n"))
    best = stars.groupBy("b").agg(F.max_by("a", "n").alias("a"))
    links = saved(verified(best.select("a", "b"), sets), "star-links")
    used, turn = [links], 0
    while True:
        roots = saved(components(links), "star-roots")
        discard(*used)
        looks = saved(dealt(near, roots, turn), "looks")
        found = saved(verified(looks, sets), "look-links")
        asking, finding = looks.select("b").distinct().count(), found.select("b").distinct().count()
        links = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(found)
        discard(looks)
        used = [roots, found]
        if finding <= PAYS * asking:
            break
        turn += 1
    centres = central(near)
    differing = saved(from_centre(centres, sets), "differing")
    discard(centres)
    close = differing.where("7 * size(apart) <= n + m").select(F.col("node").alias("a"), F.col("centre").alias("b"))
    links = saved(links.unionByName(close), "dealt-links")
    discard(*used)
    roots = saved(components(links), "dealt-components")
    pairs = residual(near.select("sig", "node", "next"), sets, roots, live.select("node", "n", "own", "next"), differing, parts)
    last = saved(verified(pairs, sets), "residual-links")
    discard(near, pairs, sets, live, roots, differing)
    return links.unionByName(last)
