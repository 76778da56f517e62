"""Document fingerprints from prefix polynomial hashes.

`Prefixes` holds, for a block of code points, the sums c0 + c1 b + c2 b^2 + ... modulo a prime for every prefix and two
bases. The hash of any span is a difference of two of them, shifted to exponent zero, so spans of different texts compare
in constant time and the longest common extension of two positions is a binary search. A fingerprint keeps, for each of
128 classes of span hashes, the least hash of the text's spans of 12 code points; likeness is the share of equal
classes. The edited text's spans are those of its two parts and the few that cross the seam.

Order of documents: ascending doc_id, a null doc_id before all others, equal ones by text. Null text is empty. A text
shorter than a span is a span itself; an empty text has an empty fingerprint, which is like another empty one (1.0) and
unlike all others (0.0). The successor of the last document is the first, so a single one succeeds itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRIME = np.uint64((1 << 31) - 1)
BASES = (1_000_003, 1_234_577_891)
BITS = np.uint64(31)
SHIFT = np.uint64(2) * PRIME
SPAN = 12
CLASSES = 128
BLOCK = 1 << 18
NONE = np.uint64((1 << 64) - 1)


def _step(x: np.ndarray) -> np.ndarray:
    """A number congruent modulo 2^31 - 1, a little above 2^31 at most for x below 2^52."""
    low = x & PRIME
    x >>= BITS
    x += low
    return x


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo 2^31 - 1 for any x; x is overwritten."""
    x = _step(_step(x))
    x -= PRIME * (x >= PRIME)
    return x


def _powers(base: int, count: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    step = base
    while len(out) < count:
        out = np.concatenate([out, _mod(out * np.uint64(step))])
        step = step * step % int(PRIME)
    return out[:count]


POWERS = [_powers(b, BLOCK + 2 * SPAN) for b in BASES]
INVERSE = [_powers(pow(b, -1, int(PRIME)), BLOCK + 2 * SPAN) for b in BASES]


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Prefixes:
    """Prefix hashes of a block of code points."""

    def __init__(self, points: np.ndarray):
        self.n = len(points)
        self.sums = []
        values = points.astype(np.uint64)
        values += np.uint64(1)
        for power in POWERS:
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(_step(values * power[:self.n]), out=sums[1:])
            self.sums.append(_step(sums))

    def spans(self, width: int) -> np.ndarray:
        """Hash of every span of that width, as one number of 62 bits."""
        if self.n < width:
            return np.zeros(0, np.uint64)
        count = self.n - width + 1
        first, second = (_mod((s[width:] - s[:count] + SHIFT) * inverse[:count]) for s, inverse in zip(self.sums, INVERSE, strict=True))
        return first << BITS | second

    def span(self, start: int, end: int) -> tuple[int, ...]:
        return tuple((int(s[end]) - int(s[start])) * int(i[start]) % int(PRIME) for s, i in zip(self.sums, INVERSE, strict=True))


def common_extension(a: Prefixes, i: int, b: Prefixes, j: int) -> int:
    """Number of equal code points from position i of a and j of b on."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        middle = (low + high + 1) // 2
        if a.span(i, i + middle) == b.span(j, j + middle):
            low = middle
        else:
            high = middle - 1
    return low


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


EDGES = (np.arange(CLASSES, dtype=np.uint64) << np.uint64(57))


def _least(hashes: list[np.ndarray]) -> np.ndarray:
    """Least hash of each class (the leading seven bits)."""
    ordered = np.sort(np.concatenate(hashes))
    at = np.searchsorted(ordered, EDGES)
    found = ordered[np.minimum(at, len(ordered) - 1)] if len(ordered) else np.full(CLASSES, NONE)
    found = np.where((at < len(ordered)) & (found >> np.uint64(57) == EDGES >> np.uint64(57)), found, NONE)
    return found


class Document:
    """Prefix hashes, span hashes and fingerprint of one text, block by block."""

    def __init__(self, text: str):
        self.text = text
        self.points = codes(text)
        self.first = self._block(0)
        self.hashes = [_mixed((self._block(at) if at else self.first).spans(SPAN)) for at in range(0, max(1, len(self.points)), BLOCK)]
        self.fingerprint = fingerprint(self.points, len(self.points), self.hashes)

    def _block(self, at: int) -> Prefixes:
        return Prefixes(self.points[at:at + BLOCK + SPAN - 1])

    def block(self, at: int) -> Prefixes:
        return self._block(at) if at else self.first

    def within(self, count: int) -> list[np.ndarray]:
        """Hashes of the spans inside the first `count` code points."""
        return [h[:max(0, count - at * BLOCK - SPAN + 1)] for at, h in enumerate(self.hashes) if count - at * BLOCK >= SPAN]


def fingerprint(points: np.ndarray, count: int, hashes: list[np.ndarray]) -> np.ndarray:
    """Class minima, 16 bits each behind the class bits; 0 marks a class without spans."""
    if 0 < count < SPAN:
        hashes = [_mixed(np.array([(x := Prefixes(points).span(0, count))[0] << 31 | x[1]], np.uint64))]
    least = _least(hashes or [np.zeros(0, np.uint64)])
    return np.where(least == NONE, 0, (least >> np.uint64(41)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    used = (a != 0) | (b != 0)
    return float(((a == b) & used).sum() / used.sum()) if used.any() else 1.0


def common_prefix(a: Document, b: Document) -> int:
    for at in range(0, min(len(a.points), len(b.points)), BLOCK):
        here = common_extension(a.block(at), 0, b.block(at), 0)
        if here < BLOCK:
            return at + here
    return min(len(a.points), len(b.points))


def edited(own: Document, other: Document) -> tuple[str, np.ndarray]:
    """own's text with its last half replaced by the beginning of other's, and its fingerprint."""
    n = len(own.points)
    cut = n // 2
    keep, take = n - cut, min(cut, len(other.points))
    seam = np.concatenate([own.points[max(0, keep - SPAN + 1):keep], other.points[:min(take, SPAN - 1)]])
    count = keep + take
    if count < SPAN:
        mark = fingerprint(np.concatenate([own.points[:keep], other.points[:take]]), count, [])
    else:
        mark = fingerprint(seam, count, [*own.within(keep), *other.within(take), _mixed(Prefixes(seam).spans(SPAN))])
    return own.text[:keep] + other.text[:take], mark


OUTPUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, common_prefix_next long")


def _described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of some ranges in, one row per own document out; the row after the last own one is only a successor."""
    held: tuple | None = None
    for batch in batches:
        rows: list[tuple] = []
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            for target, appended, doc_id, text in zip(*(part.column(c).to_pylist() for c in ("target", "appended", "doc_id", "text")), strict=True):
                if appended and (held is None or held[0] != target or held[1]):
                    continue
                document = Document(text or "")
                if held and held[0] == target:
                    own = held[3]
                    whole, mark = edited(own, document)
                    rows.append((held[2], len(own.points), hashlib.sha256(whole.encode()).hexdigest(), own.fingerprint.tobytes().hex(),
                                 mark.tobytes().hex(), likeness(own.fingerprint, mark), likeness(own.fingerprint, document.fingerprint),
                                 common_prefix(own, document)))
                held = (target, appended, doc_id, document)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)], NAMES)


NAMES = [c.split()[0] for c in OUTPUT.split(", ")]
TYPES = [{"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[c.split()[1]] for c in OUTPUT.split(", ")]
LOWEST = -(1 << 63)


def fingerprints(documents: DataFrame, rows_per_range: int = 4096, most_ranges: int = 20_000) -> DataFrame:
    """Fingerprint of every text, of its edited text, and its likeness to both the edited text and the next document.

    Documents are dealt into ranges of doc_id by quantiles (one pass over doc_id). The first document of each range is
    also sent to the range before it, so each range knows every successor: texts are shuffled once, and no task sees
    more than its ranges.
    """
    spark = documents.sparkSession
    own = documents.select("doc_id", "text", F.coalesce("doc_id", F.lit(LOWEST)).alias("place"))
    count = own.count()
    if not count:
        return spark.createDataFrame([], OUTPUT)
    ranges = min(most_ranges, -(-count // rows_per_range))
    cuts = sorted(set(own.select("doc_id").approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.1 / ranges))) if ranges > 1 else []
    bounds = np.array(cuts, np.int64)

    @F.pandas_udf("int")
    def rank(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, place.to_numpy(), "right").astype(np.int32))

    dealt = own.withColumn("target", rank("place"))
    firsts = sorted((r.target, r.place) for r in dealt.groupBy("target").agg(F.min("place").alias("place")).collect())
    successors = spark.createDataFrame([(place, firsts[i - 1][0]) for i, (_, place) in enumerate(firsts)], "place long, before int")
    parts = F.array(F.struct(F.col("target"), F.lit(0).alias("appended")), F.struct(F.col("before").alias("target"), F.lit(1).alias("appended")))
    every = (dealt.join(F.broadcast(successors), "place", "left")
             .select("place", "doc_id", "text", F.explode(F.when(F.col("before").isNull(), F.slice(parts, 1, 1)).otherwise(parts)).alias("to"))
             .select("to.*", "place", "doc_id", "text"))
    ordered = every.repartition(len(firsts), "target").sortWithinPartitions("target", "appended", "place", "text")
    return ordered.select("target", "appended", "doc_id", "text").mapInArrow(_described, OUTPUT)
