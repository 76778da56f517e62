"""Hard negatives: for every anchor and positive, the best rows of other labels whose score lies in a window of the positive's.

Vectors are whole numbers and scores exact inner products. Every row stores its angles to some reference directions. For an anchor
at angle a and a row at angle b of the same direction, their own angle lies between |a - b| and a + b, so their cosine lies between
cos(a + b) and cos(a - b); times both norms and rounded outwards, the tightest pair over all directions bounds the score. Only rows
whose bounds meet a window that an anchor still looks at are scored.

Anchors are a stated set of queries, held against all rows in blocks. Tasks own chunks of rows and read the anchors, block after
block, from a table in the shared folder; of each chunk only the best few per window leave the task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sundial.llm.shared import discard, saved

SCALE = 256
REFERENCES = 16
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these percentages of the positive's.
WINDOW = (30, 90)
#: One row in so many is scored first: what the best of them reach, others must reach too.
PILOT = 32
CHUNK, ROW_BLOCK, ANCHOR_BLOCK = 131_072, 8_192, 64
ANCHORS_A_FILE = 65_536
#: Sums of products below this are exact in doubles.
EXACT = float(1 << 53)


def usable(vectors: DataFrame, anchor: Column, label: Column) -> DataFrame:
    """Rows that take part: vec_id, label, q (whole components) and anchor (boolean).

    Without a label, a vector or an id, or with a component that is null or not finite, a row takes no part. Rows of one id count
    once: of several, the least (label, q). Vectors of different lengths are compared as if the shorter one ended in zeros.
    """
    x = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull()).where(finite).select(
        "vec_id", label.cast("long").alias("label"), F.transform(x, lambda v: F.floor(v * SCALE)).alias("q"), F.coalesce(anchor, F.lit(False)).alias("anchor")).where("label IS NOT NULL")
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "q", "anchor")).alias("r")).select("vec_id", "r.*")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows, ended with zeros."""
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), flat.dtype if len(flat) else np.float64)
    out[np.arange(width)[None, :] < offsets[:, None]] = flat
    return out


def with_angles(rows: DataFrame, references: np.ndarray, width: int) -> DataFrame:
    """Adds norm and angles to the reference directions; a zero vector is at right angles to all."""
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields), "norm double, angles array<double>"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch.column("q"), width).astype(float)
            norm = np.sqrt((q * q).sum(1))
            cosine = q @ references.T / np.where(norm > 0, norm, 1.0)[:, None]
            angles = np.arccos(np.clip(cosine, -1.0, 1.0))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, angles.size + 1, max(1, angles.shape[1]), dtype=np.int32) if angles.shape[1] else np.zeros(len(q) + 1, np.int32)), pa.array(angles.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norm), lists], [*batch.schema.names, "norm", "angles"])

    return rows.mapInArrow(run, schema)


def _scores(a: np.ndarray, b: np.ndarray, largest: float) -> np.ndarray:
    """Exact inner products: doubles while they are exact, then 64-bit integers, beyond them held to their limits."""
    if largest < EXACT:
        return a.astype(float) @ b.astype(float).T
    if largest < 2.0**62:
        return a @ b.T
    limits = np.iinfo(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, limits.min, limits.max).astype(np.int64)


class Side:
    """Columns of anchors or rows as arrays."""

    def __init__(self, batch: pa.RecordBatch | pa.Table, width: int):
        column = {n: c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for n, c in zip(batch.schema.names, batch.columns, strict=True)}
        self.id, self.label = column["vec_id"].to_numpy(), column["label"].to_numpy()
        self.norm = column["norm"].to_numpy()
        self.angles = _matrix(column["angles"], len(column["angles"][0]) if len(column["angles"]) else 0)
        self.q = _matrix(column["q"], width).astype(np.int64)
        # norm times cosine and sine of every angle: both cosine formulas are sums of two products
        self.along, self.across = self.norm[:, None] * np.cos(self.angles), self.norm[:, None] * np.sin(self.angles)
        if "low" in column:
            self.low, self.high = column["low"], column["high"]


def reachable(anchors: Side, rows: Side, a: slice, r: slice, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Rows of a block that, by their angles, may score between low and high of an anchor (a row of booleans per anchor)."""
    shape = anchors.norm[a][:, None] * rows.norm[r][None, :]
    upper, lower = shape.copy(), -shape
    for j in range(anchors.along.shape[1]):
        along = np.multiply.outer(anchors.along[a, j], rows.along[r, j])
        across = np.multiply.outer(anchors.across[a, j], rows.across[r, j])
        np.minimum(upper, along + across, out=upper)
        np.maximum(lower, along - across, out=lower)
    slack = 1.0 + 1e-9 * shape
    return (np.ceil(upper + slack) >= low[:, None]) & (np.floor(lower - slack) <= high[:, None])


def _best(anchor: np.ndarray, score: np.ndarray, row: np.ndarray, most: int) -> np.ndarray:
    """Of rows by anchor, the first `most` by score, ties by id: indices."""
    order = np.lexsort((row, -score, anchor))
    own = anchor[order]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
    place = np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))
    return order[place < most]


def search(anchors: Side, rows: Side, low: np.ndarray, high: np.ndarray, most: int, same: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per window w (columns of low and high): anchor indices, ids and scores of the best `most` rows of the same or other labels."""
    largest = float(anchors.norm.max(initial=0) * rows.norm.max(initial=0))
    low = low.astype(float)
    held = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)) for _ in range(low.shape[1])]
    every = slice(0, len(anchors.id))
    for start in range(0, len(rows.id), ROW_BLOCK):
        r = slice(start, min(start + ROW_BLOCK, len(rows.id)))
        allowed = (anchors.label[:, None] == rows.label[None, r]) == same
        if same:
            allowed &= anchors.id[:, None] != rows.id[None, r]
        if not allowed.any():
            continue
        allowed &= reachable(anchors, rows, every, r, low.min(1), high.max(1))
        some = np.flatnonzero(allowed.any(0))
        if not len(some):
            continue
        scores = _scores(anchors.q, rows.q[r][some], largest)
        allowed, ids = allowed[:, some], rows.id[r][some]
        for w in range(low.shape[1]):
            hit = allowed & (scores >= low[:, w][:, None]) & (scores <= high[:, w][:, None])
            if len(some) > most:  # no row below the `most`-th best of the block can be among the best
                ranked = np.where(hit, scores.astype(float), -np.inf)
                hit &= ranked >= np.partition(ranked, len(some) - most, axis=1)[:, len(some) - most][:, None]
            at, col = np.nonzero(hit)
            if not len(at):
                continue
            anchor, score, row = (np.concatenate(x) for x in zip(held[w], (at, scores[at, col], ids[col]), strict=True))
            keep = _best(anchor, score, row, most)
            held[w] = anchor[keep], score[keep], row[keep]
            full = np.bincount(held[w][0], minlength=len(anchors.id)) == most
            worst = np.full(len(anchors.id), np.inf)
            np.minimum.at(worst, held[w][0], held[w][1].astype(float))
            low[:, w] = np.where(full, np.maximum(low[:, w], worst), low[:, w])
    for w, (anchor, score, row) in enumerate(held):
        yield w, anchor, row, score


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches joined to chunks of at most about CHUNK rows."""
    kept, n = [], 0
    for batch in batches:
        kept.append(batch)
        n += len(batch)
        if n >= CHUNK:
            yield pa.Table.from_batches(kept)
            kept, n = [], 0
    if n:
        yield pa.Table.from_batches(kept)


def found_in(rows: DataFrame, anchors: DataFrame, width: int, most: int, same: bool) -> DataFrame:
    """anchor_id, w (window), vec_id, score: the best rows of every chunk for every window of every anchor.

    `anchors` is a written table with the columns of rows, low and high (arrays of window bounds).
    """
    folders = sorted({name.rsplit("/", 1)[0] for name in anchors.inputFiles()})
    columns = ["vec_id", "label", "q", "norm", "angles", "low", "high"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches):
            own = Side(piece, width)
            for folder in folders:
                files, path = fs.FileSystem.from_uri(folder)
                names = [i.path for i in files.get_file_info(fs.FileSelector(path)) if i.path.endswith(".parquet")]
                for block in ds.dataset(names, filesystem=files, format="parquet").scanner(columns, batch_size=ANCHOR_BLOCK, batch_readahead=1, fragment_readahead=1).to_batches():
                    if not len(block):
                        continue
                    side = Side(block, width)
                    windows = len(block.column("low")[0])
                    low, high = (_matrix(block.column(c), windows).astype(float) for c in ("low", "high"))
                    for w, at, ids, scores in search(side, own, low, high, most, same):
                        if len(at):
                            yield pa.RecordBatch.from_arrays([pa.array(side.id[at]), pa.array(np.full(len(at), w, np.int32)), pa.array(ids), pa.array(scores.astype(np.int64))],
                                                             ["anchor_id", "w", "vec_id", "score"])

    return rows.select("vec_id", "label", "q", "norm", "angles").mapInArrow(run, "anchor_id long, w int, vec_id long, score long")


def _ranked(found: DataFrame, most: int) -> DataFrame:
    """The best rows over all chunks with their rank from 1; Spark limits groups before they are shuffled."""
    order = Window.partitionBy("anchor_id", "w").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _raised(anchors: DataFrame, pilot: DataFrame, most: int) -> DataFrame:
    """Anchors with each lower bound raised to the `most`-th best score of the pilot rows, where there are so many."""
    reached = pilot.where(F.col("rank") == most).groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("w", F.col("score").cast("double")))).alias("reached"))
    joined = anchors.join(reached, F.col("vec_id") == F.col("anchor_id"), "left").drop("anchor_id")
    low = F.transform("low", lambda v, i: F.greatest(v, F.try_element_at("reached", i)))
    return joined.withColumn("low", F.when(F.col("reached").isNull(), F.col("low")).otherwise(low)).drop("reached")


def _searched(rows: DataFrame, anchors: DataFrame, width: int, most: int, same: bool) -> DataFrame:
    """The best rows for every window: first of the pilot rows, then of all, with what the pilot shows as a lower bound."""
    files = -(-anchors.count() // ANCHORS_A_FILE) or 1
    first = saved(anchors.repartition(files), "anchors")
    pilot = saved(_ranked(found_in(rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(PILOT)) == 0), first, width, most, same), most), "pilot")
    raised = saved(_raised(first, pilot, most).repartition(files), "anchors")
    best = saved(_ranked(found_in(rows, raised, width, most, same), most), "best")
    discard(first, pilot, raised)
    return best


def mine(vectors: DataFrame, anchor: Column, label: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         window: tuple[int, int] = WINDOW, references: int = REFERENCES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Positives of an anchor are its best `positives` other rows of the same label, negatives the best `negatives` rows of other labels
    whose score is between the two percentages of the positive's score; higher scores first, ties by smaller id (scores beyond 2^53 are
    ordered as doubles). Which rows take
    part: see `usable`; other columns are not read, so no name can clash. An anchor without positives, or a positive whose window is empty
    (as it is below 0), gives no rows, and neither does an empty table. The `references` rows of smallest hash give the reference
    directions (a bounded sample; results do not depend on it).
    """
    spark = vectors.sparkSession
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    plain = saved(usable(vectors, anchor, label), "vectors")
    count, width, anchors_count = plain.agg(F.count("*"), F.coalesce(F.max(F.size("q")), F.lit(0)), F.count(F.when(F.col("anchor"), 1))).first()
    if not anchors_count:
        return spark.createDataFrame([], result)
    chosen = plain.where(F.exists("q", lambda v: v != 0)).orderBy(F.xxhash64("vec_id")).limit(references).select("q").collect()
    directions = np.zeros((len(chosen), width))
    for i, r in enumerate(chosen):
        directions[i, :len(r.q)] = r.q
    directions /= np.sqrt((directions**2).sum(1))[:, None]
    # chunks are cut by a hash of the id, so a label or a group of equal vectors is spread over all of them
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // CHUNK))
    rows = saved(with_angles(plain.repartition(parts, "vec_id"), directions, width), "angles")
    discard(plain)
    anchors = rows.where("anchor").drop("anchor")
    everything = anchors.withColumns({"low": F.array(F.lit(float("-inf"))), "high": F.array(F.lit(float("inf")))})
    same = _searched(rows, everything, width, positives, True)
    # the windows of an anchor in whole scores: both ends are exact
    score = F.col("score").cast("decimal(20,0)")
    low, high = F.ceil(score * window[0] / 100), F.floor(score * window[1] / 100)
    windows = same.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", low.cast("double").alias("low"), high.cast("double").alias("high")))).alias("all"))
    bounds = windows.select("anchor_id", *[F.concat(F.col(f"all.{c}"), F.array_repeat(F.lit(v), positives - F.size("all"))).alias(c)
                                           for c, v in (("low", float("inf")), ("high", float("-inf")))])
    other = _searched(rows, anchors.join(bounds, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id"), width, negatives, False)
    pairs = same.select("anchor_id", (F.col("rank") - 1).alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return other.join(pairs, ["anchor_id", "w"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
                                                        F.col("score").alias("negative_score"))


def report(vectors: DataFrame) -> DataFrame:
    """Hard negatives of every hundredth row; the label of every seventh is moved by one first."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(vectors, F.col("vec_id") % 100 == 0, moved)
