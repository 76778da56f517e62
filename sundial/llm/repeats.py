"""Removal of repeated passages by hashing lines and sentences.

A text is cut into units: at line ends, after a sentence mark, and before a capitalised word, so that a passage is cut alike
wherever it was pasted. Units are normalised (lower case, single blanks) and hashed. Of all occurrences of a digest the
first by (doc_id, text hash, unit number) stays; every other one is repeated. A repeated unit is removed if it lies in a run
of repeated units that follow one another and count `least_words` words together, so that short common sentences are
left where they stand. Offsets are code points of the original text.

Each task first keeps the least occurrence of each digest among its own: the others are repeats already, whatever the
rest of the corpus holds. So a digest is sent by each task once, and a line that a third of all documents share makes no
large group. Null text is empty. Rows equal in doc_id and text are one document. A null doc_id ranks last.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LEAST_WORDS = 30
HELD = 2_000_000
LAST = (1 << 63) - 1
#: Between two units: a line end, white space after a sentence mark, white space before a capital.
BORDER = regex.compile(r"\s*\n\s*|(?<=[.!?…][\"'”’)\]]?)\s+|\s+(?=\p{Lu})")
UNITS = "kind int, digest long, doc_id long, text_key long, unit int, start int, end int, words int, earlier long"
NAMES = [c.split()[0] for c in UNITS.split(", ")]
TYPES = [{"int": pa.int32(), "long": pa.int64()}[c.split()[1]] for c in UNITS.split(", ")]


def units(text: str) -> Iterator[tuple[int, int, int, int]]:
    """(digest, start, end, words) of every unit that holds a word."""
    at = 0
    for border in BORDER.finditer(text):
        start, end = border.span()
        if (found := _unit(text, at, start)) is not None:
            yield found
        at = end
    if (found := _unit(text, at, len(text))) is not None:
        yield found


def _unit(text: str, start: int, end: int) -> tuple[int, int, int, int] | None:
    words = text[start:end].lower().split()
    return (xxhash.xxh3_64_intdigest(" ".join(words).encode()), start, end, len(words)) if words else None


def _first_marked(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Occurrences sorted by digest and rank; kind 0 for the first of each digest, 1 for repeats, which name the first one's document.

    Occurrences equal to the first (repeated rows) are dropped.
    """
    digest, doc_id, key, unit = columns[:4]
    order = np.lexsort((unit, key, doc_id, digest))
    columns = [c[order] for c in columns]
    digest, doc_id, key, unit = columns[:4]
    new = np.concatenate([[True], digest[1:] != digest[:-1]])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    same = (doc_id == doc_id[first]) & (key == key[first]) & (unit == unit[first])
    keep = new | ~same
    return [np.where(new, 0, 1)[keep].astype(np.int32), *(c[keep] for c in columns), np.where(new, LAST, doc_id[first])[keep]]


def cut(documents: DataFrame) -> DataFrame:
    """Units of all texts: the first occurrence in the task of each digest (kind 0), and what repeats it (kind 1)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[int]] = [[] for _ in range(7)]
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                found = list(units(text))
                if not found:
                    continue
                digests, starts, ends, words = zip(*found, strict=True)
                n = len(found)
                for column, values in zip(held, (digests, [LAST if doc_id is None else doc_id] * n, [xxhash.xxh3_64_intdigest(text.encode()) >> 1] * n, range(n), starts, ends, words), strict=True):
                    column.extend(values)
                if len(held[0]) >= HELD:
                    yield _batch(held)
                    held = [[] for _ in range(7)]
        if held[0]:
            yield _batch(held)

    return documents.select("doc_id", "text").mapInArrow(run, UNITS)


def _batch(held: list[list[int]]) -> pa.RecordBatch:
    digest = np.array(held[0], np.uint64).view(np.int64)
    columns = [digest, np.array(held[1], np.int64), np.array(held[2], np.int64), *(np.array(c, np.int32) for c in held[3:])]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(_first_marked(columns), TYPES, strict=True)], NAMES)


def repeated_units(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, unit, start, end, words, earlier (a document with an earlier occurrence) of every repeated unit."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, first = None, None
        for batch in batches:
            columns = [batch.column(n).to_numpy() for n in NAMES]
            known = columns[0] == 1
            if known.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[known], t) for c, t in zip(columns, TYPES, strict=True)], NAMES)
            columns = [c[~known] for c in columns]
            if not len(columns[0]):
                continue
            digests = columns[1]
            new = np.concatenate([[digests[0] != digest], digests[1:] != digests[:-1]])
            ids = np.stack([columns[2], columns[3], columns[4].astype(np.int64)])
            place = np.cumsum(new) - 1
            firsts = ids[:, np.flatnonzero(new)]
            if place[0] < 0:  # the group began in an earlier batch
                firsts, place = np.concatenate([first[:, None], firsts], axis=1), place + 1
            mine = firsts[:, place]
            repeat = (ids != mine).any(axis=0)
            digest, first = digests[-1], firsts[:, -1]
            columns[8] = mine[0]
            if repeat.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[repeat], t) for c, t in zip(columns, TYPES, strict=True)], NAMES)

    dealt = cut(documents).withColumn("slot", F.expr("IF(kind = 0, digest, xxhash64(doc_id, text_key, unit))"))
    ordered = dealt.repartition("slot").drop("slot").sortWithinPartitions("digest", "kind", "doc_id", "text_key", "unit")
    return ordered.mapInArrow(run, UNITS).drop("kind", "digest")


def removed(documents: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, text_key, start, end, words and earlier of every passage to remove."""
    found = repeated_units(documents).dropDuplicates(["doc_id", "text_key", "unit"])
    turn = F.row_number().over(Window.partitionBy("doc_id", "text_key").orderBy("unit"))  # as many rows as the document has units
    return (found.withColumn("run", F.col("unit") - turn).groupBy("doc_id", "text_key", "run")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("words"), F.min("earlier").alias("earlier"))
            .where(F.col("words") >= least_words)
            .select(F.expr(f"nullif(doc_id, {LAST}L)").alias("doc_id"), "text_key", "start", "end", "words", F.expr(f"nullif(earlier, {LAST}L)").alias("earlier")))


def report(documents: DataFrame, least_words: int = LEAST_WORDS, every: bool = False) -> DataFrame:
    """One row per document that loses a passage: spans (start:end, comma-joined), their words, and documents with earlier occurrences.

    `every` adds all later occurrences of lines, paragraphs and windows of `least_words` words to the runs of sentences.
    """
    if every:
        from sundial.llm import passages
    return ((passages.removed if every else removed)(documents, least_words).groupBy("doc_id", "text_key")
            .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("s"), F.sum("words").alias("removed_words"), F.array_sort(F.collect_set("earlier")).alias("earlier_doc_ids"))
            .select("doc_id", F.size("s").cast("long").alias("n_removed"), "removed_words",
                    F.concat_ws(",", F.transform("s", lambda x: F.concat(x["start"].cast("string"), F.lit(":"), x["end"].cast("string")))).alias("spans"), "earlier_doc_ids"))


def cleaned(documents: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Documents, all columns, with the passages taken out of `text`, and removed_spans (array of start, end)."""
    spans = (removed(documents, least_words).groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
             .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("removed_spans")))

    @F.pandas_udf("long")
    def key(texts):
        return texts.map(lambda t: xxhash.xxh3_64_intdigest(t.encode()) >> 1 if t else 0)

    joined = documents.withColumn("__own", key("text")).join(spans, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__key")), "left")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("kept"))
    kept = F.aggregate("removed_spans", start, lambda a, s: F.struct(s["end"].alias("at"), F.concat(a["kept"], F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"])).alias("kept")))
    text = F.when(F.col("removed_spans").isNull(), F.col("text")).otherwise(F.concat(kept["kept"], F.substring(F.col("text"), kept["at"] + 1, F.length("text"))))
    return joined.withColumn("text", text).drop("__own", "__id", "__key")
