"""Every later occurrence of a line, a paragraph or a window of words, beside runs of repeated sentences.

Words are split at white space and compared by 64-bit hashes in lower case. Items of a text are its sentences (level 0), its lines
and paragraphs of several lines (level 1), and each window of `least_words` words, one at every word (level 2). Of all
occurrences of an item the first by (doc_id, text hash, position) stays. Lines, paragraphs and windows are removed wherever they occur
again, whatever their length; sentences in runs of `least_words` words, as in `repeats`. So a passage that is cut or edited at an
end loses all of its windows. A window that overlaps its first occurrence in the same text is removed from there on.

A task sorts the items of some documents by digest and sends the first of each to one of many buckets; what repeats it goes
straight to its document. So a bucket gets an item from such a lot of documents once, and buckets follow the size of the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sundial.llm.repeats import BORDER, LAST

HELD_WORDS = 500_000
ROW_ITEMS = 2000
BUCKET_CHARS = 20_000_000
LEAST_BUCKETS = 16
ITEMS = "slot int, docs binary, keys binary, counts binary, digests binary, words binary, sizes binary, earlier binary, lengths binary"
FOUND = "doc_id long, text_key long, words array<int>, sizes array<int>, earlier array<long>, lengths binary"
SPANS = "doc_id long, text_key long, start int, end int, words long, earlier long"
ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
WORD, TEXT = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    names, types = zip(*(c.split() for c in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, ARROW[t]) for c, t in zip(columns, types, strict=True)], list(names))


def _bytes(values: np.ndarray, width: int = 4) -> bytes:
    """Numbers as all their lowest bytes, then all next ones, and so on: bytes that are nearly always 0 compress well."""
    return np.asarray(values).astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def _numbers(data: bytes, width: int = 4) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(f"<u{width}").ravel().astype(np.int64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """A number for the lower case of each code point, and whether it is white space."""
    lower = np.array([ord(x) if len(x := chr(i).lower()) == 1 else i for i in range(0x110000)], np.uint64)
    return _mix(lower + np.uint64(WORD)), np.array([chr(i).isspace() for i in range(0x110000)])


@cache
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    factors = np.array([[base], [pow(base, -1, 1 << 64)]], np.uint64).repeat(size, axis=1)
    factors[:, 0] = 1
    return tuple(np.multiply.accumulate(factors, axis=1))


def _pieces(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hashes of values[start:end]."""
    up, down = _powers(base, 1 << max(12, int(len(values)).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[:len(values)], dtype=np.uint64)])
    return _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(TEXT))


def items(text: str, least_words: int) -> tuple[np.ndarray, ...] | None:
    """digest, first word and words * 4 + level of all items in order of level and word; then the blanks before and the length of each word."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    numbers, blank = _characters()
    edges = np.flatnonzero(np.diff(np.concatenate([[True], blank[points], [True]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    n = len(starts)
    if not n:
        return None
    words = _pieces(numbers[points], starts, ends, WORD)
    sentences = np.unique(np.concatenate([[0], np.searchsorted(starts, [b.end() for b in BORDER.finditer(text)]), [n]]).astype(np.int64))
    at, times = np.unique(np.searchsorted(starts, np.flatnonzero(points == 10)), return_counts=True)
    lines = np.unique(np.concatenate([[0], at, [n]]))
    paragraphs = np.unique(np.concatenate([[0], at[times > 1], [n]]))
    several = np.diff(np.searchsorted(lines, paragraphs)) > 1
    windows = np.arange(max(0, n - least_words + 1))
    first = np.concatenate([sentences[:-1], lines[:-1], paragraphs[:-1][several], windows])
    last = np.concatenate([sentences[1:], lines[1:], paragraphs[1:][several], windows + least_words])
    level = np.repeat([0, 1, 2], [len(sentences) - 1, len(lines) - 1 + several.sum(), len(windows)])
    digest = _mix(_pieces(words, first, last, TEXT) + level.astype(np.uint64)).view(np.int64)
    return digest, first, (last - first) * 4 + level, np.stack([starts - np.concatenate([[0], ends[:-1]]), ends - starts])


def _union(first, last, earlier) -> list[np.ndarray]:
    order = np.argsort(first, kind="stable")
    first, last, earlier = first[order], last[order], earlier[order]
    reach = np.maximum.accumulate(last)
    new = np.flatnonzero(np.concatenate([[True], first[1:] > reach[:-1]]))
    return [first[new], np.maximum.reduceat(last, new), np.minimum.reduceat(earlier, new)]


def spans(first, sizes, earlier, least_words: int) -> list[np.ndarray]:
    """first word, last word + 1 and earlier of what a document loses, from its repeated items."""
    columns, sentence = (first, first + (sizes >> 2), earlier), sizes & 3 == 0
    kept = [c[~sentence] for c in columns]
    if sentence.any():
        runs = _union(*(c[sentence] for c in columns))
        long = runs[1] - runs[0] >= least_words
        kept = [np.concatenate([a, b[long]]) for a, b in zip(kept, runs, strict=True)]
    return _union(*kept) if len(kept[0]) else []


def _packed(docs: list, parts: list[tuple[np.ndarray, ...]], buckets: int) -> pa.RecordBatch:
    """Documents in order of rank: the first occurrences of their items by bucket; then a row for each with what repeats an item, and its words' lengths."""
    ids, keys = (np.array(c, np.int64) for c in zip(*docs, strict=True))
    digest, first, sizes = (np.concatenate([p[i] for p in parts]) for i in range(3))
    doc = np.repeat(np.arange(len(docs)), [len(p[0]) for p in parts])
    order = np.argsort(digest, kind="stable")
    new = np.concatenate([[True], np.diff(digest[order]) != 0])
    lead = np.empty(len(order), np.int64)
    lead[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    leads = lead == np.arange(len(lead))
    mine = np.flatnonzero(leads)
    slots = ((digest[mine].view(np.uint64) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
    turn = np.argsort(slots, kind="stable")
    mine, slots = mine[turn], slots[turn]
    cuts = np.unique(np.concatenate([np.flatnonzero(np.diff(slots)) + 1, np.arange(0, len(mine), ROW_ITEMS), [len(mine)]]))
    rows = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        at = mine[a:b]
        turn = np.flatnonzero(np.concatenate([[True], np.diff(doc[at]) != 0]))
        rows.append((int(slots[a]), _bytes(ids[doc[at[turn]]], 8), _bytes(keys[doc[at[turn]]], 8), _bytes(np.diff(np.append(turn, b - a))), digest[at].tobytes(), _bytes(first[at]), _bytes(sizes[at]), b"", b""))
    again = np.flatnonzero(~leads)
    length, words, lead = sizes[again] >> 2, first[again], lead[again]
    before = np.where(doc[lead] == doc[again], first[lead] + length, 0)
    columns = np.maximum(words, before), words + length, ids[doc[lead]]
    level = sizes[again] & 3
    edges = np.searchsorted(doc[again], np.arange(len(docs) + 1))
    for d, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        other = level[a:b] > 0
        merged = _union(*(c[a:b][other] for c in columns)) if other.any() else [c[:0] for c in columns]
        w, l, e = (np.concatenate([c[a:b][~other], m]) for c, m in zip(columns, merged, strict=True))
        kind = np.repeat([0, 2], [b - a - other.sum(), len(merged[0])])
        rows.append((int(keys[d] % buckets), _bytes(ids[d:d + 1], 8), _bytes(keys[d:d + 1], 8), b"", b"", _bytes(w), _bytes((l - w) * 4 + kind), _bytes(e, 8), _bytes(parts[d][3])))
    return _batch(list(zip(*rows, strict=True)), ITEMS)


def _items(documents: DataFrame, least_words: int, buckets: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if text and (found := items(text, least_words)) is not None:
                    held[LAST if doc_id is None else doc_id, xxhash.xxh3_64_intdigest(text.encode()) >> 1] = found
                    size += len(found[0])
                if size >= HELD_WORDS:
                    yield _packed(sorted(held), [held[d] for d in sorted(held)], buckets)
                    held, size = {}, 0
        if held:
            yield _packed(sorted(held), [held[d] for d in sorted(held)], buckets)

    return documents.select("doc_id", "text").mapInArrow(run, ITEMS)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)]), pa.int32()), pa.array(np.concatenate(values), kind))


def repeated(documents: DataFrame, least_words: int, buckets: int) -> DataFrame:
    """doc_id, text_key and the repeated items of documents, in several rows; one of them has the lengths of the words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(1, 9)]
            known = []
            for ids, keys, counts, digests, words, sizes, earlier, lengths in zip(*columns, strict=True):
                if digests:
                    held.append((_numbers(ids, 8), _numbers(keys, 8), _numbers(counts), np.frombuffer(digests, np.int64), _numbers(words).astype(np.int32), _numbers(sizes).astype(np.int32)))
                else:
                    known.append((_numbers(ids, 8)[0], _numbers(keys, 8)[0], _numbers(words), _numbers(sizes), _numbers(earlier, 8), lengths))
            if known:
                ids, keys, words, sizes, earlier, lengths = zip(*known, strict=True)
                yield _batch([ids, keys, _lists(words, pa.int32()), _lists(sizes, pa.int32()), _lists(earlier, pa.int64()), lengths], FOUND)
        if not held:
            return
        all_ids, all_keys, counts, digest, all_words, all_sizes = (np.concatenate(c) for c in zip(*held, strict=True))
        del held
        order = np.argsort(digest)
        equal = np.diff(digest[order]) == 0
        several = np.sort(order[np.concatenate([[False], equal]) | np.concatenate([equal, [False]])])
        if not len(several):
            return
        doc = np.searchsorted(np.cumsum(counts), several, "right")
        digest, ids, keys, words, sizes = digest[several], all_ids[doc], all_keys[doc], all_words[several], all_sizes[several]
        order = np.lexsort((words, keys, ids, digest))
        digest, ids, keys, words, sizes = (c[order] for c in (digest, ids, keys, words, sizes))
        new = np.concatenate([[True], np.diff(digest) != 0])
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        again = np.flatnonzero((ids != ids[lead]) | (keys != keys[lead]) | (words != words[lead]))
        if not len(again):
            return
        earlier = ids[lead[again]]
        order = np.lexsort((keys[again], ids[again]))
        at, earlier = again[order], earlier[order]
        turn = np.flatnonzero(np.concatenate([[True], (np.diff(ids[at]) != 0) | (np.diff(keys[at]) != 0)]))
        lists = [pa.ListArray.from_arrays(pa.array(np.append(turn, len(at)), pa.int32()), pa.array(c, t)) for c, t in zip((words[at], sizes[at], earlier), [pa.int32(), pa.int32(), pa.int64()], strict=True)]
        whole = _batch([ids[at[turn]], keys[at[turn]], *lists, pa.nulls(len(turn), pa.binary())], FOUND)
        for i in range(0, len(turn), 5000):
            yield whole.slice(i, 5000)

    return _items(documents, least_words, buckets).repartitionById(buckets, F.col("slot")).mapInArrow(run, FOUND)


def removed(documents: DataFrame, least_words: int) -> DataFrame:
    """doc_id, text_key, start, end, words and earlier of every passage to remove."""
    chars = documents.agg(F.sum(F.length("text"))).first()[0] or 0
    found = repeated(documents, least_words, max(LEAST_BUCKETS, chars // BUCKET_CHARS + 1))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out, lengths = None, [], [], None

        def close():
            first, sizes, earlier = (np.concatenate(c).astype(np.int64) for c in zip(*held, strict=True))
            if not len(first):
                return
            pair = _numbers(lengths).reshape(2, -1)
            ends = np.cumsum(pair.sum(axis=0))
            for a, b, e in zip(*spans(first, sizes, earlier, least_words), strict=True):
                out.append((*now, ends[a] - pair[1, a], ends[b - 1], b - a, e))

        for batch in batches:
            ids, keys, sent = (batch.column(c).to_pylist() for c in (0, 1, 5))
            lists = [(c.offsets.to_numpy() - c.offsets[0].as_py(), c.flatten().to_numpy(zero_copy_only=False)) for c in batch.columns[2:5]]
            for i, doc in enumerate(zip(ids, keys, strict=True)):
                if doc != now:
                    if held:
                        close()
                    now, held = doc, []
                held.append([values[at[i]:at[i + 1]] for at, values in lists])
                if sent[i]:
                    lengths = sent[i]
            if len(out) > 10_000:
                yield _batch(list(zip(*out, strict=True)), SPANS)
                out = []
        if held:
            close()
        if out:
            yield _batch(list(zip(*out, strict=True)), SPANS)

    ordered = found.repartition("doc_id", "text_key").sortWithinPartitions("doc_id", "text_key")
    return (ordered.mapInArrow(run, SPANS)
            .select(F.expr(f"nullif(doc_id, {LAST}L)").alias("doc_id"), "text_key", "start", "end", "words", F.expr(f"nullif(earlier, {LAST}L)").alias("earlier")))
