"""Byte-level BPE encoding and decoding with the ranks of a public tokenizer.

Texts are cut into pieces by the tokenizer's pattern and each piece is merged on its own: a segment tree over byte
positions holds the rank of the pair that starts there, so the root names the leftmost pair of least rank, and a merge
updates the three live neighbours it touches in logarithmic time. Short pieces are merged many at a time, one tree each.
Pieces repeat, so each worker remembers a bounded number of them. Nothing is shuffled; one document is the largest unit of work.

Null text is treated as empty (no ids, empty bytes). Repeated rows are encoded alike; other columns are kept untouched.
"""

from __future__ import annotations

import base64
import re
import sys
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sundial.llm.shared import keeps, lean

REMEMBERED = 100_000
#: Pieces that are merged at once; each takes some kilobytes meanwhile.
TOGETHER = 4096
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Runs without white space, with at most one blank before them: no piece crosses the border of two runs.
RUNS = re.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
NO_RANK = 1 << 62


def merge(piece: bytes, ranks: dict[bytes, int], find: Callable[[int, int], int | None]) -> list[int]:
    """Ids of one piece: merge the leftmost pair of least rank until no pair has a rank."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    size = 1 << (n - 1).bit_length()
    ids = [ranks[piece[i:i + 1]] for i in range(n)]
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    tree = [NO_RANK] * (2 * size)
    for i in range(n - 1):
        rank = find(ids[i], ids[i + 1])
        if rank is not None:
            tree[size + i] = rank * n + i
    for i in range(size - 1, 0, -1):
        left, right = tree[2 * i], tree[2 * i + 1]
        tree[i] = left if left <= right else right
    least = tree[1]
    while least != NO_RANK:
        rank, i = divmod(least, n)
        j = after[i]
        ids[i] = rank
        ids[j] = -1
        k = after[i] = after[j]
        changed = [(j, NO_RANK)]
        if k < n:
            before[k] = i
            rank = find(ids[i], ids[k])
            changed.append((i, NO_RANK if rank is None else rank * n + i))
        else:
            changed.append((i, NO_RANK))
        h = before[i]
        if h >= 0:
            rank = find(ids[h], ids[i])
            changed.append((h, NO_RANK if rank is None else rank * n + h))
        for at, value in changed:
            at += size
            if tree[at] == value:
                continue
            tree[at] = value
            while at > 1:
                other = tree[at ^ 1]
                at >>= 1
                if other < value:
                    value = other
                if tree[at] == value:
                    break
                tree[at] = value
        least = tree[1]
    return [i for i in ids if i >= 0]


class Pairs:
    """Rank of a pair of ids, looked up for whole arrays: an open-addressing table."""

    def __init__(self, pairs: dict[int, int]):
        self.bits = max(4, (2 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.zeros(1 << self.bits, np.int64)
        keys, ranks = np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int64, len(pairs))
        at = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[at] < 0)
            self.keys[at[free]] = keys[free]
            here = self.keys[at] == keys
            self.ranks[at[here]] = ranks[here]
            keys, ranks, at = keys[~here], ranks[~here], (at[~here] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def one(self, left: int, right: int) -> int | None:
        """Rank of one pair, if it has any."""
        rank = int(self.find(np.array([left]), np.array([right]))[0])
        return None if rank < 0 else rank

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks, or -1 where the pair has none or an id is negative."""
        keys = left << 32 | right
        out = np.full(len(keys), -1, np.int64)
        rows = np.flatnonzero((left >= 0) & (right >= 0))
        at = self._slot(keys[rows])
        while len(rows):
            held = self.keys[at]
            here = held == keys[rows]
            out[rows[here]] = self.ranks[at[here]]
            on = ~here & (held >= 0)
            rows, at = rows[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return out


def merge_many(pieces: list[bytes], letters: np.ndarray, pairs: Pairs) -> list[bytes]:
    """`merge` for many short pieces at once: a forest of equal segment trees, one merge in each tree per round.

    The ids of a piece are the bytes of 32-bit numbers.
    """
    lengths = np.array([len(p) for p in pieces])
    size = 1 << int(lengths.max() - 1).bit_length()
    shift, m = size.bit_length() - 1, len(pieces)
    none = np.int64(NO_RANK)
    ids = np.full((m, size + 1), -1, np.int64)
    inside = np.arange(size + 1) < lengths[:, None]
    ids[inside] = letters[np.frombuffer(b"".join(pieces), np.uint8)]
    after = np.minimum(np.arange(1, size + 2), lengths[:, None]).ravel()
    before = np.tile(np.arange(-1, size), (m, 1)).ravel()
    tree = np.full((m, 2 * size), none)
    ranks = pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(m, size)
    tree[:, size:] = np.where(ranks >= 0, ranks << shift | np.arange(size), none)
    at = size
    while at > 1:
        tree[:, at // 2:at] = np.minimum(tree[:, at:2 * at:2], tree[:, at + 1:2 * at:2])
        at //= 2
    tree, ids = tree.ravel(), ids.ravel()
    rows = np.arange(m)
    while True:
        least = tree[rows * (2 * size) + 1]
        live = least < none
        rows, least = rows[live], least[live]
        if not len(rows):
            break
        flat, top = rows * (size + 1), rows * (2 * size)
        i = least & (size - 1)
        j = after[flat + i]
        k = after[flat + j]
        h = before[flat + i]
        ids[flat + i] = least >> shift
        ids[flat + j] = -1
        after[flat + i] = k
        before[flat + k] = i
        own = pairs.find(ids[flat + i], ids[flat + k])
        left = pairs.find(np.where(h >= 0, ids[flat + np.maximum(h, 0)], -1), ids[flat + i])
        spots = [size + j, size + i, np.where(h >= 0, size + h, 0)]
        tree[top + spots[0]] = none
        tree[top + spots[1]] = np.where(own >= 0, own << shift | i, none)
        tree[top + spots[2]] = np.where(left >= 0, left << shift | h, none)
        for _ in range(shift):
            for n, spot in enumerate(spots):
                spots[n] = spot = spot >> 1
                below = top + 2 * spot
                tree[top + spot] = np.minimum(tree[below], tree[below + 1])
    ids = ids.reshape(m, size + 1)
    kept = ids >= 0
    flat, ends = ids[kept].astype(np.int32).tobytes(), (4 * np.cumsum(kept.sum(axis=1))).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class Recent:
    """Ids of short runs seen lately: two generations, so that frequent ones stay and memory is bounded."""

    def __init__(self):
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, run: str) -> bytes | None:
        ids = self.old.get(run)
        if ids is not None:
            self.put(run, ids)
        return ids

    def put(self, run: str, ids: bytes) -> None:
        if len(run) <= 64:
            if len(self.new) >= REMEMBERED:
                self.old, self.new = self.new, {}
            self.new[run] = ids


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.letters = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {}
        for word, rank in self.ranks.items():
            for cut in range(1, len(word)):
                left, right = self.ranks.get(word[:cut]), self.ranks.get(word[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.table = Pairs(pairs)
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]"))
        self.runs = Recent()
        words = [b""] * (max(self.ranks.values()) + 1)
        for word, rank in self.ranks.items():
            words[rank] = word
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(words), np.uint8)

    def _new(self, runs: set[str]) -> dict[str, bytes]:
        """Ids of runs not seen lately."""
        cut = {run: [run] if run.isalpha() or run[0] == " " and run[1:].isalpha() else self.pattern.findall(run) for run in runs}
        known: dict[str, bytes] = {}
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for piece in set(chain.from_iterable(cut.values())):
            raw = piece.encode()
            if (rank := self.ranks.get(raw)) is not None:
                known[piece] = rank.to_bytes(4, sys.byteorder)
            elif len(raw) > 64:
                known[piece] = np.array(merge(raw, self.ranks, self.table.one), np.int32).tobytes()
            else:
                by_size.setdefault((len(raw) - 1).bit_length(), []).append((piece, raw))
        for group in by_size.values():
            for at in range(0, len(group), TOGETHER):
                some = group[at:at + TOGETHER]
                known.update(zip([p for p, _ in some], merge_many([r for _, r in some], self.letters, self.table), strict=True))
        out = {run: b"".join(map(known.__getitem__, pieces)) for run, pieces in cut.items()}
        for run, ids in out.items():
            self.runs.put(run, ids)
        return out

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and their number for each text."""
        cut = [RUNS.findall(t) for t in texts]
        found = [list(map(self.runs.new.get, runs)) for runs in cut]
        missing = {r for f, runs in zip(found, cut, strict=True) if None in f for i, r in zip(f, runs, strict=True) if i is None}
        if missing:
            older = {r: ids for r in missing if (ids := self.runs.get(r)) is not None}
            older |= self._new(missing.difference(older))
            found = [[older[r] if i is None else i for i, r in zip(f, runs, strict=True)] if None in f else f for f, runs in zip(found, cut, strict=True)]
        joined = [b"".join(f) for f in found]
        return np.frombuffer(b"".join(joined), np.int32), np.fromiter(map(len, joined), np.int64, len(joined)) // 4

    def encode(self, text: str) -> list[int]:
        return self.encode_many([text])[0].tolist()

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of all ids one after the other."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        at += np.arange(len(at))
        return self.data[at]


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


keeps("bpe", codec.cache_clear)


def _fitting(df: DataFrame, *names: str) -> None:
    taken = [n for n in names if n.lower() in {c.lower() for c in df.columns}]
    if taken:
        raise ValueError(f"the input has columns named {taken} already")


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """All columns of df and the array of token ids of its text."""
    _fitting(df, ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                flat, counts = own.encode_many([t or "" for t in part.column(text).to_pylist()])
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], [*part.schema.names, ids])

    return df.mapInArrow(lean(run, "bpe"), T.StructType([*df.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """All columns of df and the bytes that its ids stand for; null ids give empty bytes."""
    _fitting(df, decoded)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                lists = part.column(ids).fill_null([])
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                data = own.decode(flat)
                counts = lists.value_lengths().to_numpy(zero_copy_only=False)
                token_ends = np.concatenate([[0], np.cumsum(own.lengths[flat])])
                ends = token_ends[np.concatenate([[0], np.cumsum(counts)])].astype(np.int32)
                out = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
                yield pa.RecordBatch.from_arrays([*part.columns, out], [*part.schema.names, decoded])

    return df.mapInArrow(lean(run, "bpe"), T.StructType([*df.schema.fields, T.StructField(decoded, T.BinaryType())]))


def digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, number of ids, and the SHA-256 of the ids (decimal, one blank between) and of the decoded bytes."""
    own = documents.select("doc_id", "text")
    both = decode(encode(own, path, pattern).drop("text"), path, pattern)
    return both.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
