"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to five bytes long with the counts of the bytes that follow. A byte is predicted
in the longest known context; if it was never seen there, an escape leads to the next shorter one, where the bytes that
the longer context knows are excluded, down to a uniform choice among the bytes never seen. A byte seen n times in a
context of total T and D distinct bytes gets (n - 1/2) / T and the escape D / 2T, so probabilities sum to one.
Before a text stand five marks, after it one that is predicted like a byte (0xFF, which UTF-8 never has).

`pretrained` counts all training texts: combined counts of six-byte strings by task, summed by Spark, shorter ones by
marginal sums. The trie is laid out as tables for whole arrays of positions, written to the shared folder in shards of
bounded size, and read from there by the tasks; none of it passes the driver: contexts of two bytes and more go by their last two bytes, words by hash. A text is scored against each shard
in turn and partial sums are added, so a model of any size fits and no score depends on their number. `adaptive`
starts each document with an empty trie and learns as it reads.

A-Z count as lower case. Null text is empty: only the end is scored. Equal texts get equal scores. Rows with a null doc_id
belong to the training texts. Without training texts every byte is uniform and every token unknown.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sundial.llm.arrays import LOWER, Lookup, by_text, counted, mixed, words
from sundial.llm.shared import saved, shared_folder, text_slices

ORDER = 5
END = 0xFF
SHARD = 2_500_000
HELD = 1 << 20


class Trie:
    """The model as nested counts; learns one symbol at a time."""

    def __init__(self, order: int = ORDER):
        self.order = order
        self.nodes: dict[bytes, dict[int, int]] = {}

    def probability(self, context: bytes, symbol: int) -> float:
        p, excluded = 1.0, {}
        for j in range(min(self.order, len(context)), -1, -1):
            seen = self.nodes.get(context[len(context) - j:])
            if not seen:
                continue
            left = {s: n for s, n in seen.items() if s not in excluded}
            if not left:
                continue
            total = sum(left.values())
            if symbol in left:
                return p * (left[symbol] - 0.5) / total
            p *= len(left) / 2 / total
            excluded = seen
        return p / (256 - len(excluded))

    def learn(self, context: bytes, symbol: int) -> None:
        for j in range(min(self.order, len(context)) + 1):
            seen = self.nodes.setdefault(context[len(context) - j:], {})
            seen[symbol] = seen.get(symbol, 0) + 1


def symbols(text: bytes, order: int = ORDER) -> Iterator[tuple[bytes, int]]:
    """Context and symbol of every position, the end included."""
    marked = bytes([END]) * order + LOWER[np.frombuffer(text, np.uint8)].tobytes() + bytes([END])
    for i in range(order, len(marked)):
        yield marked[i - order:i], marked[i]


def adaptive_score(text: bytes, order: int = ORDER) -> float:
    """log10 probability of a text under a trie that learns as it reads."""
    trie, total = Trie(order), 0.0
    for context, symbol in symbols(text, order):
        total += np.log10(trie.probability(context, symbol))
        trie.learn(context, symbol)
    return float(total)


def adaptive(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep` and `score`: each text under a trie of its own."""
    own = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [adaptive_score(t.encode()) for t in batch.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], [*keep, "score"])

    return own.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1]), "score double"]))


def strings(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every position (end included) of all texts its context and byte as one number of six bytes; and where each text begins."""
    lengths = np.diff(offsets)
    marked = np.full(len(data) + (ORDER + 1) * len(lengths), END, np.uint8)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    marked[np.arange(len(data)) + (ORDER + 1) * owner + ORDER] = LOWER[data]
    wide = marked.astype(np.uint64)
    keys = wide[ORDER:].copy()
    for back in range(1, ORDER + 1):
        keys |= wide[ORDER - back:len(wide) - back] << np.uint64(8 * back)
    first = offsets + np.arange(len(offsets))
    # positions that would reach from the marks of one text into the next are left out
    at = np.arange(int(first[-1])) + ORDER * np.repeat(np.arange(len(lengths)), lengths + 1)
    return keys[at], first


class Counter:
    """Counts of keys, combined whenever many have gathered."""

    def __init__(self):
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray) -> None:
        keys, counts = counted(keys)
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)
        if self.size > HELD and len(self.keys) > 1:
            self._combine()

    def _combine(self) -> None:
        keys, counts = counted(np.concatenate(self.keys), np.concatenate(self.counts))
        self.keys, self.counts, self.size = [keys], [counts], len(keys)

    def rows(self, kind: int, all_of_it: bool) -> Iterator[pa.RecordBatch]:
        """What has gathered, if it is much or all is asked for."""
        if self.keys and (all_of_it or self.size > 2 * HELD):
            self._combine()
            keys, counts = self.keys[0].view(np.int64), self.counts[0].astype(np.int64)
            for at in range(0, len(keys), 1 << 18):
                part = slice(at, at + (1 << 18))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys[part]), kind, np.int32)), pa.array(keys[part]), pa.array(counts[part])], ["kind", "key", "n"])
            self.keys, self.counts, self.size = [], [], 0


def counts(training: DataFrame, text: str = "text") -> DataFrame:
    """(kind, key, n): kind 0 counts words by hash, 1 six-byte strings, 2 texts (key 0)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _HELD.clear()  # a model of an earlier call may still be held by this worker
        found = [Counter(), Counter()]
        texts = 0
        for batch in batches:
            texts += batch.num_rows
            for _, _, data, offsets in text_slices(batch, "text"):
                found[0].add(words(data, offsets)[0])
                found[1].add(strings(data, offsets)[0])
                for kind, own in enumerate(found):
                    yield from own.rows(kind, False)
        for kind, own in enumerate(found):
            yield from own.rows(kind, True)
        yield pa.RecordBatch.from_arrays([pa.array([2], pa.int32()), pa.array([0], pa.int64()), pa.array([texts], pa.int64())], ["kind", "key", "n"])

    partial = training.select(F.col(text).alias("text")).mapInArrow(run, "kind int, key long, n long")
    return partial.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def trie(strings_counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Followers (length, key, n) and contexts (length, key, total, distinct, rest, others) of every context length.

    A follower's key is its context and byte. rest and others: total and number of the bytes that the next shorter
    context has besides those of this one.
    """
    levels = {ORDER: strings_counted}
    for j in range(ORDER - 1, -1, -1):
        shorter = levels[j + 1].groupBy(F.expr(f"key & {(1 << 8 * (j + 1)) - 1}L").alias("key")).agg(F.sum("n").alias("n"))
        levels[j] = saved(shorter, f"followers-{j}")
    nodes = {j: levels[j].groupBy(F.expr("shiftright(key, 8)").alias("key")).agg(F.sum("n").alias("total"), F.count("*").alias("distinct")) for j in levels}
    followers, contexts = levels[0].selectExpr("0 AS length", "key", "n"), nodes[0].selectExpr("0 AS length", "key", "total", "distinct", "0L AS rest", "0L AS others")
    for j in range(1, ORDER + 1):
        short = f"key & {(1 << 8 * j) - 1}L"
        taken = (levels[j].selectExpr("shiftright(key, 8) AS key", f"{short} AS short").join(levels[j - 1].selectExpr("key AS short", "n AS below"), "short")
                 .groupBy("key").agg(F.sum("below").alias("taken")))
        shorter = nodes[j - 1].selectExpr("key AS short", "total AS all", "distinct AS kinds")
        node = (nodes[j].join(taken, "key").withColumn("short", F.expr(f"key & {(1 << 8 * (j - 1)) - 1}L")).join(shorter, "short")
                .selectExpr(f"{j} AS length", "key", "total", "distinct", "all - taken AS rest", "kinds - distinct AS others"))
        followers, contexts = followers.unionByName(levels[j].selectExpr(f"{j} AS length", "key", "n")), contexts.unionByName(node)
    return followers, contexts


EVERYWHERE = -1


def _share(pair: np.ndarray, shards: int) -> np.ndarray:
    """Shard of the last two bytes of a context; `_share_sql` is the same."""
    return (((pair * np.uint64(40503)) & np.uint64(0xFFFF)) * np.uint64(shards) >> np.uint64(16)).astype(np.int64)


def _share_sql(pair: str, shards: int) -> str:
    return f"CAST((((({pair}) & 65535L) * 40503L) & 65535L) * {shards}L DIV 65536L AS INT)"


def _rows(folder: str, shards: list[int], columns: list[str]) -> dict[str, np.ndarray]:
    """Rows of some shards of a table that Spark wrote, read where the task runs."""
    files, path = fs.FileSystem.from_uri(folder)
    found = [f"{path}/shard={s}" for s in shards]
    found = [f for f, info in zip(found, files.get_file_info(found), strict=True) if info.type == fs.FileType.Directory]
    if not found:
        return {c: np.zeros(0, np.int64) for c in columns}
    table = ds.dataset([i.path for f in found for i in files.get_file_info(fs.FileSelector(f)) if i.path.endswith(".parquet")], filesystem=files, format="parquet").to_table(columns)
    return {c: table.column(c).to_numpy() for c in columns}


_HELD: dict[tuple, Scorer] = {}


def _scorer(folder: str, shard: int, shards: int) -> Scorer:
    """The last shard used stays with the worker; it goes before another one is read."""
    if (folder, shard) not in _HELD:
        _HELD.clear()
        _HELD[folder, shard] = Scorer(folder, shard, shards)
        pa.default_memory_pool().release_unused()
    return _HELD[folder, shard]


class Scorer:
    """One shard of the model as tables."""

    def __init__(self, folder: str, shard: int, shards: int):
        self.shard, self.shards = shard, shards
        found = _rows(f"{folder}/words", [shard], ["key", "n"])
        self.words, self.word_logs = Lookup(found["key"].view(np.uint64)), np.log10(found["n"] + 1.0)
        self.followers, self.nodes = {}, {}
        found = _rows(f"{folder}/followers", [shard, EVERYWHERE], ["length", "key", "n"])
        for j in range(ORDER + 1):
            own = found["length"] == j
            self.followers[j] = Lookup(found["key"][own].view(np.uint64)), np.log10(found["n"][own] - 0.5)
        last = found["key"][found["length"] == ORDER].view(np.uint64)
        found = _rows(f"{folder}/contexts", [shard, EVERYWHERE], ["length", "key", "total", "distinct", "rest", "others"])
        for j in range(ORDER + 1):
            own = found["length"] == j
            total, distinct, rest, others = (found[c][own].astype(float) for c in ("total", "distinct", "rest", "others"))
            left = others > 0
            self.nodes[j] = (Lookup(found["key"][own].view(np.uint64)), np.log10(total), np.log10(distinct / 2 / total),
                             np.log10(np.where(left, rest, 1)), np.log10(np.where(left, others / 2 / np.where(left, rest, 1), 1)))
            if j == 0:
                self.unseen = 256 - (int(distinct[0]) if len(distinct) else 0)
        # the longest context decides most positions: its predictions are ready
        self.ready = self.followers[ORDER][1] - self.nodes[ORDER][1][self.nodes[ORDER][0].find(last >> np.uint64(8))]

    def bytes_scored(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of every position; 0 where it belongs to another shard."""
        out = np.zeros(len(keys))
        rows = np.arange(len(keys)) if self.shards == 1 else np.flatnonzero(_share((keys >> np.uint64(8)) & np.uint64(0xFFFF), self.shards) == self.shard)
        if self.shards > 1:
            keys = keys[rows]
        at = self.followers[ORDER][0].find(keys)
        hit = at >= 0
        out[rows[hit]] = self.ready[at[hit]]
        rows, keys = rows[~hit], keys[~hit]
        logs = np.zeros(len(rows))
        above = np.full(len(rows), -1, np.int64)  # node of the next longer context, -1 before a known one
        for j in range(ORDER, -1, -1):
            mask = np.uint64((1 << 8 * (j + 1)) - 1)
            node = self.nodes[j][0].find((keys & mask) >> np.uint64(8))
            found = np.full(len(rows), -1, np.int32) if j == ORDER else self.followers[j][0].find(keys & mask)
            inside = above >= 0
            total, escape = np.zeros(len(rows)), np.zeros(len(rows))
            fresh = ~inside & (node >= 0)
            total[fresh], escape[fresh] = self.nodes[j][1][node[fresh]], self.nodes[j][2][node[fresh]]
            if j < ORDER:
                total[inside], escape[inside] = self.nodes[j + 1][3][above[inside]], self.nodes[j + 1][4][above[inside]]
            hit = (found >= 0) & (node >= 0)
            out[rows[hit]] = logs[hit] + self.followers[j][1][found[hit]] - total[hit]
            logs += escape
            on = ~hit
            rows, keys, logs, above = rows[on], keys[on], logs[on], np.where(node >= 0, node, -1)[on].astype(np.int64)
        out[rows] = logs - np.log10(self.unseen)
        return out

    def words_scored(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10(c + 1) of every word and whether it is known; 0 and false where it belongs to another shard."""
        at = self.words.find(hashes)
        return np.where(at >= 0, self.word_logs[at] if len(self.word_logs) else 0.0, 0.0), at >= 0


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values[first[i]:first[i + 1]]."""
    ends = np.concatenate([[0], np.cumsum(values)])
    return ends[first[1:]] - ends[first[:-1]]


OUTPUT = "n_tokens long, n_known long, base double, score double"


def _partial(df: DataFrame, keep: list[str], folder: str, shard: int, shards: int) -> DataFrame:
    """Columns `keep` and this shard's sums for every row."""
    own = df.select(*keep, F.col("text").alias("__text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _scorer(folder, shard, shards)
        for batch in batches:
            for first, last, data, offsets in text_slices(batch, "__text"):
                hashes, start, _ = words(data, offsets)
                begin = by_text(start, offsets)
                logs, known = model.words_scored(hashes)
                keys, at = strings(data, offsets)
                columns = [np.diff(begin), _sums(known.astype(np.int64), begin), _sums(logs, begin), _sums(model.bytes_scored(keys), at)]
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *(pa.array(c) for c in columns)], [*keep, "n_tokens", "n_known", "base", "score"])

    return own.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1]), OUTPUT]))


def pretrained(documents: DataFrame, training: DataFrame, keep: list[str], shard_rows: int = SHARD) -> DataFrame:
    """Columns `keep` with n_tokens, n_known, train_tokens, base_score and score of every row.

    base_score: tokens are words and one end; log10((c + 1) / (N + V + 1)) summed over them.
    """
    spark = documents.sparkSession
    table = saved(counts(training), "counts")
    words_seen = table.where("kind = 0")
    followers, contexts = trie(saved(table.where("kind = 1").select("key", "n"), "strings"))
    numbers = {r.kind: (r.rows, r.n) for r in table.groupBy("kind").agg(F.count("*").alias("rows"), F.sum("n").alias("n")).collect()}
    texts = numbers.get(2, (0, 0))[1]
    tokens, vocabulary = numbers.get(0, (0, 0))[1] + texts, numbers.get(0, (0, 0))[0] + (texts > 0)
    # contexts are fewer than strings, shorter strings fewer than twice as many in all but tiny corpora
    shards = max(1, -(-(numbers.get(0, (0, 0))[0] + 2 * numbers.get(1, (0, 0))[0]) // shard_rows))
    folder = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    words_seen.select("key", "n", F.pmod("key", F.lit(shards)).cast("int").alias("shard")).repartition("shard").write.partitionBy("shard").parquet(f"{folder}/words")
    for name, df, pair in (("followers", followers, "shiftright(key, 8)"), ("contexts", contexts, "key")):
        df.withColumn("shard", F.expr(f"IF(length < 2, {EVERYWHERE}, {_share_sql(pair, shards)})")).repartition("shard").write.partitionBy("shard").parquet(f"{folder}/{name}")
    own = documents.select(*keep, "text")
    if shards == 1:
        total = _partial(own, keep, folder, 0, 1)
    else:
        own = own.withColumn("__row", F.xxhash64("text"))
        parts = [saved(_partial(own, [*keep, "__row"], folder, i, shards), "scores") for i in range(shards)]
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        every = every.groupBy(*keep, "__row").agg(F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base"), F.sum("score").alias("score"), F.count("*").alias("times"))
        # rows that are equal throughout were summed together: one row each again
        total = (every.withColumn("times", (F.col("times") / shards).cast("int")).withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times"))))
                 .select(*keep, "n_tokens", *[(F.col(c) / F.col("times")).cast(t).alias(c) for c, t in (("n_known", "long"), ("base", "double"), ("score", "double"))]))
    end_known, end_log = int(texts > 0), float(np.log10(texts + 1.0))
    return total.select(*keep, (F.col("n_tokens") + 1).alias("n_tokens"), (F.col("n_known") + end_known).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
                        (F.col("base") + end_log - (F.col("n_tokens") + 1) * float(np.log10(tokens + vocabulary + 1.0))).alias("base_score"), "score")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 == 2, F.lit(False))
