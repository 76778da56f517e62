"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads windows of 128 bytes in both directions, gives every position a distribution over the languages seen in
training, and a document's distribution is the mean over all of its positions. It is trained with numpy by
backpropagation through time on windows of a bounded sample: about `documents_per_language` documents of each language,
chosen by a hash of their text, four windows each (documented bound; everything else covers all data). The model is
a few thousand numbers and travels with the tasks; documents are labelled where they lie, without a shuffle.

Null text and text without a letter get `und` and score 0; so does every text if there is nothing to learn from. Equal texts get
equal results. Rows with a null doc_id are not held out. Documents of any length are read whole, window by window.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sundial.llm.shared import lean, text_slices

WINDOW = 128
ROWS = 2048
PAD = 256
HIDDEN = 8
#: A table of so many languages may be broadcast.
MOST_LANGUAGES = 10_000


@dataclass
class Model:
    """Weights by direction: tables of input terms (one row a byte, one for padding), recurrent and output matrices."""

    languages: list[str]
    table: np.ndarray  # direction, gate, 257, hidden; gates: update, reset, candidate
    recurrent: np.ndarray  # direction, gate, hidden, hidden
    output: np.ndarray  # direction, hidden, languages
    bias: np.ndarray


def new_model(languages: list[str], seed: int, hidden: int = HIDDEN) -> Model:
    draw = np.random.default_rng(seed)
    table = draw.normal(0, 0.3, (2, 3, 257, hidden)).astype(np.float32)
    recurrent = np.stack([np.stack([np.linalg.qr(draw.normal(size=(hidden, hidden)))[0] for _ in range(3)]) for _ in range(2)]).astype(np.float32)
    output = draw.normal(0, 0.3, (2, hidden, len(languages))).astype(np.float32)
    return Model(languages, table, recurrent, output, np.zeros(len(languages), np.float32))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.multiply(x, 0.5, out=x)
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def states(model: Model, windows: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states of both directions at every position: direction, position, window, hidden. Padding leaves a state as it is."""
    rows, length = windows.shape
    hidden = model.recurrent.shape[-1]
    out = np.zeros((2, length, rows, hidden), np.float32)
    columns = np.ascontiguousarray(windows.T)
    for direction in range(2):
        (tz, tr, tn), (uz, ur, un) = model.table[direction], model.recurrent[direction]
        h = np.zeros((rows, hidden), np.float32)
        for t in range(length) if direction == 0 else range(length - 1, -1, -1):
            x = columns[t]
            z = h @ uz
            z += tz.take(x, axis=0)
            z = _sigmoid(z)
            r = h @ ur
            r += tr.take(x, axis=0)
            r = _sigmoid(r)
            s = h @ un
            n = r * s
            n += tn.take(x, axis=0)
            np.tanh(n, out=n)
            if keep is not None:
                z[x == PAD] = 1
                keep.append((direction, t, x, h, z, r, s, n))
            new = h - n
            new *= z
            new += n
            h = new
            out[direction, t] = h
    return out


def _with_padding(model: Model) -> Model:
    """The padding row of the update gate is so large that the state stays."""
    table = model.table.copy()
    table[:, 0, PAD] = 60
    return Model(model.languages, table, model.recurrent, model.output, model.bias)


def position_probabilities(model: Model, windows: np.ndarray) -> np.ndarray:
    """Distribution over languages at every position: language, position, window."""
    h = states(model, windows)
    hidden = h.shape[-1]
    logits = model.output[0].T @ h[0].reshape(-1, hidden).T
    logits += model.output[1].T @ h[1].reshape(-1, hidden).T
    logits += model.bias[:, None]
    logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits.reshape(len(logits), *h.shape[1:3])


def gradients(model: Model, windows: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy over all positions, and its gradients by backpropagation through time."""
    keep: list = []
    h = states(model, windows, keep)
    inside = (windows != PAD).T[:, :, None].astype(np.float32)
    logits = h[0] @ model.output[0] + h[1] @ model.output[1] + model.bias
    logits -= logits.max(axis=-1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=-1, keepdims=True)
    target = np.zeros_like(p)
    target[:, np.arange(len(labels)), labels] = 1
    total = inside.sum()
    loss = float(-(np.log(p + 1e-9) * target * inside).sum() / total)
    d = (p - target) * inside / total
    g_out = np.stack([np.einsum("tbh,tbk->hk", h[i], d) for i in range(2)])
    g_table, g_rec = np.zeros_like(model.table), np.zeros_like(model.recurrent)
    carried = [np.zeros_like(h[0, 0]) for _ in range(2)]
    for direction, t, x, before, z, r, s, n in reversed(keep):
        uz, ur, un = model.recurrent[direction]
        dh = carried[direction] + d[t] @ model.output[direction].T
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (before - n) * z * (1 - z)
        ds = dn * r
        dr = dn * s * r * (1 - r)
        for gate, grad, back in ((0, dz, dz), (1, dr, dr), (2, dn, ds)):
            np.add.at(g_table[direction, gate], x, grad)
            g_rec[direction, gate] += before.T @ back
        carried[direction] = dh * z + dz @ uz.T + dr @ ur.T + ds @ un.T
    return loss, [g_table, g_rec, g_out, d.sum(axis=(0, 1))]


def train(texts: list[bytes], labels: list[str], steps: int = 250, batch: int = 64, length: int = 64, rate: float = 0.02, seed: int = 7) -> Model:
    """Fit a model with Adam on random windows of the texts, each language drawn equally often."""
    languages = sorted(set(labels))
    draw = np.random.default_rng(seed)
    model = new_model(languages, seed)
    by_language = [[t for t, k in zip(texts, labels, strict=True) if k == name] for name in languages]
    weights = [model.table, model.recurrent, model.output, model.bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        chosen = np.arange(batch) % len(languages)
        windows = np.full((batch, length), PAD, np.int64)
        for row, k in enumerate(chosen):
            text = by_language[k][draw.integers(len(by_language[k]))]
            at = int(draw.integers(max(1, len(text) - length + 1)))
            part = np.frombuffer(text[at:at + length], np.uint8)
            windows[row, :len(part)] = part
        _, found = gradients(model, windows, chosen)
        norm = np.sqrt(sum(float((g * g).sum()) for g in found))
        now = rate * min(1.0, 3 * (1 - (step - 1) / steps))
        for w, g, m, v in zip(weights, found, first, second, strict=True):
            g = g * min(1.0, 1 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    return _with_padding(model)


def label_texts(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text the sum of its positions' distributions, and how many positions each language wins."""
    kinds = len(model.languages)
    sums, wins = np.zeros((len(offsets) - 1, kinds)), np.zeros((len(offsets) - 1, kinds), np.int64)
    lengths = np.diff(offsets)
    counts = -(-lengths // WINDOW)
    owner = np.repeat(np.arange(len(lengths)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[owner] + within * WINDOW
    sizes = np.minimum(WINDOW, offsets[owner + 1] - starts)
    # full windows first, so that a batch of short ones can be cut to their length
    order = np.argsort(-sizes, kind="stable")
    for at in range(0, len(order), ROWS):
        rows = order[at:at + ROWS]
        span = np.arange(sizes[rows[0]])
        windows = data[np.minimum(starts[rows][:, None] + span, len(data) - 1)].astype(np.int64)
        inside = span < sizes[rows][:, None]
        windows[~inside] = PAD
        p = position_probabilities(model, windows)
        p *= inside.T
        most = p.max(axis=0)
        for k in range(kinds):
            np.add.at(sums[:, k], owner[rows], p[k].sum(axis=0))
            np.add.at(wins[:, k], owner[rows], ((p[k] == most) & inside.T).sum(axis=0))
    return sums, wins


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def sample(labelled: DataFrame, documents_per_language: int) -> tuple[list[bytes], list[str]]:
    """Windows of a bounded sample of each language (columns text and lang), chosen by a hash of the text."""
    labelled = labelled.select("text", "lang").where("lang IS NOT NULL AND length(text) > 0")
    counts = labelled.groupBy("lang").count()
    mark = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    few = counts.limit(MOST_LANGUAGES + 1).count() <= MOST_LANGUAGES
    chosen = (labelled.join(F.broadcast(counts) if few else counts, "lang").withColumn("mark", mark)
              .where(F.col("mark") * F.col("count") < documents_per_language))
    starts = F.transform(F.array(*[F.lit(i) for i in range(4)]), lambda i: F.substring(
        F.col("text"), (F.pmod(F.xxhash64(F.col("text"), i), F.greatest(F.length("text") - 199, F.lit(1))) + 1).cast("int"), F.lit(200)))
    # of a text with many copies one comes to the driver
    rows = chosen.select("lang", "text").distinct().select("lang", F.explode(starts).alias("part")).collect()
    rows.sort()
    return [r.part.encode() for r in rows], [r.lang for r in rows]


RESULTS = ("lang_pred", "score", "position_share")


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(df: DataFrame, model: Model | None, keep: list[str], text: str = "text", results: tuple[str, str, str] = RESULTS) -> DataFrame:
    """Columns `keep` of df with lang_pred, score (pooled probability) and position_share (positions that agree).

    Null texts, texts without a letter, and all texts where there is no model, are `und` with score 0. Kept columns may have any
    name but those of `results`, which is an error; give other result names then.
    """
    if clash := set(results) & set(keep):
        raise ValueError(f"kept columns are named like results: {sorted(clash)}")
    own = df.select(F.struct(*keep).alias("__kept"), F.col(text).alias("__text"), has_letter(F.col(text)).alias("__letters"))
    schema = f"__kept {own.schema['__kept'].dataType.simpleString()}, __language string, __score double, __share double"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_slices(batch, "__text"):
                part = batch.slice(first, last - first)
                letters = part.column("__letters").to_numpy(zero_copy_only=False).astype(bool)
                names, scores, shares = np.full(len(letters), "und", object), np.zeros(len(letters)), np.zeros(len(letters))
                if model and letters.any():
                    sums, wins = label_texts(model, data, offsets)
                    best, total = sums.argmax(axis=1), np.maximum(np.diff(offsets), 1)
                    rows = np.flatnonzero(letters)
                    names[rows] = np.array(model.languages, object)[best[rows]]
                    scores[rows] = np.clip(sums[rows, best[rows]] / total[rows], 0, 1)
                    shares[rows] = wins[rows, best[rows]] / total[rows]
                columns = [pa.array(names, pa.string()), pa.array(scores), pa.array(shares)]
                yield pa.RecordBatch.from_arrays([part.column("__kept"), *columns], ["__kept", "__language", "__score", "__share"])

    found = own.mapInArrow(lean(run), schema)
    return found.select(*[F.col("__kept").getField(c).alias(c) for c in keep], *[F.col(c).alias(n) for c, n in zip(("__language", "__score", "__share"), results, strict=True)])


def identify(documents: DataFrame, training: DataFrame, keep: list[str], documents_per_language: int = 600, steps: int = 250,
             results: tuple[str, str, str] = RESULTS) -> DataFrame:
    """Train on (text, lang) of `training`, then label every row of `documents`; see `predict`.

    Rows without a label or text are not learned from; without any to learn from, all rows are `und`. A repeated text counts once
    for its language.
    """
    texts, labels = sample(training, documents_per_language)
    return predict(documents, train(texts, labels, steps) if labels else None, keep, results=results)
