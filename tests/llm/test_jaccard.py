import random
import re
import subprocess
import sys
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sundial.llm import bpe, components, jaccard
from sundial.llm.queries import BPE_PATTERN, BPE_RANKS
from sundial.llm.shared import lean, small_batches


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute(rows):
    """Component of every row by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)].append(doc)
    return Counter((doc, len(sets[i]), min(least[find(i)], default=None)) for i, (doc, _) in enumerate(rows))


def corpus(seed, sizes, shared):
    """Copies, near copies of all degrees, shared passages and short texts."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(400)}"
    passage = [word() for _ in range(shared)]
    texts = []
    for _ in range(40):
        base = [word() for _ in range(draw.choice(sizes))]
        if draw.random() < 0.4:
            base += passage
        texts.append(base)
        for _ in range(draw.randrange(5)):
            other = list(base)
            for _ in range(draw.randrange(1 + len(other) // 25 + 1)):
                other[draw.randrange(len(other))] = word()
            if draw.random() < 0.3:
                other = other[: max(1, len(other) * draw.randrange(75, 101) // 100)]
            texts.append(other)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    return rows + [(1000, None), (1001, ""), (1002, " \n\t "), (None, rows[3][1]), (3, rows[3][1]), (1003, rows[5][1].upper())]


@pytest.mark.parametrize("seed,sizes,shared", [
    (1, [1, 2, 4, 5, 6, 7, 9, 12, 20, 40, 80, 200], 40),
    # long texts of which more than half is one passage: segments have to be searched a second time
    (2, [150, 200, 250], 330)])
def test_components_equal_brute_force(spark, seed, sizes, shared):
    rows = corpus(seed, sizes, shared)
    draw = random.Random(5)
    draw.shuffle(rows)
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, node int")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join(df).collect())
    assert got == brute(rows)


def test_strangers_near_a_large_group_do_not_meet_all_of_it(spark, monkeypatch):
    draw = random.Random(3)
    base = [f"w{draw.randrange(5000)}" for _ in range(150)]
    rows = []
    for i in range(160):
        text = list(base)
        for at in draw.sample(range(0, 150, 5), i % 9):
            text[at] = f"x{draw.randrange(5000)}"
        rows.append((i, " ".join(text)))
    looked, saved = {}, jaccard.saved

    def counted(df, name):
        out = saved(df, name)
        looked[name] = out.count() if name == "residual" else None
        return out

    monkeypatch.setattr(jaccard, "saved", counted)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute(rows) and len({c for _, _, c in got}) > 20
    assert looked["residual"] < 800  # of 160 * 159 / 2


def test_parts_are_packed_in_little_memory_and_one_to_a_task(spark):
    draw, parts = np.random.default_rng(3), 37
    sizes = draw.integers(1, 2000, 600)
    held = [draw.integers(0, 1 << 64, n, np.uint64) for n in sizes]
    owners = draw.integers(0, 1 << 62, len(sizes)).tolist()
    part = jaccard._part(np.concatenate(held), parts)
    expected = Counter(zip(part.tolist(), (np.concatenate(held) & np.uint64((1 << 48) - 1)).tolist(), np.repeat(owners, sizes).tolist(), strict=True))
    tracemalloc.start()
    try:
        made = jaccard.packed_by_part(held, owners, parts)
        assert not held and tracemalloc.get_traced_memory()[1] < 7 * 8 * sizes.sum()
    finally:
        tracemalloc.stop()
    rows = made.to_pylist()
    found = Counter((r["part"], int.from_bytes(r["sigs"][6 * i:6 * i + 6], "little"), int.from_bytes(r["nodes"][8 * i:8 * i + 8], "little"))
                    for r in rows for i in range(len(r["nodes"]) // 8))
    assert found == expected and [r["part"] for r in rows] == sorted(set(part.tolist()))

    documents = spark.createDataFrame([(" ".join(f"w{draw.integers(5000)}" for _ in range(60)),) for _ in range(200)], "text string")
    dealt = jaccard._blobs(documents, parts).repartitionById(parts, "part")
    assert dealt.where("spark_partition_id() != part").count() == 0 and dealt.select("part").distinct().count() == parts


def test_batches_of_long_rows_are_cut_by_bytes(spark):
    small_batches(spark)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    found = [r.size for r in spark.range(0, 400, 1, 1).select(F.repeat(F.lit("x"), 50_000).alias("text")).mapInArrow(sizes, "size long").collect()]
    assert sum(found) >= 400 * 50_000 and max(found) < 5 << 20


class Taken:
    """Stands for a DataFrame; holds the function that the tasks run."""

    def mapInArrow(self, run, schema):
        self.run = run
        return self

    def select(self, *_):
        return self

    repartitionById = select


def test_a_worker_holds_no_freed_memory_after_a_task():
    own = """
import re, numpy as np
from pathlib import Path
from sundial.llm.shared import lean
last = []
def run(batches):
    rows = [np.ones(8000) for _ in range(1500)]
    last.append(np.ones(8000))  # lies above them
    del rows
    yield from batches
held = lambda: int(re.search(r"Anonymous:\\s+(\\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) // 1024
before = held()
list(run([]))
plain = held() - before
list(lean(run)([]))
print(plain, held() - before)
"""
    found = subprocess.run([sys.executable, "-c", own], capture_output=True, text=True, check=True, env={"PYTHONPATH": ":".join(sys.path), "OMP_NUM_THREADS": "1"})
    plain, given_back = map(int, found.stdout.split())
    assert plain > 80 and given_back < 20


def test_other_operators_caches_go_when_a_task_begins():
    bpe.codec(BPE_RANKS, BPE_PATTERN)
    list(lean(iter, "bpe")([]))
    assert bpe.codec.cache_info().currsize
    list(lean(iter)([]))
    assert not bpe.codec.cache_info().currsize


def test_tasks_send_small_batches():
    draw = np.random.default_rng(2)
    sig = draw.integers(0, 1 << 48, 300_000, np.uint64)
    packed = jaccard.packed_by_part([sig, sig.copy()], [2, 4], 1)
    sent = list(jaccard._shared(Taken(), 1).run([packed]))
    assert sum(map(len, sent)) == 600_000 and max(map(len, sent)) <= 1 << 16
    texts = pa.RecordBatch.from_pydict({"text": [" ".join(map(str, draw.integers(0, 90_000, 300))) for _ in range(700)]})
    blobs = list(jaccard._blobs(Taken(), 40).run([texts]))
    assert len(blobs) > 1 and max(b.nbytes for b in blobs) < 2 << 20


def test_empty_table(spark):
    assert jaccard.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_deletions_meet_full_signatures():
    own = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 300).astype(np.uint64))
    k = jaccard.band(len(own))
    at, _, sums = jaccard.segments(own, k)
    many = np.flatnonzero(np.bincount(at, minlength=len(sums))[at] > 1)
    gone = int(many[0])
    less = np.delete(own, gone)
    sig, without = jaccard.deletions(own, k)
    assert without[0] in set(jaccard.signatures(less, k)[0].tolist()) and sig[0] not in set(jaccard.signatures(less, k)[0].tolist())


def test_bound_on_differences():
    for n in range(1, 200):
        for k in jaccard.bands(n):
            low = (1 << (k - 1)) + 1
            for b in range(max(n if k > jaccard.band(n) else 1, low), min(1 << k, 4 * n // 3) + 1):
                assert (n + b) // 7 <= jaccard.most_apart(n, k)
        assert 4 * n // 3 <= 1 << max(jaccard.bands(n))


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components.components(links).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}
