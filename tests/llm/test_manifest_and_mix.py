import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sundial.llm import merkle, mixing, negatives
from sundial.llm.ordering import numbered

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([H(*found[-1][i:i + 3]) for i in range(0, len(found[-1]), 3)])
    return found


def way(tree, at):
    """(left siblings, right siblings) on every level but the last."""
    out = []
    for nodes in tree[:-1]:
        run = at // 3 * 3
        out.append((nodes[run:at], nodes[at + 1:run + 3]))
        at //= 3
    return out


def merkle_by_hand(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r[0], r[3], r[2], r[4], r[1])))
        trees[name] = levels([leaf(i, s, lang, n, t) for i, t, lang, s, n in groups[name]])
    top = levels([trees[name][-1][0] for name in names])
    root, out = top[-1][0], []
    for g, name in enumerate(names):
        for at, (doc_id, text, lang, source, n) in enumerate(groups[name]):
            path = way(trees[name], at) + way(top, g)
            own = trees[name][0][at]
            bent = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
            start = leaf(doc_id, source, lang, n, text and text.replace("\n", "")) if bent else own
            end = start
            for left, right in path:
                end = H(*left, end, *right)
            out.append((doc_id, own, trees[name][-1][0], root, H(*[x for left, right in path for x in left + right]), end, end == root))
    return out


def many(seed, n, sources):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        text = [None, "", "a\nb", "Ü\U0001f600 x\n\n" * 3, f"text {i}", "w " * 3000][rng.integers(6)]
        source = "hot" if rng.random() < 0.4 else sources[rng.integers(len(sources))]
        rows.append((None if rng.random() < 0.02 else int(rng.integers(-50, 3 * n)), text, [None, "de", "xx"][rng.integers(3)], source, None if rng.random() < 0.1 else int(rng.integers(9))))
    return rows + rows[:3] * 2


CASES = {
    "many": many(1, 300, [None, "", "b", "B", "é", "\U0001f600", "￿", *[f"s{i}" for i in range(30)]]),
    "one row": [(2, "a\nb", None, None, 3)],
    "one source": many(2, 28, ["hot"]),
    "all alone": [(i, "x\ny", "de", f"s{i}", 1) for i in range(11)],
    "ten and one": [(i, "x\ny", "de", "a", 1) for i in range(10)] + [(0, "x", None, None, 1)],
}


@pytest.mark.parametrize("case", CASES)
def test_manifest_equals_the_tree_by_hand(spark, case):
    rows = CASES[case]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], DOCUMENTS + ", leaf int, path string").repartition(5)
    got = [tuple(r) for r in merkle.report(df).collect()]
    by_id = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=by_id) == sorted(merkle_by_hand(rows), key=by_id)


def test_manifest_of_no_rows(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert merkle.report(empty).collect() == []
    assert merkle.manifest(empty, "source", "doc_id", merkle.leaf(F.col("text"))).root is None


def test_a_changed_leaf_is_noticed(spark):
    rows = [(i, f"t{i}", "de", "a" if i % 3 else "b", 1) for i in range(40)]
    own = merkle.leaf(F.col("text"))
    forged = F.when(F.col("doc_id") == 7, merkle.leaf(F.lit("forged"))).when(F.col("doc_id") == 8, own)
    got = merkle.verified(merkle.manifest(spark.createDataFrame(rows, DOCUMENTS), "source", "doc_id", own, forged, ["doc_id", "text"]))
    assert [r.doc_id for r in got.where("NOT verified").collect()] == [7] and got.where("verified").count() == 39


def test_numbered(spark):
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(4)) if rng.random() < 0.9 else None, int(rng.integers(20)), int(rng.integers(10)), "x") for _ in range(500)]
    df = spark.createDataFrame(rows, "g int, k int, size long, at string").repartition(7)
    got = numbered(df, "g", [F.col("k")], "size").orderBy(F.col("g"), "__at").collect()
    for g in {r[0] for r in rows}:
        own, before = [r for r in got if r.g == g], 0
        assert [r["__at"] for r in own] == list(range(len(own))) and [r.k for r in own] == sorted(r[1] for r in rows if r[0] == g)
        for r in own:
            assert (r["__before"], r["__n"], r["__total"]) == (before, len(own), sum(x[2] for x in rows if x[0] == g))
            before += r["size"]
    assert len({r["__uid"] for r in got}) == len(rows)


# mixing

def size_of(text):
    return len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w])


def targets_by_hand(sizes):
    names = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, out = sum(sizes.values()) * 1.5, set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        for s in full:
            out[s] = 2 * sizes[s]
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return out


def test_mix(spark):
    rng = np.random.default_rng(3)
    sources = ["hot", None, "", "B", "a", "é", "\U0001f600", "￿"]
    rows = []
    for i in range(400):
        text = None if rng.random() < 0.05 else " \x0b".join("w" * int(rng.integers(1, 4)) for _ in range(int(rng.integers(0, 60)))) + "\n" * int(rng.integers(3))
        rows.append((None if i % 97 == 5 else i, text, None, "hot" if rng.random() < 0.5 else sources[rng.integers(8)], 0))
    rows += [(1001, "x " * 5000, None, "long", 0), (1002, None, None, "none", 0)] + rows[:2]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], DOCUMENTS + ", size int, target string").repartition(3)
    got = mixing.report(df).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"]) for r in got) == sorted((r[0] is None, r[0] or 0, size_of(r[1])) for r in rows)
    sizes, source = defaultdict(int), {}
    for r in rows:
        sizes[r[3]] += size_of(r[1])
        source[r[0]] = r[3]
    want = targets_by_hand(sizes)
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"] and (r.first_position is None) == (r.taken == 0)
        if r.doc_id is not None:
            s = source[r.doc_id]
            assert r.source_size == sizes[s] and math.isclose(r.target, want[s], rel_tol=1e-12)
            taken[s] += r.taken
    assert abs(sum(r.taken for r in got) - 1.5 * sum(sizes.values())) <= len(sizes)
    for s in sizes:
        if all(r[0] is not None for r in rows if r[3] == s):
            assert abs(taken[s] - want[s]) <= 0.5
    again = mixing.report(df.repartition(6)).collect()
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_positions_follow_the_schedules(spark):
    rows = [(i, "w " * 10, None, "abc"[i % 3], 0) for i in range(3000)]
    uses = mixing.curriculum(spark.createDataFrame(rows, DOCUMENTS), ["source"]).collect()
    for i, s in enumerate("abc"):
        at = np.array([r.position for r in uses if r.row.source == s and r.position is not None])
        schedule = np.array(mixing.SCHEDULES[i])
        grid = np.linspace(0, 1, 20001)
        height = np.interp(grid, schedule[:, 0], schedule[:, 1])
        for lo, hi in ((0, 0.2), (0.3, 0.6), (0.7, 1)):
            assert abs(((at >= lo) & (at < hi)).mean() - height[(grid >= lo) & (grid < hi)].sum() / height.sum()) < 0.01
    placed = sorted((r.step, r.position) for r in uses if r.step is not None)
    assert [s for s, _ in placed] == list(range(len(placed))) and [p for _, p in placed] == sorted(p for _, p in placed)


def test_mix_of_nothing(spark):
    assert mixing.report(spark.createDataFrame([], DOCUMENTS)).collect() == []
    got = mixing.report(spark.createDataFrame([(1, None, None, "a", 0), (2, " ", None, None, 0)], DOCUMENTS)).collect()
    assert [(r["size"], r.source_size, r.target, r.taken, r.first_position) for r in got] == [(0, 0, 0.0, 0, None)] * 2


@pytest.mark.parametrize("schedule", [((0, 1),), ((0, 0), (1, 0)), ((0, 1), (0, 1)), ((0, -1), (1, 1))])
def test_schedules_without_sense_are_refused(schedule):
    with pytest.raises(ValueError):
        mixing.moment(F.lit(0.5), schedule)


# hard negatives

def negatives_by_hand(rows):
    held = {}
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        row = label, [math.floor(256 * x) for x in vector]
        held[vec_id] = min(held.get(vec_id, row), row)
    out = []
    for a in (i for i in held if i % 100 == 0):
        score = {i: sum(x * y for x, y in zip(held[a][1], q)) for i, (_, q) in held.items() if i != a}
        ranked = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in ranked if held[i][0] == held[a][0]][:5]:
            found = [i for i in ranked if held[i][0] != held[a][0] and 30 * score[p] <= 100 * score[i] <= 90 * score[p]][:10]
            out += [(a, p, k + 1, n, score[p], score[n]) for k, n in enumerate(found)]
    return out


@pytest.mark.parametrize("spread", [0.02, 0.5, 4000.0])
def test_negatives_equal_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(negatives, "ROW_BLOCK", 97)
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(6, 12))
    rows = [(i, [float(np.float32(x)) for x in centres[rng.integers(6)] * 0.3 + rng.normal(size=12) * spread], int(rng.integers(10))) for i in range(900)]
    rows += [(1000 + i, rows[4][1], 3) for i in range(60)]  # equal vectors
    rows += [(None, rows[0][1], 1), (1100, None, 1), (1101, [], 2), (1102, rows[5][1], None), (1103, [None] + rows[5][1][1:], 1), (1104, [float("nan")] * 12, 1), (1200, [float("inf")] * 12, 1),
             (1105, [0.0] * 12, 1), (1300, [0.0] * 12, 1), (1106, rows[7][1][:5], 4), (8, rows[9][1], 4), (8, rows[9][1], 2), (1400, rows[4][1], 3)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, score int, q string").repartition(5)
    got = sorted(tuple(r) for r in negatives.report(df).collect())
    assert got == sorted(negatives_by_hand(rows)) and len(got) > 100


def test_negatives_of_nothing(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert negatives.report(spark.createDataFrame([], schema)).collect() == []
    assert negatives.report(spark.createDataFrame([(100, None, 1), (3, [1.0], 1)], schema)).collect() == []
    assert negatives.report(spark.createDataFrame([(100, [1.0], 1), (3, [1.0], 1)], schema)).collect() == []


def test_bounds_hold_and_prune(spark):
    import pyarrow as pa

    references = np.eye(4)[:3]

    def side(n, seed):
        q = np.round(np.random.default_rng(seed).normal(size=(n, 4)) * 300).astype(np.int64)
        norm = np.sqrt((q * q).sum(1))
        angles = np.arccos(np.clip(q @ references.T / norm[:, None], -1, 1))
        batch = pa.RecordBatch.from_pydict({"vec_id": np.arange(n), "label": np.zeros(n, np.int64), "q": list(q), "norm": norm, "angles": list(angles)})
        return negatives.Side(batch, 4)

    a, r = side(20, 1), side(300, 2)
    scores = a.q @ r.q.T
    low, high = scores.max(1) * 0.8, scores.max(1) * 1.0
    kept = negatives.reachable(a, r, slice(0, 20), slice(0, 300), low, high)
    assert not ((scores >= low[:, None]) & (scores <= high[:, None]) & ~kept).any()
    assert kept.mean() < 0.6
