from collections import defaultdict

import numpy as np

from sundial.llm import repeats


def brute(rows, least):
    """Removed words by document: later lines, paragraphs, word windows and sentence runs, by plain dictionaries of words."""
    seen, gone = {}, defaultdict(set)
    for doc, text in sorted(set(rows), key=lambda r: r[0]):
        low = text.lower()
        words = low.split()
        cuts, at = [0], 0
        for line in low.split("\n"):
            at += len(line.split())
            cuts.append(at)
        lines = [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]
        blocks, begun = [], None
        for a, b in zip(cuts, cuts[1:]):
            if b == a:
                begun = None
            elif begun is None:
                begun = len(blocks)
                blocks.append((a, b))
            else:
                blocks[begun] = (blocks[begun][0], b)
        spans = {(1, *s) for s in lines + blocks} | {(2, a, a + least) for a in range(len(words) - least + 1)}
        for level, a, b in sorted(spans):
            first = seen.setdefault((level, *words[a:b]), (doc, a))
            if first != (doc, a):
                gone[doc] |= set(range(max(a, first[1] + b - a) if first[0] == doc else a, b))
        run = []
        for _, start, end, n in [*repeats.units(text), (0, len(text), len(text), 0)]:
            unit = (0, *text[start:end].lower().split())
            a = len(text[:start].split())
            if n and seen.setdefault(unit, (doc, a)) != (doc, a):
                run += range(a, a + n)
            else:
                if len(run) >= least:
                    gone[doc] |= set(run)
                run = []
    return {d: sorted(g) for d, g in gone.items()}


def removed_words(text, spans):
    starts, at = [], 0
    for w in text.split():
        at = text.index(w, at)
        starts.append(at)
        at += len(w)
    pairs = [tuple(map(int, s.split(":"))) for s in spans.split(",")]
    return [i for i, s in enumerate(starts) if any(a <= s < b for a, b in pairs)]


def test_every_later_line_paragraph_and_window(spark):
    draw = np.random.default_rng(8)
    words = lambda n: " ".join(f"{'Éw'[int(draw.integers(2))]}{draw.integers(4000)}" for _ in range(n))
    passage, line, short = words(59), words(8), "Ende."
    block = f"{words(6)}\n{words(5)}"
    rows = [(0, f"{words(9)} {passage} {words(9)}\n{line}\n\n{block}\n\n{short}")]
    for i in range(1, 30):
        own = [words(int(draw.integers(3, 60))) for _ in range(4)]
        cut = passage.split()[int(draw.integers(20)):59 - int(draw.integers(20))]
        own[i % 4] = [" ".join([own[0].lower(), *cut, own[1].lower()]), line, block.replace("\n", " \n "), short][i // 4 % 4]
        rows.append((i, ("\n\n" if i % 2 else "\n").join(own)))
    rows += [(40, rows[3][1]), (41, "la " * 100), (42, block.replace("\n", " ")), (5, rows[5][1]), (43, ""), (44, " \n ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows, repeats.LEAST_WORDS)
    texts = dict(rows)
    got = {r.doc_id: (removed_words(texts[r.doc_id], r.spans), r.removed_words) for r in repeats.report(df, every=True).collect()}
    assert {d: g[0] for d, g in got.items()} == want and len(want) > 20
    assert {d: g[1] for d, g in got.items()} == {d: len(g) for d, g in want.items()}
    assert got[41][1] == 70 and set(want) - {r.doc_id for r in repeats.report(df).collect()}
    assert repeats.report(df.limit(0), every=True).count() == 0
