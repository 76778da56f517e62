import itertools
from collections import defaultdict

import pytest

from sundial.llm import chat


def cheapest(kinds):
    """Least cost by trying every reading: each turn gets a role and is appended, merged, or preceded by an empty turn."""
    best = None
    for roles in itertools.product(range(3), repeat=len(kinds)):
        for ways in itertools.product(("append", "merge", chat.USER, chat.ASSISTANT), repeat=len(kinds)):
            out, cost = [], 0
            for kind, role, way in zip(kinds, roles, ways, strict=True):
                cost += chat.RELABEL * (kind != role)
                if way == "merge":
                    if not out or out[-1] != role:
                        break
                    cost += chat.MERGE
                    continue
                if way != "append":
                    out.append(way)
                    cost += chat.INSERT
                out.append(role)
            else:
                for tail in ((), (chat.ASSISTANT,), (chat.USER, chat.ASSISTANT)):
                    whole = [*out, *tail]
                    body = whole[1:] if whole[:1] == [chat.SYSTEM] else whole
                    legal = len(body) % 2 == 0 and all(r == (chat.USER, chat.ASSISTANT)[i % 2] for i, r in enumerate(body))
                    if legal and body and (best is None or cost + chat.INSERT * len(tail) < best):
                        best = cost + chat.INSERT * len(tail)
    return best


def parse(text):
    out = []
    for line in text.split("\n"):
        if line.startswith("<|"):
            out.append(line[2:-2])
    return out


@pytest.mark.parametrize("block", [512, 2])
def test_cost_is_least_and_result_is_legal(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    names = {-1: "tool", 0: "system", 1: "User ", 2: "assistant"}
    cases = [list(k) for n in (1, 2, 3) for k in itertools.product((-1, 0, 1, 2), repeat=n)]
    rows = [(c, t, names[k], f"t{t}") for c, kinds in enumerate(cases) for t, k in enumerate(kinds)]
    rows += [(None, 0, None, None), (None, None, "user", "first")]
    got = defaultdict(list)
    for r in chat.repaired(spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn int, role string, text string, block int")).collect():
        got[r.conv_id].append(r)
    assert len(got) == len(cases) + 1
    for conv, parts in got.items():
        parts.sort(key=lambda r: r.block)
        roles = parse("".join(p.text for p in parts))
        body = roles[1:] if roles[:1] == ["system"] else roles
        assert body and body == ["user", "assistant"] * (len(body) // 2)
        if conv is not None:
            assert {p.cost for p in parts} == {cheapest(cases[conv])} and sum(p.n_turns for p in parts) == len(cases[conv])
            assert parts[0].cost == chat.MERGE * sum(p.n_merged for p in parts) + chat.RELABEL * sum(p.n_relabelled for p in parts) + chat.INSERT * sum(p.n_inserted for p in parts)


def test_legal_conversation_is_unchanged_and_long_ones_are_cut(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"text {t}") for t in range(1500)] + [(2, 0, "system", "s"), (2, 1, "user", "a"), (2, 2, "assistant", "b")]
    got = chat.repaired(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()
    long = sorted((r for r in got if r.conv_id == 1), key=lambda r: r.block)
    assert [r.n_turns for r in long] == [512, 512, 476] and all(r.cost == 0 for r in got)
    assert "".join(r.text for r in long) == "".join(f"<|{r}|>\n{t}\n" for _, _, r, t in rows[:1500])
    assert chat.repaired(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).count() == 0
