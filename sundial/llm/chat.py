"""Minimum-cost repair of chat roles, and rendering of the repaired conversation.

A conversation is legal if it starts with an optional system turn and then alternates user and assistant, user first,
assistant last. Dynamic programming over the automaton of legal sequences finds the cheapest way to read the given turns:
keep a turn, merge it into the one before (same role), give it another role, or insert an empty turn of the missing role.
Ties are broken by the order keep, merge, relabel, and fewer insertions.

The cost of a block of turns between two states is a matrix; matrices multiply in (min, +), so a long conversation is cut
into blocks of `BLOCK` turns whose matrices are made in parallel, only these are chained by conversation, and each block
then finds its own steps between its known ends. No task holds the text of more than one block of a conversation, and a
conversation that has a third of all turns is spread like any other. The rendered result has one row per block.

Order: turn, null before all, then role and text. A null or unknown role has to be relabelled; roles are compared without
case and outer blanks. Null text is empty. A null conv_id is a conversation of its own. Equal turns are kept as they are.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sundial.llm.shared import saved

ROLES = ["system", "user", "assistant"]
SYSTEM, USER, ASSISTANT = range(3)
# Own choice: prices of the repairs.
MERGE, RELABEL, INSERT = 2, 3, 4
BLOCK = 512
#: States: nothing yet, and the role of the last turn. A legal end is an assistant turn, or nothing at all.
START, STATES = 3, 4
FAR = 1 << 40


def step(given: int, state: int) -> list[tuple[int, int, str, int, int]]:
    """Ways to read one turn in a state: (cost, next state, action, role it gets, inserted role or -1)."""
    ways = []
    for role in (SYSTEM, USER, ASSISTANT):
        price = 0 if role == given else RELABEL
        name = "keep" if role == given else "relabel"
        if role == state and state != START:
            ways.append((price + MERGE, role, "merge", role, -1))
        if follows(state, role):
            ways.append((price, role, name, role, -1))
        for between in (USER, ASSISTANT):
            if follows(state, between) and follows(between, role):
                ways.append((price + INSERT, role, name, role, between))
    return ways


def follows(state: int, role: int) -> bool:
    if role == SYSTEM:
        return state == START
    if role == USER:
        return state in (START, SYSTEM, ASSISTANT)
    return state == USER


WAYS = {(given, state): step(given, state) for given in range(-1, 3) for state in range(STATES)}
#: Cost of each turn kind as a matrix from state to state.
MATRICES = np.full((4, STATES, STATES), FAR, np.int64)
for (_given, _state), _ways in WAYS.items():
    for _cost, _next, *_ in _ways:
        MATRICES[_given + 1, _state, _next] = min(MATRICES[_given + 1, _state, _next], _cost)
#: A conversation that ends on a user or system turn needs what is missing.
CLOSING = np.array([2 * INSERT, INSERT, 0, 0], np.int64)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(min, +) product of matrices."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


def block_matrix(kinds: list[int]) -> np.ndarray:
    out = np.where(np.eye(STATES, dtype=bool), 0, FAR).astype(np.int64)
    for k in kinds:
        out = product(out, MATRICES[k + 1])
    return out


def path(kinds: list[int], first: int, last: int) -> list[tuple[int, int, str, int, int]]:
    """Cheapest steps over the turns from one state to another."""
    best = [{first: (0, None, None)}]
    for k in kinds:
        now: dict[int, tuple] = {}
        for state, (cost, _, _) in sorted(best[-1].items()):
            for way in WAYS[k, state]:
                if way[1] not in now or cost + way[0] < now[way[1]][0]:
                    now[way[1]] = (cost + way[0], state, way)
        best.append(now)
    steps, state = [], last
    for now in reversed(best[1:]):
        _, before, way = now[state]
        steps.append(way)
        state = before
    return steps[::-1]


def closing(state: int) -> list[int]:
    """Roles inserted after the last turn."""
    return [USER, ASSISTANT] if state == SYSTEM else [ASSISTANT] if state == USER else []


def rendered(role: int, text: str) -> str:
    return f"<|{ROLES[role]}|>\n{text}\n"


def _blocks(conversations: DataFrame) -> DataFrame:
    """Turns with their kind and the number of their block within the conversation.

    Turns are numbered over ranges of (conversation, turn): a range sort, counts by range and conversation, and
    positions within a range. So a long conversation is numbered by many tasks.
    """
    role = F.lower(F.trim(F.coalesce("role", F.lit(""))))
    kind = F.when(role == "system", SYSTEM).when(role == "user", USER).when(role == "assistant", ASSISTANT).otherwise(-1)
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                                 kind.cast("int").alias("kind"))
    order = ["conv_id", "turn", "role", "text"]
    ranged = saved(turns.repartitionByRange(*[F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]).withColumn("range", F.spark_partition_id()), "turns")
    counts = ranged.groupBy("conv_id", "range").agg(F.count("*").alias("n"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row per range
    offsets = counts.withColumn("before", earlier).select(F.col("conv_id").alias("id"), F.col("range").alias("r"), "before")
    within = F.row_number().over(Window.partitionBy("range", "conv_id").orderBy(*[F.col(c).asc_nulls_first() for c in order[1:]])) - 1
    numbered = ranged.withColumn("within", within).join(offsets, F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("range") == F.col("r")))
    at = F.col("before") + F.col("within")
    return numbered.select("conv_id", F.floor(at / BLOCK).alias("block"), at.alias("place"), "kind", "text")


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, block, cost (of the whole conversation), n_turns, n_kept, n_merged, n_relabelled, n_inserted (of the block) and its rendered text."""
    turns = saved(_blocks(conversations), "blocks")
    kinds = turns.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(F.struct("place", "kind"))).alias("k")).select("conv_id", "block", F.transform("k", lambda x: x["kind"]).alias("kinds"))

    @F.pandas_udf("array<long>")
    def matrix(column):
        return column.map(lambda k: block_matrix(list(k)).ravel().tolist())

    def chained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Entry and exit state of each block; the batches hold whole conversations, a row each, as their block matrices."""
        for batch in batches:
            out: list[tuple] = []
            for conv, matrices in zip(batch.column("conv_id").to_pylist(), batch.column("matrices").to_pylist(), strict=True):
                costs, back = np.where(np.arange(STATES) == START, 0, FAR), []
                for m in matrices:
                    ways = costs[:, None] + np.array(m).reshape(STATES, STATES)
                    back.append(ways.argmin(axis=0))
                    costs = ways.min(axis=0)
                state = int((costs + CLOSING).argmin())
                total = int((costs + CLOSING)[state])
                for i in range(len(matrices) - 1, -1, -1):
                    before = int(back[i][state])
                    out.append((conv, i, before, state, total, i == len(matrices) - 1))
                    state = before
            columns = zip(*out, strict=True) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_()), strict=True)], ["id", "b", "first", "last", "cost", "final"])

    # a matrix is sixteen numbers for each 512 turns
    whole = (kinds.select("conv_id", "block", matrix("kinds").alias("matrix")).groupBy("conv_id")
             .agg(F.array_sort(F.collect_list(F.struct("block", "matrix"))).alias("m")).select("conv_id", F.transform("m", lambda x: x["matrix"]).alias("matrices")))
    ends = whole.mapInArrow(chained, "id long, b long, first int, last int, cost long, final boolean")
    blocks = (turns.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(F.struct("place", "kind", "text"))).alias("turns"))
              .join(ends, F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("block") == F.col("b"))))
    blocks = blocks.select("conv_id", "block", "first", "last", "cost", "final", F.transform("turns", lambda x: F.struct(x["kind"].alias("kind"), x["text"].alias("text"))).alias("turns"))

    def render(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_rendered_block(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "block", "first", "last", "cost", "final", "turns")), strict=True)]
            columns = zip(*out, strict=True) if out else [[]] * len(NAMES)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES, strict=True)], NAMES)

    return blocks.mapInArrow(render, OUTPUT)


OUTPUT = "conv_id long, block long, cost long, n_turns long, n_kept long, n_merged long, n_relabelled long, n_inserted long, text string"
NAMES = [c.split()[0] for c in OUTPUT.split(", ")]
TYPES = [{"long": pa.int64(), "string": pa.string()}[c.split()[1]] for c in OUTPUT.split(", ")]


def _rendered_block(conv: int | None, block: int, first: int, last: int, cost: int, final: bool, turns: list[dict]) -> tuple:
    steps = path([t["kind"] for t in turns], first, last)
    parts, inserted = [], 0
    for turn, (_, _, action, role, between) in zip(turns, steps, strict=True):
        if between >= 0:
            parts.append(rendered(between, ""))
            inserted += 1
        parts.append(f"{turn['text']}\n" if action == "merge" else rendered(role, turn["text"]))
    for role in closing(last) if final else []:
        parts.append(rendered(role, ""))
        inserted += 1
    count = lambda name: sum(s[2] == name for s in steps)
    relabelled = sum(s[3] != t["kind"] for s, t in zip(steps, turns, strict=True))
    return conv, block, cost, len(turns), count("keep"), count("merge"), relabelled, inserted, "".join(parts)
