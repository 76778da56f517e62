"""Mixing sources to target weights on a time-varying curriculum.

A source's share of training is its target; when its words come is its schedule, a weight that changes over training. The
integral of the schedule is the demand up to a moment; inverting it gives the moment at which a word of the source's stream is due.
Documents follow one another in the stream in a hashed order, over and over until the target is reached, and all are range-sorted
by their moments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sundial.llm.ordering import numbered
from sundial.llm.shared import saved

WORD = r"[^\x20\x09-\x0D]+"
#: Share of all words that the mix takes, as a fraction: 150 %.
SHARE = (3, 2)
#: A source, and so a document, is repeated at most this often.
REPEATS = 2
WEIGHTS = (5, 2, 1)
#: Schedules by place in WEIGHTS: (moment, height) from 0 to 1, linear in between: heavy sources early, light ones late.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)))

Schedule = Sequence[tuple[float, float]]


def words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def moment(done: Column, schedule: Schedule) -> Column:
    """The moment by which this fraction of a source's words is due: the integral of its schedule, inverted."""
    if len(schedule) < 2 or any(h < 0 for _, h in schedule) or any(a >= b for (a, _), (b, _) in zip(schedule, schedule[1:])):
        raise ValueError("a schedule has two moments or more, ascending, with heights of 0 or more")
    areas = [(b - a) * (g + h) / 2 for (a, g), (b, h) in zip(schedule, schedule[1:])]
    if sum(areas) <= 0:
        raise ValueError("a schedule with no weight is never due")
    due = done * sum(areas)
    result, before = F.lit(float(schedule[-1][0])), sum(areas)
    for (a, g), (b, h), area in reversed(list(zip(schedule, schedule[1:], areas))):
        before -= area
        rest, slope = F.greatest(due - before, F.lit(0.0)), (h - g) / (b - a)
        # the root of slope / 2 x^2 + g x = rest, in the form that also holds for slope 0
        below = g + F.sqrt(F.greatest(g * g + 2 * slope * rest, F.lit(0.0)))
        step = F.coalesce(F.try_divide(2 * rest, below), F.lit(0.0))
        result = F.when(due < before + area, a + F.least(step, F.lit(b - a))).otherwise(result)
    return result


def targets(groups: DataFrame, weights: Sequence[int], share: tuple[int, int], repeats: int) -> DataFrame:
    """Columns __g, cycle (the place of its weight) and target of every source (__g, __total).

    Sources by code point, null last, get the weights in turn. What a source cannot take, because `repeats` times its words are
    fewer, is shared again by weight until none is above. The driver sees two sums a round; sources stay where they are.
    """
    ordered = numbered(groups.select(F.col("__g").alias("__source"), F.col("__total").alias("words")), None, [F.col("__source").asc_nulls_last()])
    cycle = F.expr(f"CAST(__at % {len(weights)} AS INT)")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), cycle + 1)
    sources = saved(ordered.select(F.col("__source").alias("__g"), "words", cycle.alias("cycle"), weight.alias("weight"), (F.col("words") * repeats).alias("most")), "sources")
    total = (sources.agg(F.sum("words")).first()[0] or 0) * share[0] / share[1]
    rate, full = 0.0, -1
    while True:
        capped = F.col("most") < F.col("weight") * rate
        count, taken, rest = sources.agg(F.count(F.when(capped, 1)), F.sum(F.when(capped, F.col("most")).otherwise(0)), F.sum(F.when(capped, 0).otherwise(F.col("weight")))).first()
        if count == full:
            break
        full = count
        if not rest:
            break
        rate = (total - taken) / rest
    return sources.select("__g", "cycle", F.least(F.col("most").cast("double"), F.col("weight") * F.lit(rate)).alias("target"))


def curriculum(docs: DataFrame, keep: list[str], group: str = "source", order: str = "doc_id", text: str = "text", weights: Sequence[int] = WEIGHTS,
               share: tuple[int, int] = SHARE, repeats: int = REPEATS, schedules: Sequence[Schedule] = SCHEDULES) -> DataFrame:
    """Training order: a row per use of a document, at least one per document, in ranges sorted by position.

    Columns: row (struct of `keep`), __row (of the document), size, source_size, target (of its source), copy (from 0), tokens (words
    that this use takes, from the start), position (0 to 1) and step (place in the whole order). A use that the target ends within
    takes fewer words than the document has; a document that is not used has one row with tokens 0 and neither position nor step, and
    comes last. Every source's words add up to its target, rounded, and no document is used more than `repeats` times.

    Null texts and texts without words have size 0 and are not used. Rows with a null id are documents, repeated rows too. A
    null source is a source. An empty table gives no rows. Kept columns are in a struct, so no name can clash. The order is a
    hash of id and source, so it repeats.
    """
    mark = F.md5(F.concat_ws(":", F.lit("mix"), F.col(order).cast("string"), F.col(group)))
    rows = docs.select(F.struct(*keep).alias("row"), F.col(group).alias("__source"), words(F.col(text)).alias("size"), mark.alias("__mark"), F.col(order).alias("__id"))
    stream = numbered(rows, "__source", [F.col("__mark"), F.col("__id"), F.col("size")], "size", lambda groups: targets(groups, weights, share, repeats))
    take = F.floor(F.col("target") + 0.5)
    start = F.col("copy") * F.col("__total") + F.col("__before")
    tokens = F.least(F.col("size"), F.greatest(take - start, F.lit(0).cast("long")))
    used = stream.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).withColumn("tokens", tokens).where("tokens > 0 OR copy = 0")
    done = F.try_divide(start + F.col("tokens") / 2, take.cast("double"))
    due = F.lit(None).cast("double")
    for i, schedule in enumerate(schedules):
        due = F.when(F.col("cycle") == i, moment(done, schedule)).otherwise(due)
    used = used.select("row", F.col("__uid").alias("__row"), "size", F.col("__total").alias("source_size"), "target", "copy", "tokens",
                       F.when(F.col("tokens") > 0, due).alias("position"), "__mark")
    sequence = numbered(used, None, [F.col("position").asc_nulls_last(), F.col("__mark"), F.col("copy")])
    return sequence.withColumn("step", F.when(F.col("tokens") > 0, F.col("__at"))).drop("__mark", "__at", "__n", "__uid")


def report(documents: DataFrame) -> DataFrame:
    """What the mix takes of every document, and when it is first due."""
    uses = curriculum(documents, ["doc_id"])
    return uses.groupBy("__row").agg(F.first("row.doc_id").alias("doc_id"), F.first("size").alias("size"), F.first("source_size").alias("source_size"), F.first("target").alias("target"),
                                     F.sum("tokens").alias("taken"), F.round(F.min("position"), 6).alias("first_position")).drop("__row")
