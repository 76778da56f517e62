"""Look-back windows, their name grammar, and the one-pass windowed aggregate.

Names follow `<base>_l<N><unit>` for the last N units and `<base>_l<A><unit>_to_l<B><unit>` for
the span that ends B units before the snapshot; later steps read the window back from the name.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sundial.functions.dates import DateLike, add_months, as_date, day
from sundial.operators.distincts import MERGED, Part, aggregated

UNITS = {"d": "day", "w": "week", "m": "month", "y": "year"}
_PHRASE = re.compile(r"last\s+(\d+)\s+(day|week|month|year)s?", re.I)
_SUFFIX = re.compile(r"_l(\d+)([dwmy])$")
_SPAN = re.compile(r"_l\d+[dwmy]_to_l\d+[dwmy]$")


@dataclass(frozen=True)
class Offset:
    """A distance back from the snapshot."""

    count: int
    unit: str = "w"

    def before(self, snapshot: DateLike) -> dt.date:
        start = as_date(snapshot)
        if self.unit in "dw":
            return start - dt.timedelta(days=self.count * (7 if self.unit == "w" else 1))
        return add_months(start, -self.count * (12 if self.unit == "y" else 1))

    @property
    def name(self) -> str:
        return f"l{self.count}{self.unit}"


@dataclass(frozen=True)
class LookBack:
    """Days after `start` up to and including `end`; both count back from the snapshot."""

    start: Offset | None = None
    end: Offset | None = None

    @property
    def name(self) -> str:
        return "_to_".join(part.name for part in (self.start, self.end) if part) or "current"

    def sql(self, date: str, snapshot: DateLike) -> str:
        """The same test as text, for tables with hundreds of generated columns."""
        until = f"{date} <= DATE'{self.end.before(snapshot) if self.end else as_date(snapshot)}'"
        return until if self.start is None else f"{date} > DATE'{self.start.before(snapshot)}' AND {until}"

    def contains(self, date: Column, snapshot: DateLike) -> Column:
        until = date <= day(self.end.before(snapshot) if self.end else as_date(snapshot))
        return until if self.start is None else (date > day(self.start.before(snapshot))) & until


def parse_offset(text: str) -> Offset | None:
    """`last 12 weeks` to an offset; empty text to none."""
    if not text:
        return None
    match = _PHRASE.search(text)
    if match is None:
        raise ValueError(f"not a look-back window: {text!r}")
    return Offset(int(match.group(1)), match.group(2)[0].lower())


def parse_window(start: str, end: str = "") -> LookBack:
    return LookBack(parse_offset(start), parse_offset(end))


def last(*counts: int, unit: str = "w") -> list[LookBack]:
    """The plain windows `last N units`."""
    return [LookBack(Offset(n, unit)) for n in counts]


def last_and_previous(*counts: int, unit: str = "w") -> list[LookBack]:
    """Each `last N` window and the equally long span just before it."""
    return last(*counts, unit=unit) + [LookBack(Offset(2 * n, unit), Offset(n, unit)) for n in counts]


def split_window(column: str) -> tuple[str, str] | None:
    """(base, window) of a plain-window column; none for spans and other names."""
    match = _SUFFIX.search(column)
    if match is None or _SPAN.search(column):
        return None
    return column[: match.start()], match.group(0)[1:]


def previous_span(column: str, factor: int = 2) -> str:
    """Name of the span before a plain window: `x_l12w` to `x_l24w_to_l12w`."""
    base, window = split_window(column)
    count, unit = int(window[1:-1]), window[-1]
    return f"{base}_l{count * factor}{unit}_to_{window}"


def plain_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """Columns that do not belong to a span window."""
    return [c for c in df.columns if c not in (exclude or []) and not _SPAN.search(c)]


@dataclass(frozen=True)
class Measure:
    """One statistic to repeat for every window; `column` is an expression over the input."""

    func: str
    column: Column | str
    alias: str

    @property
    def value(self) -> Column:
        if isinstance(self.column, Column):
            return self.column
        return F.lit(1) if self.column == "*" else F.col(self.column)


AGGREGATES = {
    "sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg,
    "stddev": F.stddev, "collect_set": F.collect_set, "count_distinct": F.count_distinct,
    "skewness": F.skewness, "kurtosis": F.kurtosis,
}
def _widest(windows: list[LookBack], date: Column, snapshot: DateLike) -> Column:
    """One predicate on the raw column that covers every window, so the scan can prune."""
    until = date <= day(max(w.end.before(snapshot) if w.end else as_date(snapshot) for w in windows))
    if any(w.start is None for w in windows):
        return until
    return (date > day(min(w.start.before(snapshot) for w in windows))) & until


def windowed_aggregate(
    df: DataFrame,
    keys: list[str],
    measures: list[Measure],
    windows: list[LookBack],
    snapshot: DateLike,
    date: str = "date",
    keep_empty: bool = False,
) -> DataFrame:
    """All measures for all windows in one pass over the source.

    Filters inside aggregates do not reach the scan, so the widest window is also applied as a
    row filter. Set `keep_empty` to keep groups whose rows all lie outside every window.

    Distinct counts beside sums, counts, minima, maxima, averages and deviations are taken in two levels (see `aggregated`):
    one row per key and value with a flag per window, then a count of flags. No input row is copied per window, and a hot key is
    spread over its values in the first level.
    """
    when = {w.name: w.contains(F.col(date), snapshot) for w in windows}
    source = df if keep_empty else df.filter(_widest(windows, F.col(date), snapshot))
    funcs = {m.func for m in measures}
    if "count_distinct" in funcs and funcs <= {"count_distinct", *MERGED}:
        return aggregated(source, keys, [Part(f"{m.alias}_{name}", m.func, m.value, test) for name, test in when.items() for m in measures])
    aggregates = [
        AGGREGATES[m.func](F.when(test, m.value)).alias(f"{m.alias}_{name}")
        for name, test in when.items() for m in measures
    ]
    return source.groupBy(*keys).agg(*aggregates)


def outer_bound(windows: list[LookBack], snapshot: DateLike) -> dt.date:
    """First day (exclusive) any of the windows needs."""
    return reduce(min, (w.start.before(snapshot) for w in windows if w.start))
