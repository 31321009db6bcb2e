"""Exact quantiles of whole tables without holding a column in one task.

Spark's ``percentile`` keeps a value->count map per group in one task, which does not
survive a table with billions of distinct amounts. Here:

1. one aggregate of mergeable sketches (``percentile_approx``) brackets each wanted rank;
2. one grouped count lists only the values inside the brackets, while all values between
   brackets fall into a few "gap" rows. The listing is small because a bracket spans a
   fixed share of the rows, and its size is checked before it is used.

Brackets that still hold too many distinct values are narrowed by a further sketch of
what lies strictly between their edges. An edge that is itself a frequent value is counted
apart: it either is the answer or drops out, so its weight cannot hold up the narrowing.
Every answer is read off counted ranks; the sketch's error decides how many values get
listed and never what the result is.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F

SKETCH_ACCURACY = 10_000
MARGIN = 2.0 / SKETCH_ACCURACY
LISTED_VALUES = 200_000
SMALL_TABLE = 20_000


@dataclass
class _Bracket:
    """Values between two edges around the wanted rank; below/inside count rows."""
    column: str
    rank: int
    inside: int
    low: float = -math.inf
    high: float = math.inf
    below: int = 0

    def tighten(self, low: float, high: float, margin: float) -> None:
        """Take sketch values as new edges, keeping an edge open near the ends."""
        offset, slack = self.rank - self.below, margin * self.inside
        if offset > slack:
            self.low = max(self.low, low)
        if self.inside - 1 - offset > slack:
            self.high = min(self.high, high)

    def between(self, value: Column) -> Column:
        """Strictly between the edges."""
        cond = value.isNotNull()
        if self.low != -math.inf:
            cond = cond & (value > self.low)
        return cond & (value < self.high) if self.high != math.inf else cond


def _sketch(values: DataFrame, brackets: list[_Bracket], margin: float) -> None:
    aggs = []
    for i, b in enumerate(brackets):
        share = (b.rank - b.below) / max(b.inside - 1, 1)
        edges = [max(0.0, share - margin), min(1.0, share + margin)]
        content = F.when(b.between(F.col(b.column)), F.col(b.column))
        aggs.append(F.percentile_approx(content, edges, SKETCH_ACCURACY).alias(f"b{i}"))
    row = values.agg(*aggs).first()
    for i, b in enumerate(brackets):
        b.tighten(*row[f"b{i}"], margin)


def _recount(values: DataFrame, totals: Mapping[str, int], brackets: list[_Bracket]) -> dict:
    """Place each rank among exact counts: on an edge (returned), strictly between the
    edges (the bracket's new content), or outside, which reopens the bracket."""
    aggs = []
    for i, b in enumerate(brackets):
        value = F.col(b.column)
        aggs += [F.count_if(value < b.low).alias(f"under{i}"), F.count_if(value == b.low).alias(f"low{i}"),
                 F.count_if(b.between(value)).alias(f"in{i}"), F.count_if(value == b.high).alias(f"high{i}")]
    row = values.agg(*aggs).first()
    on_edge = {}
    for i, b in enumerate(brackets):
        first = row[f"under{i}"] + row[f"low{i}"]
        past = first + row[f"in{i}"]
        if row[f"under{i}"] <= b.rank < first:
            on_edge[(b.column, b.rank)] = b.low
        elif first <= b.rank < past:
            b.below, b.inside = first, row[f"in{i}"]
        elif past <= b.rank < past + row[f"high{i}"]:
            on_edge[(b.column, b.rank)] = b.high
        else:
            b.low, b.high, b.below, b.inside = -math.inf, math.inf, 0, totals[b.column]
    return on_edge


def _entry(column: str, brackets: list[_Bracket]) -> Column:
    """struct(slot, v): v is the value inside a bracket and null in the gap below it."""
    edges: list[list[float]] = []
    for b in sorted(brackets, key=lambda b: b.low):
        if edges and b.low <= edges[-1][1]:
            edges[-1][1] = max(edges[-1][1], b.high)
        else:
            edges.append([b.low, b.high])
    value, none = F.col(column), F.lit(None).cast("double")
    steps: list[tuple[Column, int, Column]] = []
    for k, (low, high) in enumerate(edges):
        if low != -math.inf:
            steps.append((value < low, 2 * k, none))
        steps.append((value <= high, 2 * k + 1, value))
    slot = shown = F
    for cond, code, seen in steps:
        slot, shown = slot.when(cond, code), shown.when(cond, seen)
    return F.struct(F.lit(column).alias("column"), slot.otherwise(2 * len(edges)).alias("slot"),
                    shown.otherwise(none).alias("v"))


def _listing(values: DataFrame, brackets: list[_Bracket]) -> list | None:
    """Counts per listed value and per gap in rank order, or None when too many."""
    columns = list(dict.fromkeys(b.column for b in brackets))
    entries = [F.when(F.col(c).isNotNull(), _entry(c, [b for b in brackets if b.column == c]))
               for c in columns]
    entry = entries[0] if len(entries) == 1 else F.explode(F.array(*entries))
    rows = (values.select(entry.alias("e")).where("e IS NOT NULL").groupBy("e.column", "e.slot", "e.v")
            .count().limit(LISTED_VALUES + 1).collect())
    if len(rows) > LISTED_VALUES:
        return None
    return sorted(((r["column"], r["slot"], r["v"], r["count"]) for r in rows),
                  key=lambda r: (r[0], r[1], -math.inf if r[2] is None else r[2]))


def _read(rows: list, column: str, rank: int) -> float | None:
    seen = 0
    for name, _, value, n in rows:
        if name == column:
            seen += n
            if rank < seen:
                return value
    return None


def between(a: float, b: float, part: float) -> float:
    """``a * (1 - part) + b * part`` with the first product unrounded, a fused multiply-add, as DuckDB's quantiles have it."""
    if a == b or not (math.isfinite(a) and math.isfinite(b)):
        return a if a == b else a * (1 - part) + b * part
    return float(Fraction(a) * Fraction(1 - part) + Fraction(b * part))


def exact_quantiles(df: DataFrame, columns: Mapping[str, Column | str] | Sequence[str],
                    probabilities: Sequence, interpolate: bool = True) -> dict[str, list[float | None]]:
    """Quantiles of each column over its non-null rows; None for an all-null column.

    Linear interpolation between neighbouring ranks, or the lower rank's value with
    ``interpolate=False``. Runs eagerly, two aggregates over the wanted columns in the
    usual case, and returns driver-side numbers that callers embed as literals.
    """
    if not isinstance(columns, Mapping):
        columns = {c: c for c in columns}
    values = df.select(*[(F.col(c) if isinstance(c, str) else c).cast("double").alias(name)
                         for name, c in columns.items()])

    # First job: row counts and the first brackets together.
    grid = [min(1.0, max(0.0, float(p) + d)) for p in probabilities for d in (-MARGIN, MARGIN)]
    head = values.agg(*[F.count(F.col(n)).alias(f"n_{n}") for n in columns],
                      *[F.percentile_approx(F.col(n), grid, SKETCH_ACCURACY).alias(f"q_{n}")
                        for n in columns]).first()
    totals = {n: head[f"n_{n}"] for n in columns}
    wanted: dict[str, list[tuple[int, int, float]]] = {}
    pending: dict[tuple[str, int], _Bracket] = {}
    for name, n in totals.items():
        wanted[name] = []
        for i, p in enumerate(probabilities if n else ()):
            position = p * (n - 1)
            low = math.floor(position)
            high = min(low + 1, n - 1) if interpolate and position > low else low
            wanted[name].append((low, high, float(position - low)))
            for rank in (low, high):
                bracket = _Bracket(name, rank, n)
                if n > SMALL_TABLE:
                    bracket.tighten(*head[f"q_{name}"][2 * i:2 * i + 2], MARGIN)
                pending[(name, rank)] = bracket

    found: dict[tuple[str, int], float] = {}
    margin = MARGIN
    while pending:
        brackets = list(pending.values())
        rows = _listing(values, brackets)
        if rows is not None:
            found.update({k: v for k in pending if (v := _read(rows, *k)) is not None})
            pending = {k: b for k, b in pending.items() if k not in found}
            margin = min(4 * margin, 0.25)
        if pending:
            found.update(_recount(values, totals, list(pending.values())))
            pending = {k: b for k, b in pending.items() if k not in found}
        if pending:
            _sketch(values, list(pending.values()), margin)

    def at(name: str, low: int, high: int, part: float) -> float:
        return between(found[(name, low)], found[(name, high)], part)

    return {name: [at(name, *w) for w in wanted[name]] or [None] * len(probabilities) for name in columns}
