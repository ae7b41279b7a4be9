"""Exact order statistics without sorting the data or gathering a column.

A rank is bracketed between two values taken from a quantile sketch, whose error is bounded, and
the rows below and inside the bracket are counted. What lies strictly inside is a few times
``1/accuracy`` of the rows before, so each round narrows the bracket by orders of magnitude, for
all columns and ranks in one scan. A rank that falls on a border value is settled at once, however
many copies of that value there are. When few enough rows are inside, they are sorted.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000
GATHER_LIMIT = 20_000


@dataclass
class _Bracket:
    """An open range of values of a column and the ranks (0-based) that fall into it."""

    column: str
    ranks: list[int]
    inside: int
    below: int = 0
    low: float | None = None
    high: float | None = None

    def value_inside(self) -> Column:
        value = F.col(self.column).cast("double")
        tests = []
        if self.low is not None:
            tests.append(value > F.lit(self.low))
        if self.high is not None:
            tests.append(value < F.lit(self.high))
        for test in tests:
            value = F.when(test, value)
        return value

    def neighbours(self) -> list[list[int]]:
        """Ranks in runs of adjacent ones, which one pair of borders can serve."""
        runs: list[list[int]] = []
        for rank in sorted(self.ranks):
            if runs and rank - runs[-1][-1] <= 1:
                runs[-1].append(rank)
            else:
                runs.append([rank])
        return runs


def order_statistics(
    df: DataFrame,
    wanted: Mapping[str, Sequence[int]],
    counts: Mapping[str, int],
    accuracy: int = ACCURACY,
    gather_limit: int = GATHER_LIMIT,
) -> dict[tuple[str, int], float]:
    """Values at 0-based ranks of the non-null values of each column. ``counts`` are their numbers."""
    found: dict[tuple[str, int], float] = {}
    brackets = [
        _Bracket(column, sorted(set(ranks)), counts[column]) for column, ranks in wanted.items()
    ]
    while brackets:
        small = [b for b in brackets if b.inside <= gather_limit]
        large = [b for b in brackets if b.inside > gather_limit]
        if small:
            picks = []
            for b in small:
                ordered = F.sort_array(F.collect_list(b.value_inside()))
                picks.append(
                    F.array(*[F.element_at(ordered, rank - b.below + 1) for rank in b.ranks])
                )
            for b, values in zip(small, _one_row(df, picks)):
                found.update({(b.column, rank): v for rank, v in zip(b.ranks, values)})
        brackets = _narrow(df, large, found, accuracy) if large else []
    return found


def _narrow(
    df: DataFrame,
    brackets: list[_Bracket],
    found: dict[tuple[str, int], float],
    accuracy: int,
) -> list[_Bracket]:
    # Borders lie two sketch errors away from the ranks, on either side; one sketch per bracket.
    sketches = []
    for b in brackets:
        shares = []
        for run in b.neighbours():
            first, last = ((rank - b.below + 0.5) / b.inside for rank in (run[0], run[-1]))
            shares += [max(0.0, first - 2 / accuracy), min(1.0, last + 2 / accuracy)]
        sketches.append(F.percentile_approx(b.value_inside(), shares, accuracy))
    edges = _one_row(df, sketches)

    pieces, tallies = [], []
    for b, borders in zip(brackets, edges):
        value = b.value_inside()
        for i, run in enumerate(b.neighbours()):
            low, high = borders[2 * i], borders[2 * i + 1]
            tests = [value < low, value == low, (value > low) & (value < high), value == high]
            tally = F.struct(*[F.count_if(t).alias(f"t{k}") for k, t in enumerate(tests)])
            pieces.append((b, run, low, high))
            tallies.append(tally)

    narrowed: dict[tuple, _Bracket] = {}

    def put(b: _Bracket, rank: int, below: int, inside: int, low, high) -> None:
        key = (b.column, low, high)
        part = narrowed.setdefault(key, _Bracket(b.column, [], inside, below, low, high))
        part.ranks.append(rank)

    for (b, run, low, high), (under, at_low, between, at_high) in zip(pieces, _one_row(df, tallies)):
        if low == high:
            at_high = 0
        for rank in run:
            position = rank - b.below
            if position < under:
                put(b, rank, b.below, under, b.low, low)
            elif position < under + at_low:
                found[b.column, rank] = low
            elif position < under + at_low + between:
                put(b, rank, b.below + under + at_low, between, low, high)
            elif position < under + at_low + between + at_high:
                found[b.column, rank] = high
            else:
                passed = under + at_low + between + at_high
                put(b, rank, b.below + passed, b.inside - passed, high, b.high)
    return list(narrowed.values())


def _one_row(df: DataFrame, aggregates: list[Column]) -> list:
    row = df.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggregates)]).first()
    return list(row)


def exact_quantiles(
    df: DataFrame,
    counts: Mapping[str, int],
    probabilities: Sequence[float],
    accuracy: int = ACCURACY,
    gather_limit: int = GATHER_LIMIT,
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation between neighbours, for the columns in ``counts``."""
    spots = {
        column: [p * (n - 1) for p in probabilities] for column, n in counts.items() if n > 0
    }
    wanted = {
        column: [edge for s in places for edge in (math.floor(s), math.ceil(s))]
        for column, places in spots.items()
    }
    values = order_statistics(df, wanted, counts, accuracy, gather_limit)

    def at(column: str, spot: float) -> float:
        low, high = values[column, math.floor(spot)], values[column, math.ceil(spot)]
        return low if low == high else low + (high - low) * (spot - math.floor(spot))

    return {
        column: [at(column, s) for s in spots[column]] if column in spots else
        [None] * len(probabilities)
        for column in counts
    }
