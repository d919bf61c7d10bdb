"""Exact quantiles of columns of any length."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A search ends by sorting the values left in its interval, at most this many.
SORTED = 100_000
_ACCURACY = 10_000


@dataclass
class _Search:
    """Looks for the value with ``rank`` values before it among the ``n``
    values strictly between ``low`` and ``high``."""

    column: str
    rank: int
    n: int
    low: float | None = None
    high: float | None = None
    value: float | None = None

    def inside(self) -> Column:
        v = F.col(self.column)
        kept = v.isNotNull()
        if self.low is not None:
            kept &= v > self.low
        if self.high is not None:
            kept &= v < self.high
        return F.when(kept, v)

    def narrow(self, a: float, b: float, below: int, at_a: int, between: int, at_b: int) -> None:
        """Take over the part that holds the rank; wrong guesses of ``a`` and
        ``b`` only make that part larger."""
        parts = [(self.low, a, below), (a, None, at_a), (a, b, between), (b, None, at_b)]
        for i, (low, high, size) in enumerate(parts):
            if self.rank < size:
                if i % 2:
                    self.value = low
                else:
                    self.low, self.high, self.n = low, high, size
                return
            self.rank -= size
        self.low, self.n = b, self.n - below - at_a - between - at_b


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], fractions: Sequence[float], limit: int = SORTED
) -> dict[str, list[float] | None]:
    """Linearly interpolated quantiles per column; None for a column without
    values. NULL and NaN are missing.

    All searches go on together. A round brackets every value between two
    approximate percentiles and counts around them, which leaves about one row
    in 1 600; ``limit`` only decides how many rounds there are.
    """
    numbers = [F.col(c).cast("double") for c in columns]
    names = [f"v{i}" for i in range(len(columns))]
    values = df.select(*[F.when(~F.isnan(v), v).alias(n) for v, n in zip(numbers, names)])
    counts = values.agg(*[F.count(n).alias(n) for n in names]).first()
    searches: dict[tuple[str, int], _Search] = {}
    for name in names:
        for q in fractions if counts[name] else ():
            place = (counts[name] - 1) * q
            for rank in (math.floor(place), math.ceil(place)):
                searches.setdefault((name, rank), _Search(name, rank, counts[name]))
    while wide := [s for s in searches.values() if s.value is None and s.n > limit]:
        margin = 2.0 / _ACCURACY
        guesses = values.agg(
            *[
                F.percentile_approx(
                    s.inside(),
                    [max(0.0, s.rank / s.n - margin), min(1.0, s.rank / s.n + margin)],
                    _ACCURACY,
                ).alias(f"g{i}")
                for i, s in enumerate(wide)
            ]
        ).first()
        places = values.agg(
            *[
                F.array(
                    F.count_if(s.inside() < a),
                    F.count_if(s.inside() == a),
                    F.count_if((s.inside() > a) & (s.inside() < b)),
                    F.count_if((s.inside() == b) & F.lit(a != b)),
                ).alias(f"p{i}")
                for i, (s, (a, b)) in enumerate(zip(wide, guesses))
            ]
        ).first()
        for s, (a, b), place in zip(wide, guesses, places):
            s.narrow(a, b, *place)
    intervals: dict[tuple, list[_Search]] = {}
    for s in searches.values():
        if s.value is None:
            intervals.setdefault((s.column, s.low, s.high), []).append(s)
    if intervals:
        groups = list(intervals.values())
        rows = values.agg(
            *[
                F.sort_array(F.collect_list(group[0].inside())).alias(f"s{i}")
                for i, group in enumerate(groups)
            ]
        ).select(
            *[
                F.array(*[F.get(f"s{i}", F.lit(s.rank)) for s in group]).alias(f"s{i}")
                for i, group in enumerate(groups)
            ]
        ).first()
        for group, picked in zip(groups, rows):
            for s, value in zip(group, picked):
                s.value = value
    found: dict[str, list[float] | None] = {}
    for column, name in zip(columns, names):
        if not counts[name]:
            found[column] = None
            continue
        found[column] = []
        for q in fractions:
            place = (counts[name] - 1) * q
            lower = searches[name, math.floor(place)].value
            upper = searches[name, math.ceil(place)].value
            found[column].append(lower + (upper - lower) * (place - math.floor(place)))
    return found
