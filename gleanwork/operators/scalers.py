"""Scalers: fit is one aggregation, transform a projection."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.quantiles import exact_quantiles


@dataclass(frozen=True)
class Fitted:
    """Per-column ``(x - shift) / divisor``."""

    shift: dict[str, float]
    divisor: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(
            *[
                ((F.col(c).cast("double") - F.lit(self.shift[c])) / F.lit(self.divisor[c])).alias(c)
                if c in self.shift
                else F.col(c)
                for c in df.columns
            ]
        )


def _fitted(shift: dict[str, float | None], divisor: dict[str, float | None]) -> Fitted:
    # A constant column is shifted only; an all-NULL column stays NULL.
    return Fitted(
        {c: float(v) if v is not None else 0.0 for c, v in shift.items()},
        {c: float(v) if v else 1.0 for c, v in divisor.items()},
    )


def _known(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles; NULL and NaN are missing."""
    numbers = {c: F.col(f"`{c}`").cast("double") for c in columns}
    return df.select(*[F.when(~F.isnan(v), v).alias(c) for c, v in numbers.items()])


def fit_standard(df: DataFrame, columns: Sequence[str]) -> Fitted:
    """Mean and population standard deviation (P-1)."""
    row = _known(df, columns).agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
    ).first()
    return _fitted({c: row[f"m_{c}"] for c in columns}, {c: row[f"s_{c}"] for c in columns})


def fit_min_max(df: DataFrame, columns: Sequence[str]) -> Fitted:
    """Minimum and range; a constant column becomes 0 (P-2)."""
    row = _known(df, columns).agg(
        *[F.min(c).alias(f"l_{c}") for c in columns],
        *[(F.max(c) - F.min(c)).alias(f"r_{c}") for c in columns],
    ).first()
    return _fitted({c: row[f"l_{c}"] for c in columns}, {c: row[f"r_{c}"] for c in columns})


def fit_robust(df: DataFrame, columns: Sequence[str]) -> Fitted:
    """Median and interquartile range with linear interpolation (P-3)."""
    found = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    return _fitted(
        {c: found[c][1] if found[c] else None for c in columns},
        {c: found[c][2] - found[c][0] if found[c] else None for c in columns},
    )


def fit_max_abs(df: DataFrame, columns: Sequence[str]) -> Fitted:
    """Largest absolute value (P-4)."""
    row = _known(df, columns).agg(*[F.max(F.abs(c)).alias(c) for c in columns]).first()
    return _fitted({c: 0.0 for c in columns}, {c: row[c] for c in columns})


SCALERS: dict[str, Callable[[DataFrame, Sequence[str]], Fitted]] = {
    "standard": fit_standard,
    "min_max": fit_min_max,
    "robust": fit_robust,
    "max_abs": fit_max_abs,
}


def scale(df: DataFrame, columns: Sequence[str], scaler: str) -> DataFrame:
    """Fit the named scaler on ``df`` and apply it (P-5)."""
    return SCALERS[scaler](df, columns).transform(df)


def scale_chained(df: DataFrame, columns: Sequence[str], scalers: Sequence[str]) -> DataFrame:
    """Each scaler is fitted on the output of the one before it (P-6)."""
    for name in scalers:
        df = scale(df, columns, name)
    return df
