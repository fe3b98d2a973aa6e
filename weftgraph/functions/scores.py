"""Rounding and top-k of scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rounded(value: Column | str, digits: int = 6) -> Column:
    """The form in which floating results are reported."""
    return F.round(value, digits)


def significant(value: Column | str, digits: int = 11) -> Column:
    """The value to a number of significant digits, whatever its size."""
    value = F.col(value) if isinstance(value, str) else value
    places = F.lit(digits - 1.0) - F.floor(F.log10(F.abs(F.nullif(value, F.lit(0.0)))))
    unit = F.pow(F.lit(10.0), places)
    return F.coalesce(F.round(value * unit) / unit, value)


def top_k(df: DataFrame, score: str, k: int = 10, key: str = "id") -> DataFrame:
    """The ``k`` rows of highest ``score``, ties broken by ascending ``key``.

    Scores that agree in 11 significant digits tie, so that two runs which add in
    another order cut at the same row; the scores returned are the exact ones.
    """
    return df.orderBy(F.desc(significant(score)), F.asc(key)).limit(k)
