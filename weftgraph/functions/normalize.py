"""Column rules that turn raw text into vertex attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings read as true, and the label of a missing attribute.
TRUE_WORDS = ("1", "true", "t", "yes")
MISSING_LABEL = "UNK"


def trimmed(text: Column) -> Column:
    """``text`` without surrounding white space of any kind."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def to_flag(text: Column) -> Column:
    """True for one of the true words in any case, false for all else and null."""
    return F.coalesce(F.lower(trimmed(text)).isin(*TRUE_WORDS), F.lit(False))


def to_integer(text: Column, kind: str = "bigint") -> Column:
    """Null and empty text become 0; text that is no integer raises."""
    return F.when(text.isNull() | (text == ""), F.lit(0).cast(kind)).otherwise(
        trimmed(text).cast(kind)
    )


def to_key(text: Column, name: str) -> Column:
    """A vertex id; null, empty and non-integer text raise."""
    missing = text.isNull() | (text == "")
    return F.when(missing, F.raise_error(F.lit(f"missing {name}")).cast("bigint")).otherwise(
        trimmed(text).cast("bigint")
    )


def to_attribute(text: Column) -> Column:
    """Null and empty text become the missing label; the rest is trimmed after that."""
    return trimmed(F.coalesce(F.nullif(text, F.lit("")), F.lit(MISSING_LABEL)))
