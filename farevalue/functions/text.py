"""Column builders for text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_empty(column: str, text: bool) -> Column:
    """Null, or for text nothing but spaces (a tab is not a space)."""
    value = F.col(column)
    return value.isNull() | (F.trim(value.cast("string")) == "") if text else value.isNull()


def first_filled(df: DataFrame, candidates: Sequence[str]) -> Column:
    """First of ``candidates`` that is neither null nor ``''``, as text.

    Columns that ``df`` lacks are passed over. The last candidate is the final
    fallback and is taken as it is.
    """
    present = [name for name in candidates if name in df.columns]
    values = [
        F.col(name).cast("string")
        if name == candidates[-1]
        else F.nullif(F.col(name).cast("string"), F.lit(""))
        for name in present
    ]
    return F.coalesce(*values) if values else F.lit(None).cast("string")


def money_text(currency: Column, amount: Column) -> Column:
    """``USD 1,234.50``."""
    return F.when(amount.isNotNull(), F.concat_ws(" ", currency, F.format_number(amount, 2)))


def cpp_text(cpp: Column) -> Column:
    """``1.00 cents``, or ``Not available`` for null and NaN."""
    shown = F.concat(F.call_function("format_number", cpp, F.lit("0.00")), F.lit(" cents"))
    return F.when(cpp.isNull() | F.isnan(cpp), "Not available").otherwise(shown)
