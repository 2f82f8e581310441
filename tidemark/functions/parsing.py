"""Parsing of raw columns that may be text or already typed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import no_nan


def number(name: str) -> Column:
    """Double, or NULL where the text is no number (NaN counts as missing)."""
    return no_nan(F.col(name).try_cast("double"))


def invoice_time(df: DataFrame, formats: Sequence[str], name: str = "InvoiceDate") -> Column:
    """Timestamp of a typed column as it is, or of text by the first format that fits."""
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.DateType, T.TimestampNTZType)):
        return F.col(name).cast("timestamp")
    text = F.col(name)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])
