"""Column expressions shared by the text operators.  All of them read a null text as empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: tab, line feed, vertical tab, form feed, return, space.
BLANKS = "\t\n\x0b\f\r "
#: Most bytes of a table that is broadcast.
BROADCAST = 32 << 20
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def checked(df: DataFrame, size: Column) -> DataFrame:
    """``df``, with a broadcast hint if its rows have at most BROADCAST bytes in all.

    ``df`` is read for that: a stage table, or one as cheap.
    """
    total = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST else df


def whole(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else.

    ``translate`` walks a dictionary per character, so it runs only where a
    capital is present and where full lower-casing would touch other letters.
    """
    return F.translate(text, _CAPITALS, _CAPITALS.lower())


def words(text: Column) -> Column:
    """Runs of characters that are not white space, in order."""
    inner = F.btrim(text, F.lit(BLANKS))
    none = F.array().cast("array<string>")
    return F.when(inner == "", none).otherwise(F.split(inner, r"[\x09-\x0D\x20]+"))


def without(text: Column, characters: str) -> Column:
    """``text`` with every one of ``characters`` removed, by plain byte searches."""
    for c in characters:
        text = F.replace(text, F.lit(c))
    return text


def count_of(text: Column, characters: str) -> Column:
    """How many characters of ``text`` are one of ``characters``."""
    return (F.length(text) - F.length(without(text, characters))).cast("long")
