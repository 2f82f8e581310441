"""Helpers for rows in order: ids without nulls, lookups of frequent keys, digests of long lists."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import checked, whole

#: Stands for a null id inside the operators, so that nulls can be joined and come last.
NULL_ID = 2**63 - 1
#: Rows of one key above which a lookup doesn't shuffle them.
HOT = 10_000
#: Characters of a text that take part in the order of rows with equal turns.
HEAD = 32


def known_id(column: Column) -> Column:
    return F.coalesce(column.cast("long"), F.lit(NULL_ID))


def given_id(column: Column) -> Column:
    return F.nullif(column, F.lit(NULL_ID))


def decimal(conv: Column) -> Column:
    """Digits of an id; none for a null id."""
    return F.when(conv == NULL_ID, "").otherwise(conv.cast("string"))


def name_of(*parts: Column) -> Column:
    """Sixteen bytes that name a sequence of strings or binaries of fixed widths."""
    joined = F.concat(*[p.cast("binary") for p in parts])
    return F.substring(F.unhex(F.sha2(joined, 256)), 1, 16)


def said(role: Column, text: Column) -> Column:
    """Name of a turn's role and text."""
    return name_of(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def turn_order(turn: str, role: str, text: Column, name: str) -> list[Column]:
    """Order of a conversation's rows: by turn, nulls first; ties by role, text and its name."""
    return [F.col(turn).asc_nulls_first(), F.col(role), F.substring(whole(text), 1, HEAD), F.col(name)]


def looked_up(rows: DataFrame, found: DataFrame, on: Sequence[str], count: str, hot: int = HOT) -> DataFrame:
    """``rows`` joined to ``found``, which has one row for each key and in ``count`` its rows in ``rows``.

    Keys of over ``hot`` rows, of which there can be one for each ``hot`` rows, are
    broadcast if they are few in bytes, so that their rows stay where they are; ``rows`` is
    read twice.
    """
    on = list(on)
    frequent = found.where(F.col(count) > hot)
    if frequent.isEmpty():
        return rows.join(found, on)
    frequent = checked(frequent, F.lit(64))
    rest = rows.join(frequent.select(*on), on, "left_anti").join(found.where(F.col(count) <= hot), on)
    return rows.join(frequent, on).unionByName(rest)


def joined_sha256(rows: DataFrame, key: str, order: Sequence[str], line: str, between: str) -> DataFrame:
    """(``key``, sha256): digest of each key's lines in order, joined by ``between``.

    A digest takes its bytes one after the other, so the rows of a key stream
    through one task, sorted by Spark; the task holds one batch of them.
    """
    return sorted_sha256(rows.repartition(key).sortWithinPartitions(key, *order), key, line, between)


def sorted_sha256(rows: DataFrame, key: str, line: str, between: str) -> DataFrame:
    """As ``joined_sha256``, for rows that lie together by key and in order."""
    mark = between.encode()
    kind = rows.schema[key].dataType.simpleString()

    def _digests(done: list, kinds: pa.DataType) -> pa.RecordBatch:
        columns = [pa.array([k for k, _ in done], kinds), pa.array([d for _, d in done], pa.string())]
        return pa.RecordBatch.from_arrays(columns, [key, "sha256"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, state, kinds = None, None, None
        for batch in batches:
            kinds = batch.schema.field(0).type
            done = []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if state is None or k != open_key:
                    if state is not None:
                        done.append((open_key, state.hexdigest()))
                    open_key, state = k, hashlib.sha256(text.encode())
                else:
                    state.update(mark)
                    state.update(text.encode())
            yield _digests(done, kinds)
        if state is not None:
            yield _digests([(open_key, state.hexdigest())], kinds)

    return rows.select(key, F.col(line).alias("__line")).mapInArrow(run, f"{key} {kind}, sha256 string")
