"""Licence scans: a generalised suffix automaton over licence tokens.

Templates (labelled licence wordings) are token sequences.  The automaton of all
their runs is built once per Python worker; its size is that of the templates.
A text is streamed through it: for every token the longest run of template
tokens that ends there (the matching statistics).  Runs of at least ``LONG``
tokens, or of a whole shorter template, are matches; matches of one template
that go forward in text and template with small gaps are chained to a span, and
a span's share of its template is its coverage.

Words are lower-cased runs of letters, digits and characters beyond ASCII.
Words in no template end every run, so only the stretches between them are
streamed.

Defined results: null and empty texts have no words, no labels and score 0; rows
stay as they are, equal keys and nulls included; columns that are added replace
columns of the same name.  Spans never cross texts.  Ties between spans of equal coverage go to
the one that starts first, then to the label that sorts first.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Labels with wordings.  Base phrases first, then notices.
BASE = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)
NOTICES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
     " and associated documentation files, to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the"
     " GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"
     " provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc0", "To the extent possible under law the author has waived all copyright and related rights to this work"),
    ("reserved", "All rights reserved."),
)

#: Least tokens of a match, most tokens skipped between two matches of a span, least coverage of a label.
LONG, GAP, COVERED = 4, 8, 0.75
_WORD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def tokens(text: bytes) -> list[bytes]:
    return text.translate(_WORD).split()


@dataclass(frozen=True)
class Span:
    label: str
    first: int  # word of the text
    last: int
    template: int
    coverage: float


class Automaton:
    """Generalised suffix automaton of token sequences."""

    def __init__(self, base: tuple[tuple[str, str], ...], notices: tuple[tuple[str, str], ...]):
        self.templates = [(label, tokens(text.encode())) for label, text in (*base, *notices)]
        self.n_base = len(base)
        self.id_of: dict[bytes, int] = {}
        for _, sequence in self.templates:
            for t in sequence:
                self.id_of.setdefault(t, len(self.id_of) + 1)
        self.sequences = [[self.id_of[t] for t in sequence] for _, sequence in self.templates]
        self.shortest = min([LONG, *map(len, self.sequences)])
        self.go: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        # Template and place of its last token, for one run that ends in each state.
        self.ends: list[list[tuple[int, int]]] = [[]]
        for k, sequence in enumerate(self.sequences):
            last = 0
            for place, t in enumerate(sequence):
                last = self._extend(last, t)
                self.ends[last].append((k, place))
        # What ends in a state also ends in the states its link leads to.
        for s in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            self.ends[self.link[s]].extend(self.ends[s])
        self.ends[0] = []

    def _state(self, go: dict[int, int], link: int, length: int) -> int:
        self.go.append(go)
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.go) - 1

    def _split(self, p: int, q: int, t: int) -> int:
        """A state for the runs of ``q`` that are as short as those of ``p`` and one token."""
        if self.length[q] == self.length[p] + 1:
            return q
        twin = self._state(dict(self.go[q]), self.link[q], self.length[p] + 1)
        self.link[q] = twin
        while p >= 0 and self.go[p].get(t) == q:
            self.go[p][t] = twin
            p = self.link[p]
        return twin

    def _extend(self, last: int, t: int) -> int:
        if t in self.go[last]:
            return self._split(last, self.go[last][t], t)
        new = self._state({}, 0, self.length[last] + 1)
        p = last
        while p >= 0 and t not in self.go[p]:
            self.go[p][t] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.go[p][t], t)
        return new

    def statistics(self, ids: list[int]) -> list[tuple[int, int]]:
        """(state, length) of the longest run of template tokens that ends at each token."""
        state = length = 0
        out = []
        for t in ids:
            while state and t not in self.go[state]:
                state = self.link[state]
                length = self.length[state]
            to = self.go[state].get(t)
            state, length = (to, length + 1) if to is not None else (0, 0)
            out.append((state, length))
        return out

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int, int]], list[Span]]:
        """Number of words, base places (template, first word, last word), spans."""
        found = tokens(text)
        ids = np.fromiter(map(self.id_of.get, found, [0] * len(found)), np.int32, len(found))
        known = np.flatnonzero(ids)
        if not len(known):
            return len(found), [], []
        base: list[tuple[int, int, int]] = []
        pieces: dict[int, list[tuple[int, int, int]]] = {}
        cuts = np.flatnonzero(np.diff(known) > 1) + 1
        begins, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(known)]])
        worth = ends - begins >= self.shortest
        for lo, hi in zip(begins[worth].tolist(), ends[worth].tolist()):
            begin, values = int(known[lo]), ids[known[lo:hi]].tolist()
            for i, (state, length) in enumerate(self.statistics(values)):
                follows = values[i + 1] if i + 1 < len(values) else 0
                seen: set[tuple[int, int]] = set()
                # The longest run, then its shorter ends that stand in more templates.
                while length >= self.shortest:
                    for k, place in self.ends[state]:
                        if (k, place) in seen:
                            continue
                        seen.add((k, place))
                        sequence = self.sequences[k]
                        size, run = len(sequence), min(length, place + 1)
                        if k < self.n_base and run == size:
                            base.append((k, begin + i - size + 1, begin + i))
                        # Only where a run ends.
                        grows = place + 1 < size and sequence[place + 1] == follows
                        if not grows and (run >= LONG or run == size):
                            pieces.setdefault(k, []).append((begin + i - run + 1, begin + i, place - run + 1))
                    state = self.link[state]
                    length = self.length[state]
        return len(found), base, self._chains(pieces)

    def _chains(self, pieces: dict[int, list[tuple[int, int, int]]]) -> list[Span]:
        spans = []
        for k, found in pieces.items():
            label, sequence = self.templates[k]
            # (first word, last word, next template place, tokens covered); greedy in text order.
            open_: list[tuple[int, int, int, int]] = []
            for first, last, place in sorted(found):
                size = last - first + 1
                best = None
                for n, (a, b, after, _) in enumerate(open_):
                    if b < first <= b + 1 + GAP and after <= place <= after + GAP:
                        best = n
                if best is None:
                    open_.append((first, last, place + size, size))
                else:
                    a, _, _, covered = open_[best]
                    open_[best] = (a, last, place + size, covered + size)
                done = [x for x in open_ if x[1] + 1 + GAP < first]
                open_ = [x for x in open_ if x[1] + 1 + GAP >= first]
                spans += [Span(label, a, b, k, c / len(sequence)) for a, b, _, c in done]
            spans += [Span(label, a, b, k, c / len(sequence)) for a, b, _, c in open_]
        return sorted(spans, key=lambda s: (s.first, s.label, -s.coverage, s.last))


@functools.cache
def automaton(base=BASE, notices=NOTICES) -> Automaton:
    return Automaton(base, notices)


SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("label", T.StringType()),
            T.StructField("first_word", T.LongType()),
            T.StructField("last_word", T.LongType()),
            T.StructField("coverage", T.DoubleType()),
        ]
    )
)
RESULTS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()),
    T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("spans", SPANS),
]


def scan(df: DataFrame, text: str = "text", base=BASE, notices=NOTICES, covered: float = COVERED) -> DataFrame:
    """``df`` without its text, with RESULTS."""
    names = {f.name.lower() for f in RESULTS}
    fields = [f for f in df.schema.fields if f.name != text and f.name.lower() not in names]
    schema = T.StructType(fields + RESULTS)

    def judge(raw: bytes) -> tuple:
        a = automaton(base, notices)
        n, places, spans = a.scan(raw)
        own = {a.templates[k][0] for k, _, _ in places}
        more = {s.label for s in spans if s.coverage >= covered}
        score = max([s.coverage for s in spans] + [1.0] * bool(places), default=0.0)
        return (
            n,
            len(places),
            min((p[1] for p in places), default=None),
            max((p[1] for p in places), default=None),
            ",".join(sorted(own)),
            ",".join(sorted(own | more)),
            min(1.0, score),
            [(s.label, s.first, s.last, s.coverage) for s in spans],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in RESULTS]
        inner = [f.name for f in SPANS.elementType.fields]
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
            rows = [judge(x.as_py() or b"") for x in column]
            out = [batch.column(f.name) for f in fields]
            for k, kind in enumerate(kinds):
                values = [r[k] for r in rows]
                if k == len(kinds) - 1:
                    values = [[dict(zip(inner, s)) for s in spans] for spans in values]
                out.append(pa.array(values, kind))
            yield pa.RecordBatch.from_arrays(out, [f.name for f in schema.fields])

    return df.mapInArrow(run, schema)
