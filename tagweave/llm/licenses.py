"""Licence notices in texts: Dice coefficient of word bigrams with licence templates.

A text is normalised to lower-case words. Its lines, its paragraphs (runs of lines with a word) and the whole text are compared with the
templates: the Dice coefficient of two sets of bigrams is twice the shared ones over the sum of the sizes. A coefficient of
``MIN_DICE`` bounds the ratio of the sizes, so only templates within that ratio are compared; and a unit without any template's bigram is not
compared at all.

Defined cases: a null or empty text has no licence; a unit of one word has no bigram and matches nothing; repeated rows are scanned one by
one; very long texts are scanned whole; extra columns of the input stay, and result columns win over input columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tagweave.llm.contamination import words_of
from tagweave.llm.octets import byte_table, map_slices, spans, text_bytes

MIN_DICE = 0.8

# Notices and paragraphs of public licences, as published.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("Proprietary", "All rights reserved. Unauthorized copying of this file, via any medium, is strictly prohibited."),
)

_NOT_NEWLINE = ~byte_table((0x0A, 0x0A))
FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("license", T.StringType()),
            T.StructField("dice", T.DoubleType()),
            T.StructField("word_begin", T.IntegerType()),
            T.StructField("word_end", T.IntegerType()),
        ]
    )
)


def _bigrams(words: np.ndarray) -> np.ndarray:
    """A hash of each word with the next one."""
    return words[:-1] * np.uint64(0x9E6C63D0876A9A47) + words[1:]


class Matcher:
    """Templates as sets of bigrams."""

    def __init__(self, templates=TEMPLATES, min_dice: float = MIN_DICE):
        self.min_dice = min_dice
        self.names, self.sets = [], []
        for name, text in templates:
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            words = words_of(data, np.array([0, len(data)]))[4]
            self.names.append(name)
            self.sets.append(set(_bigrams(words).tolist()))
        self.known = np.unique(np.array([b for s in self.sets for b in s], dtype=np.uint64))
        self.ratio = min_dice / (2 - min_dice)
        self.most = max(map(len, self.sets)) / self.ratio

    def match(self, bigrams: np.ndarray) -> list[tuple[str, float]]:
        """(licence, coefficient) of the templates a unit matches."""
        own = np.unique(bigrams)
        size = len(own)
        if not 0 < size <= self.most:
            return []
        unit, out = set(own.tolist()), []
        for name, template in zip(self.names, self.sets, strict=True):
            if self.ratio * size <= len(template) and self.ratio * len(template) <= size:
                dice = 2 * len(unit & template) / (size + len(template))
                if dice >= self.min_dice:
                    out.append((name, dice))
        return out


def units(octets: np.ndarray, offsets: np.ndarray, starts: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last-but-one word of the lines, paragraphs and whole texts of a slice."""
    line_starts, line_ends, line_bounds = spans(octets, offsets, _NOT_NEWLINE)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(line_bounds))
    first, stop = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    worded = stop > first
    row, first, stop = row[worded], first[worded], stop[worded]
    begin, end = line_starts[worded], line_ends[worded]
    # Adjacent lines with words: nothing but one newline between them.
    joined = np.zeros(len(row), dtype=bool)
    joined[1:] = (row[1:] == row[:-1]) & (begin[1:] == end[:-1] + 1)
    heads = np.flatnonzero(~joined)
    tails = np.append(heads[1:], len(row)) - 1
    texts = np.flatnonzero(np.diff(bounds))
    return (
        np.concatenate((row, row[heads], texts)),
        np.concatenate((first, first[heads], bounds[texts])),
        np.concatenate((stop, stop[tails] if len(heads) else stop[:0], bounds[texts + 1])),
    )


def find_rows(matcher: Matcher, octets: np.ndarray, offsets: np.ndarray) -> list[list[tuple[str, float, int, int]]]:
    """For each text the best unit of every licence it matches: (licence, coefficient, first word, end word), by name."""
    out: list[dict[str, tuple[float, int, int]]] = [{} for _ in range(len(offsets) - 1)]
    lowered, starts, _, bounds, words = words_of(octets, offsets)
    if len(words) > 1:
        pairs = _bigrams(words)
        at = np.minimum(np.searchsorted(matcher.known, pairs), len(matcher.known) - 1)
        hits = np.concatenate(([0], np.cumsum(matcher.known[at] == pairs)))
        row, first, stop = units(lowered, offsets, starts, bounds)
        wanted = (stop - first > 1) & (hits[np.maximum(stop - 1, first)] > hits[first])
        for r, b, e in zip(row[wanted].tolist(), first[wanted].tolist(), stop[wanted].tolist(), strict=True):
            base = int(bounds[r])
            for name, dice in matcher.match(pairs[b : e - 1]):
                # The best coefficient; of equal ones the first, then the shortest unit.
                found = (-dice, b - base, e - base)
                out[r][name] = min(out[r].get(name, found), found)
    return [[(name, -d, b, e) for name, (d, b, e) in sorted(found.items())] for found in out]


def scan(docs: DataFrame, text: str = "text", templates=TEMPLATES, min_dice: float = MIN_DICE) -> DataFrame:
    """``docs`` with ``licenses``: the best matching unit of each licence found, by name."""
    others = docs.drop(*["licenses"] if text != "licenses" else [])
    schema = T.StructType([*others.schema.fields, T.StructField("licenses", FOUND)])
    kind = pa.list_(
        pa.struct([("license", pa.string()), ("dice", pa.float64()), ("word_begin", pa.int32()), ("word_end", pa.int32())])
    )
    matcher: list[Matcher] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not matcher:
            matcher.append(Matcher(templates, min_dice))
        found = find_rows(matcher[0], *text_bytes(batch.column(batch.schema.get_field_index(text))))
        names = ("license", "dice", "word_begin", "word_end")
        rows = [[dict(zip(names, item, strict=True)) for item in own] for own in found]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, type=kind)], names=schema.names)

    return others.mapInArrow(map_slices(work, text), schema)
