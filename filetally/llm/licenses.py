"""License scans: winnowed fingerprints find candidates, banded alignment measures them.

Templates are indexed by winnowed hashes of ``GRAM`` consecutive words: of any ``WINDOW``
neighbouring hashes the smallest is kept. All hashes of a text are looked up, so a shared run
of ``GRAM + WINDOW - 1`` words is always found. Hits are chained: both places go on, by at most
``GAP`` words, and drift apart by at most ``BAND`` words from one hit to the next. So repeats of
a template are chains of their own, however close, and one chain may drift far. Between its
hits, and at both ends, template and text are aligned. Reported are the template's matched
share and the span of text it covers.

The index holds the templates only, so its size is that of the template list, not of the corpus;
a long list is scanned for in blocks.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.llm.common import texts
from filetally.llm.text import PIECE, batch_of, buffer_of, column, mix, runs, words

GRAM = 3
WINDOW = 2
BAND = 6  # words inserted or left out between two hits
GAP = 40  # words of text or template between two hits
LEAST_COVERAGE = 0.6
MOST_WORDS = 100_000  # of the templates that a task holds at once

# Short notices and opening sentences by which licenses are referred to.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may'
    " not use this file except in compliance with the License. You may obtain a copy of the"
    " License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it"
    " under the terms of the GNU General Public License as published by the Free Software"
    " Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
    " software and associated documentation files",
    "MIT-notice": "Released under the MIT License.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without"
    " modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International"
    " License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0"
    " International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v."
    " 2.0.",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it"
    " under the terms of the GNU Lesser General Public License as published by the Free Software"
    " Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it"
    " under the terms of the GNU Affero General Public License as published by the Free Software"
    " Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with"
    " or without fee is hereby granted, provided that the above copyright notice and this"
    " permission notice appear in all copies.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of"
    " the Eclipse Public License 2.0",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC0-1.0": "To the extent possible under law, the author has dedicated all copyright and"
    " related and neighboring rights to this software to the public domain worldwide.",
    "Proprietary": "All rights reserved. No part of this publication may be reproduced",
}

NOT_WORD = np.ones(256, dtype=bool)  # words are letters, digits and all beyond ASCII
NOT_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def gram_hashes(hashes: np.ndarray) -> np.ndarray:
    """Hash of every ``GRAM`` consecutive words."""
    with np.errstate(over="ignore"):
        out = hashes.copy()
        for k in range(1, GRAM):
            out = mix(out[: max(0, len(hashes) - k)] * np.uint64(0x9E3779B97F4A7C15) + hashes[k:])
    return out


def winnow(grams: np.ndarray) -> np.ndarray:
    """Places of the smallest hash of each window."""
    if len(grams) <= WINDOW:
        return np.array([grams.argmin()]) if len(grams) else np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
    return np.unique(view.argmin(axis=1) + np.arange(len(view)))


def template_words(templates: dict[str, str]) -> list[tuple[str, np.ndarray]]:
    data, bounds = buffer_of(pa.array(list(templates.values()), pa.string()))
    hashes, _, _, before = words(data, bounds, space=NOT_WORD)
    return [
        (name, hashes[before[k] : before[k + 1]]) for k, name in enumerate(templates)
    ]


def index_of(templates) -> dict[int, list[tuple[int, int]]]:
    """Template and place of every kept hash."""
    index: dict[int, list[tuple[int, int]]] = {}
    for k, (_, hashes) in enumerate(templates):
        grams = gram_hashes(hashes)
        for place in winnow(grams).tolist():
            index.setdefault(int(grams[place]), []).append((k, place))
    return index


def common(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """A longest common subsequence of two short word lists, as pairs of places."""
    if not len(a) or not len(b):
        return []
    same = a[:, None] == b[None, :]
    best = np.zeros((len(a) + 1, len(b) + 1), np.int64)  # of what is left from each place
    for i in range(len(a) - 1, -1, -1):
        row = np.where(same[i], best[i + 1, 1:] + 1, best[i + 1, :-1])
        best[i, :-1] = np.maximum.accumulate(row[::-1])[::-1]
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if same[i, j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1, j] >= best[i, j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def chains(hits: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Hits ``(place in the text, place in the template)`` put together to one chain for each
    occurrence, the longest first; a hit is in one chain only."""
    hits = sorted(set(hits))
    best = [1] * len(hits)
    before = [-1] * len(hits)
    low = 0
    for k, (p, t) in enumerate(hits):
        while p - hits[low][0] > GAP + GRAM:
            low += 1
        for o in range(k - 1, low - 1, -1):
            q, u = hits[o]
            straight = p - q == t - u and t > u
            apart = GRAM <= p - q and GRAM <= t - u <= GAP + GRAM
            near = abs((p - q) - (t - u)) <= BAND
            if (straight or (apart and near)) and best[o] + 1 > best[k]:
                best[k], before[k] = best[o] + 1, o
    used = [False] * len(hits)
    out = []
    for k in sorted(range(len(hits)), key=lambda k: (-best[k], hits[k])):
        chain = []
        while k >= 0 and not used[k]:
            used[k] = True
            chain.append(hits[k])
            k = before[k]
        if chain:
            out.append(chain[::-1])
    return out


def align(template: np.ndarray, text: np.ndarray, chain, low: int, high: int) -> tuple[int, int, int]:
    """Matched words, and first and last matched place in the text (last exclusive).

    The hits of the chain match as they are; what lies between them, before and behind is
    aligned. Nothing outside ``low:high`` of the text is looked at.
    """
    matched = {}  # place in the template to place in the text
    t_end = p_end = None
    for p, t in chain:
        if t_end is None:
            begin = max(low, p - t - BAND)
            matched.update((i, begin + j) for i, j in common(template[:t], text[begin:p]))
        elif t >= t_end and p >= p_end:
            inner = common(template[t_end:t], text[p_end:p])
            matched.update((t_end + i, p_end + j) for i, j in inner)
        matched.update((t + k, p + k) for k in range(GRAM))
        t_end, p_end = t + GRAM, p + GRAM
    stop = min(high, p_end + len(template) - t_end + BAND)
    matched.update((t_end + i, p_end + j) for i, j in common(template[t_end:], text[p_end:stop]))
    places = matched.values()
    return len(matched), min(places), max(places) + 1


def occurrences(template: np.ndarray, text: np.ndarray, hits, least: float):
    """``(matched, first, last)`` of each place where enough of the template stands, in order.

    Longer chains come first; later ones are aligned in the room that is left. A chain may have
    run on from one copy into the next where both lack words, so no word counts twice.
    """
    found: list[tuple[int, int, int]] = []
    for chain in chains(hits):
        begin, end = chain[0][0], chain[-1][0] + GRAM
        low = max([last for _, _, last in found if last <= begin], default=0)
        high = min([first for _, first, _ in found if first >= end], default=len(text))
        if any(first < end and begin < last for _, first, last in found):
            continue
        n, first, last = align(template, text, chain, low, high)
        if n >= least * len(template):
            found.append((n, first, last))
    return sorted(found, key=lambda f: f[1])


MATCHES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("template", pa.string()),
        ("coverage", pa.float64()),
        ("n_matched", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("span", pa.string()),
    ]
)
MATCHES_SQL = (
    "doc_id long, template string, coverage double, n_matched long, first_word long,"
    " last_word long, span string"
)


def scanner(templates: dict[str, str], least: float):
    """Function for ``mapInArrow``: matches of the templates in each text."""

    def run(batches):
        known = template_words(templates)
        index = index_of(known)
        wanted = np.sort(np.array(list(index), np.uint64))
        for batch in batches:
            data, bounds = buffer_of(column(batch, "text"))
            ids = column(batch, "doc_id")
            out = {field: [] for field in MATCHES.names}
            for first, end in runs(bounds, PIECE):
                low = bounds[first]
                part = data[low : bounds[end]]
                hashes, starts, ends, before = words(
                    part, bounds[first : end + 1] - low, space=NOT_WORD
                )
                grams = gram_hashes(hashes)
                if not len(grams) or not len(wanted):
                    continue
                at = np.minimum(np.searchsorted(wanted, grams), len(wanted) - 1)
                places = np.flatnonzero(wanted[at] == grams)
                rows = np.searchsorted(before, places, "right") - 1
                fits = places + GRAM <= before[rows + 1]
                by_text: dict[tuple[int, int], list[tuple[int, int]]] = {}
                for place, row in zip(places[fits].tolist(), rows[fits].tolist(), strict=True):
                    inside = place - int(before[row])
                    for k, where in index[int(grams[place])]:
                        by_text.setdefault((row, k), []).append((inside, where))
                for (row, k), hits in sorted(by_text.items()):
                    name, template = known[k]
                    base = int(before[row])
                    text = hashes[base : before[row + 1]]
                    for n, begin, stop in occurrences(template, text, hits, least):
                        span = part[starts[base + begin] : ends[base + stop - 1]]
                        values = (
                            ids[first + row].as_py(),
                            name,
                            n / len(template),
                            n,
                            begin,
                            stop,
                            span.tobytes().decode("utf-8"),
                        )
                        for field, value in zip(MATCHES.names, values, strict=True):
                            out[field].append(value)
            yield batch_of(MATCHES, **out)

    return run


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST_COVERAGE
) -> DataFrame:
    """Matches in ``docs`` (doc_id, text): one row per text, template and matched span.

    ``coverage`` is the share of the template's words matched in order, ``first_word`` and
    ``last_word`` (exclusive) the span in words, ``span`` its text. Words ignore case of A-Z and
    punctuation. Every row is scanned by itself, so repeated rows give repeated matches; a text
    that matches a template several times gives a row for each place, templates that share
    words each give their own, also where they match equally well. Null and empty texts match
    nothing, as do templates of fewer than ``GRAM`` words; very long texts are scanned whole, an
    empty table gives an empty result. For every ``MOST_WORDS`` words of templates the table is
    scanned once. Only doc_id and text are read, so other columns cannot clash.
    """
    templates = TEMPLATES if templates is None else templates
    blocks: list[dict[str, str]] = [{}]
    size = 0
    for name, text in templates.items():
        size += len(text.split())
        if blocks[-1] and size > MOST_WORDS:
            blocks.append({})
            size = len(text.split())
        blocks[-1][name] = text
    rows = texts(docs).where(F.col("text") != "")
    found = [rows.mapInArrow(scanner(block, least), MATCHES_SQL) for block in blocks]
    return reduce(DataFrame.unionAll, found)
