"""Licence notices in documents by patience alignment.

A text and a template are aligned on the words that occur once in each: the longest run of those that is in order in both
(by a longest increasing subsequence) is kept, and the gaps between them are aligned in the same way. A gap without such
words is aligned by its longest common subsequence. The coverage is the share of the template's words that are matched.

Words that tell one licence from another (version numbers, Lesser, Affero, NC, SA, ND) must all match, and the text may not
have more of the named ones in between. Where matches overlap, the best covered one is kept, and of those the longest.

Only places that can reach the coverage are aligned: the stretch of a match is at most as much longer than the template as
the coverage allows, it holds all but a few of the template's longer words, and of all its words, each counted as often as the
template has it, as many as the coverage needs. Places around which the text reads the same are aligned once.
"""

from __future__ import annotations

import bisect
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from .batches import ranges, slices
from .decontaminate import SPACE, normal_form

#: Customary licence notices. Whole licence texts are told by their title and their first lines.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
    "License. You may obtain a copy of the License at",
    "BSD-header": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "ISC-header": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
    "that the above copyright notice and this permission notice appear in all copies",
    "MIT": "Released under the MIT License",
    "MIT-header": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "Apache-2.0-name": "Apache License, Version 2.0",
    "Apache-2.0-name-2": "Apache License 2.0",
    "Apache-2.0-name-3": "Apache License v2.0",
    "Apache-2.0-name-4": "Apache 2.0 License",
    "Apache-2.0-title": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ Terms and conditions for use, reproduction, and distribution",
    "BSD-name": "under the BSD License",
    "BSD-2-Clause-name": "BSD 2-Clause License",
    "BSD-3-Clause-name": "BSD 3-Clause License",
    "BSD-3-Clause-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission",
    "CC0-1.0": "CC0 1.0 Universal",
    "CC0-1.0-header": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "EPL-1.0-header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies "
    "this distribution",
    "EPL-2.0-header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
    "GPL-2.0-only-header": "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free "
    "Software Foundation",
    "GPL-3.0-only-header": "you can redistribute it and/or modify it under the terms of the GNU General Public License version 3 as published by the Free "
    "Software Foundation",
    "ISC-name": "under the ISC License",
    "BSL-1.0": "Boost Software License, Version 1.0",
    "MIT-field": "License: MIT",
    "MIT-name": "under the MIT License",
    "MIT-name-2": "under the terms of the MIT License",
    "MIT-name-3": "Licensed under MIT",
    "MIT-title": "The MIT License (MIT)",
    "MIT-title-2": "MIT License Copyright (c)",
    "Unlicense": "This is free and unencumbered software released into the public domain",
    "Unlicense-header": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
    "compiled binary, for any purpose, commercial or non-commercial, and by any means",
}
for _family, _kind, _version, _date in (
    ("GPL", "", "2", "June 1991"), ("GPL", "", "3", "29 June 2007"), ("LGPL", "Library ", "2", "June 1991"), ("LGPL", "Lesser ", "2.1", "February 1999"),
    ("LGPL", "Lesser ", "3", "29 June 2007"), ("AGPL", "Affero ", "3", "19 November 2007"),
):
    _id, _full = f"{_family}-{_version if '.' in _version else _version + '.0'}", f"GNU {_kind}General Public License"
    TEMPLATES |= {
        f"{_id}-name": f"{_full}, version {_version}", f"{_id}-name-2": f"{_full} v{_version}", f"{_id}-name-3": f"version {_version} of the {_full}",
        f"{_id}-name-4": f"{_family}v{_version}", f"{_id}-name-5": f"under the {_family} version {_version}",
        f"{_id}-title": f"{_full} Version {_version}, {_date} Copyright (C)",
    }
    TEMPLATES.setdefault(f"{_id}-header", f"This {'library' if _version in ('2', '2.1') and _kind else 'program'} is free software: you can redistribute it and/or "
                         f"modify it under the terms of the {_full} as published by the Free Software Foundation, either version {_version} of the License, or (at "
                         "your option) any later version")
for _parts in ("", "-NC", "-SA", "-ND", "-NC-SA", "-NC-ND"):
    _full = "Attribution" + _parts.replace("-NC", "-NonCommercial").replace("-SA", "-ShareAlike").replace("-ND", "-NoDerivatives")
    for _version in ("3.0", "4.0"):
        TEMPLATES |= {f"CC-BY{_parts}-{_version}-name": f"CC BY{_parts} {_version}", f"CC-BY{_parts}-{_version}-name-2": f"Creative Commons {_full} {_version}"}
for _name, _versions in (("Mozilla", ("1.1", "2.0")), ("Eclipse", ("1.0", "2.0"))):
    for _version in _versions:
        _id = f"{_name[0]}PL-{_version}"
        TEMPLATES |= {f"{_id}-name": f"{_name} Public License {_version}", f"{_id}-name-2": f"{_name} Public License, version {_version}",
                      f"{_id}-name-3": f"{_name} Public License v{_version}", f"{_id}-name-4": f"{_name} Public License, v. {_version}"}
for _id in ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "EPL-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0",
            "AGPL-3.0", "ISC", "MIT", "MPL-2.0", "Unlicense"):
    TEMPLATES[f"{_id}-spdx"] = f"SPDX-License-Identifier: {_id}"
#: Words, beside those with a digit, by which licences of nearly the same wording differ.
TELLING = set("lesser affero nc sa nd noncommercial sharealike noderivatives noderivs".split())
COVERAGE = 0.9
LONG_WORD = 5
#: Stretches of text per template whose alignment is remembered.
REMEMBERED = 4096


def longest_increasing(values: list[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence, by piles whose tops are searched by halving."""
    tops: list[int] = []
    at: list[int] = []
    back = [-1] * len(values)
    for k, v in enumerate(values):
        pile = bisect.bisect_left(tops, v)
        if pile == len(tops):
            tops.append(v)
            at.append(k)
        else:
            tops[pile], at[pile] = v, k
        back[k] = at[pile - 1] if pile else -1
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(k)
        k = back[k]
    return out[::-1]


def _common(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """A longest common subsequence, as early in ``a`` as it can be."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i][j + 1] >= best[i + 1][j] and best[i][j + 1] > 0:
            j += 1
        else:
            i += 1
    return out


def align(a: list[int], b: list[int], late: bool = False) -> list[tuple[int, int]]:
    """Pairs of equal entries of ``a`` and ``b``, in order in both; -1 in ``a`` equals nothing.

    What stands before the first anchor is matched as late as it can be, the rest early.
    """
    if not a or not b:
        return []
    in_a, in_b = Counter(a), Counter(b)
    place = {w: j for j, w in enumerate(b) if in_b[w] == 1}
    once = [(i, place[w]) for i, w in enumerate(a) if in_a[w] == 1 and w in place]
    anchors = [once[k] for k in longest_increasing([j for _, j in once])]
    if not anchors:
        if not in_a.keys() & in_b.keys():
            return []
        if late:
            return [(len(a) - 1 - i, len(b) - 1 - j) for i, j in reversed(_common(a[::-1], b[::-1]))]
        return _common(a, b)
    out: list[tuple[int, int]] = []
    i0 = j0 = 0
    for i, j in [*anchors, (len(a), len(b))]:
        out += [(i0 + x, j0 + y) for x, y in align(a[i0:i], b[j0:j], late or not i0)]
        if i < len(a):
            out.append((i, j))
        i0, j0 = i + 1, j + 1
    return out


def covered(pairs: list[tuple[int, int]], size: int) -> float:
    """Share of matched words in the template of ``size`` words, or in their stretch of text if that is longer."""
    return len(pairs) / max(size, pairs[-1][0] - pairs[0][0] + 1) if pairs else 0.0


def trimmed(pairs: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """``pairs`` without those at either end that lie so far off that the coverage is better without them."""
    while True:
        less = max((pairs[1:], pairs[:-1]), key=lambda p: covered(p, size))
        if covered(less, size) <= covered(pairs, size):
            return pairs
        pairs = less


def shared_words(codes: np.ndarray, bounds: np.ndarray, times: np.ndarray, reach: int) -> np.ndarray:
    """For each word of the texts, how many words the ``reach`` ones from there on in its text share with a template, in
    which each code occurs so many ``times``; codes of -1 are in none."""
    at = np.flatnonzero(times[codes])
    at = at[np.argsort(codes[at], kind="stable")]  # occurrences of a code stand together, in order
    kinds, firsts = np.unique(codes[at], return_index=True)
    rank = np.arange(len(at)) - np.repeat(firsts, np.diff(np.append(firsts, len(at))))
    often = times[codes[at]]
    earlier = np.where(rank >= often, at[np.maximum(np.arange(len(at)) - often, 0)], -1)
    text = np.searchsorted(bounds, at, "right") - 1
    # An occurrence counts for the stretches that begin after the one so many times before it, and reach up to it.
    low = np.maximum(np.maximum(earlier + 1, at - reach + 1), bounds[text])
    change = np.bincount(low, minlength=len(codes) + 1) - np.bincount(at + 1, minlength=len(codes) + 1)
    return np.cumsum(change)[: len(codes)]


class Notices:
    """Templates as word codes."""

    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE):
        self.names = sorted(templates)
        words = [_words(pa.array([templates[n]]))[0].to_pylist() for n in self.names]
        self.vocabulary = sorted({w for ws in words for w in ws} | TELLING)
        code = {w: k for k, w in enumerate(self.vocabulary)}
        self.coverage, self.codes = coverage, [[code[w] for w in ws] for ws in words]
        self.telling = {code[w] for w in TELLING}
        #: The places in each template of words that must match.
        self.must = [{j for j, w in enumerate(ws) if w in TELLING or any(c.isdigit() for c in w)} for ws in words]
        self.needed, self.is_key = [], []
        self.times = [np.bincount(ws, minlength=len(self.vocabulary) + 1) for ws in self.codes]
        self.least = [math.ceil(len(ws) * coverage - 1e-9) for ws in words]
        for ws in words:
            spare = len(ws) - math.ceil(len(ws) * coverage - 1e-9)  # words that may be missing
            long = [w for w in ws if len(w) >= LONG_WORD]
            keys = long if len(long) > spare else ws
            self.needed.append(len(keys) - spare)
            table = np.zeros(len(self.vocabulary) + 1, bool)
            table[[code[w] for w in keys]] = True
            self.is_key.append(table)

    def _told(self, codes: list[int], pairs: list[tuple[int, int]], must: set[int]) -> bool:
        """Whether all telling words match."""
        matched = {i for i, _ in pairs}
        return must <= {j for _, j in pairs} and not any(codes[i] in self.telling and i not in matched for i in range(pairs[0][0], pairs[-1][0]))

    def matches(self, codes: np.ndarray, bounds: np.ndarray) -> list[tuple[int, str, int, int, float]]:
        """(text, name, first word, last word, coverage) of the matches, the best where some overlap; codes are -1 for words of
        no template."""
        best: list[tuple[int, str, int, int, float]] = []
        taken: dict[int, list[tuple[int, int]]] = {}
        for match in sorted(self._all_matches(codes, bounds), key=lambda m: (m[0], -m[4], m[2] - m[3], m[2], m[1])):
            spans = taken.setdefault(match[0], [])  # apart from each other, in order
            k = bisect.bisect_right(spans, (match[3], match[3]))
            if (not k or spans[k - 1][1] < match[2]) and (k == len(spans) or spans[k][0] > match[3]):
                spans.insert(k, (match[2], match[3]))
                best.append(match)
        return sorted(best, key=lambda m: (m[0], m[2]))

    def _all_matches(self, codes: np.ndarray, bounds: np.ndarray) -> list[tuple[int, str, int, int, float]]:
        """The matches of each template, one after the other."""
        out = []
        text_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        for name, template, needed, is_key, must, times, least in zip(
            self.names, self.codes, self.needed, self.is_key, self.must, self.times, self.least
        ):
            if not template:
                continue
            reach = math.floor(len(template) / self.coverage + 1e-9)
            keys = np.flatnonzero(is_key[codes])
            ends = keys[needed - 1 :]
            starts = keys[: len(ends)]
            likely = starts[(ends - starts < reach) & (text_of[starts] == text_of[ends])]
            if len(likely):
                enough = np.concatenate(([0], np.cumsum(shared_words(codes, bounds, times, reach) >= least)))
                lows = np.maximum(likely - reach, bounds[text_of[likely]])
                likely = likely[enough[np.minimum(likely + reach, bounds[text_of[likely] + 1])] > enough[lows]]
            seen: dict[bytes, list[tuple[int, int]]] = {}

            def aligned(start: int, stop: int) -> list[tuple[int, int]]:
                stretch = codes[start:stop]
                if (key := stretch.tobytes()) not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen[key] = trimmed(align(stretch.tolist(), template), len(template))
                return seen[key]

            free = -1
            for key in likely.tolist():  # a match holds at least ``needed`` keys from its first one on
                t = int(text_of[key])
                lo, hi = int(bounds[t]), int(bounds[t + 1])
                if key < free:
                    continue
                start = max(lo, free, key - reach)
                pairs = aligned(start, min(hi, key + reach))
                share = covered(pairs, len(template))
                if share >= self.coverage - 1e-9:
                    again = start + pairs[0][0]  # the stretch from its first word on may hold more of it
                    more = aligned(again, min(hi, again + reach))
                    if covered(more, len(template)) > share:
                        start, pairs, share = again, more, covered(more, len(template))
                    if not self._told(codes[start : start + pairs[-1][0] + 1].tolist(), pairs, must):
                        continue
                    first, last = start + pairs[0][0], start + pairs[-1][0]
                    out.append((t, name, first - lo, last - lo, share))
                    free = last + 1
        return out


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts and the n + 1 bounds of the texts in them."""
    data, before, bounds = normal_form(texts)
    spaces = np.flatnonzero(data == SPACE)
    ends = spaces[np.searchsorted(spaces, before, "right")] if len(before) else before
    lengths = ends - before - 1
    flat = data[ranges(before + 1, lengths)]
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.StringArray.from_buffers(len(before), pa.py_buffer(offsets), pa.py_buffer(flat)), bounds


_MATCH = StructType([StructField("license", StringType()), StructField("first", LongType()), StructField("last", LongType()), StructField("coverage", DoubleType())])


def with_notices(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE, names: tuple[str, str] = ("n_words", "notices"), text_col: str = "text"
) -> DataFrame:
    """``docs`` with its number of words and the notices found in the whole text: license, first and last word, coverage.

    Words are as in benchmark decontamination. A template may match several times, one match after the other; of
    templates that match the same words the best covered one is given. A null or wordless text has none, and a template without words never
    matches. Notices are in the order of their first word. Rows stay as they are; a column named
    like one of ``names`` is an error.
    """
    if clash := set(names) & set(docs.columns):
        raise ValueError(f"the table already has columns {sorted(clash)}")
    rows = docs.select(F.col(text_col).alias("x"), F.struct(*([c for c in docs.columns if c != text_col] or [F.lit(0)])).alias("row"))
    kind = pa.list_(pa.struct([("license", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("coverage", pa.float64())]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        notices = Notices(templates, coverage)
        vocabulary = pa.array(notices.vocabulary, pa.string())
        for batch in batches:
            n_words, found = [], []
            for part in slices(iter([batch]), "x"):
                words, bounds = _words(part.column(0))
                codes = np.asarray(pc.index_in(words, vocabulary).fill_null(-1)).astype(np.int64)
                mine: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for t, name, first, last, share in sorted(notices.matches(codes, bounds), key=lambda m: (m[0], m[2], m[1])):
                    mine[t].append({"license": name, "first": first, "last": last, "coverage": share})
                n_words += np.diff(bounds).tolist()
                found += mine
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(n_words, pa.int64()), pa.array(found, kind)], schema=pa.schema([*batch.schema, ("n", pa.int64()), ("y", kind)]))

    done = rows.mapInArrow(each, StructType([*rows.schema.fields, StructField("n", LongType()), StructField("y", ArrayType(_MATCH))]))
    columns = [F.col("x").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    return done.select(*columns, F.col("n").alias(names[0]), F.col("y").alias(names[1]))


def report(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row per document: doc_id, n_words, n_notices, licenses (sorted, joined by commas), coverage (the best, 0 without
    notices), first_word (of the first notice, null without)."""
    found = with_notices(docs.select("doc_id", "text"), templates)
    return found.select(
        "doc_id", "n_words", F.size("notices").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("notices", lambda n: n["license"]))), ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("notices", lambda n: n["coverage"])), F.lit(0.0)).alias("coverage"),
        F.get(F.transform("notices", lambda n: n["first"]), F.lit(0)).alias("first_word"))
