"""License scan: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies.

Templates are grouped by length, up to a factor of two. For each group a document is cut into windows of 1.5 times the
longest template that start every half of it, so an occurrence lies whole in some window of at most about three times its
shingles. A window retrieves a template if one of BANDS MinHash values agrees. With 0.8 of a template's shingles in it, its
similarity s to the template is at least 0.8 / 3.2, so 64 bands of one row miss it with a probability of (1 - s)^64, about
10^-8.

Retrieved windows are verified on the shingles themselves. Templates that differ in a word, as the notices of two versions
do, contain most of each other: of matches that overlap by more than half, the one that covers most words in the least space is the best. A
template below five words is one phrase, which is looked up as it is. The templates are the only table sent to all tasks;
they are a parameter and their number is checked.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
BANDS = 64
MAX_TEMPLATES = 20_000
SCAN_AT_ONCE = 1 << 15
_WORD = re.compile(r"[^\W_]+(?:[.'-][^\W_]+)*")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFF)

# Notices and opening sentences of public licences, as their publishers word them.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at",
    "BSD-clauses": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                   "the following conditions are met:",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                      "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                      "option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
           "provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                "documentation files (the \"Software\"), to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

# Further notices, and the names and versions from which `templates` makes the notices of the families.
FURTHER = {
    "BSD-style": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "CDDL-1.0": "The contents of this file are subject to the terms of the Common Development and Distribution License",
    "EPL-1.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "MPL-1.1": "The contents of this file are subject to the Mozilla Public License Version 1.1",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
            "liable for any damages arising from the use of this software.",
    "proprietary-reserved": "All rights reserved.",
    "proprietary-confidential": "This software is proprietary and confidential.",
    "proprietary-copying": "Unauthorized copying of this file, via any medium, is strictly prohibited.",
    "proprietary-parts": "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means",
    "public-domain": "This work is in the public domain.",
}
GNU = [("GPL", "GNU General Public License", "2.0 3.0"), ("LGPL", "GNU Lesser General Public License", "2.1 3.0"),
       ("LGPL", "GNU Library General Public License", "2.0"), ("AGPL", "GNU Affero General Public License", "3.0")]
CC = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
CC_KINDS, CC_VERSIONS = "BY BY-SA BY-ND BY-NC BY-NC-SA BY-NC-ND", {"2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}
OTHER_IDS = "MIT ISC Apache-2.0 BSD-2-Clause BSD-3-Clause MPL-1.1 MPL-2.0 EPL-1.0 EPL-2.0 CDDL-1.0 BSL-1.0 CC0-1.0 Unlicense Zlib"


def templates() -> dict[str, str]:
    """NOTICES, FURTHER, and by rule the usual notices of every license and version; wordings that are there already are left out."""
    made, ids = NOTICES | FURTHER, OTHER_IDS.split()

    def gnu(short: str, name: str, version: str) -> Iterator[tuple[str, str]]:
        v, thing = version.removesuffix(".0"), "library" if short == "LGPL" else "program"
        terms = f"This {thing} is free software; you can redistribute it and/or modify it under the terms of the {name} " \
                "as published by the Free Software Foundation; "
        yield f"{short}-{version}-or-later/header", f"{terms}either version {v} of the License, or (at your option) any later version."
        yield f"{short}-{version}-only/header", f"{terms}version {v} of the License."
        yield f"{short}-{version}/work", f"This work is licensed under the {name}, version {v}."
        yield f"{short}-{version}/short", f"Licensed under the {name} v{v}."

    rows = [row for short, name, versions in GNU for version in versions.split() for row in gnu(short, name, version)]
    ids += sorted({name.split("/")[0] for name, _ in rows})
    for kind in CC_KINDS.split():
        for version, port in CC_VERSIONS.items():
            words = "-".join(CC[part] for part in kind.split("-"))
            rows += [(f"CC-{kind}-{version}/work", f"This work is licensed under a Creative Commons {words} {version} {port} License."),
                     (f"CC-{kind}-{version}/short", f"Licensed under CC {kind} {version}.")]
            ids.append(f"CC-{kind}-{version}")
    for name in ids:
        rows += [(f"{name}/released", f"Released under the {name} License."), (f"{name}/licensed", f"Licensed under the {name} License."),
                 (f"{name}/spdx", f"SPDX-License-Identifier: {name}")]
    known = {tuple(words_of(text)) for text in made.values()}
    return made | {name: text for name, text in rows if tuple(words_of(text)) not in known}


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def shingles_of(words: list[str]) -> list[str]:
    """Runs of SHINGLE words; fewer words make one shingle, none makes none."""
    return [" ".join(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))] if words else []


def _word_hashes(words: list[str]) -> np.ndarray:
    known = {x: xxhash.xxh64_intdigest(x) for x in set(words)}
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _runs(w: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` words, from word hashes: position by position, without building the strings."""
    n = max(len(w) - width + 1, 0)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = (out ^ w[i:i + n]) * _ODD
        out ^= out >> np.uint64(29)
    return out


def _minhash_seeds() -> np.ndarray:
    return np.random.default_rng(5).integers(1, 1 << 63, BANDS, dtype=np.uint64) | np.uint64(1)


def _permuted(hashes: np.ndarray, seed: np.uint64) -> np.ndarray:
    x = (hashes ^ seed) * seed
    return (x ^ (x >> np.uint64(32))) * _ODD


class Place(NamedTuple):
    """A match: words `start` to `end`; `covered` words are those of the template's shingles that are there."""
    start: int
    end: int
    template: int
    share: float
    covered: int


@dataclass(frozen=True)
class _Group:
    """Templates of like length: `index[band]` maps MinHash values to templates."""
    step: int  # shingles
    steps: int  # of a window
    index: list[dict[int, list[int]]]  # one band is enough for single shingles
    marks: list[np.ndarray]  # per band, the low bits of its values


def _marks(values: dict[int, list[int]]) -> np.ndarray:
    out = np.zeros(1 << 16, bool)
    out[np.fromiter(values, np.uint64, len(values)) & _LOW] = True
    return out


class Templates:
    """`phrases`: a template below five words matches wherever it stands, not only as a whole text."""

    def __init__(self, texts: dict[str, str], phrases: bool = False):
        self.anywhere = phrases
        if len(texts) > MAX_TEMPLATES:
            raise ValueError(f"more than {MAX_TEMPLATES} templates")
        self.names = sorted(name for name, text in texts.items() if words_of(text))
        words = {n: words_of(texts[n]) for n in self.names}
        self.shingles = [set(shingles_of(words[n])) for n in self.names]
        self.lengths = [len(words[n]) for n in self.names]
        sizes = [len(shingles_of(words[n])) for n in self.names]
        seeds = _minhash_seeds()
        whole = [i for i, n in enumerate(self.lengths) if n >= SHINGLE]
        self.groups = []
        for level in sorted({sizes[i].bit_length() for i in whole}):
            own = [i for i in whole if sizes[i].bit_length() == level]
            index: list[dict[int, list[int]]] = [{} for _ in (seeds if level > 1 else seeds[:1])]
            for i in own:
                hashes = _runs(_word_hashes(words[self.names[i]]), SHINGLE)
                for values, seed in zip(index, seeds):
                    values.setdefault(int(_permuted(hashes, seed).min()), []).append(i)
            longest = max(sizes[i] for i in own)
            self.groups.append(_Group((longest + 1) // 2, 3 if longest > 1 else 1, index, [_marks(v) for v in index]))
        self.seeds = seeds
        self.phrases: dict[int, dict[int, list[int]]] = {}
        for i in set(range(len(sizes))) - set(whole):
            value = int(_runs(_word_hashes(words[self.names[i]]), self.lengths[i])[0])
            self.phrases.setdefault(self.lengths[i], {}).setdefault(value, []).append(i)
        self.phrase_marks = {width: _marks(v) for width, v in self.phrases.items()}

    def short(self, words: list[str], w: np.ndarray) -> Iterator[tuple[int, int]]:
        """(template, first word) of the templates below five words."""
        for width, known in self.phrases.items():
            if not self.anywhere and width != len(words):
                continue
            values = _runs(w, width)
            for at in np.flatnonzero(self.phrase_marks[width][values & _LOW]).tolist():
                for i in known.get(int(values[at]), ()):
                    if " ".join(words[at:at + width]) in self.shingles[i]:
                        yield i, at

    def candidates(self, parts: list[np.ndarray]) -> set[tuple[int, int, int, int]]:
        """(part, template, first, end) of the windows that retrieve it; windows are ranges of shingles of a part."""
        found: set[tuple[int, int, int]] = set()
        hashes = np.concatenate(parts)
        sizes = np.array([len(p) for p in parts])
        starts = np.cumsum(sizes) - sizes
        layout = []
        for g in self.groups:
            steps = -(-sizes // g.step)
            part = np.repeat(np.arange(len(parts)), steps)
            within = (np.arange(len(part)) - np.repeat(np.cumsum(steps) - steps, steps)) * g.step
            same = [part[k:] == part[:-k] for k in range(1, g.steps)]
            layout.append((g, starts[part] + within, part, within, same))
        for band, seed in enumerate(self.seeds):
            values = _permuted(hashes, seed)
            for g, edges, part, within, same in layout:
                if band >= len(g.index):
                    continue
                steps = np.minimum.reduceat(values, edges) if g.step > 1 else values
                low = steps.copy() if g.steps > 1 else steps
                for k, ahead in enumerate(same, 1):  # the minimum of a window is that of its steps
                    if len(ahead):
                        np.minimum(low[:-k], steps[k:], out=low[:-k], where=ahead)
                for at in np.flatnonzero(g.marks[band][low & _LOW]):
                    found.update((int(part[at]), i, int(within[at])) for i in g.index[band].get(int(low[at]), ()))
        window = {i: g.step * g.steps for g in self.groups for own in g.index[0].values() for i in own}
        return {(p, i, a, min(a + window[i], int(sizes[p]))) for p, i, a in found}

    def scan(self, texts: list[str | None], least: float, best: bool = False) -> Iterator[list[tuple[str, int, int, int, float]]]:
        """For each text (template, places, first word, end word, containment); the span is that of the first best window.
        With `best` only places without a better match count."""
        for found in self.places(texts, least):
            by_template: dict[int, list[Place]] = {}
            for place in (best_places(found) if best else found):
                by_template.setdefault(place.template, []).append(place)
            rows = []
            for i, own in sorted(by_template.items()):
                top = max(own, key=lambda p: p.share)
                rows.append((self.names[i], _apart([p.start for p in own], self.lengths[i]), top.start, top.end, top.share))
            yield rows

    def places(self, texts: list[str | None], least: float) -> Iterator[list[Place]]:
        """All verified matches of each text, in the order of their starts."""
        overlap = max((g.step * g.steps for g in self.groups), default=0)
        waiting: list[tuple[list[str], list[Place]]] = []
        parts: list[tuple[int, int, np.ndarray]] = []  # text, first shingle, hashes
        held = 0
        for text in [*texts, None]:
            last = len(waiting) == len(texts)
            if not last:
                words = words_of(text)
                w = _word_hashes(words)
                hashes = _runs(w, SHINGLE)
                parts += [(len(waiting), at, hashes[at:at + SCAN_AT_ONCE + overlap]) for at in range(0, len(hashes), SCAN_AT_ONCE)]
                held += len(hashes)
                waiting.append((words, [Place(at, at + self.lengths[i], i, 1.0, self.lengths[i]) for i, at in self.short(words, w)]))
            if held >= SCAN_AT_ONCE or last:
                yield from self._verified(waiting, parts, least)
                texts, waiting, parts, held = texts[len(waiting):], [], [], 0

    def _verified(self, texts: list[tuple[list[str], list[Place]]], parts: list[tuple[int, int, np.ndarray]], least: float
                  ) -> Iterator[list[Place]]:
        found: dict[int, set[tuple[int, int, int]]] = {}
        if parts and self.groups:
            for p, i, a, b in self.candidates([x[2] for x in parts]):
                text, at, _ = parts[p]
                found.setdefault(text, set()).add((i, a + at, b + at))
        for number, (words, places) in enumerate(texts):
            for i, a, b in found.get(number, ()):
                own = shingles_of(words[a:b + SHINGLE - 1])
                hit = [k for k, s in enumerate(own) if s in self.shingles[i]]
                share = len({own[k] for k in hit}) / len(self.shingles[i])
                if share >= least:
                    first, last, distinct = _densest(own, hit, len(self.shingles[i]) * 5 // 4)
                    places.append(Place(a + first, min(a + last + SHINGLE, len(words)), i, share, distinct + SHINGLE - 1))
            yield sorted(places)


def _densest(own: list[str], hit: list[int], room: int) -> tuple[int, int, int]:
    """First and last hit of the best stretch of at most `room` shingles, and the number of distinct hits in it.

    A window is longer than its template and may hold the end of a like notice besides.
    """
    counts: dict[str, int] = {}
    best, low = (0, 0, 0), 0
    for high, k in enumerate(hit):
        counts[own[k]] = counts.get(own[k], 0) + 1
        while k - hit[low] >= room or counts[own[hit[low]]] > 1:
            counts[own[hit[low]]] -= 1
            if not counts[own[hit[low]]]:
                del counts[own[hit[low]]]
            low += 1
        if not best[2] or 2 * len(counts) - (k - hit[low]) > 2 * best[2] - (best[1] - best[0]):
            best = (hit[low], k, len(counts))
    return best


def best_places(places: list[Place]) -> list[Place]:
    """The places that no better one overlaps by more than half of the shorter of the two.

    Better is what covers more words of its template, less the words of the text between them, then the larger share, then
    the first name.
    """
    kept: list[Place] = []
    longest = max((p.end - p.start for p in places), default=0)
    for p in sorted(places, key=lambda p: (p.end - p.start - 2 * p.covered, -p.share, p.template, p.start)):
        near = kept[bisect_left(kept, (p.start - longest,)):bisect_left(kept, (p.end,))]
        if all(2 * (min(p.end, q.end) - max(p.start, q.start)) <= min(p.end - p.start, q.end - q.start) for q in near):
            insort(kept, p)
    return kept


def _apart(starts: list[int], length: int) -> int:
    """Number of occurrences: windows overlap, so places that begin within a template of the last one are the same."""
    count, last = 0, -length
    for start in sorted(starts):
        if start >= last + length:
            count, last = count + 1, start
    return count


def scan_licenses(docs: DataFrame, known: dict[str, str] | None = None, least: float = 0.8, id_col: str = "doc_id",
                  text_col: str = "text", best: bool = True) -> DataFrame:
    """`doc_id`, `template`, `n_places`, `first_word`, `end_word`, `containment`: one row for each document and template of
    which a window contains at least `least` of the shingles (five words). With `best` only places where no better template
    overlaps by more than half count, so the notice of one version is not reported as that of another.

    Words are runs of letters and digits in lower case, so punctuation does not matter. Whole texts are scanned. Null and
    empty texts match nothing; templates below five words match as a phrase. Repeated rows give repeated results;
    an empty table gives an empty result; other columns are ignored. One pass without a shuffle. At most MAX_TEMPLATES
    templates, more raise an error.
    """
    index = Templates(templates() if known is None else known, phrases=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.float64())
        names = ["doc_id", "template", "n_places", "first_word", "end_word", "containment"]
        for batch in batches:
            found = index.scan(batch["text"].to_pylist(), least, best)
            rows = [(doc_id, *row) for doc_id, hits in zip(batch["doc_id"].to_pylist(), found) for row in hits]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 6, kinds)], names)

    return docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text_col}`"].cast("string").alias("text")).mapInArrow(
        run, "doc_id long, template string, n_places int, first_word long, end_word long, containment double")
