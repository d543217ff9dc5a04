"""License scan by a trained paragraph classifier.

A paragraph is what lies between blank lines; a notice wrapped over lines is one, and comment signs are no words. Most paragraphs
have none of the model's features (hashed word 2- and 3-grams, few of them by an L1 penalty) and cost nothing more. Where
features lie close together, the stretch of words that they span is classified by multinomial logistic regression: the whole
stretch, its lines, and overlapping windows of it, so neither the length of a paragraph nor how it is wrapped changes the verdict.

The model is trained here on variants of notice templates, on sentences that only sound like licences, and on a bounded sample of
the corpus's lines as the unknown class. A temperature calibrates it, fitted with whole templates held out; what is
not likely enough of one family is unknown. Families that share clauses are told apart by a document's words: the title of a whole licence text says whose the
text below it is, among families that speak of one another, and clauses that BSD licences share count for the one whose own clauses are there. A prediction counts only if the words hold enough of the 3-grams of one of the family's
templates, or are an excerpt of one. Of confirmed stretches that overlap the one that holds most counts. "All rights reserved" alone
confirms nothing unless it is the whole paragraph, and nothing beside another family in the document.

Scanning reads every whole text where it lies, without a shuffle; the model is a few thousand weights.

Defined results: null and empty texts have no paragraphs; blank lines are none (n_paragraphs counts the others, since each may be a
paragraph, and a notice's place is the line where it begins); repeated rows and null ids are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM, SPACED, Block, blocks, mix, span_hashes, table, words

# Short notices of licence families.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for additional information regarding copyright ownership. The ASF licenses this file to You under the Apache License, Version 2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
    ],
    "LGPL": ["This library is licensed under the GNU Lesser General Public License, version 2.1.", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "SPDX-License-Identifier: LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "SPDX-License-Identifier: AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES",
    ],
    "ISC": ["Licensed under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.", "SPDX-License-Identifier: ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "SPDX-License-Identifier: CC0-1.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "Released under the Unlicense.", "SPDX-License-Identifier: Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "GPL-1.0": ["This work is licensed under the GNU General Public License, version 1.", "GNU GENERAL PUBLIC LICENSE Version 1, February 1989", "SPDX-License-Identifier: GPL-1.0-or-later", "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 1, or (at your option) any later version."],
    "MPL-1.1": ["Licensed under the Mozilla Public License, version 1.1.", "MOZILLA PUBLIC LICENSE Version 1.1", "SPDX-License-Identifier: MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", "Licensed under the Simplified BSD License.", "SPDX-License-Identifier: BSD-2-Clause"],
    "Zlib": ["Licensed under the zlib License.", "SPDX-License-Identifier: Zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"],
    "bzip2-1.0.6": ["Licensed under the bzip2 and libbzip2 License v1.0.6.", "SPDX-License-Identifier: bzip2-1.0.6", "This program, bzip2, the associated library libbzip2, and all documentation, are copyright (C) Julian R Seward. All rights reserved."],
    "Proprietary": ["All rights reserved.", "Copyright, all rights reserved. No part of this work may be reproduced without permission.", "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited."],
}
# How whole licence texts begin, at the start of a line; the first of each family is a template too.
TITLES = [
    ("Apache-2.0", "Apache License Version 2.0, January 2004"), ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"), ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"), ("GPL-1.0", "GNU GENERAL PUBLIC LICENSE Version 1, February 1989"),
    ("LGPL", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"), ("LGPL", "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991"), ("LGPL", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"), ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"), ("MPL-1.1", "MOZILLA PUBLIC LICENSE Version 1.1"), ("CC0-1.0", "CC0 1.0 Universal"), ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
]
for _family, _title in TITLES:
    if _title not in TEMPLATES[_family]:
        TEMPLATES[_family].append(_title)
#: Families whose texts speak of one another: below a title only its own counts of them.
RELATED = [{"GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL", "AGPL-3.0"}, {"Apache-2.0", "MPL-1.1", "MPL-2.0"}, {"MPL-2.0", "GPL-2.0", "LGPL", "AGPL-3.0"}, {"CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0"}]
# Words of a document that tell families with the same clauses apart.
ORIGIN = "The origin of this software must not be misrepresented"
CLAUSE_1, CLAUSE_2, CLAUSE_3 = "Redistributions of source code must retain", "Redistributions in binary form must reproduce", ("Neither the name of", "BSD 3 Clause", "may not be used to endorse or promote", "be used to endorse or promote products")
APACHE = ("Apache License", "Apache Software Foundation", "www apache org", "License Identifier Apache")
# Sentences that sound like licences and name no family.
GENERIC = [
    "See the license file for details.", "This product requires a license.", "The license of this work is unknown.", "Licensed to the customer under a separate agreement.", "The driver needs a license, version of the year.",
    "Released under the terms below.", "This work is free.", "The public may use the work of the foundation.", "Copyright belongs to the authors.", "The library is open to the general public.", "Version 2.0 was released under the bridge.",
    "A copy of the file may be obtained from the author.", "Permission to enter was granted.", "Copyright (c) 2019 The Authors. All rights reserved.", "Copyright 2021 by the library and its members, all rights reserved.", "Commons and public works department, international attribution.", "The software comes without warranty of any kind.",
]
FAMILIES = ["unknown", *TEMPLATES]
BITS = 20
#: Lines of the corpus that train the unknown class, at most, from the documents with the smallest hashes of doc_id.
SAMPLE_DOCS, SAMPLE_LINES = 256, 2000
VARIANTS, STEPS, RATE, L1 = 16, 150, 1.0, 1e-4
#: A family must be this likely, and a template's 3-grams this far contained; or this share of the words' 3-grams, and so many of them, be a template's.
LIKELY, CONTAINED, EXCERPT, LEAST = 0.6, 0.6, 0.8, 8
#: Words without a feature that end a stretch; words of the windows.
GAP, WINDOWS = 8, (8, 16, 32, 64)
SEED = 13


def ngrams(hashes: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word 2- and 3-grams that begin at each word; zero if the words are not of one paragraph. same: the next word is."""
    two, three = np.zeros(len(hashes), np.uint64), np.zeros(len(hashes), np.uint64)
    at = np.flatnonzero(same)
    two[at] = mix(hashes[at] * np.uint64(3) + hashes[at + 1]) | np.uint64(1)
    at = at[:-1][same[at[:-1] + 1]] if len(at) else at
    three[at] = mix(two[at] * np.uint64(5) + hashes[at + 2]) & ~np.uint64(1)
    return two, three


def _block(texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The 2- and 3-grams of each text, and its word hashes."""
    block = next(blocks([pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t in enumerate(texts)])], 1 << 40))
    s, e, bounds = words(block, ALNUM)
    h = span_hashes(block.buf, s, e)
    grams, hashes = [], []
    for a, b in zip(bounds, bounds[1:]):
        two, three = ngrams(h[a:b], np.arange(b - a) < b - a - 1)
        both = np.concatenate((two, three))
        grams.append(both[both > 0])
        hashes.append(h[a:b])
    return grams, hashes


def _threes(hashes: np.ndarray) -> frozenset[int]:
    """The 3-grams of some words; of fewer words, all of them."""
    if len(hashes) < 3:
        return frozenset([int(mix(hashes.sum(keepdims=True))[0])]) if len(hashes) else frozenset()
    _, three = ngrams(hashes, np.arange(len(hashes)) < len(hashes) - 1)
    return frozenset(three[three > 0].tolist())


class Model:
    """Features in order with their weights for each family, and the temperature."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.features, self.weights, self.bias, self.temperature = features, weights, bias, temperature
        self.maybe = np.zeros(1 << BITS, bool)  # the top bits of features: few words get past it
        self.maybe[features >> np.uint64(64 - BITS)] = True
        self.grams = {f: [_threes(h) for h in _block(ts)[1]] for f, ts in TEMPLATES.items()}

    def places(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of some n-grams are features, and their places."""
        at = np.flatnonzero(self.maybe[grams >> np.uint64(64 - BITS)])
        place = np.searchsorted(self.features, grams[at])
        place[place == len(self.features)] = 0
        ok = self.features[place] == grams[at] if len(self.features) else np.zeros(len(at), bool)
        return at[ok], place[ok]

    def chances(self, sums: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        """Probabilities of the families from the summed weights of some words."""
        z = (sums / np.sqrt(np.maximum(n_words, 1))[:, None] + self.bias) / self.temperature
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        return p / p.sum(axis=1, keepdims=True)

    def contained(self, family: str, own: frozenset[int], whole: bool) -> float:
        """How much of one of the family's templates some words' 3-grams hold, or, of an excerpt, how much of them it holds. whole: they are a whole paragraph."""
        best = 0.0
        for g in self.grams[family]:
            both = len(own & g)
            if len(g) == 1 and not (whole and len(own) == 1):
                continue
            best = max(best, both / len(g), both / len(own) * CONTAINED / EXCERPT if both >= LEAST else 0.0)
        return best


def variants(rng: np.random.Generator, fillers: list[str], left_out: frozenset[str] = frozenset()) -> tuple[list[str], list[int]]:
    """Templates cut, with lost words and with other words around, and the class of each."""
    texts, classes = [], []
    for k, family in enumerate(FAMILIES):
        for t in TEMPLATES.get(family, GENERIC):
            if t in left_out:
                continue
            w = t.split()
            for v in range(VARIANTS):
                own = list(w)
                if v and len(own) > 12 and rng.random() < 0.5:
                    n = int(len(own) * rng.uniform(0.6, 1))
                    at = int(rng.integers(0, len(own) - n + 1))
                    own = own[at : at + n]
                if v and len(own) > 8:
                    own = [x for x in own if rng.random() > 0.05] or own
                if v and fillers and rng.random() < 0.4:
                    extra = fillers[int(rng.integers(len(fillers)))].split()[: int(rng.integers(1, 8))]
                    own = [*extra, *own] if rng.random() < 0.5 else [*own, *extra]
                texts.append(" ".join(own))
                classes.append(k)
    return texts, classes


def _matrix(texts: list[str], known: np.ndarray) -> np.ndarray:
    grams, hashes = _block(texts)
    x = np.zeros((len(texts), len(known)), np.float32)
    for i, (f, h) in enumerate(zip(grams, hashes)):
        at = np.searchsorted(known, f)
        at[at == len(known)] = 0
        np.add.at(x[i], at[known[at] == f], 1 / np.sqrt(max(1, len(h))))
    return x


def _fitted(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by AdaGrad with the L1 penalty's proximal step; families count alike."""
    w, b = np.zeros((x.shape[1], len(FAMILIES)), np.float32), np.zeros(len(FAMILIES), np.float32)
    share = 1 / np.bincount(y, minlength=len(FAMILIES))[y]
    share = (share / share.sum()).astype(np.float32)
    target = np.eye(len(FAMILIES), dtype=np.float32)[y]
    sums_w, sums_b = np.full_like(w, 1e-8), np.full_like(b, 1e-8)
    for _ in range(STEPS):
        z = x @ w + b
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        d = (p - target) * share[:, None]
        gw, gb = x.T @ d, d.sum(axis=0)
        sums_w += gw**2
        sums_b += gb**2
        step = RATE / np.sqrt(sums_w)
        w -= step * gw
        w = np.sign(w) * np.maximum(np.abs(w) - step * L1, 0)
        b -= RATE / np.sqrt(sums_b) * gb
    return w, b


def held_out_templates() -> frozenset[str]:
    """The second template of each family that has three or more, and every fourth sentence that only sounds alike."""
    return frozenset([ts[1] for ts in TEMPLATES.values() if len(ts) > 2] + GENERIC[::4])


def train(lines: list[str], seed: int = SEED) -> Model:
    """The model from templates and the corpus's lines; lines that hold a template don't train the unknown class.

    The temperature comes from a first fit without some whole templates and a fifth of the lines, by what it says of them.
    """
    rng = np.random.Generator(np.random.PCG64(seed))
    all_grams = [g for ts in TEMPLATES.values() for g in map(_threes, _block(ts)[1])]
    lines = [x for x, h in zip(lines, _block(lines)[1] if lines else []) if not any(len(own & g) >= CONTAINED * len(g) for own in [_threes(h)] for g in all_grams)]
    known = np.unique(np.concatenate(_block([t for ts in [*TEMPLATES.values(), GENERIC] for t in ts])[0]))
    held, sample, rest = held_out_templates(), lines[::5], [x for i, x in enumerate(lines) if i % 5]

    def rows(left_out: frozenset[str], unknown: list[str]) -> tuple[np.ndarray, np.ndarray]:
        texts, classes = variants(rng, lines, left_out)
        return _matrix(texts + unknown, known), np.array(classes + [0] * len(unknown))

    w, b = _fitted(*rows(held, rest))
    x, y = rows(frozenset(t for ts in [*TEMPLATES.values(), GENERIC] for t in ts) - held, sample)
    z, best = x @ w + b, (np.inf, 1.0)
    for t in np.geomspace(0.25, 8, 41):
        q = z / t - (z / t).max(axis=1, keepdims=True)
        best = min(best, (float(np.mean(np.log(np.exp(q).sum(axis=1)) - q[np.arange(len(q)), y])), float(t)))
    w, b = _fitted(*rows(frozenset(), lines))
    used = np.flatnonzero(np.abs(w).sum(axis=1) > 0)
    return Model(known[used], w[used].astype(np.float32), b.astype(np.float32), best[1])


def sample_lines(docs: DataFrame, seed: int = SEED) -> list[str]:
    """At most SAMPLE_LINES lines of at most SAMPLE_DOCS documents: a bounded sample, and the same for any partitioning."""
    ids = docs.where("doc_id is not null and text is not null").select("doc_id").orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(SAMPLE_DOCS)
    some = docs.join(F.broadcast(ids.withColumnRenamed("doc_id", "__id").distinct()), F.col("doc_id") == F.col("__id"), "left_semi")
    lines = some.select(F.explode(F.split("text", "\n")).alias("line")).where("trim(line) <> '' and length(line) < 2000").distinct()
    return [r[0] for r in lines.orderBy(F.xxhash64("line"), "line").limit(SAMPLE_LINES).collect()]


FOUND = "doc_id long, n_paragraphs long, paragraph int, family string, probability double, contained double"


def scan_block(block: Block, model: Model) -> Iterator[tuple]:
    """First the number of lines that aren't blank of each document; then (doc, line, family, probability, contained) of what isn't unknown."""
    s, e, bounds = words(block, ALNUM)
    doc = np.repeat(np.arange(len(block.ids)), np.diff(bounds))
    breaks = np.flatnonzero(block.buf == 10)
    line = np.searchsorted(breaks, s)  # of the block; documents are apart by a newline too
    new_line = np.append(line[1:] != line[:-1], True) if len(s) else np.zeros(0, bool)
    yield np.bincount(doc[new_line], minlength=len(block.ids))
    if len(s) < 2 or not len(model.features):
        return
    first_line = np.searchsorted(breaks, block.starts)
    ends = np.append(breaks, len(block.buf))
    ink = np.concatenate(([0], np.cumsum(SPACED[block.buf])))
    blank = np.cumsum(ink[ends] == ink[np.append(0, breaks + 1)])
    same = np.append((blank[line[1:]] == blank[line[:-1]]) & (doc[1:] == doc[:-1]), False)  # the next word is of the same paragraph
    paragraph = np.cumsum(np.append(True, ~same[:-1]))
    hashes = span_hashes(block.buf, s, e)
    two, three = ngrams(hashes, same)
    at, place = model.places(two)
    at3, place3 = model.places(three)
    if not len(at):
        return
    hit = np.unique(np.concatenate((at, at3)))
    # stretches of features with fewer than GAP words between, within a paragraph
    found: list[tuple] = []
    apart = np.flatnonzero((np.diff(hit) > GAP) | (paragraph[hit[1:]] != paragraph[hit[:-1]])) + 1
    for own in np.split(hit, apart):
        a, b = int(own[0]), int(own[-1]) + 2
        while b < len(s) and b < int(own[-1]) + 3 and paragraph[b] == paragraph[a]:
            b += 1  # a 3-gram's last word
        sums = np.zeros((b - a + 1, len(FAMILIES)))
        for x, p in ((at, place), (at3, place3)):
            i, j = np.searchsorted(x, a), np.searchsorted(x, b)
            np.add.at(sums, x[i:j] - a + 1, model.weights[p[i:j]])
        whole = (a == 0 or paragraph[a - 1] != paragraph[a]) and (b == len(s) or paragraph[b] != paragraph[a])
        d = int(doc[a])
        for i, j, family, p, contained in _verdicts(model, np.cumsum(sums, axis=0), line[a:b], hashes[a:b], whole):
            found.append((d, int(line[a + i] - first_line[d]), family, p, contained))
    if found:
        yield from _told_apart(found, Phrases(hashes, doc, line, first_line))


class Phrases:
    """Where fixed phrases occur in a block of words."""

    def __init__(self, hashes: np.ndarray, doc: np.ndarray, line: np.ndarray, first_line: np.ndarray):
        self.hashes, self.doc, self.line, self.first_line = hashes, doc, line, first_line

    def at(self, phrase: str) -> np.ndarray:
        """The first words of a phrase's occurrences within a document."""
        own = _hashes(phrase)
        at = np.flatnonzero(self.hashes[: len(self.hashes) - len(own) + 1] == own[0])
        for k, h in enumerate(own.tolist()):
            at = at[self.hashes[at + k] == h]
        return at[self.doc[at] == self.doc[at + len(own) - 1]]

    def docs(self, *phrases: str) -> set[int]:
        return {d for p in phrases for d in self.doc[self.at(p)].tolist()}

    def titles(self) -> dict[int, list[tuple[int, str]]]:
        """(line, family) of each document's titles, in order."""
        out: dict[int, list[tuple[int, str]]] = {}
        for family, title in TITLES:
            at = self.at(title)
            for i in at[(at == 0) | (self.line[at - 1] != self.line[at])].tolist():
                d = int(self.doc[i])
                out.setdefault(d, []).append((int(self.line[i] - self.first_line[d]), family))
        return {d: sorted(x) for d, x in out.items()}


def _hashes(text: str) -> np.ndarray:
    return _block([text])[1][0]


def _told_apart(found: list[tuple], phrases: Phrases) -> Iterator[tuple]:
    """What was found, by what tells families apart that share clauses: a title says whose text follows, and some families ask for words that only they have."""
    titles = phrases.titles()
    first, second, third, origin, apache = (phrases.docs(*x) for x in ((CLAUSE_1,), (CLAUSE_2,), CLAUSE_3, (ORIGIN,), APACHE))
    for d, line, family, p, contained in found:
        title = next((f for at, f in reversed(titles.get(d, [])) if at <= line), None)
        if title and family != title and any(title in g and family in g for g in RELATED):
            continue
        if family == "Apache-2.0" and d not in apache:
            continue
        if family in ("BSD-3-Clause", "BSD-2-Clause") and d in origin and d in first:
            family = "bzip2-1.0.6"
        elif family == "BSD-3-Clause" and d in second and d not in third:
            family = "BSD-2-Clause"
        yield d, line, family, p, contained


def _verdicts(model: Model, sums: np.ndarray, line: np.ndarray, hashes: np.ndarray, whole: bool) -> list[tuple]:
    """(first word, end, family, probability, contained) of a stretch: of its confirmed parts, or of all of it if none is."""
    n = len(line)
    cuts = [0, *(np.flatnonzero(np.diff(line)) + 1).tolist(), n]
    parts = [(0, n), *zip(cuts, cuts[1:])]
    for w in WINDOWS:
        parts += [(i, min(i + w, n)) for i in range(0, n - w // 2, w // 2)] if w < n else []
    parts = list(dict.fromkeys(parts))
    ij = np.array(parts)
    # a feature counts where it begins, so one over the end of a part is counted with it
    chances = model.chances(sums[ij[:, 1]] - sums[ij[:, 0]], ij[:, 1] - ij[:, 0])
    top = chances.argmax(axis=1)
    likely = np.flatnonzero((top > 0) & (chances.max(axis=1) >= LIKELY))
    sure, unsure = [], []
    for k in likely.tolist():
        i, j = parts[k]
        family, p = FAMILIES[top[k]], float(chances[k, top[k]])
        contained = float(model.contained(family, _threes(hashes[i:j]), whole and (i, j) == (0, n)))
        (sure if contained >= CONTAINED else unsure).append((i, j, family, p, contained))
    kept: list[tuple] = []
    near: dict[int, list[tuple]] = {}  # what is kept, by the places that it covers
    for x in sorted(sure, key=lambda x: (-x[4], -x[3], x[1] - x[0], x[0])):
        places = range(x[0] // 64, (x[1] - 1) // 64 + 1)
        # a part of one family's notice can look like another's: what overlaps by more than half is the same place
        common = [(min(x[1], y[1]) - max(x[0], y[0]), min(x[1] - x[0], y[1] - y[0]), y[2]) for k in places for y in near.get(k, ())]
        if all(m <= 0 if x[2] == family else 2 * m <= least for m, least, family in common):
            kept.append(x)
            for k in places:
                near.setdefault(k, []).append(x)
    return kept or sorted(unsure, key=lambda x: -x[3])[:1]


def _open_only(found: list[tuple]) -> list[tuple]:
    """Without the bare phrase of reserved rights in documents that name another family."""
    others = {d for d, _, family, _, contained in found if contained >= CONTAINED and family != "Proprietary"}
    return [x for x in found if not (x[2] == "Proprietary" and x[0] in others)]


def paragraphs(docs: DataFrame, model: Model) -> DataFrame:
    """FOUND: a row for each paragraph of a likely family, and one without paragraph for each document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found = scan_block(block, sent.value)
            counts = next(found)
            rows = [(block.ids[d], int(n), None, None, None, None) for d, n in enumerate(counts)]
            rows += [(block.ids[d], None, *rest) for d, *rest in _open_only(list(found))]
            types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [x.split()[0] for x in FOUND.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, FOUND)


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, n_paragraphs, n_confirmed, n_unconfirmed, families): one row a document, made where its text lies."""
    sent = docs.sparkSession.sparkContext.broadcast(model or train(sample_lines(docs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found = scan_block(block, sent.value)
            counts = next(found)
            sure: list[list[str]] = [[] for _ in block.ids]
            unsure = [0] * len(block.ids)
            for d, _, family, _, contained in _open_only(list(found)):
                if contained >= CONTAINED:
                    sure[d].append(family)
                else:
                    unsure[d] += 1
            cols = [pa.array(block.ids, pa.int64()), pa.array(counts.astype(np.int64)), pa.array([len(x) for x in sure], pa.int64()), pa.array(unsure, pa.int64()), pa.array([",".join(sorted(set(x))) for x in sure])]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_paragraphs", "n_confirmed", "n_unconfirmed", "families"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_paragraphs long, n_confirmed long, n_unconfirmed long, families string")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
