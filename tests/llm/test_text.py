import hashlib
import math
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from made_up import words
from pyspark.sql import functions as F

from corpusflow.llm import decontaminate, licenses, lines, mixing, packing, quality

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(b: bytes) -> bytes:
    return re.sub(rb"[A-Z]", lambda m: m[0].lower(), b)


def frame(spark, pairs):
    return spark.createDataFrame([(k, t, "en", f"s{k % 9}", 1) for k, t in pairs], DOCS)


# --- packing ---------------------------------------------------------------------------------


def brute_ids(text):
    from tokenizers import Tokenizer

    if "t" not in _tok:
        _tok["t"] = Tokenizer.from_file(packing.public_tokenizer())
    return [*_tok["t"].encode(text or "", add_special_tokens=False).ids, 1]


_tok: dict = {}


def test_packing(docs, awkward, none):
    rows = packing.packed(docs, packing.public_tokenizer(), capacity=4096).collect()
    want = Counter()
    for k, t, *_ in awkward:
        ids = brute_ids(t)
        for n, i in enumerate(range(0, len(ids), 4096)):
            cut = ids[i : i + 4096]
            want[k, n, i, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins: dict = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 4096
    assert len(bins) <= math.ceil(sum(r.length for r in rows) / 4096) + 1
    assert packing.packed(none, packing.public_tokenizer()).count() == 0


@pytest.mark.parametrize("text", ["Ünïcode ΑΣ Σ İstanbul", "it's we're <|endoftext|> x<|StartOfText|>", "a.b,c. d, e.. 1,000.5 7 x7y", "　wide space line", "é é", "ﬁ ª º µ ½", "😀 a😀.", "\x1c\x1f a\x0bb", "STRASSE ß ẞ."])
def test_token_ids_are_the_tokenizers(text):
    (got,) = packing.token_ids([text], packing.public_tokenizer())
    assert np.frombuffer(got, "<u4").tolist() == brute_ids(text)[:-1]


def test_bins_close_the_fullest():
    b = packing.Bins(10, 2)
    assert [b.put(n) for n in (6, 7)] == [(0, 0), (1, 0)]
    assert b.put(3) == (1, 7)  # the best fit
    assert b.put(8) == (2, 0)
    assert b.put(9) == (3, 0)  # bin 2 is the fullest and closes
    assert b.put(2) == (0, 6)
    assert b.put(10) == (4, 0)


def test_packing_closes_bins_as_pieces_come(spark):
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 700, 3000).tolist()
    rows = spark.createDataFrame([(i, 0, 0, n, 0, i) for i, n in enumerate(sizes)], packing.PIECES)
    bins = packing.Bins(1000, 16)
    at = [bins.put(n) for n in sizes]
    assert bins.n == 16
    got = sorted((r.doc_id, r.sequence_id, r.offset) for r in packing.pack(rows.repartition(4), 1000, 16).collect())
    assert got == [(i, b, o) for i, (b, o) in enumerate(at)]
    assert bins.made <= 1.03 * sum(sizes) / 1000  # bins that close are all but full


def test_another_tokenizer_encodes_whole_texts():
    from tokenizers import Tokenizer

    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["Two  spaces\n and  more", "", "naïve 😀 text, with. marks"]
    whole = Tokenizer.from_file(path)
    assert [np.frombuffer(x, "<u4").tolist() for x in packing.token_ids(texts, path)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


# --- decontamination -------------------------------------------------------------------------


def brute_contamination(doc, items, n=10):
    w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower((doc or "").encode()))
    hit, found = set(), []
    for k, t in items:
        i = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower((t or "").encode()))
        wins = [i[j : j + n] for j in range(len(i) - n + 1)] if len(i) >= n else [i] if i else []
        at = [(j, len(x)) for x in wins for j in range(len(w) - len(x) + 1) if w[j : j + len(x)] == x]
        if at:
            found.append(str(k))
            hit.update(p for j, m in at for p in range(j, j + m))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def test_decontamination(spark, docs, awkward, none):
    items = [(1, words(3, 60)), (2, "ONE"), (3, None), (4, "..."), (5, words(4, 12).upper()), (10, " ".join(words(4, 80).split()[20:40])), (11, words(77, 30)), (12, "ab ab ab"), (None, "x")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (decontaminate.ITEMS_BYTES, 100):  # 100: groups of items
        m = decontaminate.matches(docs, bench, items_bytes=size)
        got = {r.doc_id: (r.n_words, r.n_hit, len(r.item_ids), hashlib.sha256(",".join(r.item_ids).encode()).hexdigest()) for r in m.collect()}
        want = {k: brute_contamination(t, items[:-1]) for k, t, *_ in awkward}
        assert got == want
    longest = {r.doc_id: r.longest for r in decontaminate.matches(docs, bench).collect()}
    assert longest[15] == 60
    clean = decontaminate.clean(docs.withColumn("n_hit", F.lit(0)), bench)
    assert sorted(r.doc_id or -1 for r in clean.collect()) == sorted(k or -1 for k, t, *_ in awkward if not brute_contamination(t, items[:-1])[1])
    assert clean.columns[-1] == "n_hit"
    assert decontaminate.matches(none, bench).count() == 0
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(awkward)


def test_decontamination_whatever_the_groups(spark):
    text = words(5, 60)
    other = words(6, 60)
    rows = [(1, text), (1, other), (None, text), (None, words(7, 40)), (3, text + " " + other), (4, None), (4, "")]
    df = spark.createDataFrame([(k, t, "own") for k, t in rows], "doc_id long, text string, item_id string")
    items = [(7, " ".join(text.split()[5:20])), (7, " ".join(other.split()[30:50])), (7, " ".join(text.split()[10:30])), (8, " ".join(other.split()[2:12])), (9, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = [(7, t) for k, t in items if k == 7]
    want = Counter()
    for k, t in rows:
        n, hit, _, _ = brute_contamination(t, items)
        ids = sorted({str(i) for i in (7, 8) if brute_contamination(t, [x for x in items if x[0] == i])[1]})
        want[k, n, hit, ",".join(ids)] += 1
    assert len(one) == 3
    for size in (8 << 20, 20):
        got = Counter((r.doc_id, r.n_words, r.n_hit, ",".join(r.item_ids)) for r in decontaminate.matches(df, bench, items_bytes=size).collect())
        assert got == want
        kept = decontaminate.clean(df, bench, items_bytes=size)
        assert kept.columns == df.columns
        assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter((k, t) for k, t in rows if not brute_contamination(t, items)[1])


# --- lines -----------------------------------------------------------------------------------


def test_lines(spark, docs, awkward, none):
    rows = [(100 + i, f"{words(i, 8)}\n  Subscribe now! \n{words(300 + i, 6)}", "en", f"s{i % 7}", 1) for i in range(40)]
    copied = words(9, 30) + "\n" + words(10, 30) + "\n" + words(11, 5)
    rows += [(200 + i, copied, "en", f"s{i % 7}", 1) for i in range(40)]
    few = [(300 + i, f"{words(500 + i, 5)}\nOnly here\n{words(700 + i, 5)}", "en", f"s{i % 4}", 1) for i in range(40)]
    df = docs.unionByName(spark.createDataFrame(rows + few, DOCS)).withColumn("line", F.lit("own"))
    out = {r.doc_id: r.text for r in lines.deduplicate(df).collect()}
    want = {r[0]: r[1] for r in [*awkward, *rows, *few]}
    for i in range(40):  # on 7 sites in 40 contexts: boilerplate; copies and lines of 4 sites stay
        want[100 + i] = "\n".join(x for x in want[100 + i].split("\n") if "Subscribe" not in x)
    assert out == want
    assert lines.deduplicate(df).columns == df.columns
    assert lines.deduplicate(none).count() == 0


def test_blocks_of_lines_go_and_near_copies_stay(spark):
    footer = "All about us\nWrite to us\nCookies and you\nTerms of use"
    pages = [(i, f"{words(i, 60)}\n{words(2000 + i, 60)}\n\n{footer}", "en", f"site{i}", 1) for i in range(60)]
    few = [(100 + i, f"{words(100 + i, 40)}\nSeen on six sites", "en", f"site{i}", 1) for i in range(6)]
    body = [words(3000 + j, 30) for j in range(12)]
    near = [(200 + i, "\n".join(b if j != i % 12 else words(4000 + i, 30) for j, b in enumerate(body)), "en", f"site{i}", 1) for i in range(40)]
    quoted = [(300 + i, f"{words(300 + i, 90)}\n{words(5000, 40)}", "en", f"site{i}", 1) for i in range(8)]
    df = spark.createDataFrame(pages + few + near + quoted, DOCS)
    out = {r.doc_id: r.text for r in lines.deduplicate(df).collect()}
    assert all(out[i] == t.removesuffix("\n" + footer) for i, t, *_ in pages)  # the blank line before the footer stays
    assert all(out[i] == t.removesuffix("\nSeen on six sites") for i, t, *_ in few)
    assert all(out[i] == t for i, t, *_ in [*near, *quoted])


def brute_lines(rows):
    """The rule of lines, row by row."""
    split = {i: [x.strip(" \t\n\x0b\x0c\r") for x in t.split("\n")] for i, t, _ in rows}
    site = {i: s for i, _, s in rows}
    size = lambda x: len(x.encode())

    def on(docs, bars):
        sites = {}
        for i in docs:
            for x in split[i]:
                if x:
                    sites.setdefault(x, set()).add(site[i])
        return {x for x, s in sites.items() if len(s) >= bars[size(x) > lines.LONG]}

    every = on(split, (lines.MIN_SITES, lines.MIN_SITES))
    own = {i: (sum(size(x) for x in v if x in every), sum(map(size, v))) for i, v in split.items()}
    strong = {i for i, (a, b) in own.items() if a <= lines.SHARE * b}
    weak = {i for i, (a, b) in own.items() if a < b and a <= lines.BANNER}
    bad = every & (on(strong, (lines.MIN_SITES, lines.LONG_SITES)) | on(strong | weak, (lines.SHORT_SITES, lines.LONG_SITES)))
    return {i: "\n".join(x for x, y in zip(t.split("\n"), split[i]) if y not in bad) for i, t, _ in rows}


def test_pages_that_are_mostly_boilerplate(spark):
    """A short line of its own above a footer, on 60 sites and on 12; copies and near copies beside them; columns with any name."""
    footer = "All about us and our work since then\nWrite to us at any time of day\nCookies and you, and what we keep\nTerms of use"
    pages = [(i, f"{words(i, 3)}\n{footer}", f"site{i}") for i in range(60)]
    other = [(100 + i, f"{words(100 + i, 2)}\nTwelve sites have this", f"site{i}") for i in range(12)]
    few = [(120 + i, f"{words(120 + i, 1)}\nEight sites have this", f"site{i}") for i in range(8)]
    copies = [(200 + i, words(9000, 20) + "\n" + words(9001, 20), f"site{i}") for i in range(40)]
    body = [words(3000 + j, 12) for j in range(20)]
    near = [(300 + i, "\n".join(b if j != i % 20 else words(4000 + i, 12) for j, b in enumerate(body)), f"site{i}") for i in range(40)]
    long = [(400 + i, f"{words(600 + i, 60)}\n{footer}\n \n", f"site{i % 9}") for i in range(20)]
    rows = [*pages, *other, *few, *copies, *near, *long, (500, "", "a"), (501, "\n\n", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for c in ("__r", "key", "row", "Bad", "kept", "_kept", "line", "l", "__removed"):
        df = df.withColumn(c, F.lit(c))
    cut = lines.deduplicate(df)
    assert cut.columns == df.columns
    out = {r.doc_id: r.text for r in cut.collect()}
    assert out == brute_lines(rows)
    assert not any(f in out[i] for i, _, _ in pages for f in footer.split("\n"))
    assert all(out[i] == t for i, t, _ in [*few, *copies, *near])
    assert not any("Twelve" in out[i] for i, _, _ in other)
    assert {r.key for r in cut.select("key").collect()} == {"key"}


# --- quality ---------------------------------------------------------------------------------


def graded(n, seed=0):
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for i in range(n):
        kind = int(rng.integers(0, 3))
        w = words(seed * 10_000 + i, int(rng.integers(30, 200))).split()
        if kind == 0:
            for _ in range(max(2, len(w) // 20)):
                w.insert(int(rng.integers(len(w))), ["nasty", "vile"][int(rng.integers(2))])
        if kind == 1:
            w = [x + "###" for x in w]
        rows.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, int(kind == 2), int(kind == 0)))
    return rows, labels


def test_quality_on_held_out_rows(spark):
    rows, labels = graded(1600)
    df = spark.createDataFrame(rows, DOCS)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.train(df.where("doc_id < 1400"), lab)
    assert (np.diff(model.thresholds) >= 0).all()
    s = quality.scored(spark, model)
    got = df.where("doc_id >= 1400").select("doc_id", s("text").alias("s")).select("doc_id", "s.*").collect()
    good = {k: q for k, q, _ in labels}
    right = sum((r.top_chance >= quality.KEEP) == bool(good[r.doc_id]) for r in got)
    assert right / len(got) > 0.95
    assert all(0 <= r.expected_grade <= 2 for r in got)


def test_quality_edges(spark, docs, none):
    no = spark.createDataFrame([(1, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    kept = quality.select(docs.withColumn("top_chance", F.lit(1)), no)
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted([8, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, -1])
    assert quality.select(none, no).count() == 0


def test_quality_scores_by_hand(spark, awkward):
    """Features counted one by one give the same score as the blocks of documents do."""
    rows, labels = graded(300, 3)
    df = spark.createDataFrame(rows, DOCS)
    model = quality.train(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    hashed = lambda x, low=True: int(quality.span_hashes(np.frombuffer(x, np.uint8), np.array([0]), np.array([len(x)]), lower=low)[0])
    one = spark.createDataFrame(awkward + rows[:20], DOCS)
    got = {r.text: (r.s.expected_grade, r.s.top_chance) for r in one.select("text", quality.scored(spark, model)("text").alias("s")).collect()}
    mask = (1 << quality.BITS) - 1
    for t in {r[1] for r in awkward + rows[:20]}:
        raw = (t or "").encode()
        found, last = Counter(), None
        for w in re.finditer(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", raw):
            h = hashed(w[0]) | 1
            own = [h]
            if len(w[0]) > quality.PREFIX:
                own.append(hashed(w[0][: quality.PREFIX]) ^ (0x5DEECE66D << 16))
            if len(w[0]) > 1 and re.fullmatch(rb"[A-Z]+", w[0]):
                own.append(int(quality._LOUD))
            if h == last:
                own.append(int(quality._AGAIN))
            last = h
            found.update((x >> 7) & mask for x in own)
        for m in re.finditer(rb"[\x00-\x08\x0E-\x1F\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", raw):
            found[((hashed(m[0][:4], False) & ~1) >> 7) & mask] += 1
        n = sum(found.values())
        score = sum(model.weights[i] * math.sqrt(c / n) for i, c in found.items())
        above = [1 / (1 + math.exp(-(score - t_))) for t_ in model.thresholds] if n else [0.0, 0.0]
        assert np.allclose(got[t], (sum(above), above[-1]), atol=1e-6)


def test_quality_takes_clashing_columns_and_repeated_ids(spark):
    rows, labels = graded(120, 4)
    df = spark.createDataFrame(rows + rows[:50], DOCS).withColumns({"grade": F.lit("own"), "rated_id": F.lit(1), "indexes": F.lit(2)})
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert quality.training_rows(df, lab, 60).count() == 60
    assert quality.select(df, lab).columns == df.columns


# --- licences --------------------------------------------------------------------------------


def test_licenses(spark, docs, none):
    texts = {
        1: "Hello there\nLicensed under the Apache License, Version 2.0.\nbye", 2: "Released under the MIT License.", 3: "The license of the work is fine and so are you.", 4: "see: This work is licensed under the GNU General Public License, version 3.\nLicensed under CC BY-NC 4.0.",
        5: "All rights reserved.", 6: None, 7: "", 8: "Licensed under CC BY 4.0.", 9: "version " * 500,
    }
    model = licenses.train([words(i, 12) for i in range(200)])
    got = {r.doc_id: r for r in licenses.scan(frame(spark, texts.items()), model).collect()}
    assert {k: got[k].families for k in texts} == {1: "Apache-2.0", 2: "MIT", 3: "", 4: "CC-BY-NC-4.0,GPL-3.0", 5: "Proprietary", 6: "", 7: "", 8: "CC-BY-4.0", 9: ""}
    assert (got[1].n_paragraphs, got[6].n_paragraphs) == (3, 0)
    para = licenses.paragraphs(frame(spark, texts.items()), model).where("family is not null").collect()
    assert {(r.doc_id, r.paragraph) for r in para if r.contained >= licenses.CONTAINED} == {(1, 1), (2, 0), (4, 0), (4, 1), (5, 0), (8, 0)}
    assert licenses.scan(docs).count() == 16
    assert licenses.scan(none).count() == 0


def test_licenses_wrapped_and_in_long_lines(spark):
    model = licenses.train([words(i, 12) for i in range(200)])
    mit, gpl, apache = licenses.TEMPLATES["MIT"][2], licenses.TEMPLATES["GPL-3.0"][1], licenses.TEMPLATES["Apache-2.0"][1]
    texts = {
        1: f"{words(1, 300)} Released under the MIT License. {words(2, 300)}", 2: "\n".join(textwrap.wrap(mit, 40)), 3: "# " + "\n# ".join(textwrap.wrap(gpl, 40)),
        4: f"{words(3, 200)}\n\n" + "\n".join(textwrap.wrap(apache, 40)), 5: "Released under\n\nthe MIT License", 6: words(4, 600),
    }
    got = {r.doc_id: (r.families, r.n_confirmed) for r in licenses.scan(frame(spark, texts.items()), model).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: "MIT", 2: "MIT", 3: "GPL-3.0", 4: "Apache-2.0", 5: "", 6: ""}
    assert got[1][1] == 1


MIT_NOTICE = '''MIT License

Copyright (c) 2020 Some One. All rights reserved.

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
'''
GPL_NOTICE = '''# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details.
'''
BSD_NOTICE = '''Copyright (c) 2011, The Project
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

* Redistributions of source code must retain the above copyright notice, this
  list of conditions and the following disclaimer.
* Neither the name of the copyright holder nor the names of its
  contributors may be used to endorse or promote products derived from
  this software without specific prior written permission.
'''
APACHE_NOTICE = '''Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
'''


def test_notices_as_they_are_found(spark):
    """Wrapped headers, with comment signs or without, joined to one line, inside a long line, or wrapped anew: the same families."""
    model = licenses.train([words(i, 12) for i in range(200)])
    want = {"MIT": MIT_NOTICE, "GPL-3.0": GPL_NOTICE, "BSD-3-Clause": BSD_NOTICE, "Apache-2.0": APACHE_NOTICE, "GPL-2.0": GPL_NOTICE.replace("version 3", "version 2").replace("software:", "software;")}
    texts, families = {}, {}
    for family, t in want.items():
        for form in (t, " ".join(t.split()), words(7, 400) + " " + " ".join(t.split()) + " " + words(8, 400), "\n\n".join("\n".join(textwrap.wrap(x, 30)) for x in t.split("\n\n")), t.upper()):
            families[len(texts)] = family
            texts[len(texts)] = form
    for plain in ("Copyright (c) 2020 Some One. All rights reserved.", "Copyright 2011 Foo Inc, all rights reserved.\n" + words(3, 50), "We use the software of the library for any purpose, and the public may see the work.\n" * 3):
        families[len(texts)] = ""
        texts[len(texts)] = plain
    got = {r.doc_id: r.families for r in licenses.scan(frame(spark, texts.items()), model).collect()}
    assert got == families


def test_verdicts_of_held_out_templates():
    """Whole templates that the first fit doesn't see are mostly given to their family or left unknown, rarely to another."""
    held = licenses.held_out_templates()
    assert len(held) > 15
    texts = [(f, t) for f, ts in licenses.TEMPLATES.items() for t in ts if t in held]
    known = np.unique(np.concatenate(licenses._block([t for ts in [*licenses.TEMPLATES.values(), licenses.GENERIC] for t in ts])[0]))
    seen, classes = licenses.variants(np.random.default_rng(0), [words(i, 9) for i in range(50)], held)
    w, b = licenses._fitted(licenses._matrix(seen + [words(i, 9) for i in range(100)], known), np.array(classes + [0] * 100))
    x = licenses._matrix([t for _, t in texts], known)
    used = np.flatnonzero(np.abs(w).sum(axis=1))
    assert len(used) < len(known)
    p = licenses.Model(known[used], w[used], b, 1.0).chances((x[:, used] @ w[used]) * np.sqrt(10), np.full(len(x), 10))
    said = [licenses.FAMILIES[k] if p[i, k] >= licenses.LIKELY else "unknown" for i, k in enumerate(p.argmax(axis=1))]
    wrong = [(f, g) for (f, _), g in zip(texts, said) if g not in (f, "unknown")]
    assert len(wrong) <= 0.25 * len(texts)


def test_a_long_stretch_of_notices_is_scanned_quickly():
    model = licenses.train([])
    text = (GPL_NOTICE + APACHE_NOTICE) * 100
    block = next(licenses.blocks([pa.RecordBatch.from_pylist([{"doc_id": 1, "text": text}])], 1 << 30))
    found = licenses.scan_block(block, model)
    assert next(found).tolist() == [1500]
    families = {x[2] for x in found if x[4] >= licenses.CONTAINED}
    assert {"GPL-3.0", "Apache-2.0"} <= families


def test_licenses_held_out():
    model = licenses.train([words(i, 12) for i in range(300)], seed=1)
    assert (model.weights != 0).mean() < 0.5
    texts, classes = licenses.variants(np.random.default_rng(99), [words(i, 9) for i in range(50)])
    right = total = 0
    for i in range(0, len(texts), 500):
        batch = pa.RecordBatch.from_pylist([{"doc_id": j, "text": t} for j, t in enumerate(texts[i : i + 500])])
        for block in licenses.blocks([batch], 1 << 30):
            found = licenses.scan_block(block, model)
            next(found)
            said = {d: f for d, _, f, _, c in found if c >= licenses.CONTAINED}
            for j, k in enumerate(classes[i : i + 500]):
                total += 1
                right += said.get(j, "unknown") == licenses.FAMILIES[k]
    assert right / total > 0.9


# --- scoring ---------------------------------------------------------------------------------


def test_mixing(spark, docs, awkward, none):
    rows = [(1000 + i, words(i % 150, 120), "en", "a", 1) for i in range(300)]
    df = docs.unionByName(spark.createDataFrame(rows, DOCS))
    all_rows = [r for r in [*awkward, *rows] if r[0] is not None]
    held = lambda k: zlib.crc32(str(k).encode()) % 5 == 1
    tokens = [(k, [*re.findall(rb"[^\x20\x09-\x0D]+", lower((t or "").encode())), None]) for k, t, *_ in all_rows]
    c = Counter(x for k, w in tokens if not held(k) for x in w)
    n, v = sum(c.values()), len(c)
    want = Counter((k, held(k), len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6)) for k, w in tokens)
    got = mixing.score(df).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    out = [r for r in got if r.held_out and r.doc_id >= 1000]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)  # half of the texts come twice
    assert all(r.score < 0 for r in got)
    assert mixing.score(none).count() == 0


HELD = [i for i in range(100_000, 130_000) if zlib.crc32(str(i).encode()) % 5 == 1]
TRAIN = [i for i in range(100_000, 100_200) if zlib.crc32(str(i).encode()) % 5 != 1]


def told_of(rows):
    """A model fitted on all of some rows and what the counts say of them, without Spark."""
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["doc_id", "text"])
    (one,) = mixing._shards()([batch])
    row = one.to_pylist()[0]
    shard = mixing.Shard(row["ids"], row["ends"], row["text"])
    tables, code = mixing.Tables(), mixing.Code(row["bytes"])
    tables.learn(shard, code)
    model = mixing.Model(code, tables.stretch(code), tables.n[mixing.LEAVES][0])
    told = mixing.Told(shard, [shard.counts(k) for k in range(3)], model.leaves)
    return model, told


def test_mixing_tells_the_counts_of_the_other_documents(awkward):
    rows = [(k, t) for k, t, *_ in awkward if k is not None] + [(i, words(n % 9, 40)) for n, i in enumerate([*TRAIN[:30], *HELD[:10]])]
    _, told = told_of(rows)
    texts = [[*re.findall(rb"[^\x20\x09-\x0D]+", lower((t or "").encode())), None] for _, t in rows]
    held = [zlib.crc32(str(k).encode()) % 5 == 1 for k, _ in rows]

    def grams(w, n):  # the n words to each place; the start is one more token
        return Counter(tuple((["start", *w])[max(0, j - n + 2) : j + 2]) for j in range(len(w)))

    all_ = [sum((grams(w, n) for w, h in zip(texts, held) if not h), Counter()) for n in (1, 2, 3)]
    at = 0
    for w, h in zip(texts, held):
        own = [Counter() if h else grams(w, n) for n in (1, 2, 3)]
        left = lambda n, g: all_[n - 1][g] - own[n - 1][g]  # noqa: E731, B023
        for j, x in enumerate(w):
            line = ["start", *w]
            assert told.known[at] == (left(1, (x,)) > 0)
            two = left(1, (w[j - 1],)) if j else 0
            three = left(2, tuple(line[j - 1 : j + 1])) if j else 0
            assert told.asked["two"][at] == (two > 0) and told.asked["three"][at] == (three > 0)
            if two:
                assert math.isclose(told.foretold["two"][at], left(2, (w[j - 1], x)) / two)
            if three:
                assert math.isclose(told.foretold["three"][at], left(3, tuple(line[j - 1 : j + 2])) / three)
            assert math.isclose(told.foretold["again"][at], w[:j].count(x) / max(j, 1))
            at += 1
    assert at == len(told.known)


def test_mixing_is_a_distribution():
    train = [(i, words(n % 6, 30)) for n, i in enumerate(TRAIN[:40])]
    vocabulary = sorted({w for _, t in train for w in t.split()})
    for start in (words(2, 30).split()[:5], words(99, 4).split(), [vocabulary[0]] * 9):
        ends = [*vocabulary, None, *(a + b for a in "qxzw" for b in ["", "j", "qq"]), *(v[:2] for v in vocabulary if v[:2] not in vocabulary and len(v) > 2)]
        ends = list(dict.fromkeys(ends))
        asked = [(HELD[k], " ".join([*start, x] if x else start)) for k, x in enumerate(ends)]
        model, told = told_of(train + asked)
        model.fit(told)
        cost = model.score(told)
        first = told.shard.bounds[len(train) : -1] + len(start)
        total = float((10 ** cost[first]).sum())
        assert 0.4 < total <= 1 + 1e-6


def test_mixing_learns_from_all_training_documents():
    """Sums of two shards are those of both together, held-out texts add nothing, and the step makes the training texts cheaper."""
    rows = [(i, words(n % 25, 60)) for n, i in enumerate(TRAIN[:80])]
    model, told = told_of(rows)
    for d in model.deciders.values():
        d.settle()
    sums = model.sums(told)
    before = model.score(told).sum()
    parts = []
    for some in (rows[:30] + [(HELD[0], words(7, 50))], rows[30:]):
        _, own = told_of(some)
        totals = []
        for kind in range(3):
            n = dict(zip(told.shard.grams[kind][0].tolist(), told.shard.counts(kind).tolist()))
            totals.append(np.array([n.get(g, 0) for g in own.shard.grams[kind][0].tolist()]))
        parts.append(model.sums(mixing.Told(own.shard, totals, model.leaves)))
    assert np.allclose(parts[0] + parts[1], sums, rtol=1e-9, atol=1e-9)
    model.step(sums)
    assert all(np.isclose(n.sum(), told.shard.train[told.asked[k]].sum()) for k, d in model.deciders.items() for n in d.n)
    assert model.score(told).sum() > before


def test_documents_beyond_the_first_sample_change_the_model(spark, monkeypatch):
    """The step counts every training token, though the first model saw one document."""
    monkeypatch.setattr(mixing, "FIT_DOCS", 1)
    seen, real = [], mixing.Model.step
    monkeypatch.setattr(mixing.Model, "step", lambda self, sums: (real(self, sums), seen.append(self.deciders["known"].n[0].sum()))[0])
    rows = [(i, words(n % 12, 80)) for n, i in enumerate(TRAIN[:40])]
    mixing.score(frame(spark, rows)).collect()
    assert np.allclose(seen, [40 * 81])


def test_counts_summed_in_groups_of_shards_are_the_same(spark, monkeypatch):
    rows = [(i, words(n % 12, 80)) for n, i in enumerate([*TRAIN[:40], *HELD[:10]])]
    df = frame(spark, rows).repartition(5)
    monkeypatch.setattr(mixing, "SHARD_BYTES", 4000)
    one = {r.doc_id: (r.score, r.base_score, r.n_known) for r in mixing.score(df).collect()}
    monkeypatch.setattr(mixing, "GROUP", 2)
    two = {r.doc_id: (r.score, r.base_score, r.n_known) for r in mixing.score(df).collect()}
    assert all(np.allclose(one[k], two[k], rtol=1e-9) for k, _ in rows)


def test_scores_depend_on_training_documents_alone(spark):
    rows = [(i, words(n % 12, 80)) for n, i in enumerate([*TRAIN[:40], *HELD[:10]])]
    changed = [(k, "other Ωmega Words" * 9) if k == HELD[3] else (k, t) for k, t in rows]
    one, two, three = (
        {r.doc_id: (r.score, r.base_score) for r in mixing.score(df).collect()}
        for df in (frame(spark, rows).coalesce(1), frame(spark, changed).coalesce(1), frame(spark, reversed(rows)).repartition(3))
    )
    for k, _ in rows:
        assert k == HELD[3] or np.allclose(one[k], two[k], rtol=1e-9)
        assert np.allclose(one[k], three[k], rtol=1e-9)
    copies = [k for k, t in rows if k in HELD]
    assert all(one[k][0] > 0.5 * one[k][1] for k in copies)  # what training documents say too costs little
