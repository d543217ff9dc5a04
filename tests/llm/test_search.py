"""Main text, phrases and ranked search against brute force."""

import math
import re
from collections import Counter
from itertools import product

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from made_up import words

from corpusflow.llm import layouts, maintext, phrases, retrieval
from corpusflow.llm.common import blocks

DATA = "/root/testdata/sf0.001"


def block_of(texts):
    return list(blocks([pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)})]))


def same(got: pd.DataFrame, want: pd.DataFrame):
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert sorted(map(str, got[cols].values.tolist())) == sorted(map(str, want[cols].values.tolist()))


def against_sql(frame: pd.DataFrame, sql: str, **tables: pd.DataFrame):
    c = duckdb.connect()
    for name, t in tables.items():
        c.register(name, t)
    same(frame, c.execute(sql).df())


# --- main text -------------------------------------------------------------------------------


def texts_of(source):
    tree = maintext.Tree()
    maintext.parse(source, tree)
    return [(tree.tag[p], t) for p, t in zip(tree.parent, tree.text) if t is not None]


@pytest.mark.parametrize(
    "source, want",
    [
        ("<p>a<p>b", [("p", "a"), ("p", "b")]),
        ("<p>a <b>b<br>c</p>d", [("p", "a b c"), ("html", "d")]),
        ('<script>var t="</p>";</script><p>x&amp;y&nbsp; z</p>', [("p", "x&y z")]),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", [("li", "a"), ("li", "b"), ("li", "c")]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", [("td", "a"), ("td", "b"), ("td", "c")]),
        ('<div title="a>b">x<!-- <p>no --> y</div>', [("div", "x y")]),
        ("a < b <p>c<p", [("html", "a < b"), ("p", "c")]),
        ("<article>one<div>two</div>three", [("article", "one"), ("div", "two"), ("article", "three")]),
        ("<style>p{}", []),
        ("</p></div><p>x", [("p", "x")]),
        ("<P CLASS=x>A</P>", [("p", "A")]),
    ],
)
def test_parse(source, want):
    assert texts_of(source) == want


def test_marginals_and_gradient_are_those_of_all_labellings():
    f = maintext.forest(["<div class=content><p>one two. three</p><ul><li>a<li>b</ul></div><footer>c</footer>"])
    rng = np.random.default_rng(3)
    m = maintext.Model(rng.normal(size=1 << maintext.BITS), rng.normal(size=(maintext.N_KINDS, 2, 2)))
    n = len(f.parent)
    assert n < 16
    all_ = [np.array(y) for y in product((0, 1), repeat=n)]
    chance = np.exp([m.likelihood(f, y) for y in all_])
    assert chance.sum() == pytest.approx(1)
    assert m.marginals(f) == pytest.approx(sum(c * y for c, y in zip(chance, all_)))
    label = all_[11]
    weights, pairs = m.gradient(f, label)
    base = m.likelihood(f, label)
    for k in (int(f.index[0]), int(f.index[-1])):
        m.weights[k] += 1e-5
        assert (m.likelihood(f, label) - base) / 1e-5 == pytest.approx(weights[k], abs=1e-3)
        m.weights[k] -= 1e-5
    m.pairs[0, 1, 1] += 1e-5
    assert (m.likelihood(f, label) - base) / 1e-5 == pytest.approx(pairs[0, 1, 1], abs=1e-3)


@pytest.fixture(scope="module")
def model():
    f_pages = [layouts.labelled(i) for i in range(300)]
    f = maintext.forest([h for h, _ in f_pages])
    return maintext.Model().fit(f, maintext.labels(f, [t for _, t in f_pages]), 120)


def test_held_out_pages(model):
    pages = [layouts.labelled(10_000 + i) for i in range(150)]
    found = missed = extra = 0
    for got, (_, want) in zip(maintext.main_texts(model, [h for h, _ in pages]), pages):
        a, b = Counter(got.split("\n\n")), Counter(want.split("\n\n"))
        found, missed, extra = found + (a & b).total(), missed + (b - a).total(), extra + (a - b).total()
    assert found / (found + missed) > 0.97
    assert found / (found + extra) > 0.97


def test_pages_are_judged_alike_in_any_batch(model):
    pages = [layouts.labelled(i)[0] for i in range(500, 530)]
    assert maintext.main_texts(model, pages) == [maintext.main_texts(model, [p])[0] for p in pages]


def test_extract_awkward(spark, model):
    long = "<article><h1>t</h1>" + "".join(f"<p>{words(i, 40)}.</p>" for i in range(3000)) + "</article>"
    rows = [(1, None, "u", 1), (2, "", "u", 2), (3, "   ", None, 3), (None, "<p>" * 5000 + "deep", "u", 4), (4, long, "u", 5), (4, long, "u", 5), (5, "<article><p>" + words(7, 50) + ".", "u", 6)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string, n_chars long")
    out = maintext.extract(pages, model).toPandas()
    assert list(out.columns) == ["page_id", "html", "text", "n_chars"] and len(out) == len(rows)
    got = list(zip(out["page_id"].fillna(-1).tolist(), out["text"], out["n_chars"]))
    assert [t for i, t, _ in got if i in (1, 2, 3)] == ["", "", ""]
    assert all(len(t) == n for _, t, n in got)
    assert [t for i, t, _ in got if i == 4] == ["t\n\n" + "\n\n".join(words(i, 40) + "." for i in range(3000))] * 2
    assert maintext.extract(pages.limit(0), model).count() == 0


def test_train_in_spark(spark):
    m = maintext.train(maintext.made_up(spark, 40).unionByName(spark.createDataFrame([(None, "x"), ("", None)], "html string, text string")), 42)
    assert maintext.main_texts(m, [layouts.labelled(3)[0]])[0]


# --- phrases ---------------------------------------------------------------------------------


def brute_phrases(rows):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= 10}
    out = []
    for (lang, p), a in cand.items():
        if any(l == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * b >= 50 * a for (l, q), b in cand.items()):
            continue
        s, _, l, r = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, -s, -a, " ".join(p).encode(), l, r))
    out.sort()
    ranks = Counter()
    rows = []
    for lang, s, a, p, l, r in out:
        ranks[lang] += 1
        rows.append((lang, ranks[lang], p.decode(), -a, l, r, n[lang], -s))
    return rows


AWKWARD = [
    *[("en", "New York. the New York Times! " * 7), ("en", None), (None, "a b c a b c a b c a b c a b c " * 3), ("en", ""), ("", "x y " * 30), ("en", "new\tyork " * 5 + "\x00 z " * 20), ("de", "naïve ß É é. " * 15), ("de", "aa aa aa aa " * 20)],
    *[("en", words(i % 3, 60)) for i in range(40)],
]


def test_phrases_brute_force(spark):
    docs = spark.createDataFrame([(t, l, 1) for l, t in AWKWARD], "text string, lang string, n long").repartition(3)
    got = phrases.collocations(docs).toPandas()
    assert sorted(map(tuple, got.values.tolist())) == sorted(brute_phrases(AWKWARD))
    against_sql(got, phrases.ORACLE_SQL, documents=pd.DataFrame(AWKWARD, columns=["lang", "text"]))
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_phrases_summed_in_groups(spark):
    docs = spark.createDataFrame([(t, l) for l, t in AWKWARD * 2], "text string, lang string").repartition(5)
    one = phrases.mined(docs).collect()
    many = phrases.mined(docs, bucket_words=500, group_shards=2).collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_bitmaps():
    maps = phrases.Bitmaps.of(block_of([t or "" for _, t in AWKWARD]))
    again = phrases.Bitmaps.read(*maps.row()[1:])
    assert again.vocabulary == maps.vocabulary and (again.block == maps.block).all() and (again.bits == maps.bits).all()
    want = Counter(w for _, t in AWKWARD for p in re.split("[.,;:!?\x0a-\x0d]", (t or "").lower()) for w in re.split("[\x20\x09]+", p) if w)
    assert {w.decode(): n for w, n in zip(maps.vocabulary, maps.counts().tolist())}["new"] == want["new"]


# --- search ----------------------------------------------------------------------------------


def cost(values, ends, each):
    at, out = 0, 0
    for e in ends:
        out += max(values[at:e]) * (e - at) - sum(values[at:e]) + each
        at = e
    return out


def test_boundaries_are_best():
    rng = np.random.default_rng(1)
    lists = [rng.integers(1, 50, n).astype(np.int64) for n in (1, 9, 0, 12, 5, 1)]
    starts = np.cumsum([0, *map(len, lists)])
    ends, tops = retrieval.boundaries(np.concatenate(lists), starts, 40.0)
    for i, v in enumerate(lists):
        own = [int(e - starts[i]) for e in ends if starts[i] < e <= starts[i + 1]]
        assert not len(v) or own[-1] == len(v)
        best = min((cost(v, [*(k + 1 for k in range(len(v) - 1) if m >> k & 1), len(v)], 40.0) for m in range(1 << max(0, len(v) - 1))), default=0) if len(v) else 0
        assert (cost(v, own, 40.0) if len(v) else 0) == pytest.approx(best)
    begin = np.concatenate(([0], ends[:-1]))
    assert tops.tolist() == [int(np.concatenate(lists)[a:b].max()) for a, b in zip(begin, ends)]


def terms(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def brute_search(docs, items, top):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n, total = sum(1 for _, b in bags if b), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    own = {}
    for i, t in items:
        if i is not None:
            own.setdefault(i, set()).update(terms(t))
    out = []
    for item, q in own.items():
        rows = []
        for i, b in bags:
            m = 10 + 90 * b.total() * n // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in q if b[t])
            if s > 0:
                rows.append((-s, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(rows, key=lambda r: (r[0], r[1], r[2] or 0))[:top])]
    return out


def test_search_brute_force(spark):
    docs = [(None, words(5, 30)), (None, words(5, 30)), (1, None), (2, ""), (3, " .\x00 "), (4, words(1, 3000)), (5, words(2, 40)), (5, words(2, 40)), (6, words(2, 40)), *[(i, words(i % 50, 10 + i % 90)) for i in range(10, 400)]]
    items = [(1, words(2, 12)), (2, words(7, 30)), (2, words(8, 5)), (3, None), (4, "zzz"), (None, words(2, 3)), (5, words(1, 200)), (6, "The the THE")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    i = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(None if v != v else v for v in r) for r in retrieval.Index.of(d).search(i).toPandas().astype(object).where(lambda x: x.notna(), None).values.tolist()]
    assert sorted(got, key=str) == sorted(brute_search(docs, items, 10), key=str)
    assert retrieval.Index.of(d.limit(0)).search(i).count() == 0
    assert retrieval.Index.of(d).search(i.limit(0)).count() == 0


def test_search_skips_and_stays_exact():
    """Many small blocks, a bar from the start: what is passed over could not have counted."""
    docs = [(i, words(i % 40, 5 + i % 60)) for i in range(600)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([i for i, _ in docs]), "text": pa.array([t for _, t in docs])})
    (raw,) = retrieval._raw_rows(iter([batch]))
    n, total = raw.column("n_docs")[0].as_py(), raw.column("n_terms")[0].as_py()
    (row,) = retrieval._blocked(n, total)(iter([raw]))
    shard = retrieval.Shard({c: row.column(c)[0].as_py() for c in row.schema.names})
    df = Counter(t for _, x in docs for t in set(terms(x)))
    for item in (words(3, 8), words(9, 40), words(11, 2)):
        (block,) = block_of([item])
        asked = np.unique(retrieval.terms_of(block)[1])
        by_hash = dict(zip(retrieval.terms_of(block)[1].tolist(), terms(item)))
        w = np.array([retrieval.weight(n, df[by_hash[t]]) if df[by_hash[t]] else 0 for t in asked.tolist()], np.int64)
        want = [(i, s) for _, _, i, s in brute_search(docs, [(1, item)], 10)]
        for seeds in (1, 4, 1000):
            for bar in (1, want[-1][1]) if want else (1,):
                d, s = retrieval.search_shard(shard, asked, w, bar, 10, n, total, seeds)
                assert sorted(zip((-s).tolist(), d.tolist()))[:10] == [(-x, i) for i, x in want]


@pytest.mark.parametrize("name", ["op12_phrases", "op13_search"])
def test_against_sql(spark, name):
    from corpusflow.llm.queries import ORACLES, QUERIES

    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    same(QUERIES[name](spark, DATA).toPandas(), c.execute(ORACLES[name]).df())
