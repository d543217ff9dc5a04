import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from made_up import words
from pyspark.sql import functions as F

from corpusflow.llm import chunks, collisions, common, simhash, suffixes



def texts(rows):
    return {r[0]: (r[1] or "").encode() for r in rows if r[0] is not None}


def roots(ids, links):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


# --- simhash ---------------------------------------------------------------------------------


def brute_fingerprint(text, n):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text))
    if not w:
        return 0
    s = [b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def test_simhash(spark, docs, awkward, monkeypatch):
    want = {k: brute_fingerprint(v, 3) for k, v in texts(awkward).items()}
    comp = roots(want, [(a, b) for a in want for b in want if a < b and (want[a] ^ want[b]).bit_count() <= 3])
    for chunk in (simhash.CHUNK, 2):  # 2: all anchors are split
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        got = simhash.groups(docs, 3, 1, 2, 32, 1, 3).collect()
        assert len(got) == 15
        assert all(r.f0 & (2**64 - 1) == want[r.doc_id] and r.component_id == comp[r.doc_id] for r in got)


def test_simhash_finds_all_pairs_within_three_bits(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40)
    f = [int(x) for x in base] + [int(x) ^ sum(1 << int(b) for b in rng.choice(62, d, replace=False)) for x in base for d in (1, 2, 3, 4)]
    nodes = spark.createDataFrame([(i, x) for i, x in enumerate(f)], "node long, f0 long")
    links = [(r.a, r.b) for r in simhash.links(nodes, 1, 2, 32, 1, 3).collect()]
    ids = range(len(f))
    assert roots(ids, links) == roots(ids, [(a, b) for a in ids for b in ids if a < b and (f[a] ^ f[b]).bit_count() <= 3])


def test_keep_one(spark, docs, none):
    kept = simhash.keep_one(docs.withColumn("component_id", F.lit("own")).withColumn("f0", F.lit(1)))
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [5, 8, 8, 10, 12, 14, 15, 16, 17, 18]
    assert ids.count(None) == 1
    assert kept.columns[-2:] == ["component_id", "f0"]
    assert simhash.keep_one(none).count() == 0


def jaccard(a, b, n=5):
    s, t = (set(simhash.shingles(x.encode(), n)) for x in (a, b))
    return len(s & t) / max(1, len(s | t))


def test_near_duplicates_recall_at_the_bar(spark):
    """Pairs just above 0.8 are found, at 0.7 none is linked, nor texts that share a passage said often."""
    rows, want, far = [], [], []
    rng = np.random.default_rng(2)
    for i in range(300):
        w = words(7000 + i, 300).split()
        v = list(w)
        for at in rng.choice(58, 6 if i < 200 else 10, replace=False):
            v[5 * int(at) + 3] = f"new{at}"
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
        (want if i < 200 else far).append((2 * i, 2 * i + 1))
    said = " ".join([words(1, 12)] * 40)
    rows += [(1000 + i, said + " " + words(9000 + i, 200)) for i in range(5)]
    text = dict(rows)
    assert all(0.8 <= jaccard(text[a], text[b]) < 0.83 for a, b in want)
    assert all(jaccard(text[a], text[b]) < 0.75 for a, b in far)
    assert jaccard(text[1000], text[1001]) < 0.1
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert np.mean([got[b] == a for a, b in want]) >= 0.95
    assert all(got[b] == b for _, b in far)
    assert all(got[1000 + i] == 1000 + i for i in range(5))


def test_no_unconfirmed_link_stands_for_another(spark):
    """Texts on both sides of the bar: of all candidates, each pair of 0.8 or more ends in one group, whatever lies between them."""
    rows, rng = [], np.random.default_rng(6)
    for base in range(25):
        w = words(30_000 + base, 300).split()
        for i in range(12):
            v = list(w)
            for at in rng.choice(20, 4, replace=False):
                v[14 * int(at) + 5] = f"new{i}"
            rows.append((12 * base + i, " ".join(v)))
    f = np.array([simhash.fingerprint(t.encode(), 5, 4)[:4] for _, t in rows], np.uint64)
    bit = (f[:, np.arange(256) // 64] >> (np.arange(256, dtype=np.uint64) % np.uint64(64))).astype(np.uint8) & 1
    bands, width, distance = simhash.plan(len(rows), 0.8, 256)
    want = []
    for a, b in ((a, b) for a in range(len(rows)) for b in range(a + 1, a - a % 12 + 12)):
        differ = bit[a] != bit[b]
        if differ.sum() <= distance and any(differ[x].sum() <= 1 for x in simhash.band_bits(bands, width, 256)) and jaccard(rows[a][1], rows[b][1]) >= 0.8:
            want.append((a, b))
    assert len(want) > 100
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(a, b) for a, b in want if got[a] != got[b]] == []
    assert len(set(got.values())) > 25


def test_no_table_of_pairs_in_a_cluster_at_the_bar(spark, monkeypatch):
    """Texts on both sides of the bar, all candidates of each other: all links between them count, but no table has a row for each pair."""
    rng = np.random.default_rng(8)
    w = words(40_000, 300).split()
    rows = []
    for i in range(240):
        v = list(w)
        for at in rng.choice(24, 5, replace=False):
            v[12 * int(at) + 5] = f"new{i}"
        rows.append((i, " ".join(v)))
    rows += [(240 + i, " ".join([*rows[0][1].split()[:-1], f"last{i}"])) for i in range(30)]  # a group larger than a chunk
    texts = dict(rows)
    sets = {k: set(simhash.shingles(t.encode(), 5)) for k, t in rows}
    f = {k: np.array(simhash.fingerprint(t.encode(), 5, 4)[:4], np.uint64) for k, t in rows}
    distance = simhash.plan(len(rows), 0.8, 256)[2]
    pairs = [(a, b) for a in texts for b in texts if a < b and np.bitwise_count(f[a] ^ f[b]).sum() <= distance]
    group = {k: k for k in texts}
    for a, b in pairs:
        if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8 and group[a] != group[b]:
            low, high = sorted((group[a], group[b]))
            group = {k: low if g == high else g for k, g in group.items()}
    assert len(pairs) > 5000 and 20 < len(set(group.values())) < 200
    written, materialise = [], simhash.materialise

    def counted(df):
        out = materialise(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(simhash, "materialise", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(simhash, "DEALT", 2, raising=False)  # the cluster is dealt
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert max(written) <= 4 * len(rows)
    assert got == group


def test_near_duplicates_comparisons_grow_less_than_quadratically(spark):
    """Comparisons a text, with unrelated ones, in all bands: they grow with less than the 0.4th power of the texts."""
    rng = np.random.default_rng(4)
    each = []
    for lg in (20, 22, 30):
        bands, width, _ = simhash.plan(1 << lg, 0.8, 256)
        checks = (width + 1).bit_length() - 1
        anchors, replicas = 2 ** (width - checks), np.mean([(row >= 0).sum() for row in simhash.Code(width, 1).patterns])
        each.append(bands * replicas * 2**lg / anchors)
    assert each[1] < 4**0.4 * each[0]
    assert each[2] < 1024**0.4 * each[0]
    bands, width, _ = simhash.plan(1 << 26, 0.8, 256)
    chosen = simhash.band_bits(bands, width, 256)
    assert len(chosen) == bands and all(len(set(b.tolist())) == width for b in chosen)
    f = rng.integers(-(2**63), 2**63, (200, 4))
    near = f.copy()
    for i in range(200):
        for bit in rng.choice(256, 30, replace=False):
            near[i, bit // 64] ^= np.int64(np.uint64(1) << np.uint64(bit % 64))
    nodes = spark.createDataFrame([(i, *map(int, x)) for i, x in enumerate(np.concatenate((f, near)))], "node long, f0 long, f1 long, f2 long, f3 long")
    links = {(min(r.a, r.b), max(r.a, r.b)) for r in simhash.links(nodes, 4, bands, width, 1, 54, (20, 40)).collect()}
    assert len(links & {(i, 200 + i) for i in range(200)}) >= 196 and len(links) == len(links & {(i, 200 + i) for i in range(200)})


# --- substrings ------------------------------------------------------------------------------


def brute_repeats(t, n=50):
    first = {}
    for k in sorted(t):
        for i in range(len(t[k]) - n + 1):
            first.setdefault(t[k][i : i + n], k)
    out = {}
    for k, b in t.items():
        end, kept, runs, inside = 0, bytearray(), 0, False
        for i in range(len(b)):
            if i + n <= len(b) and first[b[i : i + n]] < k:
                end = i + n
            if i < end:
                runs += not inside
            else:
                kept.append(b[i])
            inside = i < end
        out[k] = (len(b), len(b) - len(kept), runs, hashlib.sha256(bytes(kept)).hexdigest())
    return out


def test_suffixes(spark, docs, awkward, none):
    got = suffixes.deduplicate(docs).collect()
    want = brute_repeats(texts(awkward))
    assert len(got) == 15
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id] for r in got)
    assert any(r.n_removed for r in got)
    assert suffixes.deduplicate(none).count() == 0


def test_suffixes_over_windows(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "WINDOW_BYTES", 3000)
    rows = []
    for i in range(60):
        shared = words(100 + i % 7, 40)
        rows.append((i, f"{words(i, 30)} {shared[i % 11 :]} {words(1000 + i, 9)} {shared[: 30 + i]}", "en", "a", 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = brute_repeats({r[0]: r[1].encode() for r in rows})
    own = suffixes.remove(df, suffixes.repeats(df)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in own} == want


def test_a_frequent_minimizer_is_split(spark, monkeypatch):
    """One string in very many contexts: its fragments are dealt over many buckets, and nothing is lost."""
    monkeypatch.setattr(suffixes, "WINDOW_BYTES", 30_000)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 20_000)
    stop = "\x01\x02\x03\x04\x05\x06\x07\x08\x0e\x0f\x10\x11"

    def rank(w):  # the hash by which minimizers are chosen
        u = suffixes._longs(np.frombuffer(w.encode(), np.uint8))
        return common.mix(common.mix(u[:1]) + u[4:5])[0]

    often = next(w for w in (words(5000 + i, 9)[:12] for i in range(10_000)) if len(w.encode()) == 12 and rank(w) < 2**56)
    rows = []
    for i in range(120):
        w = words(100 + i % 90, 60).split()
        rows.append((i, "".join(f"{a} {often} " if k % 2 else f"{a} " for k, a in enumerate(w)) + (stop if i % 3 else ""), "en", "a", 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    total = sum(len(r[1].encode()) for r in rows)
    hot = suffixes.minimizers_to_split(df.select("doc_id", "text"), total, 50)
    assert rank(often) in hot
    batch = pa.RecordBatch.from_pylist([{"doc_id": r[0], "text": r[1]} for r in rows])
    largest = {}
    for split in (np.zeros(0, np.uint64), hot):
        sizes = {}
        for b in suffixes._send(200, 50, split)([batch]):
            for bucket, kind, blob in zip(*(b.column(k).to_pylist() for k in (0, 1, 3))):
                if kind == 0:
                    sizes[bucket] = sizes.get(bucket, 0) + len(suffixes._unpack(blob)["data"])
        largest[len(split)] = max(sizes.values())
    assert largest[len(hot)] < 0.3 * largest[0]
    want = brute_repeats({r[0]: r[1].encode() for r in rows})
    own = suffixes.remove(df, suffixes.repeats(df)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in own} == want


def test_what_is_merged_is_pruned_to_what_may_be_repeated():
    """Fragments that share less than 45 bytes around their minimizer aren't merged, a repeated string always is."""
    rng = np.random.default_rng(5)
    middle = rng.integers(97, 123, 200).astype(np.uint8)
    made = []
    for n in (30, 34, 38, 42, 50, 58):  # bytes in common with the same number's other document
        for _ in range(2):
            b = rng.integers(97, 123, 88).astype(np.uint8)
            b[38 - (n - 12) // 2 : 50 + (n - 12) // 2] = middle[100 - n // 2 : 100 + n // 2] ^ np.uint8(n)
            made.append(b)
    n = len(made)
    at, size, mark, doc = np.arange(n) * 88, np.full(n, 88), np.full(n, 38), np.arange(n)
    begin, left = suffixes._pruned(np.concatenate(made), at, size, mark, doc, 50)
    assert not left[:8].any() and (left[8:] >= 50).all() and (left[8:] < 88).all()
    for k in range(8, n, 2):
        first = 38 - (len(made[0]) - 88) - ((50 if k < 10 else 58) - 12) // 2
        assert (begin[k : k + 2] <= first).all() and (begin[k : k + 2] + left[k : k + 2] >= first + (50 if k < 10 else 58)).all()


def test_many_buckets_cost_a_window_no_longer_loop(monkeypatch):
    """Blobs of a window come together, and its numbers take less room beside the text than they do mixed with it."""
    rows = [{"doc_id": i, "text": words(40_000 + i, 300)} for i in range(200)]
    sent = list(suffixes._send(500, 50, np.zeros(0, np.uint64))([pa.RecordBatch.from_pylist(rows)]))
    blobs = [b for batch in sent for b in batch.column(3).to_pylist()]
    assert len(blobs) > 400 and len(sent) < len(blobs) / 10
    got = [suffixes._unpack(b) for b in blobs]
    mixed = sum(len(zstandard.compress(b"".join(p[k].tobytes() for k in ("doc", "count", "places", "size", "mark", "data")), 3)) for p in got)
    assert sum(map(len, blobs)) < 0.9 * mixed
    text = {r["doc_id"]: r["text"].encode() for r in rows}
    for p in got[::50]:
        ends, first = np.cumsum(p["size"]), np.cumsum(p["count"]) - p["count"]
        for d, n, e, at in zip(p["doc"].tolist(), p["size"].tolist(), ends.tolist(), p["places"][first].tolist()):
            assert text[d][at : at + n] == p["data"][e - n : e].tobytes()


def test_merge_is_the_sorted_order():
    rng = np.random.default_rng(0)
    parts = [np.concatenate([np.append(rng.integers(97, 100, 90), 0) for _ in range(4)]).astype(np.uint8) for _ in range(3)]
    order, common_ = suffixes.merge([suffixes.Shard(p) for p in parts], 50)
    rot = [(np.roll(p, -i)[:50].tobytes(), k) for k, p in enumerate(parts) for i in range(len(p))]
    assert [k for _, k in sorted(rot)] == order.tolist()
    s = [x for x, _ in sorted(rot)]
    lcp = [-1] + [next((i for i in range(50) if a[i] != b[i]), 50) for a, b in zip(s, s[1:])]
    assert lcp == common_.tolist()


def test_chunks(spark, docs, awkward, none):
    got = {r.doc_id: r for r in chunks.deduplicate(docs).collect()}
    seen = set()
    for k, b in sorted(texts(awkward).items()):
        ends, last, h = [], 0, 0
        marks = []
        for i, x in enumerate(b):
            h = ((h << 1) + int(chunks._GEAR[x])) & 0xFFFFFFFF
            if h >> (32 - chunks.BITS) == 0:
                marks.append(i + 1)
        for m in [*marks, len(b)]:
            while m - last > chunks.MAX:
                last += chunks.MAX
                ends.append(last)
            if m - last >= chunks.MIN or (m == len(b) and m > last):
                ends.append(m)
                last = m
        kept, last = b"", 0
        for e in ends:
            if b[last:e] not in seen:
                kept += b[last:e]
            seen.add(b[last:e])
            last = e
        assert bytes(got[k].kept) == kept
    assert got[11].n_removed > 0.9 * got[11].n_bytes  # one byte more in front moves one cut
    assert chunks.deduplicate(none).count() == 0


# --- embeddings ------------------------------------------------------------------------------


def test_collisions(spark, monkeypatch):
    rng = np.random.default_rng(5)
    v = rng.standard_normal((150, 16))
    v[50:100] = v[:50] + 0.1 * rng.standard_normal((50, 16))
    v[100:110] = v[0]
    rows = [(i, [float(y) for y in x]) for i, x in enumerate(v)]
    odd = [(200, None), (201, []), (202, [0.0] * 16), (203, [float("nan")] + [1.0] * 15), (204, [float("inf")] * 16), (205, [None] + [1.0] * 15), (206, [1.0, 2.0]), (207, [2.0, 4.0]), (None, [1.0] * 16), (0, rows[0][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    comp = roots(range(150), [(a, b) for a, b in zip(*np.nonzero(near)) if a < b])
    for chunk in (collisions.CHUNK, 8):
        monkeypatch.setattr(collisions, "CHUNK", chunk)
        monkeypatch.setattr(collisions, "CELL", 256 if chunk > 8 else 64)
        got = {r.vec_id: (r.n_links, r.component_id) for r in collisions.links(df).collect()}
        assert len(got) == 158
        hit = sum(got[i][0] for i in range(150)) / near.sum()
        assert 0.99 <= hit <= 1
        if hit == 1:
            assert all(got[i][1] == comp[i] for i in range(150))
        assert all(got[i] == (0, i) for i in range(200, 206))
        assert got[206] == (1, 206)
        assert got[207] == (1, 206)
    assert collisions.links(df.limit(0)).count() == 0


def test_candidates_are_the_pairs_that_collide_often_enough():
    x = np.random.default_rng(3).standard_normal((300, 24))
    counts = (np.abs(x[:, None, :] - x[None, :, :]) <= 1.1).sum(axis=2)
    for need in (0, 12, 17, 21):
        a, b = collisions.candidates(x, 1.1, need)
        assert set(zip(a.tolist(), b.tolist())) == {(i, j) for i in range(300) for j in range(i + 1, 300) if counts[i, j] >= need}


def test_collisions_copies_carry_one_vector(spark):
    small, large = collisions.Plan(10**4, 0.9), collisions.Plan(10**8, 0.9)
    assert large.grids > small.grids
    df = spark.createDataFrame([(1, 1, [float(i % 7) for i in range(64)])], "node long, n long, e array<double>")
    for plan in (small, large):
        assert {len(r.v) for r in df.mapInArrow(collisions._rows(plan), collisions.ROWS).collect()} == {1 + 4 * 64}
    unit = collisions._unit(np.random.default_rng(0).standard_normal((50, 64)))
    assert (small.cells(unit)[7:9] == small.cells(unit[7:9])).all()


def test_vectors_that_share_an_id_and_extra_columns(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 2.0]), (3, [5.0, 0.1])]
    df = spark.createDataFrame([(i, v, 9, 9) for i, v in rows], "vec_id long, embedding array<double>, node long, n long")
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in collisions.links(df).collect()) == [(1, 2, 1), (1, 2, 1), (2, 1, 1), (3, 1, 1)]  # one node with the links of both


def test_count_is_calibrated():
    p = collisions.Plan(10**6, 0.9)
    rng = np.random.default_rng(0)
    u = rng.standard_normal((4000, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.standard_normal((4000, 64))
    w -= (w * u).sum(1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    x = 0.9 * u + np.sqrt(1 - 0.81) * w  # pairs just at the threshold
    a, _, _ = p.matrices(64)
    counts = (np.abs(u @ a - x @ a) <= p.half).sum(axis=1)
    assert (counts >= p.count).mean() > 0.98
    assert (p.cells(u) == p.cells(x)).any(axis=1).mean() > 0.98


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(3, 200), (200, 150), (7, 8), (8, 7), (9, 9)]
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 3 for i in [3, 200, *range(100, 161)]} | {7: 7, 8: 7}
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
