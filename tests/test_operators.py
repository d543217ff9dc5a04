import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.operators import collate, consensus, filters, intervals, manifest, partitioning, profile, report

SEG = "source_id string, pos int, seg_start double, seg_end double, speaker int, prediction int"


def segs(spark, rows, source="s"):
    return spark.createDataFrame([(source, i, float(s), float(e), k, p) for i, (s, e, k, p) in enumerate([(*r, 0)[:4] for r in rows])], SEG)


@pytest.mark.parametrize(
    ("rows", "want"),
    [
        ([(0, 5, 0), (4, 8, 1)], [(0, 4.5, 0), (4.5, 8, 1)]), ([(0, 5, 0), (5, 8, 0)], [(0, 8, 0)]), ([(0, 5, 0), (5, 8, 1)], [(0, 5, 0), (5, 8, 1)]),
        ([(0, 32, 0)], [(0, 15, 0), (15, 30, 0), (30, 32, 0)]), ([(0, 10, 0), (0, 2, 1)], [(0, 1, 1), (1, 10, 0)]),
    ],
)
def test_timeline(spark, rows, want):
    got = intervals.timeline(segs(spark, rows), "source_id").orderBy("start", "turn", "piece").collect()
    assert [(r.start, r.end, r.speaker) for r in got] == want


def fold(rows):
    """The timeline as a plain loop."""
    out = []
    for s, e, k in rows:
        if out and out[-1][2] == k and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        elif out and out[-1][2] != k and s < out[-1][1]:
            mid = (s + out[-1][1]) / 2
            if mid <= out[-1][0]:
                out.pop()
            else:
                out[-1][1] = mid
            if e > mid:
                out.append([mid, e, k])
        else:
            out.append([s, e, k])
    return out


def test_timeline_against_a_loop(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for n in range(60):
        own = [(rng.randint(0, 30), rng.randint(1, 9), rng.randint(0, 2)) for _ in range(rng.randint(1, 12))]
        own = [(float(s), float(s + d), k) for s, d, k in own]
        rows += [(str(n), i, *r, 0) for i, r in enumerate(own)]
        order = sorted(range(len(own)), key=lambda i: (own[i][0], own[i][1], i))
        want[str(n)] = [tuple(x) for x in fold([own[i] for i in order])]
    got = {}
    for r in intervals.timeline(spark.createDataFrame(rows, SEG), "source_id", most=0).orderBy("source_id", "turn").collect():
        got.setdefault(r.source_id, []).append((r.start, r.end, r.speaker))
    assert got == want


@pytest.mark.parametrize(
    ("rows", "want"),
    [
        ([(0, 2, 0, 0), (2.3, 5, 0, 1)], [(0, 5, 0)]), ([(0, 2, 0, 0), (3, 5, 0, 1)], [(3, 5, 0)]), ([(0, 12, 0, 0), (12, 20, 0, 1)], [(5, 20, 0)]),
        ([(0, 0.4, 0, 1)], []), ([(0, 5, 0, 1), (5, 8, 0, 0)], [(0, 5, 0)]),
    ],
)
def test_turn_ends(spark, rows, want):
    assert [(r.start, r.end, r.speaker) for r in intervals.turn_ends(segs(spark, rows), "source_id").orderBy("start").collect()] == want


@pytest.mark.parametrize(
    ("clip", "rows", "want"),
    [((0, 10), [(1, 3, 0), (2, 5, 1), (7, 9, 0)], (40.0, 2.0, 2)), ((0, 10), [(10, 12, 0)], (100.0, 10.0, 0)), ((2, 6), [(0, 3, 0), (3, 5, 0)], (25.0, 1.0, 1)), ((4, 4), [(0, 9, 0)], (0.0, 0.0, 0))],
)
def test_clip_metrics(spark, clip, rows, want):
    clips = spark.createDataFrame([("s", "c", float(clip[0]), float(clip[1]))], ["source_id", "clip", "clip_start", "clip_end"])
    r = intervals.clip_metrics(clips, segs(spark, rows), "source_id", "clip").first()
    assert (r.silence_percent, r.max_silence_duration, r.n_speakers) == want


def test_clips_of_one_number_have_the_first_segments_bounds(spark):
    clips = spark.createDataFrame([("s", 1, 0.0, 4.0), ("t", 1, 10.0, 14.0)], ["source_id", "clip", "clip_start", "clip_end"])
    seg = segs(spark, [(11, 12, 0)], "t").unionByName(segs(spark, [(1, 2, 0)], "s"))
    for n in (1, 3):
        rows = intervals.clip_metrics(clips.repartition(n), seg.repartition(n), "source_id", "clip").collect()
        assert [(r.silence_percent, r.max_silence_duration) for r in rows] == [(50.0, 9.0)] * 2  # gaps of 1 and 9, and the end 8 before the last segment's


def test_hysteresis_and_words(spark):
    p = [0.1, 0.5, 0.9, 0.4, 0.6, 0.6]
    f = spark.createDataFrame([("s", i, 0, x) for i, x in enumerate(p)], ["source", "frame", "speaker", "p"])
    got = [(round(r.start, 2), round(r.end, 2)) for r in intervals.hysteresis(f, "source").orderBy("start").collect()]
    assert got == [(0.08, 0.24), (0.32, 0.48)]
    padded = intervals.hysteresis(f, "source", pad_on=0.1, pad_off=0.1).orderBy("start").collect()
    assert [(round(r.start, 2), round(r.end, 2)) for r in padded] == [(0.0, 0.48)]
    c = spark.createDataFrame([("c", list("да нет"), [0.1, 0.2, 0.3, 0.4, 0.5, 0.6]), ("bad", ["a"], [0.1, 0.2])], ["clip", "t", "x"])
    tsv = {r.clip: r.text for r in intervals.words_tsv(intervals.word_times(c, "clip", "t", "x"), "clip").collect()}
    assert tsv == {"c": "0.100\t0.300\tда\n0.400\t0.600\tнет"}


def test_segments_parse_and_median(spark):
    d = spark.createDataFrame([("s", ["0.5 1.5 speaker_2", "junk", "3 2 speaker_0"])], ["source_id", "raw"])
    assert [(r.seg_start, r.seg_end, r.speaker) for r in intervals.parse_segments(d, "source_id", "raw").collect()] == [(0.5, 1.5, 2)]
    f = spark.createDataFrame([("s", i, 0, x) for i, x in enumerate([0.0, 1.0, 0.0])], ["source", "frame", "speaker", "p"])
    assert [r.p for r in intervals.median_filter(f, "source", 3).orderBy("frame").collect()] == [0.5, 0.0, 0.5]


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1, 7), ("b", 2, 8), ("z", 5, 9)], ["filepath", "v", "w"])
    new = spark.createDataFrame([("a", None), ("b", 9), ("c", 3)], "filepath string, v int")
    keep = {r.filepath: (r.v, r.w) for r in manifest.upsert(old, new).collect()}
    assert keep == {"a": (1, 7), "b": (9, 8), "c": (3, None), "z": (5, 9)}
    over = {r.filepath: (r.v, r.w) for r in manifest.upsert(old, new, preserve=False).collect()}
    assert over == {"a": (None, 7), "b": (9, 8), "c": (3, None), "z": (5, 9)}
    again = {r.filepath: (r.v, r.w) for r in manifest.upsert(manifest.upsert(old, new), new).collect()}
    assert again == keep
    assert {r.filepath: r.v for r in manifest.replace_merge(old, new).collect()} == {"a": None, "b": 9, "c": 3, "z": None}


def test_pending(spark):
    m = spark.createDataFrame([("a", "x", False), ("b", " ", None), ("c", None, True)], "filepath string, t string, f boolean")
    w = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("d",)], ["filepath"])
    names = lambda df: sorted(r.filepath for r in df.collect())
    assert names(manifest.pending(w, m, ["t"])) == ["b", "c", "d", "d"]
    assert names(manifest.pending(w, m, ["f"])) == ["b", "d", "d"]  # False is done
    assert names(manifest.pending(w, m, ["none"])) == ["a", "b", "c", "d", "d"]
    s = spark.createDataFrame([("a", "in", "x"), ("b", "in", "x"), ("b", "out", ""), ("c", "out", "y")], ["filepath", "kind", "text"])
    assert names(manifest.pending_sidecar(w, s, "in", "out")) == ["a"]
    assert names(manifest.pending_sidecar(w, s, "in", "out", retry_empty=True)) == ["a", "b"]


def test_filters_and_audit(spark):
    d = spark.createDataFrame([(10.0, 3600.0, "true"), (10.1, 3600.0, "no"), (float("inf"), None, "1"), (None, 1800.0, None)], "crest_factor double, total_duration double, deleted string")
    r = filters.audit(filters.crest_filter(d)).first()
    assert (r.files_in, r.files_out, r.hours_in, r.hours_out, r.hours_removed) == (4, 2, 2.5, 1.5, 1.0)
    assert filters.audit(d).first().files_out == 2
    dist = filters.distribution(spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 10)], ["s"]), "s").first()
    assert (dist.p05, dist.p50, dist.p95, dist["std"]) == (1.2, 3.0, 8.8, pytest.approx(3.535534))
    h = {r.bin: r.files for r in filters.histogram(spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 10)], ["s"]), "s").collect()}
    assert h == {0: 1, 1: 1, 2: 1, 3: 1, 9: 1}
    same = filters.histogram(spark.createDataFrame([(2.0,), (2.0,)], ["s"]), "s").collect()
    assert [(r.bin, r.files) for r in same] == [(0, 2)]
    with pytest.raises(ValueError, match="above 0"):
        filters.mos_filter(d, 0)


def test_agreement_and_rover(spark):
    cols = ["m1", "m2", "m3", "m4"]
    d = spark.createDataFrame([("A b", "a  B", "c", ""), ("a", "a", "a", None), ("a", "b", "c", ""), ("a", "", None, "")], cols)
    assert [r[0] for r in d.select(consensus.agreement(cols)).collect()] == [50.0, 100.0, 0.0, None]
    assert consensus.vote(["a b c", "a x c", "a b"], str.split, " ".join) == "a b c"
    assert consensus.vote(["b", "a"], str.split, " ".join) == "b"  # of equals the earliest
    assert consensus.vote([], str.split, " ".join) == ""
    c = spark.createDataFrame([("f", "m1", "One two"), ("f", "m2", "one too"), ("f", "m3", "one two"), ("g", "m1", None)], ["filepath", "model", "text"])
    assert {r.filepath: r.text for r in consensus.rover(c).collect()} == {"f": "one two", "g": ""}
    w = spark.createDataFrame([("f",), ("g",)], ["filepath"])
    assert [r.filepath for r in consensus.without_consensus(w, c, 2).collect()] == ["g"]
    assert consensus.without_consensus(w, c, 0).count() == 2


def test_collate(spark):
    m = spark.createDataFrame([("a", "old", 1.0, "x"), ("b", "old", 2.0, "y")], ["filepath", "rover", "total_duration", "my_transcript"])
    s = spark.createDataFrame([("a", "tone", "hi"), ("a", "vosk", "hi"), ("b", "rover", "new")], ["filepath", "kind", "text"])
    rows = {r.filepath: r.asDict() for r in collate.collate(m, s, ["tone", "vosk-small", "vosk-big"]).collect()}
    assert "my_transcript" not in rows["a"]
    assert rows["a"]["asr_consistency_percent"] == 100.0
    assert rows["a"]["rover"] == ""
    assert rows["b"]["rover"] == "new"
    assert rows["b"]["tone"] == ""
    clips = spark.createDataFrame([("/d/c1", "/d", "c1"), ("/d/c1_x", "/d", "c1_x")], ["filepath", "dir", "stem"])
    files = spark.createDataFrame([("/d", "c1_rover.txt", "t1"), ("/d", "c1_x_rover.txt", "t2"), ("/d", "c1.json", "t3")], ["dir", "name", "text"])
    got = {r.filepath: r.parts for r in collate.siblings(clips, files).collect()}
    assert got == {"/d/c1": {"rover.txt": "t1", "json": "t3"}, "/d/c1_x": {"rover.txt": "t2"}}


def test_report(spark):
    a = spark.createDataFrame(
        [("t1", "punctuation", 9, 9, 9.0, 9.0, "{}", 0), ("t1", "crest_factor", 10, 8, 10.0, 8.0, '{"k": 1}', 1), ("t2", "crest_factor", 10, 5, 10.0, 5.0, "raw", 2), ("t2", "crest_factor", 10, 6, 10.0, 6.0, None, 3), ("t9", "own", 5, 4, 0.0, 4.0, "", 4)],
        "timestamp string, stage string, files_in long, files_out long, hours_in double, hours_out double, params string, sequence long",
    )
    r = {x.stage: x for x in report.stage_report(a).collect()}
    assert r["crest_factor"].files_out == 6
    assert r["crest_factor"].removed_percent == 40.0
    assert r["own"].removed_percent == 0.0
    assert [x.stage for x in report.stage_report(a).orderBy("rank", "stage").collect()] == ["crest_factor", "punctuation", "own"]
    net = report.net_effect(report.stage_report(a)).first()
    assert (net.first_in, net.last_out, net.net_percent) == (10.0, 4.0, 60.0)
    m = {x.column: (x.missing, x.n_unique) for x in report.missing(spark.createDataFrame([("", 1.0), (" ", float("nan")), ("x", None)], "t string, v double"), distinct=True).collect()}
    assert m["t"] == (2, 3)
    assert m["v"][0] == 2
    assert spark.range(1).select(report.hours_text(F.lit(12.34))).first()[0] == "12.34h (12h 20m)"
    assert spark.range(1).select(report.params_text(F.lit('{"b": 2, "a": "x"}'))).first()[0] == "`a=x`, `b=2`"


def test_profile(spark):
    d = spark.createDataFrame([("1.5", "x", 1.0), ("oops", "y", float("inf")), (None, "x", None)], "a string, b string, c double")
    assert dict(profile.coerce_numeric(d).dtypes) == {"a": "double", "b": "string", "c": "double"}
    s = profile.core_summary(d, ["c"]).first()
    assert (s.n, s["sum"]) == (1, 1.0)
    top = {(r.column, r.value): r.n for r in profile.categories(d, ["b"]).collect()}
    assert top == {("b", "x"): 2, ("b", "y"): 1}
    assert profile.correlations(spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0)], ["a", "b", "k"]), ["a", "b", "k"]).count() == 4
    q = profile.quantile_buckets(spark.createDataFrame([(float(x),) for x in (1, 1, 1, 2, 3)], ["r"]), "r", 2, ["r"]).orderBy("bucket").collect()
    assert sum(r["size"] for r in q) == 5
    e = [(r.v, r.y) for r in profile.ecdf(spark.createDataFrame([(1.0,), (1.0,), (3.0,), (None,)], "v double"), "v").orderBy("v").collect()]
    assert e == [(1.0, 0.5), (3.0, 1.0)]


def test_shards(spark):
    d = spark.range(100).select(F.col("id"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("path"), (F.col("id") % 20).cast("double").alias("dur"))
    f = partitioning.fixed_shards(d, "path", "id", size=7)
    assert {r.id: r.shard for r in f.collect()} == {i: i // 7 for i in range(100)}
    n = partitioning.length_shards(d, "dur", "id", size=10)
    assert n.count() == 100
    assert n.select(F.max("bucket")).first()[0] == 15
    assert partitioning.seeded_sample(d, "id", 10).count() == 10


def test_empty_tables(spark):
    m = spark.createDataFrame([], "filepath string, total_duration double, crest_factor double, deleted boolean")
    r = filters.audit(m).first()
    assert (r.files_in, r.hours_in) == (0, 0.0)
    assert manifest.upsert(m, m).count() == 0
    assert filters.distribution(m, "crest_factor").first()["count"] == 0
    assert intervals.timeline(spark.createDataFrame([], SEG), "source_id").count() == 0
    assert report.missing(m).count() == 4


def test_thresholds():
    assert filters.resolve_threshold(2.0, 1.0, manual=True) == 2.0
    assert filters.resolve_threshold(None, 1.0) == 1.0
    with pytest.raises(ValueError, match="manual"):
        filters.resolve_threshold(None, 1.0, manual=True)
    with pytest.raises(ValueError, match="no threshold"):
        filters.resolve_threshold()


def naive_align(slots, words, seen):
    """The whole table of costs, cell by cell."""
    n, m = len(slots), len(words)
    cost = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n + 1):
        for j in range(m + 1):
            ways = []
            if i and j:
                ways.append(cost[i - 1][j - 1] + (words[j - 1] not in slots[i - 1]))
            if i:
                ways.append(cost[i - 1][j] + (None not in slots[i - 1]))
            if j:
                ways.append(cost[i][j - 1] + 1)
            cost[i][j] = min(ways, default=0)
    out, i, j = [], n, m
    while i or j:
        if i and j and cost[i][j] == cost[i - 1][j - 1] + (words[j - 1] not in slots[i - 1]):
            i, j = i - 1, j - 1
            out.append([*slots[i], words[j]])
        elif i and cost[i][j] == cost[i - 1][j] + (None not in slots[i - 1]):
            i -= 1
            out.append([*slots[i], None])
        else:
            j -= 1
            out.append([*[None] * seen, words[j]])
    return out[::-1]


def test_alignment_in_a_band_is_the_whole_tables():
    import random

    from corpusflow.operators import consensus

    rng = random.Random(3)
    for _ in range(400):
        texts = [[rng.choice("abcde") for _ in range(rng.randint(0, 40))] for _ in range(2)]
        texts += [[w for w in texts[0] if rng.random() > 0.2], texts[1][: rng.randint(0, 40)]]
        rng.shuffle(texts)
        slots = [[w] for w in texts[0]]
        for seen, words in enumerate(texts[1:], 1):
            want = naive_align(slots, words, seen)
            assert consensus.align(slots, words, seen) == want
            slots = want


def test_alignment_of_long_texts():
    from corpusflow.operators import consensus

    a = [f"w{i % 977}" for i in range(20_000)]
    b = [w for i, w in enumerate(a) if i % 500 != 7]
    assert consensus.vote([" ".join(a), " ".join(b), " ".join(a)], str.split, " ".join).split() == a


def test_percentiles_by_rank_are_the_aggregates(spark):
    from corpusflow.operators import partitioning

    rows = [(None if i % 7 == 0 else i % 3, None if i % 11 == 0 else float((i * 37) % 50)) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, v double")
    points = [0.0, 0.01, 0.33, 0.5, 0.99, 1.0]
    for by in ([], ["k"]):
        one, two = ({r[: len(by)]: [round(x, 9) for x in r["q"]] for r in partitioning.percentiles(df, by, "v", points, most=most).collect()} for most in (10**6, 0))
        assert one == two
    assert partitioning.percentiles(df.where("v < 0"), ["k"], "v", points, most=0).count() == 0


def test_deletions_are_made_by_tasks(spark, tmp_path):
    from corpusflow.sinks import files

    names = [tmp_path / f"{i}.wav" for i in range(6)]
    for n in names[:5]:
        n.write_bytes(b"x")
    df = spark.createDataFrame([(str(n), i % 2 == 0) for i, n in enumerate(names)] + [(None, True), (str(names[5]), True)], "filepath string, deleted boolean")
    assert files.delete_flagged(spark, df, confirmed=True) == 3
    assert [n.exists() for n in names] == [False, True, False, True, False, False]


def test_one_long_island_streams(spark):
    """300,000 segments that all overlap the next: one island, folded in passing."""
    n = 300_000
    seg = spark.range(n).select(F.lit("one").alias("source_id"), F.col("id").cast("int").alias("pos"), (F.col("id") * 1.0).alias("seg_start"), (F.col("id") + 1.5).alias("seg_end"), (F.col("id") % 2).cast("int").alias("speaker"))
    out = intervals.timeline(seg, "source_id", most=0)
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()  # nothing is collected
    got = out.agg(F.count("*").alias("n"), F.max("turn").alias("last"), F.sum(F.col("end") - F.col("start")).alias("s"), F.min("start").alias("a"), F.max("end").alias("b")).first()
    assert tuple(got) == (n, n - 1, n + 0.5, 0.0, n + 0.5)


def test_percentiles_by_brackets(spark):
    """Ties, infinities, NaN and constant groups, groups large and small: as numpy has them, whatever way is taken."""
    rng = np.random.default_rng(4)
    groups = {"a": rng.normal(size=40_000), "b": rng.integers(0, 5, 30_000).astype(float), "c": np.full(20_001, 2.5), "d": rng.normal(size=7), None: rng.exponential(size=15_000), "e": np.array([1.0])}
    rows = [(g, float(v)) for g, x in groups.items() for v in x] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    points = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]
    for more in ({"most": 10**9}, {"most": 0, "group_rows": 0}, {"most": 0, "group_rows": 0, "accuracy": 20}, {"most": 0, "group_rows": 10_000, "accuracy": 1000}):
        got = {r.g: r.q for r in partitioning.percentiles(df, ["g"], "v", points, **more).collect()}
        assert set(got) == set(groups)
        for g, x in groups.items():
            assert got[g] == pytest.approx(np.quantile(x, points), rel=1e-12), (g, more)
    whole = np.concatenate(list(groups.values()))
    (one,) = partitioning.percentiles(df, [], "v", points, most=0, group_rows=0).collect()
    assert one.q == pytest.approx(np.quantile(whole, points), rel=1e-12)
    assert partitioning.percentiles(df.where("false"), ["g"], "v", points, most=-1).count() == 0


def test_few_rows_are_sent(spark):
    """Of two million rows in one group, under a hundredth lies inside the brackets."""
    df = spark.range(2_000_000).select(F.lit(1).alias("g"), (F.pmod(F.xxhash64("id"), F.lit(10**12)) / 7).alias("v"))
    edges = [e for p in (0.05, 0.25, 0.5, 0.75, 0.95) for e in (p - partitioning.SLACK / partitioning.ACCURACY, p + partitioning.SLACK / partitioning.ACCURACY)]
    got = df.agg(F.percentile_approx("v", edges, partitioning.ACCURACY)).first()[0]
    inside = df.where(" or ".join(f"v between {a} and {b}" for a, b in zip(got[::2], got[1::2]))).count()
    assert inside < 20_000
    q = partitioning.percentiles(df, ["g"], "v", [0.05, 0.25, 0.5, 0.75, 0.95], most=0).first().q
    want = df.agg(F.percentile("v", F.array(*[F.lit(p) for p in (0.05, 0.25, 0.5, 0.75, 0.95)]))).first()[0]
    assert q == pytest.approx(want, rel=1e-12)


def test_overlaps_of_all_lengths(spark):
    """Lengths from a tenth of a second to ten hours, on both sides: the pairs of brute force, and few rows an interval."""
    rng = np.random.default_rng(8)
    length = lambda n: np.exp(rng.uniform(np.log(0.1), np.log(36_000), n)).round(2)
    start = lambda n: rng.uniform(-50_000, 50_000, n).round(2)
    clips = [(int(i), "s", float(a), float(a + l)) for i, (a, l) in enumerate(zip(start(150), length(150)))] + [(900, "s", 3.0, 3.0), (901, None, 0.0, 9.0), (902, "s", None, 1.0), (903, "s", 1e9, 1e9 + 2e8)]
    segs_ = [("s", int(i), float(a), float(a + l), 0) for i, (a, l) in enumerate(zip(start(300), length(300)))] + [("s", 900, 1e9 + 5.0, 1e9 + 6.0, 0), ("s", 901, 5.0, 5.0, 0)]
    c = spark.createDataFrame(clips, "clip int, source_id string, clip_start double, clip_end double")
    g = spark.createDataFrame(segs_, "source_id string, pos int, seg_start double, seg_end double, speaker int")
    got = sorted((r.clip, r.pos, r.s, r.e) for r in intervals.overlaps(c, g, "source_id").collect())
    want = sorted((i, p, max(a, x), min(b, y)) for i, s, a, b in clips if s and a is not None for _, p, x, y, _ in segs_ if max(a, x) < min(b, y))
    assert got == want
    assert intervals.levelled(g, "seg_start", "seg_end").groupBy("pos").count().where("count > 2").count() == 0


def test_wide_correlations_are_the_narrow_ones(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 6)) * [1, 1000, 1e-3, 1, 1, 1] + [0, 1e6, 5, 0, 0, 3]
    x[:, 3] = x[:, 0] * 2 + 1
    rows = [[None if rng.random() < 0.2 else float("nan") if rng.random() < 0.05 else float("inf") if rng.random() < 0.02 else float(v) for v in line] for line in x]
    for line in rows:
        line[5] = 3.0
    df = spark.createDataFrame(rows, ", ".join(f"m{i} double" for i in range(6))).repartition(3)
    same = lambda wide: sorted(map(str, profile.correlations(df, df.columns, 6, wide=wide).collect()))
    assert same(0) == same(100)
    assert len(same(0)) == 25
    assert profile.correlations(df.limit(0), df.columns, wide=0).count() == 0


def test_frequent_values(spark):
    """Few values, a long tail, keys, ties and nulls: the sketch's way gives what counting gives."""
    df = spark.range(60_000).select(
        (F.col("id") % 9).alias("few"), F.when(F.col("id") % 5 == 0, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(4))).alias("nulls"), F.col("id").alias("key"),
        F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.col("id") % 16).alias("tail"), F.lit("one").alias("same"),
    )
    columns = df.columns
    same = lambda **more: sorted(map(str, profile.categories(df, columns, top=8, **more).collect()))
    assert same(most=0, tracked=600) == same(most=0) == same()
    assert profile.categories(df.limit(0), columns, most=-1).count() == 0


def test_a_text_is_normalised_once_for_agreement(spark):
    cols = ["m1", "m2", "m3"]
    d = spark.createDataFrame([("A b", "a  B", "c")], cols)
    plan = d.select(consensus.agreement(cols).alias("p"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == len(cols)


def test_equal_transcripts_win_without_alignment(spark, monkeypatch):
    rng = random.Random(5)
    for _ in range(400):
        a, b = ([rng.choice("xyz") for _ in range(rng.randrange(7))] for _ in range(2))
        for said in ([a, a, b], [a, b, a], [b, a, a], [a, a], [a] * 5, [a]):
            assert consensus._voted(said) == a
    # clips that cross batches, null clips and models; only the clip of three different transcripts is aligned
    rows = [(f"f{i}", m, t) for i in range(500) for m, t in (("b", "One Two"), ("a", "one two"), (None, f"one two {i}"))] + [(None, "a", "left"), ("f0", "0", "three two")]
    c = spark.createDataFrame(rows, "filepath string, model string, text string").repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = {r.filepath: (r.text, r.error) for r in consensus.rover(c).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {None: ("left", None), "f0": ("one two", None)} | {f"f{i}": ("one two", None) for i in range(500)}
    monkeypatch.setattr(consensus, "align", None)
    assert consensus.vote(["a b", "c", "A  b"], lambda t: t.lower().split(), " ".join) == "a b"
    assert "InPandas" not in consensus.rover(c)._jdf.queryExecution().optimizedPlan().toString()


def test_a_pivot_sorts_texts_once(spark):
    s = spark.createDataFrame([("a", "tone", "hi"), ("a", "tone", "ho"), ("a", "vosk", None), (None, "vosk", "x")], "filepath string, kind string, text string").repartition(3)
    p = collate.pivot(s, ["tone", "vosk"])
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1
    assert plan.count("Exchange hashpartitioning(") == 1
    assert {tuple(r) for r in p.collect()} == {("a", "ho", None), (None, None, "x")}


def test_percentiles_scan_the_rows_three_times(spark):
    n, seen = 3_000, spark.sparkContext.accumulator(0)

    def row(i):
        seen.add(1)
        return i % 2, float(i * 7919 % n)

    df = spark.createDataFrame(spark.sparkContext.parallelize(range(n), 3).map(row), "g int, v double")
    q = {r.g: r.q for r in partitioning.percentiles(df, ["g"], "v", [0.0, 0.3, 1.0], most=0, group_rows=0, accuracy=1_000).collect()}
    assert seen.value <= 3 * n  # counted, sketched, and put inside or between the brackets
    want = {g: np.quantile([i * 7919 % n for i in range(g, n, 2)], [0.0, 0.3, 1.0]) for g in (0, 1)}
    assert all(q[g] == pytest.approx(want[g]) for g in want)
