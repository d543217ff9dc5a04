import json
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow import schema
from corpusflow.operators import scorers, signal
from corpusflow.plans import stages
from corpusflow.sinks import files, records, versions
from corpusflow.sources import audio, catalogue, manifest
from corpusflow.streaming import absorb, ingest


def tone(seconds=1.0, rate=16000, level=0.5, channels=1):
    t = np.arange(int(seconds * rate)) / rate
    return np.tile(level * np.sin(2 * np.pi * 997 * t), (channels, 1))


@pytest.fixture
def corpus(tmp_path):
    d = tmp_path / "pl" / "ep"
    d.mkdir(parents=True)
    (d / "0.00_1.00_pl_ep.wav").write_bytes(files.encode_wav(tone(1.0), 16000))
    (d / "1.00_3.00_pl_ep.WAV").write_bytes(files.encode_wav(tone(2.0, level=0.1, channels=2), 16000))
    (d / "bad.wav").write_bytes(b"nothing")
    (d / "0.00_1.00_pl_ep_rover.txt").write_text(" hello \n", encoding="utf-8")
    (d / "note.md").write_text("x")
    return tmp_path


def test_audio(spark, corpus):
    found = audio.listing(spark, str(corpus), content=True)
    assert found.count() == 3
    d = {r.path.rsplit("/", 1)[1]: r for r in audio.probe_durations(found).collect()}
    assert d["0.00_1.00_pl_ep.wav"].duration == 1.0
    assert d["1.00_3.00_pl_ep.WAV"].duration == 2.0
    assert (d["bad.wav"].duration, d["bad.wav"].error is not None) == (0.0, True)
    s = {r.path.rsplit("/", 1)[1]: r for r in signal.audio_stats(found).collect()}
    assert s["0.00_1.00_pl_ep.wav"].crest_factor == pytest.approx(np.sqrt(2), abs=1e-3)
    assert s["bad.wav"].error
    side = audio.sidecars(spark, str(corpus), ["rover"])
    assert [(r.kind, r.text) for r in side.collect()] == [("rover", "hello")]
    clips = found.select(F.col("path").alias("filepath"))
    texts = {r.filepath.rsplit("/", 1)[1]: r.rover for r in audio.with_sidecar(clips, side, "rover").collect()}
    assert texts == {"0.00_1.00_pl_ep.wav": "hello", "1.00_3.00_pl_ep.WAV": "", "bad.wav": ""}
    assert audio.discover(spark, str(corpus), source="fs").count() == 3
    m = schema.conformed(spark.createDataFrame([("/x/a.mp3",), ("/x/b.txt",), (None,)], "filepath string"))
    assert [r.filepath for r in audio.discover(spark, str(corpus), m, "CSV").collect()] == ["/x/a.mp3"]
    assert audio.discover(spark, str(corpus), m.limit(0), "what").count() == 3
    b = audio.benchmark_sample(audio.probe_durations(found), side, ["rover"], 0.5, 5).collect()
    assert len(b) == 1


def test_loudness_and_mel():
    x = tone(3.0, 48000, 1.0)
    assert signal.loudness(x, 48000) == pytest.approx(-3.01, abs=0.1)
    assert signal.loudness(signal.normalised(x, 48000), 48000) == pytest.approx(-23.0, abs=0.05)
    assert signal.loudness(np.zeros((1, 48000)), 48000) == float("-inf")
    with pytest.raises(ValueError, match="shorter"):
        signal.loudness(np.zeros((1, 10)), 48000)
    assert signal.log_mel(tone(1.0)).shape[0] == 128


def test_cut_and_write(spark, corpus, tmp_path):
    found = audio.listing(spark, str(corpus), content=True)
    src = next(r.path for r in found.collect() if r.path.endswith("ep.WAV"))
    clips = spark.createDataFrame([(src, "a/x.wav", 0.0, 0.5), (src, "a/y.wav", 0.5, 2.0)], ["path", "name", "clip_start", "clip_end"])
    cut = signal.cut_chunks(found, clips)
    out = files.write_binaries(cut, str(tmp_path / "out"), "name", "content")
    assert out.count() == 2
    got = {r.path.rsplit("/", 1)[1]: r.duration for r in audio.probe_durations(audio.listing(spark, str(tmp_path / "out"), content=True)).collect()}
    assert got == {"x.wav": 0.5, "y.wav": 1.5}


def test_tar_round_trip(spark, tmp_path):
    rows = [(f"k.{i}", "wav", bytes([i]) * 10, {"text": "t", "v": None}) for i in range(7)]
    df = spark.createDataFrame(rows, "key string, ext string, content binary, meta map<string,string>").coalesce(1)
    out = files.tar_shards(df, most_samples=3)
    shards = out.collect()
    assert sorted(r.samples for r in shards) == [1, 3, 3]
    (tmp_path / "t").mkdir()
    for r in shards:
        (tmp_path / "t" / r.name).write_bytes(bytes(r.data))
    back = {(r.key, r.ext): bytes(r.content) for r in files.read_tars(spark, str(tmp_path / "t")).collect()}
    assert back["k_3", "wav"] == bytes([3]) * 10
    assert json.loads(back["k_3", "json"]) == {"text": "t", "v": None}
    assert files.clean({"a": float("nan"), "b": [float("inf"), 1]}) == {"a": None, "b": [None, 1]}


def test_versions_and_csv(spark, tmp_path):
    root = str(tmp_path / "m")
    assert manifest.load(spark, root).count() == 0
    for i in range(3):
        versions.commit(schema.conformed(spark.createDataFrame([(f"/a{i}.wav", "00")], ["filepath", "playlist_id"])), root)
    assert len(versions.versions(spark, root)) == 2
    assert [r.filepath for r in manifest.load(spark, root).collect()] == ["/a2.wav"]
    csv = tmp_path / "m.csv"
    csv.write_text("filepath,playlist_id,total_duration,own\n/a.wav,00,1.5,x\n/b.wav,01,oops,y\n")
    got = {r.filepath: (r.playlist_id, r.total_duration, r.own) for r in manifest.read_csv(spark, str(csv)).collect()}
    assert got == {"/a.wav": ("00", 1.5, "x"), "/b.wav": ("01", None, "y")}
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "x_part_0.csv").write_text("filepath,v\n/a,1\n/a,2\n")
    (tmp_path / "p" / "x_part_1.csv").write_text("filepath,v\n/a,3\n/b,4\n")
    parts = manifest.partials(spark, str(tmp_path / "p" / "x_part_*.csv"))
    assert {r.filepath: r.v for r in parts.collect()} == {"/a": "3", "/b": "4"}
    assert manifest.pending_rows(spark, str(tmp_path / "p" / "x_part_*.csv")) == 4


def test_records(spark, tmp_path):
    path = str(tmp_path / "audit")
    counts = spark.createDataFrame([(10, 7, 2.0, 1.5)], ["files_in", "files_out", "hours_in", "hours_out"])
    records.append_audit(spark, path, "crest_factor", counts, {"b": 1, "a": "é"}, 0)
    records.append_audit(spark, path, "music_detect", counts, {}, 1)
    log = manifest.audit_log(spark, path)
    assert {r.params for r in log.collect()} == {'{"a": "é", "b": 1}', "{}"}
    text = records.markdown(log)
    assert "| crest_factor | 10 | 7 | 2.00h (2h 0m) |" in text
    s = records.write_status(str(tmp_path / "s"), "5.5", 3, [{"e": str(i)} for i in range(60)])
    assert (s["errors"], len(s["error_details"])) == (60, 50)
    assert json.loads((tmp_path / "s" / "stage_5.5_status.json").read_text())["total"] == 3


def test_scorers(spark):
    df = spark.createDataFrame([(f"f{i}", f"t{i}") for i in range(5)], ["filepath", "content"])
    s = scorers.HashScorer(["a", "b"])
    one, two = (sorted(map(tuple, scorers.scored(df, s, "filepath", "content").collect())) for _ in range(2))
    assert one == two
    assert all(r[1] is None and 0 <= r[2] < 1 for r in one)

    def call(model, items):
        if "t3" in items:
            raise ValueError("no")
        return [(len(x) * model,) for x in items]

    f = scorers.FunctionScorer("n long", lambda: 10, call)
    got = {r.filepath: (r.n, r.error) for r in scorers.scored(df, f, "filepath", "content").collect()}
    assert got["f3"] == (None, "ValueError: no")
    assert got["f1"] == (20, None)
    m = spark.createDataFrame([("f1", 0.5), ("f2", None)], "filepath string, a double")
    assert scorers.score_pending(df, m, s, ["a"], limit=2).count() == 2
    d = scorers.FunctionScorer("segments string", lambda: None, lambda _, items: [("0 1.5 speaker_0\n2 3 speaker_1",) for _ in items])
    assert scorers.diarised(df, d, "filepath", "content").count() == 10


def test_stages(tmp_path):
    ran = []

    def step(name, errors=()):
        return lambda cfg: (ran.append((name, cfg.get("t"))), (1, list(errors)))[1]

    s = [stages.Stage("6", "six", step("six")), stages.Stage("5.5", "half", step("half", [{"e": "x"}])), stages.Stage("10", "ten", step("ten"))]
    cfg = stages.Settings({"six": {"t": 1}}, {"t": 0})
    out = stages.run(s, cfg, str(tmp_path), "5.5", "6")
    assert ran == [("half", 0), ("six", 1)]
    assert [o["errors"] for o in out] == [1, 0]
    with pytest.raises(RuntimeError, match=r"5\.5"):
        stages.run(s, cfg, str(tmp_path), "5", "10", strict=True)
    assert not stages.in_range("6.5", "7", "9")
    assert stages.real_time_factor(2.0, 0.0)[0] is None
    assert stages.repeats([1.0, None, 3.0]) == {"avg": 2.0, "max": 3.0, "min": 1.0}
    (tmp_path / "c.json").write_text('{"six": {"a": 2}, "shared": {"b": 3}}')
    assert stages.Settings.load(str(tmp_path / "c.json")).of("six") == {"a": 2, "b": 3}


def test_absorb(spark, tmp_path):
    root, parts = str(tmp_path / "root"), str(tmp_path / "parts")
    versions.commit(spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], ["filepath", "v", "w"]), root)
    kind = "filepath string, v int, sequence long"
    spark.createDataFrame([("a", None, 1), ("b", 5, 1), ("b", 6, 2), ("c", 7, 1)], kind).write.parquet(parts)
    from pyspark.sql import types as T

    for _ in range(2):
        absorb.absorb(spark, parts, T.StructType.fromDDL(kind), root, str(tmp_path / "ck")).awaitTermination()
    got = {r.filepath: (r.v, r.w) for r in spark.read.parquet(versions.current(spark, root)).collect()}
    assert got == {"a": (1, "x"), "b": (6, "y"), "c": (7, None)}


def test_ingest(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "1.json").write_text('{"audio_id": "1:2", "title": "a"}\n{"audio_id": "1:2", "title": "b"}\n{"title": "none"}\n')
    run = lambda: ingest.ingest(spark, str(src), schema.TRACK, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    run()
    time.sleep(0.1)
    (src / "2.json").write_text('{"audio_id": "1:2", "title": "c"}\n{"audio_id": "3", "title": "d"}\n')
    run()
    assert sorted(r.audio_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1:2", "3"]


def test_catalogue(spark, tmp_path):
    p = spark.createDataFrame([(1, '<a href="/album/12">x</a> \\/album\\/7 /album/12 \\u002Falbum\\u002F9')], ["k", "html"])
    assert [(r.id, r.pos) for r in catalogue.page_ids(p, "k", "html").orderBy("pos").collect()] == [("12", 0), ("9", 2), ("7", 3)]
    assert catalogue.page_ids(p, "k", "html", limit=1).count() == 1
    o = spark.createDataFrame([(1, '{"items": [{"id": 5}, {"albums": [{"album_id": "x"}, {"id": 5}]}]}'), (2, "junk"), (3, None)], ["k", "j"])
    assert [(r.k, r.id) for r in catalogue.object_ids(o, "j", "k").orderBy("pos").collect()] == [(1, "5"), (1, "x")]
    t = tmp_path / "t.json"
    t.write_text('[{"track_id": "1", "title": "a", "artists": ["x", "y"], "album": {"id": "2", "url": "u"}}, {"track_id": "3", "title": "b"}]')
    got = {r.track_id: r for r in catalogue.flatten_tracks(catalogue.tracks(spark, str(t))).collect()}
    assert (got["1"].audio_id, got["1"].artists, got["1"].track_url) == ("1:2", "x, y", "u/track/1")
    assert got["3"].audio_id == "3"
    u = spark.createDataFrame([("u1", "1"), (None, "2"), ("", "2"), (None, None)], "url string, id string")
    assert [r.url for r in catalogue.source_urls(u, "b/").collect()] == ["b/2", "u1"]
    c = spark.createDataFrame([("p", "e")], ["playlist_id", "podcast_id"])
    s = spark.createDataFrame([("/x", "p", "e")], ["path", "playlist_id", "podcast_id"])
    have, miss = manifest.recover(c, s)
    assert (have.count(), miss.count()) == (1, 0)


def test_json_records_name_the_broken_line(spark, tmp_path):
    from pyspark.sql import types as T

    from corpusflow.sources import catalogue

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    (tmp_path / "good.jsonl").write_text('{"a": 1, "b": "x"}\n\n{"a": 2}\n')
    assert [(r.a, r.b) for r in catalogue.json_records(spark, str(tmp_path / "good.jsonl"), schema).orderBy("a").collect()] == [(1, "x"), (2, None)]
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n{"a": \n')
    with pytest.raises(Exception, match=r"bad\.jsonl: line 2 is no JSON record"):
        catalogue.json_records(spark, str(tmp_path / "bad.jsonl"), schema).collect()


def test_benchmark_report(spark, tmp_path):
    import json

    from corpusflow.sinks import records

    rows = [("a", 0, 8, 2.0, 8.0, None), ("a", 1, 8, 4.0, 8.0, None), ("a", 2, 8, 9.0, 8.0, "failed"), ("b", 0, 8, 1.0, 0.0, None)]
    records.benchmark_report(spark.createDataFrame(rows, "target string, repeat int, samples long, wall_s double, audio_s double, error string"), str(tmp_path / "report.json"))
    a, b = json.loads((tmp_path / "report.json").read_text())["targets"]
    assert (a["repeats"], a["failed"], a["rtf_avg"], a["rtf_max"], a["x_realtime_min"]) == (3, 1, 0.375, 0.5, 2.0)
    assert b["rtf_avg"] is None and b["x_realtime_avg"] == 0.0


def test_absorbs_once_enough_rows_wait(spark, tmp_path):
    from corpusflow.sources import manifest as stored
    from corpusflow.streaming.absorb import absorb_when

    root, parts = f"file://{tmp_path}/m", f"file://{tmp_path}/p"
    part = spark.createDataFrame([("a", 1.0, 1), ("b", 2.0, 1)], "filepath string, crest_factor double, sequence int")
    args = (spark, parts, part.schema, root, f"file://{tmp_path}/c", 3)
    assert not absorb_when(*args)
    part.write.mode("append").parquet(parts)
    assert not absorb_when(*args)
    part.replace({"a": "c"}).write.mode("append").parquet(parts)
    assert absorb_when(*args)
    assert not absorb_when(*args)
    assert stored.load(spark, root).count() == 3


def test_reports_are_whole(spark, tmp_path):
    """1,500 targets, stages and columns, and 150 stages in one audit write: none is left out."""
    rows = [(f"t{i:04}", 0, 4, 1.0 + i, 2.0, None) for i in range(1500)]
    report = records.benchmark_report(spark.createDataFrame(rows, "target string, repeat int, samples long, wall_s double, audio_s double, error string"), str(tmp_path / "report.json"))
    assert [t["target"] for t in report["targets"]] == [r[0] for r in rows]
    counts = spark.range(1500).select(F.format_string("s%04d", "id").alias("stage"), (F.col("id") + 10).alias("files_in"), F.lit(3).alias("files_out"), F.lit(2.0).alias("hours_in"), F.lit(1.0).alias("hours_out"), F.col("id").alias("sequence"))
    path = str(tmp_path / "audit")
    records.append_audits(counts.where("sequence < 150").withColumn("params", records.json_params(b=F.col("sequence"), a=F.lit('q"'))), path)
    assert spark.read.parquet(path).count() == 150
    assert spark.read.parquet(path).where("stage = 's0007'").first()["params"] == '{"a": "q\\"", "b": 7}'
    records.append_audits(counts.where("sequence >= 150").withColumn("params", F.lit("{}")), path)
    missing = spark.range(1500).select(F.format_string("c%04d", "id").alias("column"), F.col("id").alias("missing"), F.lit(0.5).alias("missing_percent"))
    text = records.markdown(spark.read.parquet(path), missing)
    assert sum(line.startswith("| s") for line in text.splitlines()) == 1500
    assert sum(line.startswith("| c") for line in text.splitlines()) == 1500


def test_partials_in_levels(spark, tmp_path):
    """Runs of two sets of columns, compacted in levels: the last row of a key wins as without it, and the plan has a few scans."""
    from corpusflow.sinks import partials

    one, two = f"file://{tmp_path}/one", f"file://{tmp_path}/two"
    for k in range(30):
        own = [(f"k{(k * j) % 11}", str(k), "a,\n\"q\"" if j % 2 else None) for j in range(1, 4)]
        df = spark.createDataFrame(own, "filepath string, a string, b string").coalesce(1)
        for root in (one, two):
            partials.append(df if k % 3 else df.drop("b"), root)
        if k % 4 == 3:
            partials.compact(spark, two, fan=3)
    assert partials.rows(spark, one) == partials.rows(spark, two) == 90
    same = lambda root: sorted(map(str, partials.merged(spark, root).select("filepath", "a", "b").collect()))
    assert same(one) == same(two)
    assert len(partials.runs(spark, two)) < 4
    plan = partials.merged(spark, one)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") + plan.count("Relation[") <= 2
    assert partials.compact(spark, one, fan=1000) == 0
    # a table whose inputs aren't recorded yet doesn't count
    spark.createDataFrame([("k1", "9", "p99999999999999999999", "f", 1)], "filepath string, a string, __run string, __file string, __row long").write.parquet(f"{two}/l1-{9:020d}")
    assert same(one) == same(two)


def test_length_cache(spark, tmp_path):
    """Four cases, and what is probed in each."""
    from corpusflow.sources import lengths

    probed = []

    def probe(new):
        probed.append(sorted(r[0] for r in new.collect()))
        return new.select("filepath", F.length("filepath").cast("double").alias("duration"))

    def ask(*names):
        df = spark.createDataFrame([(n,) for n in names], "filepath string")
        rows, found = lengths.lengths(df, f"{tmp_path}/cache", probe)
        assert sorted(map(tuple, rows.collect())) == sorted({(n, float(len(n))) for n in names if n})
        return found

    assert ask("a", "bb") == "rebuild" and probed.pop() == ["a", "bb"]
    assert ask("bb", "a") == "hit" and not probed
    assert ask("bb", "ccc", "a") == "append" and probed.pop() == ["ccc"]
    assert ask("a", "bb") == "superset" and not probed
    assert ask("ccc", "a", "bb", None) == "hit" and not probed
    assert ask("ccc", "dddd") == "rebuild" and probed.pop() == ["dddd"]
    assert ask("ccc") == "rebuild" and probed.pop() == []
    assert ask("ccc", "ccc", "e") == "rebuild" and probed.pop() == ["e"]


def test_text_files_are_listed_and_read_by_tasks(spark, tmp_path):
    from corpusflow.sources import audio

    texts = {"a_t1.txt": "one\n\ntwo", "x/b_t2.txt": "", "x/y z/c%20_t3.txt": "Ünï", "x/d.txt": "no", "_x/e_t1.txt": "no", "x/.f_t1.txt": "no", "x/y z/_g_t1.txt": "no"}
    for name, text in texts.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(text.encode())
    for root in (str(tmp_path), f"file://{tmp_path}", f"{tmp_path}/"):
        out = audio.text_files(spark, root, "_t*.txt")
        assert {r.path: r.text for r in out.collect()} == {f"{tmp_path}/{n}": t for n, t in texts.items() if t != "no"}
        assert "FileScan" not in out._jdf.queryExecution().executedPlan().toString()
