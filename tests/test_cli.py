from corpusflow import schema
from corpusflow.__main__ import main
from corpusflow.sinks import records


def test_cli(spark, tmp_path, capsys):
    rows = [(f"/a{i}.wav", float(i), 60.0, 10.0) for i in range(20)]
    m = schema.conformed(spark.createDataFrame(rows, ["filepath", "crest_factor", "total_duration", "silence_percent"]))
    m.write.parquet(str(tmp_path / "m"))
    assert main(["filter", str(tmp_path / "m"), str(tmp_path / "f"), "--score", "crest_factor", "--threshold", "10"]) == 0
    assert "'files_out': 11" in capsys.readouterr().out
    assert main(["profile", str(tmp_path / "m"), str(tmp_path / "p")]) == 0
    d = {r.metric: r for r in spark.read.parquet(str(tmp_path / "p/describe")).collect()}
    assert d["speech_duration"].mean == 54.0
    records.append_audit(spark, str(tmp_path / "a"), "crest_factor", spark.createDataFrame([(20, 11, 0.3333, 0.1833)], ["files_in", "files_out", "hours_in", "hours_out"]), {"t": 10}, 0)
    assert main(["report", str(tmp_path / "a"), "--missing", str(tmp_path / "m")]) == 0
    out = capsys.readouterr().out
    assert "| crest_factor | 20 | 11 |" in out
    assert "| music_prob | 20 | 100.000 |" in out
