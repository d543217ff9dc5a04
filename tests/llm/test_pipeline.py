import re

import corpus_pipeline
from made_up import words

from corpusflow.llm import lines, quality
from corpusflow.llm.common import materialise


def jaccard(a: str, b: str) -> float:
    s, t = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.lower().split(), b.lower().split()))
    return len(s & t) / max(1, len(s | t))


def test_pipeline(spark, tmp_path):
    rows, labels, bench = [], [], [(0, words(900, 30)), (1, words(901, 5))]
    for i in range(240):
        w = words(i, 150)
        if i % 8 == 1:
            w = " ".join(x + "###" for x in w.split())
        if i % 8 == 2:
            w = " ".join(x + (" vile" if j % 12 == 0 else "") for j, x in enumerate(w.split()))
        if i % 8 == 3:
            v = words(i - 3, 150).split()
            v[70] = "other"
            w = " ".join(v)
        if i % 40 == 4:
            w = w + "\n" + words(900, 30)
        if i % 2 == 0:
            w = w + "\nFollow us today"
        rows.append((i, w, "en", f"s{i % 7}", len(w)))
        if i < 200:
            labels.append((i, int(i % 8 != 1), int(i % 8 == 2)))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, str(tmp_path)))
        if name != "packing":
            assert docs.columns == columns
            kept[name] = {r.doc_id: r.text for r in docs.collect()}
    ids = set(range(240))
    good = {i for i in ids if i % 8 not in (1, 2)}
    assert set(kept["quality"]) == good
    assert set(kept["line_dedup"]) == good
    assert not any("Follow us" in t for t in kept["line_dedup"].values())
    near = {i for i in good if i % 8 != 3}  # the copy with one word changed goes
    assert all(jaccard(kept["line_dedup"][i], kept["line_dedup"][i - 3]) >= 0.8 for i in good - near)
    assert set(kept["near_duplicates"]) == near
    assert set(kept["decontamination"]) == {i for i in near if i % 40 != 4}
    assert {r.doc_id for r in docs.collect()} == set(kept["decontamination"])
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in out.collect()} == set(kept["decontamination"])


def test_stages_take_awkward_rows(spark, docs, none, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of the kind")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for start in (docs, none):
        own = start
        for _, stage in corpus_pipeline.STAGES:
            own = materialise(stage(spark, own, str(tmp_path)))
        assert (own.count() > 0) == (start is docs)
    assert re.match(r"\d", str(quality.KEEP))
    assert lines.MIN_SITES > 1


def test_each_stage_on_awkward_rows(spark, docs, awkward, none, tmp_path):
    """What every stage does with nulls, empty texts, repeated rows and rows without an id; no labels: all but empty texts are good."""
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one"), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    ids = sorted(r[0] or -1 for r in awkward)

    def kept(name):
        out = stages[name](spark, docs, str(tmp_path))
        assert name == "packing" or out.columns == docs.columns
        return sorted(r.doc_id or -1 for r in out.select("doc_id").collect())

    assert kept("quality") == [i for i in ids if i not in (5, 6, 7)]
    assert kept("line_dedup") == ids
    assert kept("near_duplicates") == sorted([5, 8, 8, 10, 12, 14, 15, 16, 17, 18, -1])  # 9, 11 and 13 are near 8, 10 and 12
    assert kept("decontamination") == [i for i in ids if i not in (8, 9)]
    assert set(kept("packing")) == set(ids)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0, name
