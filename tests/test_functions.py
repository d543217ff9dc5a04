import math

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import numeric, paths, text


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    ("word", "label", "want"),
    [
        ("привет", "UPPER_TIRE", "Привет —"), ("привет", "LOWER_TIRE", "привет—"), ("ок", "UPPER_TOTAL_QUESTIONVOSKL", "ОК?!"), ("да", "LOWER_O", "да"),
        ("да", "SOMETHING", None), ("да", "UPPER_NOTHING", None), ("нЕт", "UPPER_COMMA", "Нет,"), ("a", "UPPER_TOTAL_MNOGOTOCHIE", "A..."),
    ],
)
def test_punct_decode(spark, word, label, want):
    assert one(spark, text.punct_decode(F.col("w"), F.col("l")), w=word, l=label) == want


def test_punct_join(spark):
    df = spark.createDataFrame([(["как", "дела"], ["UPPER_O", "LOWER_QUESTION"])], ["w", "l"])
    assert df.select(text.punct_join(F.col("w"), F.col("l"))).first()[0] == "Как дела?"


def test_text(spark):
    assert one(spark, text.normalize_text(F.col("t")), t="  Hello,\tWORLD! a_b ") == "hello world a_b"
    assert one(spark, text.normalize_transcript(F.col("t")), t=" A   b\n") == "a b"
    assert one(spark, text.consensus_key(F.col("t")), t=" A  b\n") == "a  b"
    # a combining mark ends a word
    assert one(spark, text.word_count(F.col("t")), t="за́мок дом") == 3
    assert one(spark, text.slug(F.col("t")), t="https://h.com/a b?c=1") == "h.com_a_b_c_1"
    assert one(spark, text.slug(F.col("t")), t="https://???") == "page"
    assert one(spark, text.truthy(F.col("t")), t=" Yes ") is True
    assert one(spark, text.truthy(F.col("t"), extra=False), t="on") is False
    assert one(spark, text.page_title(F.col("t")), t="<TITLE a='b'> x \n y </title>") == "x y"


def test_buckets(spark):
    rows = [(0.0, 0), (-1.0, 0), (0.5, 0), (1.0, 1), (14.99, 14), (15.0, 14), (15.01, 15)]
    got = spark.createDataFrame(rows, ["d", "want"]).select(numeric.bucket_index(F.col("d"), 1.0, 15.0).alias("b"), "want").collect()
    assert all(r.b == r.want for r in got)
    assert one(spark, numeric.bucket_label(F.col("b"), 1.0, 15.0), b=15) == "len_ge_015s"
    assert one(spark, numeric.bucket_label(F.col("b"), 1.0, 15.0), b=3) == "len_003_004s"


def test_arrays(spark):
    assert one(spark, numeric.crest_factor(F.col("x")), x=[-3.0, 1.0]) == pytest.approx(3 / math.sqrt(5))
    assert one(spark, numeric.crest_factor(F.col("x")), x=[0.0, 0.0]) == math.inf
    empty = spark.createDataFrame([([],)], "x array<double>").select(numeric.crest_factor(F.col("x"))).first()[0]
    assert empty == math.inf
    assert one(spark, numeric.fit_length(F.col("x"), 5), x=[1.0, 2.0]) == [1.0, 2.0, 1.0, 2.0, 1.0]
    assert one(spark, numeric.keep_last(F.col("x"), 3), x=[1.0, 2.0]) == [0.0, 1.0, 2.0]
    assert one(spark, numeric.keep_last(F.col("x"), 2), x=[1.0, 2.0, 3.0]) == [2.0, 3.0]
    assert one(spark, numeric.mono(F.col("x")), x=[[1.0, 3.0], [3.0, 5.0]]) == [2.0, 4.0]
    assert one(spark, numeric.peak_int16(F.col("x")), x=[0.5, -1.0]) == [16384, -32767]
    assert one(spark, numeric.positive(F.col("x")), x="abc") is None
    assert one(spark, numeric.positive(F.col("x")), x="2.5") == 2.5


def test_paths(spark):
    p = "/a/pl/00/1.00_2.50_pl_00.mp3"
    assert one(spark, paths.stem(F.col("p")), p=p) == "1.00_2.50_pl_00"
    assert one(spark, paths.suffix(F.col("p")), p="/x/A.MP3") == "mp3"
    assert one(spark, paths.sidecar(F.col("p"), "rover"), p=p) == "/a/pl/00/1.00_2.50_pl_00_rover.txt"
    assert one(spark, paths.replace_in_stem(F.col("p"), "a", "b"), p="/a/aXa.txt") == "/a/bXb.txt"
    assert one(spark, paths.normalise(F.col("p"), "/root"), p=" ./x.wav ") == "/root/x.wav"
    assert one(spark, paths.is_chunk_name(F.col("p")), p="/x/1.0_2.0_a.wav") is True
    r = one(spark, paths.identity(F.col("p"), F.lit(9.0)), p=p)
    assert (r.start, r.end, r.playlist_id, r.podcast_id) == (1.0, 2.5, "pl", "00")
    r = one(spark, paths.identity(F.col("p"), F.lit(9.0)), p="5.0_2.0_pl_ep_x.mp3")
    assert (r.start, r.end, r.playlist_id, r.podcast_id) == (0.0, 9.0, "pl", "ep_x")
    r = one(spark, paths.identity(F.col("p"), F.lit(9.0)), p="folder/name.mp3")
    assert (r.playlist_id, r.podcast_id) == ("folder", "name")
    assert one(spark, paths.container(F.col("p")), p=".xyz") == "flac"
    assert one(spark, paths.chunk_name(F.lit(1.0), F.lit(2.5), F.lit("a"), F.lit("b"), F.col("p")), p="wav") == "1.00_2.50_a_b.wav"
