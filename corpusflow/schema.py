"""Tables of the engine as explicit schemas; nothing is inferred. Ids are always text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the manifest in their order.
MANIFEST = T.StructType(
    [
        T.StructField("filepath", T.StringType(), False),
        T.StructField("speaker_id", T.IntegerType()),
        T.StructField("start", T.DoubleType()),
        T.StructField("end", T.DoubleType()),
        T.StructField("total_duration", T.DoubleType()),
        T.StructField("playlist_id", T.StringType()),
        T.StructField("podcast_id", T.StringType()),
        T.StructField("silence_percent", T.DoubleType()),
        T.StructField("max_silence_duration", T.DoubleType()),
        T.StructField("is_single_speaker", T.BooleanType()),
        T.StructField("crest_factor", T.DoubleType()),
        T.StructField("loudness_normalized", T.BooleanType()),
        T.StructField("music_prob", T.DoubleType()),
        T.StructField("DistillMOS", T.DoubleType()),
        T.StructField("score_bonafide", T.DoubleType()),
        T.StructField("score_spoof", T.DoubleType()),
        T.StructField("denoised", T.BooleanType()),
    ]
)


def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

AUDIT = _struct(timestamp=_S, stage=_S, files_in=_L, files_out=_L, hours_in=_D, hours_out=_D, hours_removed=_D, params=_S)
STATUS = _struct(stage=_S, finished_at=_S, total=_L, errors=_L, error_details=T.ArrayType(T.MapType(_S, _S)))
SIDECAR = _struct(filepath=_S, kind=_S, text=_S)
CANDIDATE = _struct(filepath=_S, model=_S, text=_S)
SEGMENT = _struct(source_id=_S, pos=_I, seg_start=_D, seg_end=_D, speaker=_I, prediction=_I)
TRACK = _struct(
    audio_id=_S, track_id=_S, album_id=_S, title=_S, artists=T.ArrayType(_S), duration_ms=_L, short_description=_S, source_type=_S, source_id=_S,
    source_title=_S, source_url=_S, album=_struct(id=_S, title=_S, url=_S), track_url=_S, parsed_at=_S,
)
RESOURCE_SAMPLE = _struct(
    timestamp_utc=_S, process_count=_L, cpu_percent_raw=_D, cpu_util_percent=_D, cpu_cores_used=_D, rss_bytes=_L, rss_gb=_D, system_cpu_percent=_D,
    system_ram_used_gb=_D, system_ram_percent=_D, gpus=T.ArrayType(_struct(index=_I, gpu_util_percent=_D, memory_used_mb=_D, memory_total_mb=_D)),
)


def ordered(df: DataFrame) -> DataFrame:
    """Manifest columns first, in their order, then all others as they came."""
    known = [f.name for f in MANIFEST if f.name in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in [*known, *[c for c in df.columns if c not in known]]])


def conformed(df: DataFrame) -> DataFrame:
    """Manifest columns in their types (values that don't parse are null), missing ones as null; others stay."""
    cols = {f.name: F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType) for f in MANIFEST}
    return ordered(df.withColumns(cols))
