"""Signal measures that need the samples: loudness, log-mel spectra, chunk cutting. numpy inside one decode per file."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks.files import encode_wav
from ..sources.audio import Decoder, decoded

TARGET_LUFS, BLOCK_S = -23.0, 0.4
MELS, FFT, HOP, PRE_EMPHASIS = 128, 512, 160, 0.97


def crest(x: np.ndarray) -> tuple[float, float, int]:
    """Peak, sum of squares and number of the channels' mean: sufficient for the crest factor."""
    m = x.mean(axis=0, dtype=np.float64) if x.size else np.zeros(0)
    return (float(np.abs(m).max()) if m.size else 0.0), float((m * m).sum()), int(m.size)


def crest_of(peak: str = "peak", squares: str = "squares", n: str = "n"):
    """The crest factor as a column: infinite for silence."""
    rms = F.sqrt(F.col(squares) / F.nullif(F.col(n), F.lit(0)))
    return F.when(F.coalesce(rms, F.lit(0.0)) == 0, F.lit(float("inf"))).otherwise(F.col(peak) / F.nullif(rms, F.lit(0.0)))


def _biquad(b: np.ndarray, a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A second-order filter along the last axis."""
    y, z = np.empty_like(x), np.zeros((2, *x.shape[:-1]))
    for i in range(x.shape[-1]):
        v = x[..., i]
        y[..., i] = b[0] * v + z[0]
        z[0] = b[1] * v - a[1] * y[..., i] + z[1]
        z[1] = b[2] * v - a[2] * y[..., i]
    return y


def _shelf(rate: int, gain: float, q: float, fc: float, high_pass: bool) -> tuple[np.ndarray, np.ndarray]:
    w = 2 * np.pi * fc / rate
    alpha, cos = np.sin(w) / (2 * q), np.cos(w)
    if high_pass:
        b = np.array([(1 + cos) / 2, -(1 + cos), (1 + cos) / 2])
        a = np.array([1 + alpha, -2 * cos, 1 - alpha])
    else:
        g = 10 ** (gain / 40)
        r = 2 * np.sqrt(g) * alpha
        b = g * np.array([(g + 1) + (g - 1) * cos + r, -2 * ((g - 1) + (g + 1) * cos), (g + 1) + (g - 1) * cos - r])
        a = np.array([(g + 1) - (g - 1) * cos + r, 2 * ((g - 1) - (g + 1) * cos), (g + 1) - (g - 1) * cos - r])
    return b / a[0], a / a[0]


def loudness(x: np.ndarray, rate: int, block: float = BLOCK_S) -> float:
    """Integrated loudness after ITU-R BS.1770-4: K-weighting, blocks with 75 % overlap, absolute and relative gates."""
    n = int(block * rate)
    if x.shape[1] < n:
        raise ValueError("the signal is shorter than a block")
    y = _biquad(*_shelf(rate, 4.0, 1 / np.sqrt(2), 1500.0, False), x.astype(np.float64))
    y = _biquad(*_shelf(rate, 0.0, 0.5, 38.0, True), y)
    squares = np.concatenate((np.zeros((len(y), 1)), np.cumsum(y * y, axis=1)), axis=1)
    starts = np.arange(0, x.shape[1] - n + 1, max(1, n // 4))
    power = (squares[:, starts + n] - squares[:, starts]) / n
    weights = np.array([1.0, 1.0, 1.0, 1.41, 1.41])[: len(y)]
    z = weights @ power
    level = -0.691 + 10 * np.log10(np.maximum(z, 1e-20))
    loud = level >= -70
    if not loud.any():
        return float("-inf")
    gate = -0.691 + 10 * np.log10(z[loud].mean()) - 10
    own = loud & (level > gate)
    return float(-0.691 + 10 * np.log10(z[own].mean()))


def normalised(x: np.ndarray, rate: int, target: float = TARGET_LUFS) -> np.ndarray:
    """x at the target loudness; silence stays."""
    own = loudness(x, rate)
    return x if not np.isfinite(own) else x * 10 ** ((target - own) / 20)


def log_mel(x: np.ndarray, rate: int = 16000) -> np.ndarray:
    """(mels, frames): log of Slaney mel energies after pre-emphasis."""
    m = x.mean(axis=0) if x.ndim > 1 else x
    m = np.append(m[:1], m[1:] - PRE_EMPHASIS * m[:-1])
    frames = np.lib.stride_tricks.sliding_window_view(np.pad(m, FFT // 2), FFT)[::HOP]
    power = np.abs(np.fft.rfft(frames * np.hanning(FFT + 1)[:-1], axis=1)) ** 2
    return np.log(_mel_filters(rate) @ power.T + 2**-24)


def _mel_filters(rate: int) -> np.ndarray:
    to_hz = lambda m: np.where(m < 15, m * 200 / 3, 1000 * np.exp((m - 15) * np.log(6.4) / 27))
    top = 15 + np.log(rate / 2 / 1000) / np.log(6.4) * 27
    edges = to_hz(np.linspace(0, top, MELS + 2))
    bins = np.fft.rfftfreq(FFT, 1 / rate)
    up = (bins[None, :] - edges[:-2, None]) / (edges[1:-1] - edges[:-2])[:, None]
    down = (edges[2:, None] - bins[None, :]) / (edges[2:] - edges[1:-1])[:, None]
    return np.maximum(0, np.minimum(up, down)) * (2 / (edges[2:] - edges[:-2]))[:, None]


def audio_stats(files: DataFrame, decoders: dict[str, Decoder] | None = None) -> DataFrame:
    """(path, error, peak, squares, n, rate, lufs, crest_factor): crest and loudness of each file in one decode."""

    def work(x: np.ndarray, rate: int) -> tuple:
        try:
            level = loudness(x, rate)
        except ValueError:
            level = None
        return (*crest(x), rate, level if level is not None and np.isfinite(level) else None)

    out = decoded(files, work, "peak double, squares double, n long, rate long, lufs double", decoders)
    return out.withColumn("crest_factor", F.when(F.col("error").isNull(), F.bround(crest_of(), 4)))


def cut_chunks(files: DataFrame, clips: DataFrame, decoders: dict[str, Decoder] | None = None) -> DataFrame:
    """(path, error, name, content): WAV bytes of each clip (path, name, clip_start, clip_end); a source is decoded once for all of its clips."""
    own = clips.groupBy("path").agg(F.collect_list(F.struct("name", "clip_start", "clip_end")).alias("clips"))
    joined = files.select("path", "content").join(own, "path")

    import pyarrow as pa

    from ..sources.audio import DECODERS

    known = decoders or DECODERS

    def run(batches):
        for batch in batches:
            for path, data, spans in zip(*(batch.column(i).to_pylist() for i in range(3))):
                try:
                    x, rate = known[path.rsplit(".", 1)[-1].lower()](data)
                    rows = [(path, None, s["name"], encode_wav(x[:, int(s["clip_start"] * rate) : int(s["clip_end"] * rate)], rate)) for s in spans]
                except Exception as e:  # noqa: BLE001
                    rows = [(path, f"{type(e).__name__}: {e}", None, None)]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.string(), pa.binary()))], ["path", "error", "name", "content"])

    return joined.mapInArrow(run, "path string, error string, name string, content binary")
