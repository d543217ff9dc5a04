"""Numbers: rounding, durations, buckets, percentages and array arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(value: Column, digits: int) -> Column:
    """Half to even."""
    return F.bround(value, digits)


def positive(value: Column) -> Column:
    """A number above zero; anything else is null."""
    v = finite_or_null(value.try_cast("double"))
    return F.when(v > 0, v)


def finite_or_null(value: Column) -> Column:
    v = value.cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """part of whole in percent; 0 when there is nothing."""
    p = F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)) * 100)
    return p if digits is None else round_even(p, digits)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return a / F.nullif(b, F.lit(0).cast("double"))


def bucket_index(duration: Column, width: float, most: float) -> Column:
    """Number of the length bucket; the last one is closed, longer clips overflow into the next."""
    last = -int(-most // width) - 1
    return F.when(duration <= 0, 0).when(duration <= most, F.least(F.floor(duration / width), F.lit(last))).otherwise(last + 1).cast("int")


def bucket_label(index: Column, width: float, most: float) -> Column:
    over = -int(-most // width)
    low = F.floor(index * width).cast("int")
    high = F.least(F.floor((index + 1) * width), F.lit(int(most))).cast("int")
    return F.when(index >= over, F.format_string("len_ge_%03ds", F.lit(int(most)))).otherwise(F.format_string("len_%03d_%03ds", low, high))


def crest_factor(samples: Column) -> Column:
    """Peak over root mean square; infinite for silence and for nothing."""
    x = F.transform(samples, lambda v: v.cast("double"))
    square = F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v)
    rms = F.sqrt(square / F.nullif(F.size(x), F.lit(0)))
    peak = F.array_max(F.transform(x, F.abs))
    return F.when(F.coalesce(rms, F.lit(0.0)) == 0, F.lit(float("inf"))).otherwise(peak / F.nullif(rms, F.lit(0.0)))


def fit_length(samples: Column, n: int, start: Column | None = None) -> Column:
    """n samples: a longer array from `start`, a shorter one repeated; empty is silence."""
    size = F.size(samples)
    begin = F.lit(0) if start is None else start
    times = F.ceil(F.lit(float(n)) / F.nullif(size.cast("double"), F.lit(0.0))).cast("int")
    repeated = F.slice(F.flatten(F.array_repeat(samples, times)), 1, n)
    silent = F.array_repeat(F.lit(0.0), n)
    return F.when(size == 0, silent).when(size >= n, F.slice(samples, begin + 1, n)).otherwise(repeated)


def keep_last(samples: Column, n: int) -> Column:
    """The last n samples, with zeros in front of a shorter array."""
    size = F.size(samples)
    return F.when(size >= n, F.slice(samples, F.greatest(size - n + 1, F.lit(1)), n)).otherwise(
        F.concat(F.array_repeat(F.lit(0.0), F.greatest(F.lit(n) - size, F.lit(0))), F.transform(samples, lambda v: v.cast("double")))
    )


def mono(channels: Column) -> Column:
    """The mean of an array of channels, sample by sample."""
    total = F.reduce(channels, F.transform(F.element_at(channels, 1), lambda _: F.lit(0.0)), lambda a, c: F.zip_with(a, c, lambda x, y: x + y))
    return F.transform(total, lambda v: v / F.size(channels))


def peak_int16(samples: Column) -> Column:
    """16-bit integers scaled to the loudest sample."""
    peak = F.array_max(F.transform(samples, lambda v: F.abs(v.cast("double"))))
    return F.transform(samples, lambda v: F.when(peak == 0, F.lit(0)).otherwise(F.bround(v.cast("double") / peak * 32767, 0)).cast("short"))


def from_int16(samples: Column, n: int | None = None) -> Column:
    """16-bit values clipped to their range, as fractions, cut to n."""
    x = F.transform(samples, lambda v: F.greatest(F.least(v.cast("double"), F.lit(32767.0)), F.lit(-32768.0)) / 32768)
    return x if n is None else F.slice(x, 1, n)


def next_multiple(n: Column, of: int) -> Column:
    return (F.ceil(n / of) * of).cast("long")
