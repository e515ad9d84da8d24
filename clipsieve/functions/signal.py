"""Signal expressions on arrays of samples; built-in higher-order functions, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipsieve.plans.policy import DEFAULT, Policy


def mean(xs: Column) -> Column:
    """Of an array; null if it is empty."""
    return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(xs), F.lit(0))


def frames(pcm: Column, width: int | Column) -> Column:
    """Frames without overlap that begin before the last ``width`` samples: one that begins exactly there is left out."""
    width = F.lit(width) if isinstance(width, int) else width
    n = F.size(pcm)
    starts = F.sequence(F.lit(0), n - width - 1, width)
    return F.when(n > width, F.transform(starts, lambda i: F.slice(pcm, i + 1, width))).otherwise(F.array().cast("array<array<double>>"))


def rms(frame: Column) -> Column:
    return F.sqrt(F.aggregate(frame, F.lit(0.0), lambda a, x: a + x * x) / F.size(frame))


def frame_rms(pcm: Column, width: int) -> Column:
    return F.transform(frames(pcm.cast("array<double>"), width), rms)


def snr_of_energies(energies: Column, policy: Policy = DEFAULT) -> Column:
    """Decibels between the louder half of the frames and the quietest tenth; 0 without frames, the ceiling without noise."""
    e = F.array_sort(energies)
    n = F.size(e)
    noise = mean(F.slice(e, F.lit(1), F.greatest(F.lit(1), F.floor(n / 10).cast("int"))))
    loud = mean(F.slice(e, F.floor(n / 2).cast("int") + 1, n))
    return F.when(n == 0, F.lit(0.0)).when(noise < policy.snr_noise_floor, F.lit(policy.snr_ceiling_db)).otherwise(20.0 * F.log10(loud / noise + 1e-10))


def snr(pcm: Column, policy: Policy = DEFAULT, width: int | None = None) -> Column:
    return snr_of_energies(frame_rms(pcm, width or int(policy.snr_frame_s * policy.sample_rate)), policy)


def peak(pcm: Column) -> Column:
    return F.array_max(F.transform(pcm, lambda x: F.abs(x)))


def peak_normalised(pcm: Column, policy: Policy = DEFAULT) -> Column:
    """Scaled so the peak is the target, and clipped to it; silence is left alone."""
    target = F.lit(policy.target_peak)

    def scaled(top: Column) -> Column:
        return F.transform(pcm, lambda x: F.greatest(-target, F.least(target, x / (top + policy.peak_epsilon) * target)))

    # the peak is bound as a lambda's argument: inside the inner one it would be sought again for each sample
    return F.transform(F.array(peak(pcm)), lambda top: F.when(F.coalesce(top, F.lit(0.0)) < policy.silence_peak, pcm).otherwise(scaled(top)))[0]


def speech_ratio(segments: Column, n: Column) -> Column:
    """Share of samples inside segments (start, end)."""
    return F.aggregate(segments, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]) / F.greatest(n, F.lit(1))


def trimmed(pcm: Column, segments: Column) -> Column:
    """The samples inside the segments, joined."""
    return F.flatten(F.transform(segments, lambda s: F.slice(pcm, s["start"] + 1, s["end"] - s["start"])))


def mono(channels: Column) -> Column:
    """The mean of an array of channels of one length."""
    n = F.size(channels)
    total = F.aggregate(F.slice(channels, F.lit(2), n), F.element_at(channels, 1).cast("array<double>"), lambda a, c: F.zip_with(a, c.cast("array<double>"), lambda x, y: x + y))
    return F.transform(total, lambda x: x / n)


def _field(name: str):
    return lambda x: x[name].cast("double")


def voiced(frequencies: Column, confidences: Column, policy: Policy = DEFAULT) -> Column:
    """(mean_f0_hz, pitch_confidence) over voiced frames; zeros with too few of them. It never rejects."""
    pairs = F.filter(F.zip_with(frequencies, confidences, lambda f, c: F.struct(f.alias("f"), c.alias("c"))), lambda x: x["c"] > policy.pitch_min_conf)
    few = F.size(pairs) < policy.pitch_min_voiced
    both = [F.when(few, F.lit(0.0)).otherwise(mean(F.transform(pairs, _field(k)))) for k in ("f", "c")]
    return F.struct(both[0].alias("mean_f0_hz"), both[1].alias("pitch_confidence"))
