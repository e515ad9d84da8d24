"""Scorers of clips behind one interface, so that model-based ones can replace the stand-ins here.

A scorer gets samples, or null for a clip that an earlier gate rejected (conditions don't keep rows from a Python
function, null inputs do), and returns null for null. A worker builds its model once, on first use. What it returns is
struct<value, error>: a model that fails on a clip gives the clip's error and doesn't end the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, IntegerType, StringType, StructField, StructType

from clipsieve.plans.policy import DEFAULT, Policy

SEGMENTS = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))
PITCH = StructType([StructField("f0", ArrayType(DoubleType())), StructField("confidence", ArrayType(DoubleType()))])


@lru_cache(maxsize=8)
def _built(build: Callable[[], Any]) -> Any:
    return build()


def scorer(build: Callable[[], Callable[[np.ndarray], Any]], returns: DataType) -> Callable[[Column], Column]:
    """A scorer from a function that builds the model: ``build()`` runs once in each worker."""
    from pyspark.sql.pandas.types import to_arrow_type

    def one(model: Callable[[np.ndarray], Any], x: list[float] | None) -> dict[str, Any] | None:
        if x is None:
            return None
        try:
            return {"value": model(np.asarray(x, dtype=np.float64)), "error": None}
        except Exception as e:  # noqa: BLE001 - any error is the clip's reject reason
            return {"value": None, "error": str(e) or type(e).__name__}

    @F.arrow_udf(StructType([StructField("value", returns), StructField("error", StringType())]))
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, kind = _built(build), pa.struct([("value", to_arrow_type(returns)), ("error", pa.string())])
        for batch in batches:
            yield pa.array([one(model, x) for x in batch.to_pylist()], kind)

    return score.asNondeterministic()


def masked(pcm: Column, alive: Column) -> Column:
    """The samples of clips not rejected so far, else null."""
    return F.when(alive, pcm)


def energy_segments(x: np.ndarray, policy: Policy = DEFAULT, below_peak_db: float = 30.0, hang: int = 5) -> list[dict[str, int]]:
    """Speech by energy, a stand-in for a voice activity model: frames less than so far below the loudest, with short gaps filled."""
    width = int(policy.snr_frame_s * policy.sample_rate)
    n = len(x) // width
    if not n:
        return []
    energy = np.sqrt((x[: n * width].reshape(n, width) ** 2).mean(axis=1))
    top = energy.max()
    if top < policy.silence_peak:
        return []
    active = energy >= top * 10 ** (-below_peak_db / 20)
    places = np.flatnonzero(active)
    breaks = np.flatnonzero(np.diff(places) > hang)
    starts, ends = np.concatenate([places[:1], places[breaks + 1]]), np.concatenate([places[breaks], places[-1:]])
    return [{"start": int(a * width), "end": int((b + 1) * width)} for a, b in zip(starts, ends, strict=True)]


def autocorrelation_pitch(x: np.ndarray, policy: Policy = DEFAULT, window: int = 1024) -> dict[str, list[float]]:
    """Pitch and its confidence for each hop by normalised autocorrelation, a stand-in for a pitch model."""
    low, high = int(policy.sample_rate / policy.pitch_fmax_hz), int(policy.sample_rate / policy.pitch_fmin_hz)
    f0, confidence = [], []
    for start in range(0, max(0, len(x) - window), policy.pitch_hop):
        frame = x[start : start + window] - x[start : start + window].mean()
        r = np.fft.irfft(np.abs(np.fft.rfft(frame, 2 * window)) ** 2)[:window]
        power = np.concatenate([[0.0], np.cumsum(frame**2)])
        lags = np.arange(window)
        norm = np.sqrt(power[window - lags] * (power[window] - power[lags])) + 1e-12
        seek = (r / norm)[low : min(high, window - 1)]
        peaks = np.flatnonzero((seek[1:-1] >= seek[:-2]) & (seek[1:-1] > seek[2:])) + 1
        good = peaks[seek[peaks] >= 0.9 * seek[peaks].max()] if len(peaks) else np.array([seek.argmax()])
        best = int(good[0])
        f0.append(policy.sample_rate / (low + best))
        confidence.append(float(np.clip(seek[best], 0.0, 1.0)) if power[window] > 1e-9 else 0.0)
    return {"f0": f0, "confidence": confidence}


def _energy_model() -> Callable[[np.ndarray], Any]:
    return energy_segments


def _pitch_model() -> Callable[[np.ndarray], Any]:
    return autocorrelation_pitch


def speech_segments(pcm: Column) -> Column:
    return scorer(_energy_model, SEGMENTS)(pcm)


def pitch_track(pcm: Column) -> Column:
    return scorer(_pitch_model, PITCH)(pcm)
