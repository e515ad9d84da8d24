"""Decoding and resampling of clips, in Arrow batches. Errors are values, not failures."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StringType, StructField, StructType

from clipsieve.plans.policy import DEFAULT

PCM = StructType([StructField("pcm", ArrayType(FloatType())), StructField("error", StringType())])
_PCM = pa.struct([("pcm", pa.list_(pa.float32())), ("error", pa.string())])
#: Clips decoded into one Arrow batch: a 30 s clip has 2 MB.
CLIPS_AT_ONCE = 32


def decode_wav(data: bytes) -> tuple[np.ndarray, int]:
    """Mono samples in [-1, 1] and the rate of a PCM wave file; the channels' mean."""
    with wave.open(io.BytesIO(data)) as w:
        raw, width, channels, rate = w.readframes(w.getnframes()), w.getsampwidth(), w.getnchannels(), w.getframerate()
    if width == 1:
        samples = np.frombuffer(raw, dtype=np.uint8).astype(np.float64) / 128.0 - 1.0
    elif width == 3:
        parts = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 3).astype(np.int32)
        value = parts[:, 0] | parts[:, 1] << 8 | parts[:, 2] << 16
        samples = np.where(value >= 1 << 23, value - (1 << 24), value) / float(1 << 23)
    elif width in (2, 4):
        samples = np.frombuffer(raw, dtype=f"<i{width}") / float(1 << (8 * width - 1))
    else:
        raise ValueError(f"unsupported sample width {width}")
    return samples.reshape(-1, channels).mean(axis=1), rate


def resample(x: np.ndarray, rate: int, to: int, taps: int = 32) -> np.ndarray:
    """Polyphase windowed-sinc resampling; the length is rounded up, as is usual."""
    if rate == to or not len(x):
        return np.asarray(x, dtype=np.float64)
    g = np.gcd(rate, to)
    up, down = to // g, rate // g
    n = -(-len(x) * up // down)
    half = taps * max(up, down)
    t = np.arange(-half, half + 1)
    cut = 1.0 / max(up, down)
    kernel = up * cut * np.sinc(t * cut) * np.kaiser(2 * half + 1, 8.6)
    at = np.arange(n) * down  # place in the upsampled signal
    first = -(-(at - half) // up)
    steps = np.arange(2 * half // up + 2)
    source = first[:, None] + steps[None, :]
    offset = at[:, None] - source * up + half
    good = (source >= 0) & (source < len(x)) & (offset >= 0) & (offset <= 2 * half)
    return np.where(good, x[np.clip(source, 0, len(x) - 1)] * kernel[np.clip(offset, 0, 2 * half)], 0.0).sum(axis=1)


def _one(data: bytes | None, rate: int) -> dict | None:
    if data is None:
        return None
    try:
        samples, found = decode_wav(data)
        return {"pcm": resample(samples, found, rate).astype(np.float32), "error": None}
    except Exception as e:  # noqa: BLE001 - any error is the clip's reject reason
        return {"pcm": None, "error": f"{type(e).__name__}: {e}"}


def decoded(content: Column, rate: int = DEFAULT.sample_rate) -> Column:
    """struct<pcm,error> of wave files; null for null. A file that can't be decoded gives its error."""

    @F.arrow_udf(PCM)
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for i in range(0, len(batch), CLIPS_AT_ONCE):
                yield pa.array([_one(data.as_py(), rate) for data in batch.slice(i, CLIPS_AT_ONCE)], _PCM)

    return decode(content)


def _content(place: str) -> bytes:
    """A file's bytes, on whatever file system its address names."""
    uri = "file://" + place[5:] if place.startswith("file:/") and not place.startswith("file://") else place
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_stream(path) as f:
        return f.read()


def loaded(rows: DataFrame, place: str, rate: int = DEFAULT.sample_rate) -> DataFrame:
    """Adds pcm and load_error of the wave files at column ``place``, which the workers read themselves.

    So samples never pass a shuffle, and a file that is gone or broken is an error of its row. A null place is one too.
    """

    def one(at: str | None) -> dict:
        try:
            return _one(_content(at), rate)
        except Exception as e:  # noqa: BLE001 - any error is the clip's reject reason
            return {"pcm": None, "error": f"{type(e).__name__}: {e}"}

    @F.arrow_udf(PCM)
    def load(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for i in range(0, len(batch), CLIPS_AT_ONCE):
                yield pa.array([one(at.as_py()) for at in batch.slice(i, CLIPS_AT_ONCE)], _PCM)

    found = rows.withColumn("_loaded", load.asNondeterministic()(F.col(place)))
    return found.withColumns({"pcm": F.col("_loaded.pcm"), "load_error": F.col("_loaded.error")}).drop("_loaded")


def resampled(pcm: Column, rate: int = DEFAULT.sample_rate, to: int = DEFAULT.output_sample_rate) -> Column:
    """struct<value,error>: samples at another rate; null for null."""
    kind = pa.struct([("value", pa.list_(pa.float32())), ("error", pa.string())])

    def one(x: list[float] | None) -> dict | None:
        if x is None:
            return None
        try:
            return {"value": resample(np.asarray(x, dtype=np.float64), rate, to).astype(np.float32), "error": None}
        except Exception as e:  # noqa: BLE001 - any error is the clip's reject reason
            return {"value": None, "error": f"{type(e).__name__}: {e}"}

    @F.arrow_udf(StructType([StructField("value", ArrayType(FloatType())), StructField("error", StringType())]))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for i in range(0, len(batch), CLIPS_AT_ONCE):
                yield pa.array([one(x.as_py()) for x in batch.slice(i, CLIPS_AT_ONCE)], kind)

    return run.asNondeterministic()(pcm)


def read_clips(files: DataFrame, content: str = "content") -> DataFrame:
    """Adds pcm and load_error to binary files (path, content)."""
    found = files.withColumn("_decoded", decoded(F.col(content)))
    return found.withColumns({"pcm": F.col("_decoded.pcm"), "load_error": F.col("_decoded.error")}).drop("_decoded", content)
