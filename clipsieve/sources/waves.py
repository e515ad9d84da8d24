"""Writing samples as wave files."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType


def wav_bytes(x: np.ndarray, rate: int) -> bytes:
    """16-bit mono; samples beyond [-1, 1] are scaled by the peak first."""
    scaled = np.asarray(x, dtype=np.float64) / max(1.0, float(np.abs(x).max(initial=0.0)))
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.round(scaled * 32767).astype("<i2").tobytes())
    return out.getvalue()


def encode_wav(pcm: Column, rate: int) -> Column:
    """Samples as a wave file; null for null."""

    @F.arrow_udf(BinaryType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([None if x is None else wav_bytes(np.asarray(x), rate) for x in batch.to_pylist()], pa.binary())

    return run(pcm)
