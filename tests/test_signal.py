from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipsieve.functions import signal
from clipsieve.operators.scorers import autocorrelation_pitch, energy_segments, masked, pitch_track, speech_segments
from clipsieve.plans.policy import DEFAULT
from clipsieve.sources.audio import decode_wav, decoded, resample
from clipsieve.sources.waves import wav_bytes

RATE = 16_000


def sine(seconds: float, hz: float = 220.0, loud: float = 0.5) -> np.ndarray:
    return loud * np.sin(2 * np.pi * hz * np.arange(int(seconds * RATE)) / RATE)


def numpy_snr(x: np.ndarray, width: int = 320) -> float:
    e = np.sort([np.sqrt(np.mean(x[i : i + width] ** 2)) for i in range(0, len(x) - width, width)])
    if not len(e):
        return 0.0
    noise, loud = e[: max(1, len(e) // 10)].mean(), e[len(e) // 2 :].mean()
    return 40.0 if noise < 1e-10 else float(20 * np.log10(loud / noise + 1e-10))


def noisy(n: int) -> np.ndarray:
    t = np.arange(n)
    return np.sin(t * 12.9898) * 0.01 + np.where(t % 4000 < 2000, np.sin(t * 0.05), 0)


@pytest.mark.parametrize("n", [0, 319, 320, 321, 640, 641, 16_000])
def test_snr(spark, n):
    x = noisy(n)
    found = spark.createDataFrame([(x.tolist(),)], "pcm array<double>").select(signal.snr(F.col("pcm"))).first()[0]
    assert found == pytest.approx(numpy_snr(x), abs=1e-9)


def test_silence_has_the_ceiling(spark):
    assert spark.createDataFrame([([0.0] * 3200,)], "pcm array<double>").select(signal.snr(F.col("pcm"))).first()[0] == 40.0


def test_peak_normalise(spark):
    x = [0.1, -0.4, 0.2]
    rows = [(x,), ([0.0, 1e-9],), ([],)]
    out = [r[0] for r in spark.createDataFrame(rows, "pcm array<double>").select(signal.peak_normalised(F.col("pcm"))).collect()]
    target = 10 ** (-1 / 20)
    assert out[0] == pytest.approx([v / (0.4 + 1e-7) * target for v in x])
    assert out[1:] == [[0.0, 1e-9], []]


def test_trim_and_ratio(spark):
    df = spark.createDataFrame([([float(i) for i in range(10)], [(0, 2), (5, 8)])], "pcm array<double>, s array<struct<start:int,end:int>>")
    r = df.select(signal.trimmed(F.col("pcm"), F.col("s")).alias("t"), signal.speech_ratio(F.col("s"), F.size("pcm")).alias("r")).first()
    assert r.t == [0, 1, 5, 6, 7] and r.r == 0.5


def test_voiced(spark):
    rows = [([180.0] * 20, [0.0] * 20), ([100.0] * 9, [0.9] * 9), ([100.0, 200.0] * 6, [0.5, 0.25] * 6), ([100.0, 200.0] * 10, [0.5, 0.3] * 10)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, f array<double>, c array<double>").orderBy("i")
    found = [tuple(r.v) for r in df.select(signal.voiced(F.col("f"), F.col("c")).alias("v")).collect()]
    assert found[:3] == [(0.0, 0.0)] * 3
    assert found[3] == pytest.approx((150.0, 0.4))


def test_mono(spark):
    df = spark.createDataFrame([([[1.0, 0.0], [0.0, 1.0]],)], "c array<array<double>>")
    assert df.select(signal.mono(F.col("c"))).first()[0] == [0.5, 0.5]


def test_wave_round_trip(spark):
    x = sine(0.1)
    samples, rate = decode_wav(wav_bytes(x, 8000))
    assert rate == 8000 and np.allclose(samples, x, atol=1e-4)
    rows = [(0, wav_bytes(x, RATE)), (1, b"no wave"), (2, None), (3, b""), (4, wav_bytes(x, 8000))]
    found = [r.d for r in spark.createDataFrame(rows, "i int, b binary").select("i", decoded(F.col("b")).alias("d")).orderBy("i").collect()]
    assert len(found[0].pcm) == len(x) and found[0].error is None
    assert found[1].pcm is None and found[1].error and found[2] is None and found[3].error
    assert len(found[4].pcm) == 2 * len(x)


@pytest.mark.parametrize(("rate", "to"), [(16_000, 24_000), (48_000, 16_000), (22_050, 16_000), (8_000, 16_000)])
def test_resample_keeps_a_tone(rate, to):
    x = np.sin(2 * np.pi * 300 * np.arange(rate) / rate)
    y = resample(x, rate, to)
    want = np.sin(2 * np.pi * 300 * np.arange(len(y)) / to)
    assert len(y) == to and np.abs(y - want)[1000:-1000].max() < 2e-3


def test_energy_segments():
    x = np.concatenate([np.zeros(RATE), sine(1.0), np.zeros(RATE)])
    (s,) = energy_segments(x)
    assert s == {"start": RATE, "end": 2 * RATE}
    assert energy_segments(np.zeros(RATE)) == [] and energy_segments(np.zeros(10)) == []


def test_pitch():
    found = autocorrelation_pitch(sine(0.5, 200.0))
    assert np.median(found["f0"]) == pytest.approx(200.0, rel=0.02) and np.median(found["confidence"]) > 0.9
    assert autocorrelation_pitch(np.zeros(2000))["confidence"] == [0.0] * 7


def test_masked_clips_are_not_scored(spark):
    df = spark.createDataFrame([(0, True, sine(1.0).tolist()), (1, False, sine(1.0).tolist())], "i int, alive boolean, pcm array<double>")
    found = df.select("i", speech_segments(masked(F.col("pcm"), F.col("alive"))).alias("s"), pitch_track(masked(F.col("pcm"), F.col("alive"))).alias("p")).orderBy("i").collect()
    assert len(found[0].s.value) == 1 and len(found[0].p.value.f0) > 50 and found[1].s is None and found[1].p is None


def test_audio_cascade(spark):
    from clipsieve.operators.gates import judge, reading
    from clipsieve.plans.pipeline import judge_audio, output_audio

    quiet = np.sin(np.arange(2 * RATE) * 1.7) * 1e-4
    speech = np.concatenate([quiet[: RATE // 2], sine(1.5), quiet[: RATE // 2]]) + 0
    broken = np.concatenate([sine(1.0, loud=0.5)[i : i + 400] * (1 if i % 4000 else 0.05) for i in range(0, RATE, 400)] * 2)
    rows = [("a", speech.tolist(), None), ("b", sine(0.5).tolist(), None), ("c", np.zeros(2 * RATE).tolist(), None), ("d", None, "unreadable"), ("e", broken.tolist(), None)]
    clips = spark.createDataFrame(rows, "clip_id string, pcm array<double>, load_error string")
    scored = judge_audio(clips).selectExpr("*", "cast(3 as double) dnsmos_ovr", "cast(3 as double) dnsmos_sig", "cast(3 as double) dnsmos_bak", "'сайн' truth", "'сайн' heard")
    found = {r.clip_id: r for r in judge(reading(scored, "truth", "heard")).collect()}
    assert (found["b"].reject_stage, found["c"].reject_reason, found["d"].reject_stage) == ("duration", "vad_no_speech", "load")
    assert found["b"].segments is None and found["d"].snr_db is None
    assert found["a"].reject_stage in ("", "snr") and found["a"].trimmed_s == pytest.approx(1.5, abs=0.1)
    out = output_audio(judge_audio(clips.filter("clip_id = 'a'"))).first().audio
    assert out.sampling_rate == 24_000 and max(abs(v) for v in out.array) == pytest.approx(DEFAULT.target_peak, abs=1e-4)
