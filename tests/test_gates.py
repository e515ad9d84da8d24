from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from clipsieve.operators import gates


def decide(spark, chosen, schema, rows):
    df = spark.createDataFrame(rows, schema)
    stage, reason = gates.verdict(chosen)
    return [(r.ok, r.reason) for r in df.select(stage.isNull().alias("ok"), F.coalesce(reason, F.lit("")).alias("reason")).collect()]


READING = [
    (0.46, 0.98, True, ""),
    (0.46, 0.52, False, "uncertain_reading_cer_0.460_ratio_0.52"),
    (0.57, 1.01, False, "high_cer_0.570"),
    (0.50, 0.75, True, ""),
    (0.50, 1.25, True, ""),
    (0.46, 1.40, False, "uncertain_reading_cer_0.460_ratio_1.40"),
    (0.00, 0.39, False, "truncated_ratio_0.39"),
    (0.35, 3.0, True, ""),
    (0.40, 0.40, False, "uncertain_reading_cer_0.400_ratio_0.40"),
    (0.501, 1.0, False, "high_cer_0.501"),
    (0.9, 0.1, False, "truncated_ratio_0.10"),
]


def test_reading_gate(spark):
    chosen = gates.reading_gates(F.col("cer"), F.col("ratio"))
    assert decide(spark, chosen, "cer double, ratio double", [x[:2] for x in READING]) == [x[2:] for x in READING]


def test_duration_gate(spark):
    rows = [(1.0,), (30.0,), (0.99,), (30.01,), (math.nan,), (None,)]
    found = decide(spark, gates.duration_gates(F.col("d")), "d double", rows)
    assert found == [(True, ""), (True, ""), (False, "too_short_0.99s"), (False, "too_long_30.01s"), (True, ""), (True, "")]


def test_speech_gate(spark):
    rows = [(0, 0.0, 0.0), (1, 0.25, 1.0), (1, 0.24, 1.0), (1, 0.9, 0.99), (None, None, None)]
    found = decide(spark, gates.speech_gates(F.col("n"), F.col("r"), F.col("t")), "n int, r double, t double", rows)
    assert [x[1] for x in found] == ["vad_no_speech", "", "speech_ratio_0.24", "trimmed_too_short_0.99s", ""]


def test_snr_gate(spark):
    found = decide(spark, gates.snr_gates(F.col("x")), "x double", [(8.0,), (7.94,), (math.nan,), (None,)])
    assert [x[1] for x in found] == ["", "snr_7.9dB", "", ""]


def test_mos_gate_order(spark):
    rows = [(2.1, 2.3, 1.9), (2.2, 2.4, 2.0), (2.2, 2.3, 1.9), (2.2, 2.4, 1.99), (math.nan, 2.4, 2.0)]
    found = decide(spark, gates.mos_gates(F.col("o"), F.col("s"), F.col("b")), "o double, s double, b double", rows)
    assert [x[1] for x in found] == ["dnsmos_ovr_2.10", "", "dnsmos_sig_2.30", "dnsmos_bak_1.99", ""]


@pytest.mark.parametrize(("row", "stage", "reason"), [
    ((None, 5.0, 9.0, 3.0, 3.0, 3.0, "ab", 0.0, 1.0), "", ""),
    (("boom", 0.1, 9.0, 3.0, 3.0, 3.0, "ab", 0.0, 1.0), "load", "boom"),
    ((None, 0.5, 1.0, 3.0, 3.0, 3.0, "ab", 0.0, 1.0), "duration", "too_short_0.50s"),
    ((None, 5.0, 1.0, 1.0, 3.0, 3.0, "ab", 0.0, 1.0), "snr", "snr_1.0dB"),
    ((None, 5.0, 9.0, 1.0, 3.0, 3.0, "", 1.0, 0.0), "dnsmos", "dnsmos_ovr_1.00"),
    ((None, 5.0, 9.0, 3.0, 3.0, 3.0, "", 1.0, 0.0), "cer", "empty_ground_truth"),
    ((None, 5.0, None, None, None, None, "ab", 0.6, 1.0), "cer", "high_cer_0.600"),
])
def test_first_failing_gate_decides(spark, row, stage, reason):
    schema = "load_error string, duration_s float, snr_db float, dnsmos_ovr float, dnsmos_sig float, dnsmos_bak float, norm_truth string, reading_cer double, reading_ratio double"
    r = gates.judge(spark.createDataFrame([row], schema)).first()
    assert (r.passed, r.reject_stage, r.reject_reason) == (stage == "", stage, reason)


def test_error_stages_keep_their_prefix(spark):
    schema = "duration_s float, vad_error string, snr_db float, dnsmos_error string, dnsmos_ovr float, dnsmos_sig float, dnsmos_bak float, asr_error string, norm_truth string, reading_cer double, reading_ratio double, crash_error string"
    rows = [(5.0, "v", 9.0, None, 3.0, 3.0, 3.0, None, "a", 0.0, 1.0, None), (5.0, None, 9.0, "d", 3.0, 3.0, 3.0, None, "a", 0.0, 1.0, None), (5.0, None, 9.0, None, 3.0, 3.0, 3.0, "w", "a", 0.0, 1.0, None), (0.1, None, 9.0, None, 3.0, 3.0, 3.0, None, "a", 0.0, 1.0, "c")]
    found = gates.judge(spark.createDataFrame(rows, schema)).select("reject_stage", "reject_reason").collect()
    assert [tuple(r) for r in found] == [("vad", "vad_error:v"), ("dnsmos", "dnsmos_error:d"), ("cer", "whisper_error:w"), ("crash", "c")]


def test_empty_table(spark):
    schema = "duration_s float, snr_db float, dnsmos_ovr float, dnsmos_sig float, dnsmos_bak float, norm_truth string, reading_cer double, reading_ratio double"
    assert gates.judge(spark.createDataFrame([], schema)).count() == 0
