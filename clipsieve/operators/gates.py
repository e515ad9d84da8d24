"""The quality cascade. A gate is data: a stage, a condition to reject, and the reason; the first that applies decides.

Conditions on floors are written as "reject if below": a score that was not measured (null) or is not a number passes,
as a comparison with it is false. Conditions on ceilings exclude NaN for the same reason, since NaN is above everything
here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsieve.functions.text import cer, fixed, length_ratio, normalise
from clipsieve.plans.policy import DEFAULT, Policy

#: The metrics of a verdict, in their order.
METRICS = ["snr_db", "mean_f0_hz", "pitch_confidence", "dnsmos_sig", "dnsmos_bak", "dnsmos_ovr", "dnsmos_p808", "cer", "asr_transcript", "duration_s"]


@dataclass(frozen=True)
class Gate:
    stage: str
    rejects: Column
    reason: Column


def above(x: Column, limit: float) -> Column:
    """Greater, but not for NaN."""
    return (x > limit) & ~F.isnan(x)


def error_gate(stage: str, error: Column, prefix: str = "") -> Gate:
    return Gate(stage, error.isNotNull(), F.concat(F.lit(prefix), error))


def duration_gates(seconds: Column, policy: Policy = DEFAULT) -> list[Gate]:
    def reason(word: str) -> Column:
        return F.concat(F.lit(f"{word}_"), fixed(seconds, 2), F.lit("s"))

    return [Gate("duration", seconds < policy.min_duration_s, reason("too_short")), Gate("duration", above(seconds, policy.max_duration_s), reason("too_long"))]


def speech_gates(n_segments: Column, ratio: Column, trimmed_s: Column, policy: Policy = DEFAULT) -> list[Gate]:
    return [
        Gate("vad", n_segments == 0, F.lit("vad_no_speech")),
        Gate("vad", ratio < policy.vad_min_speech_ratio, F.concat(F.lit("speech_ratio_"), fixed(ratio, 2))),
        Gate("vad", trimmed_s < policy.min_duration_s, F.concat(F.lit("trimmed_too_short_"), fixed(trimmed_s, 2), F.lit("s"))),
    ]


def snr_gates(snr: Column, policy: Policy = DEFAULT) -> list[Gate]:
    return [Gate("snr", snr < policy.snr_min_db, F.concat(F.lit("snr_"), fixed(snr, 1), F.lit("dB")))]


def mos_gates(ovr: Column, sig: Column, bak: Column, policy: Policy = DEFAULT) -> list[Gate]:
    limits = [("ovr", ovr, policy.dnsmos_min_ovr), ("sig", sig, policy.dnsmos_min_sig), ("bak", bak, policy.dnsmos_min_bak)]
    return [Gate("dnsmos", x < limit, F.concat(F.lit(f"dnsmos_{name}_"), fixed(x, 2))) for name, x, limit in limits]


def reading_gates(error_rate: Column, ratio: Column, policy: Policy = DEFAULT) -> list[Gate]:
    """Truncated; else clear enough; else too many errors; else, of a near miss, the length must agree."""
    misread = above(error_rate, policy.max_cer)
    off = (ratio < policy.min_rescue_len_ratio) | (ratio > policy.max_rescue_len_ratio)
    both = F.concat(F.lit("uncertain_reading_cer_"), fixed(error_rate, 3), F.lit("_ratio_"), fixed(ratio, 2))
    return [
        Gate("cer", ratio < policy.min_len_ratio, F.concat(F.lit("truncated_ratio_"), fixed(ratio, 2))),
        Gate("cer", misread & above(error_rate, policy.max_rescue_cer), F.concat(F.lit("high_cer_"), fixed(error_rate, 3))),
        Gate("cer", misread & off, both),
    ]


def verdict(gates: list[Gate]) -> tuple[Column, Column]:
    """(stage, reason) of the first gate that rejects; null if none does."""
    stage = F.coalesce(*(F.when(g.rejects, F.lit(g.stage)) for g in gates))
    reason = F.coalesce(*(F.when(g.rejects, g.reason) for g in gates))
    return stage, reason


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that are computed once for each row, whatever is read from them.

    As the output of a generator of one row, they can't be merged into the conditions and projections above, where each
    mention would compute them again.
    """
    return df.select("*", F.inline(F.array(F.struct(*(x.alias(name) for name, x in columns.items())))))


def reading(df: DataFrame, truth: str, heard: str) -> DataFrame:
    """Adds norm_truth, norm_heard, reading_cer and reading_ratio. Null texts count as empty."""
    texts = computed(df, {"norm_truth": normalise(F.coalesce(F.col(truth), F.lit(""))), "norm_heard": normalise(F.coalesce(F.col(heard), F.lit("")))})
    a, b = F.col("norm_truth"), F.col("norm_heard")
    return computed(texts, {"reading_cer": cer(a, b), "reading_ratio": F.when(a == "", F.lit(0.0)).otherwise(length_ratio(a, b))})


def judge(df: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Judges clips whose scores are columns: duration_s, snr_db, dnsmos_*, norm_truth, reading_cer, reading_ratio.

    Optional columns: load_error, vad_error, n_segments, speech_ratio, trimmed_s, dnsmos_error, asr_error, crash_error.
    Adds passed, reject_stage and reject_reason ('' if passed).
    """
    has = set(df.columns)
    c = F.col
    gates: list[Gate] = []
    if "crash_error" in has:
        gates.append(error_gate("crash", c("crash_error")))
    if "load_error" in has:
        gates.append(error_gate("load", c("load_error")))
    gates += duration_gates(c("duration_s").cast("double"), policy)
    if "vad_error" in has:
        gates.append(error_gate("vad", c("vad_error"), "vad_error:"))
    if {"n_segments", "speech_ratio", "trimmed_s"} <= has:
        gates += speech_gates(c("n_segments"), c("speech_ratio"), c("trimmed_s"), policy)
    gates += snr_gates(c("snr_db").cast("double"), policy)
    if "dnsmos_error" in has:
        gates.append(error_gate("dnsmos", c("dnsmos_error"), "dnsmos_error:"))
    gates += mos_gates(c("dnsmos_ovr").cast("double"), c("dnsmos_sig").cast("double"), c("dnsmos_bak").cast("double"), policy)
    if "asr_error" in has:
        gates.append(error_gate("cer", c("asr_error"), "whisper_error:"))
    gates.append(Gate("cer", c("norm_truth") == "", F.lit("empty_ground_truth")))
    gates += reading_gates(c("reading_cer"), c("reading_ratio"), policy)
    stage, reason = verdict(gates)
    return df.withColumns({"passed": stage.isNull(), "reject_stage": F.coalesce(stage, F.lit("")), "reject_reason": F.coalesce(reason, F.lit(""))})
