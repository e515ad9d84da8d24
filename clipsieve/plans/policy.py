"""The thresholds of the quality cascade."""

from __future__ import annotations

from dataclasses import dataclass


# The cleaning policy.
@dataclass(frozen=True)
class Policy:
    version: str = "v3_pitch_diagnostic_cer_rescue"
    sample_rate: int = 16_000
    output_sample_rate: int = 24_000
    min_duration_s: float = 1.0
    max_duration_s: float = 30.0
    vad_min_speech_ratio: float = 0.25
    snr_min_db: float = 8.0
    snr_frame_s: float = 0.02
    snr_noise_floor: float = 1e-10
    snr_ceiling_db: float = 40.0
    pitch_min_conf: float = 0.25
    pitch_min_voiced: int = 10
    pitch_hop: int = 160
    pitch_fmin_hz: float = 50.0
    pitch_fmax_hz: float = 2000.0
    dnsmos_min_ovr: float = 2.2
    dnsmos_min_sig: float = 2.4
    dnsmos_min_bak: float = 2.0
    max_cer: float = 0.35
    max_rescue_cer: float = 0.50
    min_len_ratio: float = 0.40
    min_rescue_len_ratio: float = 0.75
    max_rescue_len_ratio: float = 1.25
    target_peak: float = 10 ** (-1.0 / 20.0)
    silence_peak: float = 1e-8
    peak_epsilon: float = 1e-7
    batch_size: int = 500
    logged_chars: int = 100
    shard_bytes: int = 500_000_000


DEFAULT = Policy()
