"""Fixed schemas of inputs and outputs, and what is specific to a corpus."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import ArrayType, FloatType, IntegerType, StringType, StructField, StructType

_TYPES = {"string": StringType(), "int": IntegerType(), "float": FloatType()}


def struct(fields: dict[str, str]) -> StructType:
    return StructType([StructField(name, _TYPES[kind]) for name, kind in fields.items()])


# Columns of the split files and of the published datasets.
TSV = ["client_id", "path", "sentence", "up_votes", "down_votes", "age", "gender", "accents", "variant", "segment", "locale"]
_METRICS = {m: "float" for m in ("snr_db", "mean_f0_hz", "pitch_confidence", "dnsmos_sig", "dnsmos_bak", "dnsmos_ovr", "dnsmos_p808", "cer")} | {"asr_transcript": "string", "duration_s": "float"}
COMMON_VOICE = {c: "int" if c.endswith("votes") else "string" for c in TSV} | _METRICS
FLEURS = {"id": "int", "num_samples": "int", "path": "string", "raw_transcription": "string", "transcription": "string", "gender": "int", "lang_id": "int", "language": "string", "lang_group_id": "int"} | _METRICS
WORLDSPEECH = (
    {"sentence": "string", "human_transcript": "string", "original_asr_transcript": "string", "original_cer": "float", "snr": "float"}
    | {f"dnsmos_{x}": "float" for x in ("sig", "bak", "ovr", "p808")}
    | {"duration": "float", "source": "string", "source_url": "string", "source_start_s": "float", "source_end_s": "float"}
    | {"session_date": "string", "segment_id": "string", "language": "string", "country": "string"}
    | {f"clean_{m}": kind for m, kind in _METRICS.items()}
)
AUDIO = StructType([StructField("array", ArrayType(FloatType())), StructField("sampling_rate", IntegerType())])


@dataclass(frozen=True)
class CorpusSpec:
    """Where a corpus differs: its text, copied columns, renames, prefilter, score columns and published schema."""

    key: str
    text: str
    extra: list[str]
    output: StructType
    splits: list[str]
    renames: dict[str, str] = field(default_factory=dict)
    prefilter_snr: bool = False
    #: the column that holds each metric, where scores were computed before
    scores: dict[str, str] = field(default_factory=dict)
    row_key: str = "row_id"


def _same(prefix: str = "") -> dict[str, str]:
    return {m: prefix + m for m in _METRICS}


SPECS = {
    "cv": CorpusSpec("cv", "sentence", TSV, struct(COMMON_VOICE), ["train", "dev", "test", "validated", "other"], scores=_same()),
    "fleurs": CorpusSpec("fleurs", "raw_transcription", list(FLEURS)[:9], struct(FLEURS), ["train", "validation", "test"], scores=_same(), row_key="fl_id"),
    "ws": CorpusSpec(
        "ws",
        "human_transcript",
        ["human_transcript", "snr", "duration", "source", "source_url", "source_start_s", "source_end_s", "session_date", "segment_id", "language", "country", "original_asr_transcript", "original_cer"]
        + [f"dnsmos_{x}" for x in ("sig", "bak", "ovr", "p808")],
        struct(WORLDSPEECH),
        ["train"],
        renames={"asr_transcript": "original_asr_transcript", "cer": "original_cer"},
        prefilter_snr=True,
        scores=_same("clean_"),
        row_key="ws_id",
    ),
}
#: Names of the tables that hold the corpora.
TABLES = {"cv": "common_voice", "fleurs": "fleurs", "ws": "worldspeech"}
