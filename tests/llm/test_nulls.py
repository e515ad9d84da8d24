"""Rows without any value, and repeated rows, in the tables of all queries."""

from __future__ import annotations

import pytest

from clipsieve.llm.queries import oracle_sql, queries

METRICS = "snr_db double, mean_f0_hz double, pitch_confidence double, dnsmos_sig double, dnsmos_bak double, dnsmos_ovr double, dnsmos_p808 double, cer double, duration_s double, asr_transcript string"
SCHEMAS = {
    "common_voice": "row_id long, split string, client_id string, path string, sentence string, gender string, segment string, " + METRICS,
    "worldspeech": "ws_id long, segment_id string, source string, human_transcript string, clean_dnsmos_ovr float",
    "fleurs": "fl_id long, raw_transcription string",
    "clip_result": "result_id long, corpus string, split string, scored_at timestamp, passed boolean, reject_stage string, " + METRICS,
    "documents": "doc_id long, text string",
    "doc_subject_labels": "label_id long, doc_id long, subject string, annotator string",
    "subject_area": "subject string, title string",
}
SAMPLES = {"string": "үг", "long": 7, "double": 2.5, "float": 2.5, "boolean": True}


@pytest.mark.parametrize("rows", ["null", "null and filled", "repeated"])
@pytest.mark.parametrize("name", list(queries()))
def test_runs(spark, tables, name, rows):
    made = {}
    for t, schema in SCHEMAS.items():
        kinds = [c.strip().split(" ")[1] for c in schema.split(",")]
        none, some = tuple(None for _ in kinds), tuple(SAMPLES.get(k) for k in kinds)
        made[t] = ({"null": [none] * 3, "null and filled": [none, some, none], "repeated": [some] * 3}[rows], schema)
    queries()[name](spark, tables(**made)).collect()


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries())
