from __future__ import annotations

import pytest

CV = "row_id long, split string, client_id string, path string, sentence string, segment string, gender string, dnsmos_ovr float, asr_transcript string, speaker string, rank long, text string"


@pytest.fixture
def common_voice(tables):
    """Writes rows given by name as common_voice; the table has further columns whose names clash with the operators' own."""

    def write(*rows, **others):
        names = [x.strip().split(" ")[0] for x in CV.split(",")]
        filled = [tuple({"row_id": i, "speaker": "clash", "rank": 0, "text": "clash", **r}.get(n) for n in names) for i, r in enumerate(rows)]
        return tables(common_voice=(filled, CV), **others)

    return write
