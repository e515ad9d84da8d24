from __future__ import annotations

import pytest

from clipsieve import cli


def test_corpora():
    assert cli.corpora("ALL") == ["cv", "fleurs", "ws"] and cli.corpora(" ws, cv") == ["cv", "ws"]
    with pytest.raises(SystemExit):
        cli.corpora("cv,nope")


def test_main_resumes(spark, tables, tmp_path, monkeypatch):
    metrics = "snr_db float, mean_f0_hz float, pitch_confidence float, dnsmos_sig float, dnsmos_bak float, dnsmos_ovr float, dnsmos_p808 float, cer float, duration_s float, asr_transcript string"
    rows = [(i, "train", f"p{i}", "сайн байна", 20.0 if i else 1.0, 0.0, 0.0, 3.0, 3.0, 3.0, 3.0, 0.0, 5.0, "сайн байна") for i in range(3)]
    d = tables(common_voice=(rows, f"row_id long, split string, path string, sentence string, {metrics}"))
    out = str(tmp_path / "out")
    monkeypatch.chdir(tmp_path)
    first = cli.main([d, out, "--datasets", "cv"], spark)
    assert "Total input clips:                 3" in first["cv"]
    place = next((tmp_path / "out").iterdir())
    assert spark.read.parquet(str(place / "common_voice_clean" / "data")).count() == 2
    tables(common_voice=(rows[:1], f"row_id long, split string, path string, sentence string, {metrics}"))
    assert cli.main([d, out, "--datasets", "cv"], spark) == first
    assert "Total input clips:                 1" in cli.main([d, out, "--datasets", "cv", "--no-resume"], spark)["cv"]


def test_main_goes_on_in_the_middle(spark, tables, tmp_path, monkeypatch):
    """A run that stops after its verdicts leaves them; the next takes them as they are."""
    schema = "row_id long, split string, path string, sentence string, snr_db float, dnsmos_sig float, dnsmos_bak float, dnsmos_ovr float, duration_s float, asr_transcript string"
    rows = [(i, "train", f"p{i}", "сайн", 20.0, 3.0, 3.0, 3.0, 5.0, "сайн") for i in range(3)]
    d, out = tables(common_voice=(rows, schema)), str(tmp_path / "out")
    monkeypatch.chdir(tmp_path)

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(cli.sinks, "write_rejects", stop)
        cli.main([d, out, "--datasets", "cv"], spark)
    tables(common_voice=(rows[:1], schema))
    assert "Total PASSED (clean):              3" in cli.main([d, out, "--datasets", "cv"], spark)["cv"]
