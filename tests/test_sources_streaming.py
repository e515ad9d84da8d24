from __future__ import annotations

import tarfile

import pytest
from pyspark.sql import functions as F

from clipsieve.functions.text import first_filled
from clipsieve.plans import pipeline
from clipsieve.plans.policy import DEFAULT, Policy
from clipsieve.sources import readers, sinks
from clipsieve.sources.schema import SPECS, TSV
from clipsieve.streaming import runner


@pytest.fixture
def corpus(tmp_path):
    (tmp_path / "mn" / "clips").mkdir(parents=True)
    for name in ("a.wav", "b.wav", "c.wav", "d.wav"):
        (tmp_path / "mn" / "clips" / name).write_bytes(b"x")
    head = "\t".join(TSV)
    rows = ['k1\ta.wav\t"Quoted ""x"" t"\t2\t\tteens\t\t\t\t\tmn', 'k2\tb.wav\tmid "quote\t\t1\t\t\t\t\t\tmn', "k3\tgone.wav\tx\t1\t1\t\t\t\t\t\tmn", "k4\tc.wav\tsp ace \t0\t0"]
    (tmp_path / "mn" / "validated.tsv").write_text("\n".join([head, *rows]) + "\n", encoding="utf-8")
    (tmp_path / "mn" / "dev.tsv").write_text("path\tsentence\nd.wav\tүг\n", encoding="utf-8")
    (tmp_path / "mn" / "other.tsv").write_text(head + "\n", encoding="utf-8")
    return tmp_path


def test_read_split(spark, corpus):
    rows = {r.path: r for r in readers.read_split(spark, str(corpus / "mn"), "validated").collect()}
    assert set(rows) == {"a.wav", "b.wav", "c.wav"}
    assert (rows["a.wav"].sentence, rows["a.wav"].up_votes, rows["a.wav"].down_votes, rows["a.wav"].gender) == ('Quoted "x" t', 2, 0, "")
    assert rows["b.wav"].sentence == 'mid "quote' and rows["a.wav"].audio.endswith("/mn/clips/a.wav")
    r = readers.read_split(spark, str(corpus / "mn"), "dev").first()
    assert (r.sentence, r.client_id, r.up_votes, r.split) == ("үг", "", 0, "dev")
    assert readers.read_split(spark, str(corpus / "mn"), "other").count() == 0
    assert readers.read_split(spark, str(corpus / "mn"), "test") is None


def test_extract_archive(corpus, tmp_path):
    with tarfile.open(tmp_path / "x.tar.gz", "w:gz") as tar:
        tar.add(corpus / "mn", "cv/mn")
    place = readers.extract_archive(str(tmp_path / "x.tar.gz"), str(tmp_path / "out"))
    assert place.endswith("cv/mn") and readers.extract_archive("no such file", str(tmp_path / "out")) == place


def test_settings(tmp_path, monkeypatch):
    monkeypatch.setenv("SIEVE_B", "kept")
    monkeypatch.delenv("SIEVE_A", raising=False)
    (tmp_path / ".env").write_text("# note\n\nSIEVE_A = 1=2 \nSIEVE_B=new\nnonsense\n", encoding="utf-8")
    import os

    assert readers.load_settings(str(tmp_path / ".env")) == {"SIEVE_A": "1=2", "SIEVE_B": "new"}
    assert os.environ["SIEVE_A"] == "1=2" and os.environ["SIEVE_B"] == "kept"
    assert readers.load_settings(str(tmp_path / "none")) == {}


def test_prefilter(spark):
    rows = [(8.0,), (7.999,), (None,), (float("nan"),), (0.0,), (20.0,)]
    assert [r.snr for r in readers.prefiltered(spark.createDataFrame(rows, "snr double")).collect()] == [8.0, 20.0]


def test_prefilter_reaches_the_scan(spark, tables):
    d = tables(t=([(9.0, "x")], "snr double, other string"))
    plan = readers.prefiltered(spark.read.parquet(f"{d}/t.parquet")).select("snr")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(snr,8.0)" in plan and "ReadSchema: struct<snr:double>" in plan


def test_download_url(spark):
    df = spark.createDataFrame([('{"downloadUrl": "u"}',), ("junk",)], "j string")
    assert [r[0] for r in df.select(readers.download_url(F.col("j"))).collect()] == ["u", None]


def test_reject_log(spark, tmp_path):
    rows = [("a", "cer", "r", 'say "x", y\nz'), ("b", "snr", "r", " edge "), ("c", "snr", "r", "")]
    df = spark.createDataFrame(rows, "clip_id string, stage string, reason string, ground_truth string")
    sinks.write_rejects(df, str(tmp_path / "log"))
    sinks.write_rejects(df.limit(1), str(tmp_path / "log"), resume=True)
    found = sorted(tuple(r) for r in sinks.read_rejects(spark, str(tmp_path / "log")).collect())
    assert len(found) == 4 and found[0] == rows[0] and found[2][3] == " edge " and found[3][3] in ("", None)


def test_batches_replace_themselves(spark, tmp_path):
    df = spark.createDataFrame([(i, i // 3) for i in range(9)], "i int, batch_idx int")
    sinks.write_batches(df, str(tmp_path / "b"))
    sinks.write_batches(df.filter("batch_idx = 1"), str(tmp_path / "b"))
    assert sinks.read_batches(spark, str(tmp_path / "b")).count() == 9
    assert sinks.read_batches(spark, str(tmp_path / "b"), 0).count() == 3


def clips(spark, n: int):
    rows = []
    for i in range(n):
        truth = ["сайн байна уу", "үг", "", None][i % 4]
        rows.append((i, "other" if i % 2 else "train", f"p{i}", truth, "сайн байна уу", 5.0, 20.0 if i % 5 else 1.0, 3.0, 3.0, 3.0, "someone"))
    schema = "row_id long, split string, path string, sentence string, asr_transcript string, duration_s float, snr_db float, dnsmos_ovr float, dnsmos_sig float, dnsmos_bak float, client_id string"
    df = spark.createDataFrame(rows, schema)
    return df.selectExpr("*", "cast(null as float) mean_f0_hz", "cast(null as float) pitch_confidence", "cast(3 as float) dnsmos_p808", "cast(0.1 as float) cer")


def test_clean(spark, tmp_path):
    done = pipeline.clean(clips(spark, 40), SPECS["cv"], Policy(batch_size=5))
    verdicts = {r.row_id: r for r in done.verdicts.collect()}
    assert verdicts[2].reject_reason == "empty_ground_truth" and verdicts[3].reject_reason == "empty_ground_truth" and verdicts[0].reject_stage == "snr"
    assert done.records.count() + done.rejected.count() == 40 and "Total input clips:                40" in done.report
    assert {r.split for r in done.records.select("split").distinct().collect()} == {"train", "other_clean"} - ({"other_clean"} if not any(v.passed and v.split == "other" for v in verdicts.values()) else set())
    assert max(v.batch_idx for v in verdicts.values()) == 3
    place = sinks.publish("cv", done.records, done.report, str(tmp_path))
    assert spark.read.parquet(f"{place}/data").count() == done.records.count()
    assert sinks.publish("cv", done.records.limit(0), done.report, str(tmp_path / "none")) is None


def test_stream_resumes_to_the_same_rows(spark, tmp_path):
    df = clips(spark, 40)
    source, schema = tmp_path / "in", df.schema
    source.mkdir()
    judge = lambda d: pipeline.judged(d, SPECS["cv"]).select("row_id", "passed", "reject_reason")
    parts = [df.filter(F.col("row_id") % 4 == i) for i in range(4)]
    for part in parts[:2]:
        part.coalesce(1).write.mode("append").parquet(str(source))
    place = runner.namespace(str(tmp_path), "cv", "train")
    first = runner.run(spark, str(source), schema, place, judge)
    assert first.count() == 20 and first.select("batch_idx").distinct().count() == 2
    for part in parts[2:]:
        part.coalesce(1).write.mode("append").parquet(str(source))
    resumed = runner.run(spark, str(source), schema, place, judge)
    again = runner.run(spark, str(source), schema, place, judge)
    whole = sorted(tuple(r) for r in judge(df).collect())
    for found in (resumed, again):
        assert sorted(tuple(r) for r in found.select("row_id", "passed", "reject_reason").collect()) == whole
    fresh = runner.run(spark, str(source), schema, place, judge, resume=False, files_at_once=100)
    assert fresh.select("batch_idx").distinct().count() == 1 and fresh.count() == 40
    assert "v3_pitch" in place


def test_portions_go_on_where_a_run_stopped(spark, tmp_path):
    """Judged in portions of two batches: after a failure only portions not committed before are judged again."""
    rows = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(60)], "row_id long, split string")
    spec_key, seen = "row_id", spark.sparkContext.accumulator(0)

    def judge(df, broken=False):
        @F.udf("boolean")
        def fine(i):
            seen.add(1)
            if broken and i > 30:
                raise ValueError("lost")
            return i % 3 > 0

        return df.withColumn("passed", fine.asNondeterministic()(F.col("row_id")))

    place = str(tmp_path / "run")
    with pytest.raises(Exception, match="lost"):
        pipeline.judge_in_portions(rows, spec_key, lambda df: judge(df, True), place, 5, 2)
    assert pipeline.judge_in_portions(rows, spec_key, judge, place, 5, 2, portions=0).count() == 20
    before = seen.value
    found = pipeline.judge_in_portions(rows, spec_key, judge, place, 5, 2)
    assert seen.value - before == 40
    got = sorted((r.row_id, r.split, r.idx, r.batch_idx, r.passed) for r in found.collect())
    assert got == [(i, "ab"[i % 2], i // 2, i // 10, i % 3 > 0) for i in range(60)]
    none = pipeline.judge_in_portions(rows.limit(0), spec_key, judge, str(tmp_path / "none"), 5)
    assert none.count() == 0 and {"idx", "batch_idx", "passed"} <= set(none.columns)


@pytest.fixture
def sounds(tmp_path):
    """A split of clips: speech, too short, silence, not a wave file, and one that models fail on."""
    import numpy as np

    from clipsieve.sources.waves import wav_bytes

    place = tmp_path / "mn" / "clips"
    place.mkdir(parents=True)
    t = np.arange(32_000) / 16_000
    speech = np.where((t % 0.5) < 0.42, 0.5 * np.sin(2 * np.pi * 200 * t), 0.0005 * np.sin(2 * np.pi * 3000 * t))
    for name, x in {"good": speech, "quiet": np.zeros(32_000), "short": speech[:8_000], "odd": speech * 0.8, "deaf": speech * 0.6, "harsh": speech * 0.7}.items():
        (place / f"{name}.wav").write_bytes(wav_bytes(x, 16_000))
    (place / "broken.wav").write_bytes(b"x")
    lines = ["path\tsentence"] + [f"{n}.wav\tсайн байна уу" for n in ("good", "quiet", "short", "odd", "deaf", "harsh", "broken", "gone")]
    (tmp_path / "mn" / "train.tsv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return tmp_path / "mn"


@pytest.fixture
def models():
    """Models that fail on a clip, or think little of it, by its loudness."""
    from pyspark.sql.types import StringType

    from clipsieve.operators.scorers import SEGMENTS, energy_segments, scorer

    def only_at(limit, then, other):
        def build():
            def model(x):
                return (then if round(float(abs(x).max()), 2) == limit else other)(x)

            return model

        return build

    def fail(text):
        def model(_):
            raise ValueError(text)

        return model

    def rated(score):
        return lambda _: {k: score for k in ("sig", "bak", "ovr", "p808")}

    vad, mos = only_at(0.4, fail("no model"), energy_segments), only_at(0.35, rated(1.0), rated(3.0))
    asr = only_at(0.3, fail("no words"), lambda _: "Сайн байна уу?")
    return pipeline.Models(vad=scorer(vad, SEGMENTS), mos=scorer(mos, pipeline.MOS), asr=scorer(asr, StringType()))


def test_clips_to_records(spark, sounds, models, tmp_path):
    done = pipeline.clean_clips(spark, str(sounds), models=models, place=str(tmp_path / "run"))
    found = {r.clip_id: (r.reject_stage, r.reject_reason) for r in done.verdicts.collect()}
    assert found["good.wav"] == ("", "") and found["short.wav"] == ("duration", "too_short_0.50s") and found["quiet.wav"] == ("vad", "vad_no_speech")
    assert found["odd.wav"] == ("vad", "vad_error:no model") and found["deaf.wav"] == ("cer", "whisper_error:no words")
    assert found["harsh.wav"] == ("dnsmos", "dnsmos_ovr_1.00") and found["broken.wav"][0] == "load" and "gone.wav" not in found
    (r,) = done.records.collect()
    assert (r.path, r.cer, r.audio.sampling_rate, r.dnsmos_ovr) == ("good.wav", 0.0, 24_000, 3.0)
    assert max(map(abs, r.audio.array)) == pytest.approx(DEFAULT.target_peak, abs=1e-4) and r.snr_db > 8
    place = sinks.publish("cv", done.records, done.report, str(tmp_path / "out"))
    assert spark.read.parquet(f"{place}/data").first().audio.sampling_rate == 24_000
    assert sinks.read_text(spark, f"{place}/cleaning_report_cv.txt") == done.report
    assert pipeline.clean_clips(spark, str(tmp_path / "empty")) is None


def test_clips_with_given_scores(spark, sounds):
    """Without models for quality and recognition their results come from a table."""
    scores = spark.createDataFrame([("good.wav", "сайн байна уу", 3.0)], "path string, asr_transcript string, dnsmos_ovr double")
    done = pipeline.clean_clips(spark, str(sounds), scores=scores)
    found = {r.clip_id: r.reject_stage for r in done.verdicts.collect()}
    assert found["good.wav"] == "" and found["deaf.wav"] == "cer"


def test_a_clip_that_cannot_be_prepared_is_a_crash(spark, sounds, monkeypatch):
    def broken(pcm, *_):
        return F.when(pcm.isNotNull(), F.struct(F.lit(None).cast("array<float>").alias("value"), F.lit("MemoryError: ").alias("error")))

    monkeypatch.setattr(pipeline, "resampled", broken)
    scores = spark.createDataFrame([("good.wav", "сайн байна уу")], "path string, asr_transcript string")
    done = pipeline.clean_clips(spark, str(sounds), scores=scores)
    r = done.verdicts.filter("clip_id = 'good.wav'").first()
    assert (r.passed, r.reject_stage, r.reject_reason) == (False, "crash", "MemoryError: ") and done.records.count() == 0


def test_ids(spark):
    rows = [("p", 3, 9), ("0", 3, 9), ("", 3, 9), (None, 0, 9), (None, None, 9)]
    df = spark.createDataFrame(rows, "path string, id int, at long")
    assert [r[0] for r in df.select(first_filled(F.col("path"), F.col("id"), F.col("at"))).collect()] == ["p", "0", "3", "9", "9"]


def test_shards(spark):
    df = spark.createDataFrame([(10.0, ([0.1], 24_000))], "duration_s double, audio struct<array:array<float>,sampling_rate:int>")
    assert sinks.mean_bytes(df) == 600 + 960_000 and sinks.mean_bytes(df.drop("audio")) == 600
