"""The queries of the engine, and SQL with the same results.

Clips, transcripts and scores are the tables common_voice, fleurs, worldspeech and clip_result. Samples stand in as
arrays of numbers: ``wave`` has the values of a user's events, ``wave64`` the embeddings. They exercise operators on
samples and say nothing about sound.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsieve.functions import signal, text
from clipsieve.operators import batches, gates, records, stats
from clipsieve.operators.tables import delete, scratch, spread, stored, table
from clipsieve.plans import pipeline
from clipsieve.plans.policy import DEFAULT
from clipsieve.sources import readers, sinks
from clipsieve.sources.schema import SPECS, TABLES
from clipsieve.streaming import runner

Query = Callable[[SparkSession, str], DataFrame]
P = DEFAULT
FRAME, FRAME64 = 8, 4
WAVE_RATE = 60.0

# ------------------------------------------------------------------ Spark


def _wave(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = F.sort_array(F.collect_list(F.struct("event_id", "value")))
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("clip")).agg(F.transform(ordered, lambda x: x["value"]).alias("pcm"))


def _wave64(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("clip"), F.col("embedding").cast("array<double>").alias("pcm"))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for key, spec in SPECS.items():
        rows = table(spark, sf_dir, TABLES[key])
        kept = rows.select(F.col(spec.row_key).alias("row_key"), F.col(spec.text).alias("truth"), F.col(spec.scores["asr_transcript"]).alias("heard"))
        parts.append(spread(kept).withColumn("corpus", F.lit(key)))
    return records.union_batches(*parts)


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.reading(_texts(spark, sf_dir), "truth", "heard")


def normalise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("corpus", "row_key", text.normalise(F.col("truth")).alias("norm"))


def char_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readings(spark, sf_dir).select("corpus", "row_key", F.round("reading_cer", 9).alias("cer"))


def length_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readings(spark, sf_dir).select("corpus", "row_key", F.round("reading_ratio", 9).alias("ratio"))


def _decided(df: DataFrame, chosen: list[gates.Gate], *keep: str) -> DataFrame:
    stage, reason = gates.verdict(chosen)
    return df.select(*keep, stage.isNull().alias("passed"), F.coalesce(stage, F.lit("")).alias("stage"), F.coalesce(reason, F.lit("")).alias("reason"))


def reading_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = gates.Gate("cer", F.col("norm_truth") == "", F.lit("empty_ground_truth"))
    return _decided(_readings(spark, sf_dir), [empty, *gates.reading_gates(F.col("reading_cer"), F.col("reading_ratio"))], "corpus", "row_key")


def reason_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("snr_db")
    rows = table(spark, sf_dir, "clip_result").filter(x.isNotNull() & ~F.isnan(x))
    return rows.select("result_id", *(text.fixed(x, d).alias(f"f{d}") for d in (1, 2, 3)))


def duration_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    cv = table(spark, sf_dir, "common_voice").withColumn("d", F.col("duration_s").cast("double"))
    return _decided(cv, gates.duration_gates(F.col("d")), "row_id")


def frame_rms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _wave(spark, sf_dir).select("clip", F.posexplode(signal.frame_rms(F.col("pcm"), FRAME)).alias("frame", "rms"))
    return found.select("clip", F.col("frame").cast("long").alias("frame"), F.round("rms", 6).alias("rms"))


def snr_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _wave(spark, sf_dir).select(F.lit("wave").alias("view"), "clip", signal.snr(F.col("pcm"), width=FRAME).alias("snr"))
    b = _wave64(spark, sf_dir).select(F.lit("wave64").alias("view"), "clip", signal.snr(F.col("pcm"), width=FRAME64).alias("snr"))
    return a.union(b).withColumn("snr", F.round("snr", 6))


def snr_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decided(snr_estimate(spark, sf_dir), gates.snr_gates(F.col("snr")), "view", "clip")


def peak_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _wave64(spark, sf_dir).select("clip", signal.peak_normalised(F.col("pcm")).alias("pcm"))
    return out.select("clip", F.round(signal.peak(F.col("pcm")), 6).alias("peak"), F.round(F.aggregate("pcm", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


def _segments(df: DataFrame, width: int) -> DataFrame:
    """Frames at least as loud as the mean of the loudest and the quietest."""
    rms = df.withColumn("e", signal.frame_rms(F.col("pcm"), width))
    rms = rms.withColumn("limit", (F.array_max("e") + F.array_min("e")) / 2)
    places = F.filter(F.transform("e", lambda x, i: F.when(x >= F.col("limit"), i)), lambda i: i.isNotNull())
    return rms.withColumn("segments", F.transform(places, lambda i: F.struct((i * width).alias("start"), (i * width + width).alias("end"))))


def speech_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _segments(_wave(spark, sf_dir), FRAME)
    ratio = signal.speech_ratio(F.col("segments"), F.size("pcm"))
    return found.select("clip", F.size("segments").cast("long").alias("n_segments"), F.round(ratio, 9).alias("ratio"))


def vad_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _segments(_wave(spark, sf_dir), FRAME).withColumn("trimmed", signal.trimmed(F.col("pcm"), F.col("segments")))
    return found.select("clip", F.size("trimmed").cast("long").alias("n"), F.round(F.aggregate("trimmed", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


def vad_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _segments(_wave(spark, sf_dir), FRAME)
    n = F.size("segments")
    ratio = signal.speech_ratio(F.col("segments"), F.size("pcm"))
    return _decided(found, gates.speech_gates(n, ratio, n * FRAME / F.lit(WAVE_RATE)), "clip")


def voiced_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _wave64(spark, sf_dir)
    track = signal.voiced(F.transform("pcm", lambda x: 180.0 + 100.0 * x), F.transform("pcm", lambda x: F.abs(x) * 4))
    return df.select("clip", track.alias("v")).select("clip", F.round("v.mean_f0_hz", 6).alias("mean_f0_hz"), F.round("v.pitch_confidence", 6).alias("pitch_confidence"))


def mono_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = F.array(F.col("pcm"), F.reverse("pcm"))
    out = _wave64(spark, sf_dir).select("clip", signal.mono(both).alias("pcm"))
    return out.select("clip", F.round(F.element_at("pcm", 1), 9).alias("first"), F.round(signal.peak(F.col("pcm")), 9).alias("peak"))


def mos_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    cv = table(spark, sf_dir, "common_voice").select("row_id", *(F.col(f"dnsmos_{x}").cast("double").alias(x) for x in ("ovr", "sig", "bak")))
    return _decided(cv, gates.mos_gates(F.col("ovr"), F.col("sig"), F.col("bak")), "row_id")


def metadata_prefilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.prefiltered(table(spark, sf_dir, "worldspeech")).select("ws_id", "snr")


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.all_verdicts(spark, sf_dir)


def cascade_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdicts(spark, sf_dir).select("corpus", "split", "row_key", "clip_id", "passed", "reject_stage", "reject_reason")


def passed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SPECS["cv"]
    found = pipeline.judged(table(spark, sf_dir, "common_voice"), spec).filter("passed")
    return records.build_record(found.withColumn("out_split", records.out_split(F.col("split"))), ["row_id", "out_split", *spec.extra])


def rejected_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.rejected(_verdicts(spark, sf_dir))


def _published(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    spec = SPECS[key]
    return pipeline.published(pipeline.judged(table(spark, sf_dir, TABLES[key]), spec), spec)


def promote_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir, "ws")


def typed_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir, "fleurs")


def renamed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source's own metrics under other names, so that the cascade's don't take their place."""
    back = {b: a for a, b in SPECS["ws"].renames.items()}
    source = table(spark, sf_dir, "worldspeech").withColumnsRenamed(back)
    found = pipeline.scored(source, SPECS["ws"])
    return records.measured(found.select("ws_id", "original_asr_transcript", "original_cer", "asr_transcript", "cer"))


def error_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips on which a model or the reading of a file failed, and how that ranks among the gates."""
    failed = lambda n, text: F.when(F.col("row_id") % n == 0, F.lit(text))
    errors = {"crash_error": failed(13, "out of memory"), "load_error": failed(11, "no such file"), "vad_error": failed(7, "v"), "dnsmos_error": failed(5, "d"), "asr_error": failed(3, "w")}
    return pipeline.judged(table(spark, sf_dir, "common_voice").withColumns(errors), SPECS["cv"]).select("row_id", "passed", "reject_stage", "reject_reason")


def mirrored_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written by split and read again as a mirror."""
    path = scratch(spark)
    sinks.write_records(_published(spark, sf_dir, "cv"), path)
    return readers.read_mirror(spark, path).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("sentence")).alias("chars"))


def zero_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "clip_result").select("result_id", "passed", "snr_db", "cer", "duration_s", "asr_transcript")
    return records.zero_filled(rows)


def clip_id_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "fleurs")
    return rows.select("fl_id", records.clip_id({"path", "id"}, F.col("fl_id")).alias("clip_id"))


def vote_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("up_votes") == 1, F.lit("")).when(F.col("up_votes") == 2, F.lit("x2")).otherwise(F.col("up_votes").cast("string"))
    return table(spark, sf_dir, "common_voice").select("row_id", text.votes(raw, lenient=True).alias("votes"))


def existing_files_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "clip_result").filter("corpus = 'cv'").select(F.col("clip_id").alias("path"))
    return readers.existing(table(spark, sf_dir, "common_voice").select("row_id", "path"), files)


def target_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = spark.createDataFrame([(k, name) for k, (name, _) in sinks.TARGETS.items()], "corpus string, target string")
    n = table(spark, sf_dir, "clip_result").groupBy("corpus").agg(F.count(F.lit(1)).alias("n"))
    return n.join(F.broadcast(names), "corpus")


def missing_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = table(spark, sf_dir, "common_voice").select("split")
    return records.missing_names(every, table(spark, sf_dir, "clip_result").filter("corpus = 'cv'").select("split"))


def union_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "clip_result").select("result_id", "batch_idx")
    parts = [rows.filter(F.pmod("batch_idx", F.lit(3)) == i) for i in range(3)]
    return records.union_batches(*parts).groupBy("batch_idx").agg(F.count(F.lit(1)).alias("n"))


def selected_corpora(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = text.keys(F.lit(" CV, ws"))
    return table(spark, sf_dir, "clip_result").filter(F.array_contains(chosen, F.col("corpus"))).select("result_id", "corpus")


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({x: F.round(x, 3) for x in stats.SUMS})


def funnel_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stats.funnel(_verdicts(spark, sf_dir), "corpus", "split"))


def funnel_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stats.rolled_up(_verdicts(spark, sf_dir), "corpus", "split"))


def funnel_of_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "clip_result")
    return stats.rolled_up(rows, "corpus", "split", "batch_idx").select("corpus", "split", "batch_idx", "level", "total", "passed")


def merged_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stats.merged(stats.funnel(_verdicts(spark, sf_dir), "corpus", "split"), "corpus"))


def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.stage_counts(_verdicts(spark, sf_dir), "corpus", "split")


def stage_count_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = stats.stage_map(stats.stage_counts(table(spark, sf_dir, "clip_result"), "corpus"), "corpus")
    # a map for each corpus
    every = maps.agg(F.aggregate(F.collect_list("stages"), F.create_map().cast("map<string,bigint>"), stats.merged_maps).alias("m"))
    return every.select(F.explode("m").alias("reject_stage", "n"))


def stage_count_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.other_count(table(spark, sf_dir, "clip_result").replace("snr", "pitch", "reject_stage"), "corpus")


def clean_hours_and_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.derived(stats.funnel(_verdicts(spark, sf_dir), "corpus"))
    return found.select("corpus", *(F.round(x, 6).alias(x) for x in ("pass_percent", "clean_hours", "mean_dnsmos_ovr", "mean_snr", "mean_cer")))


def report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = stats.report("cv", _verdicts(spark, sf_dir).filter("corpus = 'cv'")).split("\n")
    return spark.createDataFrame(list(enumerate(lines)), "line_no int, line string")


def batch_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = batches.with_ordinals(table(spark, sf_dir, "common_voice").select("row_id", "split"), "split", "row_id")
    return found.select("row_id", "split", "idx", "batch_idx", batches.batch_name("batch_idx").alias("batch"))


def running_passed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "clip_result").select("split", "result_id", F.coalesce("passed", F.lit(False)).alias("passed"))
    return batches.running_passed(rows, "split", "result_id")


def resume_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = batches.with_ordinals(table(spark, sf_dir, "common_voice").select("row_id", "split"), "split", "row_id")
    return batches.after_batch(found, 0).select("row_id", "split", "idx")


def latest_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("batch_idx") % 3 == 1, F.concat(F.lit("batch_x"), F.col("batch_idx").cast("string"))).otherwise(batches.batch_name("batch_idx"))
    return batches.latest_batch(table(spark, sf_dir, "clip_result").select(name.alias("name"), (F.col("batch_idx") % 2 == 0).alias("complete")))


def stream_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = f"{sf_dir}/common_voice.parquet"
    schema = spark.read.parquet(source).schema
    spec = SPECS["cv"]
    judge = lambda df: pipeline.judged(df, spec).select("split", "passed", "reject_stage", "duration_s", "dnsmos_ovr", "snr_db", "cer")
    place = runner.namespace(scratch(spark), "cv", "all")
    folder, pattern = (sf_dir, "common_voice.parquet") if Path(source).is_file() else (source, "*")
    found = runner.run(spark, folder, schema, place, judge, pattern=pattern)
    return _rounded(stats.funnel(found, "split"))


def _batch_stats(verdicts: DataFrame) -> DataFrame:
    return stats.funnel(verdicts, "split", "batch_idx")


def resumed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the batches of a run that stopped after a portion, amid the next one, and then went on."""
    spec, place = SPECS["cv"], scratch(spark)
    rows = pipeline.scored(table(spark, sf_dir, "common_voice"), spec)
    run = lambda portions: pipeline.judge_in_portions(rows, "row_id", lambda df: pipeline.decided(spread(df), spec), place, P.batch_size, 2, portions)
    half = run(1)
    half.write.parquet(f"{place}/verdicts/portion=1")  # what a job that was killed leaves: rows without a commit
    delete(spark, f"{place}/verdicts/portion=1/_SUCCESS")
    return _rounded(_batch_stats(run(None)))


def prior_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of earlier batches, of which every third lost its own and has only its records."""
    verdicts = stored(batches.with_ordinals(pipeline.judged(table(spark, sf_dir, "common_voice"), SPECS["cv"]), "split", "row_id"))
    kept = _batch_stats(verdicts.filter("batch_idx % 3 <> 2"))
    return _rounded(stats.prior(kept, verdicts.filter("passed"), "split", "batch_idx"))


def reject_log_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    sinks.write_rejects(records.rejected(_verdicts(spark, sf_dir)), path)
    return sinks.read_rejects(spark, path).groupBy("stage").agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length(F.coalesce("ground_truth", F.lit("")))).alias("chars"))


def nfc_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "common_voice").select("row_id", text.nfc(F.col("sentence")).alias("composed"))


def wav_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clipsieve.sources.audio import decoded, resampled
    from clipsieve.sources.waves import encode_wav

    sounds = _wave(spark, sf_dir).withColumn("content", encode_wav(F.col("pcm"), 16_000))
    found = sounds.withColumn("d", decoded(F.col("content")))
    return found.select("clip", F.size("d.pcm").alias("n"), F.col("d.error").alias("error"), F.size(resampled(F.col("d.pcm"))["value"]).alias("n_out"), F.round(signal.peak(F.col("d.pcm").cast("array<double>")), 4).alias("peak"))


# ------------------------------------------------------------------ SQL

_WS = r"[\s\x1c-\x1f\x85\p{Z}]"
_OUT = r"[^\x{1800}-\x{18AF}\x{0400}-\x{04FF}\p{L}\p{N}_\s\x1c-\x1f\x85\p{Z}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _norm(x: str) -> str:
    kept = f"regexp_replace(nfc_normalize({_strip(f'lower({x})')}), '{_OUT}', '', 'g')"
    return _strip(f"regexp_replace({kept}, '{_WS}+', ' ', 'g')")


def _units(x: str) -> str:
    """A text with each character replaced by a one-byte one of its own, since edit distance counts bytes."""
    return f"coalesce(list_aggregate(list_transform(range(1, length({x}) + 1), lambda i: chr(list_position(cs, substring({x}, i, 1))::INTEGER)), 'string_agg', ''), '')"


_METRIC_SQL = ", ".join("{p}" + m + " AS " + m for m in gates.METRICS)
_CLIPS = f"""
clips AS (
  SELECT 'cv' AS corpus, row_id AS row_key, coalesce(split, '') AS split, coalesce(nullif(path, ''), row_id::VARCHAR) AS clip_id, sentence AS truth, 0 AS pre, snr_db AS snr0, {_METRIC_SQL.replace("{p}", "")} FROM common_voice
  UNION ALL SELECT 'fleurs', fl_id, coalesce(split, ''), coalesce(nullif(path, ''), nullif(id, 0)::VARCHAR, fl_id::VARCHAR), raw_transcription, 0, snr_db, {_METRIC_SQL.replace("{p}", "")} FROM fleurs
  UNION ALL SELECT 'ws', ws_id, 'train', coalesce(nullif(segment_id, ''), ws_id::VARCHAR), human_transcript, 1, snr, {_METRIC_SQL.replace("{p}", "clean_")} FROM worldspeech),
normed AS (SELECT *, {_norm("coalesce(truth, '')")} AS a, {_norm("coalesce(asr_transcript, '')")} AS b FROM clips),
charset AS (SELECT *, list_distinct(list_transform(range(1, length(a || b) + 1), lambda i: substring(a || b, i, 1))) AS cs FROM normed),
readings AS (SELECT *, CASE WHEN a = '' THEN 1.0::DOUBLE ELSE levenshtein({_units("a")}, {_units("b")}) / length(a)::DOUBLE END AS rcer,
  CASE WHEN a = '' THEN 0.0::DOUBLE ELSE length(b) / length(a)::DOUBLE END AS ratio FROM charset)"""


def _case(pairs: list[tuple[str, str]], other: str = "''") -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {other} END"


def _decision(rules: list[tuple[str, str, str]]) -> str:
    """passed, stage, reason from (condition, stage, reason)."""
    stage = _case([(c, f"'{s}'") for c, s, _ in rules])
    return f"({stage}) = '' AS passed, {stage} AS stage, {_case([(c, r) for c, _, r in rules])} AS reason"


def _duration(x: str) -> list[tuple[str, str, str]]:
    return [(f"{x} < 1.0", "duration", f"printf('too_short_%.2fs', {x})"), (f"{x} > 30.0 AND NOT isnan({x})", "duration", f"printf('too_long_%.2fs', {x})")]


def _mos(prefix: str) -> list[tuple[str, str, str]]:
    limits = (("ovr", 2.2), ("sig", 2.4), ("bak", 2.0))
    return [(f"{prefix}{n}::DOUBLE < {limit}", "dnsmos", f"printf('dnsmos_{n}_%.2f', {prefix}{n}::DOUBLE)") for n, limit in limits]


_READING = [
    ("a = ''", "cer", "'empty_ground_truth'"),
    ("ratio < 0.40", "cer", "printf('truncated_ratio_%.2f', ratio)"),
    ("rcer > 0.35 AND rcer > 0.50", "cer", "printf('high_cer_%.3f', rcer)"),
    ("rcer > 0.35 AND (ratio < 0.75 OR ratio > 1.25)", "cer", "printf('uncertain_reading_cer_%.3f_ratio_%.2f', rcer, ratio)"),
]
_SNR = [("{x} < 8.0", "snr", "printf('snr_%.1fdB', {x})")]


def _snr_rules(x: str) -> list[tuple[str, str, str]]:
    return [(c.format(x=x), s, r.replace("{x}", x)) for c, s, r in _SNR]


_CASCADE = [*_duration("duration_s::DOUBLE"), *_snr_rules("snr_db::DOUBLE"), *_mos("dnsmos_"), *_READING]
# of a clip's readings only those of the cascade's last stage were made
_VERDICTS = f"""WITH {_CLIPS},
judged AS (SELECT *, {_decision(_CASCADE)} FROM readings WHERE pre = 0 OR (snr0 >= 8.0 AND NOT isnan(snr0))),
verdicts AS (SELECT * REPLACE (CASE WHEN stage IN ('', 'cer') THEN rcer END AS cer) FROM judged)"""
_FAILED = [(f"row_key % {n} = 0", stage, f"'{text}'") for n, stage, text in ((13, "crash", "out of memory"), (11, "load", "no such file"), (7, "vad", "vad_error:v"), (5, "dnsmos", "dnsmos_error:d"), (3, "cer", "whisper_error:w"))]
_WITH_ERRORS = [*_FAILED[:2], *_duration("duration_s::DOUBLE"), _FAILED[2], *_snr_rules("snr_db::DOUBLE"), _FAILED[3], *_mos("dnsmos_"), _FAILED[4], *_READING]


def _number(x: str) -> str:
    return f"CASE WHEN NOT isnan({x}) THEN {x} END"


_MEASURED = {"dnsmos_ovr": "dnsmos_ovr", "snr": "snr_db", "cer": "cer"}
_FUNNEL = "count(*) AS total, count(*) FILTER (passed) AS passed, round(coalesce(sum(duration_s::DOUBLE) FILTER (passed AND NOT isnan(duration_s)), 0), 3) AS total_duration_s, " + ", ".join(
    f"round(coalesce(sum({x}::DOUBLE) FILTER (passed AND NOT isnan({x})), 0), 3) AS sum_{m}, count({x}) FILTER (passed AND NOT isnan({x})) AS n_{m}" for m, x in _MEASURED.items()
)


def _means(scale: str = "{0}") -> str:
    return ", ".join(f"{scale.format(f'avg({x}::DOUBLE) FILTER (passed AND NOT isnan({x}))')} AS mean_{m}" for m, x in _MEASURED.items())


def _published_sql(key: str, table_name: str, prefix: str = "") -> str:
    """Records by the corpus' schema, from the verdicts and the source table."""
    fields = []
    for f in SPECS[key].output.fields:
        kind = {"float": "FLOAT", "int": "INTEGER", "string": "VARCHAR"}[f.dataType.simpleString()]
        x = "v.cer" if f.name == f"{prefix}cer" else "t.human_transcript" if f.name == "sentence" and key == "ws" else f"t.{f.name}"
        fields.append(f"CAST({_number(x) if kind == 'FLOAT' else x} AS {kind}) AS {f.name}")
    return f"{_VERDICTS} SELECT {', '.join(fields)}, CASE WHEN v.split = 'other' THEN 'other_clean' ELSE v.split END AS split FROM {table_name} t JOIN verdicts v ON v.corpus = '{key}' AND v.passed AND v.row_key = t.{SPECS[key].row_key}"


def _report_sql() -> str:
    """The lines of the report on cv, each made from the verdicts."""
    stages = "".join(f" UNION ALL SELECT {i}, '{label}' || lpad(format('{{:,}}', count(*) FILTER (NOT passed AND stage = '{stage}')), 8, ' ') FROM cv" for i, (stage, label) in enumerate(stats.STAGE_LABELS.items(), 2))
    means = "".join(
        f" UNION ALL SELECT {i}, '{label}' || lpad(coalesce(printf('%.{digits}f', avg({x}::DOUBLE) FILTER (passed AND NOT isnan({x}))), '-'), 10, ' ') || '{unit}' FROM cv HAVING count(*) FILTER (passed) > 0"
        for i, (label, x, digits, unit) in enumerate((("Average DNSMOS OVR:         ", "dnsmos_ovr", 3, ""), ("Average SNR:                ", "snr_db", 1, " dB"), ("Average CER:                ", "cer", 3, "")), 12)
    )
    return f"""{_VERDICTS}, cv AS (SELECT * FROM verdicts WHERE corpus = 'cv'),
    lines(line_no, line) AS (SELECT 0, '=== CV — Cleaning Report ===' UNION ALL SELECT 1, 'Total input clips:          ' || lpad(format('{{:,}}', count(*)), 8, ' ') FROM cv{stages}
      UNION ALL SELECT 9, repeat('─', 50)
      UNION ALL SELECT 10, 'Total PASSED (clean):       ' || lpad(format('{{:,}}', count(*) FILTER (passed)), 8, ' ') || '  (' || printf('%.1f', 100.0::DOUBLE * count(*) FILTER (passed) / greatest(count(*), 1)) || '% of input)' FROM cv
      UNION ALL SELECT 11, 'Total hours (clean):        ' || lpad(printf('%.2f', coalesce(sum(duration_s::DOUBLE) FILTER (passed AND NOT isnan(duration_s)), 0) / 3600.0::DOUBLE), 10, ' ') || ' hours' FROM cv{means})
    SELECT line_no::INTEGER AS line_no, line FROM lines"""


_WAVE = "wave AS (SELECT user_id AS clip, list(value ORDER BY event_id) AS pcm FROM events GROUP BY user_id)"
_WAVE64 = "wave64 AS (SELECT vec_id AS clip, embedding::DOUBLE[] AS pcm FROM embeddings)"


def _energies(width: int) -> str:
    return f"list_transform(range(0, len(pcm) - {width}, {width}), lambda i: sqrt(list_sum(list_transform(pcm[i + 1:i + {width}], lambda x: x * x)) / {width}))"


_SNR_SQL = f"""WITH {_WAVE}, {_WAVE64},
e AS (SELECT 'wave' AS view, clip, list_sort({_energies(FRAME)}) AS e FROM wave UNION ALL SELECT 'wave64', clip, list_sort({_energies(FRAME64)}) FROM wave64),
parts AS (SELECT *, list_avg(e[1:greatest(1, len(e) // 10)]) AS noise, list_avg(e[len(e) // 2 + 1:]) AS loud FROM e),
snrs AS (SELECT view, clip, round(CASE WHEN len(e) = 0 THEN 0.0 WHEN noise < 1e-10 THEN 40.0 ELSE 20 * log10(loud / noise + 1e-10) END, 6) AS snr FROM parts)"""
_SEGMENTS = f"""WITH {_WAVE}, es AS (SELECT clip, pcm, {_energies(FRAME)} AS e FROM wave),
seg AS (SELECT clip, pcm, list_filter(range(0, len(e)), lambda i: e[i + 1] >= (list_max(e) + list_min(e)) / 2) AS s FROM es)"""
_TRIM = f"flatten(list_transform(s, lambda i: pcm[i * {FRAME} + 1:i * {FRAME} + {FRAME}]))"
_RATIO = f"len(s) * {FRAME} / greatest(len(pcm), 1)::DOUBLE"
_TRIMMED_S = f"(len(s) * {FRAME} / {WAVE_RATE}::DOUBLE)"
_TARGET = repr(P.target_peak)


def _ordinals(name: str, key: str, extra: str = "") -> str:
    return f"SELECT {key}, coalesce(split, '') AS split, row_number() OVER (PARTITION BY coalesce(split, '') ORDER BY {key}) - 1 AS idx{extra} FROM {name}"


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            normalise_text, char_error_rate, length_ratio, reading_gate, reason_format, duration_gate, frame_rms, snr_estimate, snr_gate,
            peak_normalise, speech_ratio, vad_trim, vad_gate, voiced_mean, mono_mix, mos_gate, metadata_prefilter, cascade_verdict, passed_records,
            rejected_log, promote_fields, typed_output, zero_filled, clip_id_fallback, vote_cast, existing_files_semi, target_lookup, missing_splits,
            union_batches, selected_corpora, funnel_by_split, funnel_rollup, funnel_of_results, merged_stats, stage_counts, stage_count_merge,
            renamed_fields, error_stages, mirrored_records, resumed_batches, prior_stats, stage_count_other, clean_hours_and_means, report_text, batch_assignment, running_passed, resume_offset, latest_checkpoint,
            stream_equals_batch, reject_log_roundtrip, nfc_udf, wav_decode,
        )
    }


def oracle_sql() -> dict[str, str]:
    readings = f"WITH {_CLIPS}"
    cv_columns = ", ".join(["row_id", "CASE WHEN split = 'other' THEN 'other_clean' ELSE split END AS out_split", *SPECS["cv"].extra])
    own = ", ".join("v.cer" if m == "cer" else f"{_number(f'cv.{m}') if m != 'asr_transcript' else f'cv.{m}'} AS {m}" for m in gates.METRICS)
    passed_cv = f"{_VERDICTS} SELECT {cv_columns}, {own} FROM common_voice cv JOIN (SELECT row_key, cer FROM verdicts WHERE corpus = 'cv' AND passed) v ON v.row_key = cv.row_id"
    numbered = f"{_VERDICTS}, b AS (SELECT *, (row_number() OVER (PARTITION BY split ORDER BY row_key) - 1) // 500 AS batch FROM verdicts WHERE corpus = 'cv')"
    ws_kept = "FROM worldspeech WHERE snr >= 8.0 AND NOT isnan(snr)"
    return {
        "normalise_text": f"{readings} SELECT corpus, row_key, CASE WHEN truth IS NOT NULL THEN a END AS norm FROM normed",
        "char_error_rate": f"{readings} SELECT corpus, row_key, round(rcer, 9) AS cer FROM readings",
        "length_ratio": f"{readings} SELECT corpus, row_key, round(ratio, 9) AS ratio FROM readings",
        "reading_gate": f"{readings} SELECT corpus, row_key, {_decision(_READING)} FROM readings",
        "reason_format": "SELECT result_id, printf('%.1f', snr_db) AS f1, printf('%.2f', snr_db) AS f2, printf('%.3f', snr_db) AS f3 FROM clip_result WHERE snr_db IS NOT NULL AND NOT isnan(snr_db)",
        "duration_gate": f"SELECT row_id, {_decision(_duration('duration_s::DOUBLE'))} FROM common_voice",
        "frame_rms": f"WITH {_WAVE}, e AS (SELECT clip, {_energies(FRAME)} AS e FROM wave) SELECT clip, unnest(range(0, len(e))) AS frame, round(unnest(e), 6) AS rms FROM e",
        "snr_estimate": f"{_SNR_SQL} SELECT view, clip, snr FROM snrs",
        "snr_gate": f"{_SNR_SQL} SELECT view, clip, {_decision(_snr_rules('snr'))} FROM snrs",
        "peak_normalise": f"""WITH {_WAVE64}, p AS (SELECT clip, pcm, list_max(list_transform(pcm, lambda x: abs(x))) AS top FROM wave64),
            o AS (SELECT clip, CASE WHEN top < 1e-8 THEN pcm ELSE list_transform(pcm, lambda x: greatest(-{_TARGET}::DOUBLE, least({_TARGET}::DOUBLE, x / (top + 1e-7) * {_TARGET}::DOUBLE))) END AS pcm FROM p)
            SELECT clip, round(list_max(list_transform(pcm, lambda x: abs(x))), 6) AS peak, round(list_sum(pcm), 6) AS total FROM o""",
        "speech_ratio": f"{_SEGMENTS} SELECT clip, len(s) AS n_segments, round({_RATIO}, 9) AS ratio FROM seg",
        "vad_trim": f"{_SEGMENTS} SELECT clip, len({_TRIM}) AS n, round(coalesce(list_sum({_TRIM}), 0.0), 6) AS total FROM seg",
        "vad_gate": f"{_SEGMENTS} SELECT clip, "
        + _decision([("len(s) = 0", "vad", "'vad_no_speech'"), (f"{_RATIO} < 0.25", "vad", f"printf('speech_ratio_%.2f', {_RATIO})"), (f"{_TRIMMED_S} < 1.0", "vad", f"printf('trimmed_too_short_%.2fs', {_TRIMMED_S})")])
        + " FROM seg",
        "voiced_mean": f"""WITH {_WAVE64}, v AS (SELECT clip, list_filter(pcm, lambda x: abs(x) * 4 > 0.25) AS v FROM wave64)
            SELECT clip, round(CASE WHEN len(v) < 10 THEN 0.0 ELSE list_avg(list_transform(v, lambda x: 180.0::DOUBLE + 100.0::DOUBLE * x)) END, 6) AS mean_f0_hz,
            round(CASE WHEN len(v) < 10 THEN 0.0 ELSE list_avg(list_transform(v, lambda x: abs(x) * 4)) END, 6) AS pitch_confidence FROM v""",
        "mono_mix": f"WITH {_WAVE64}, m AS (SELECT clip, list_transform(range(1, len(pcm) + 1), lambda i: (pcm[i] + pcm[len(pcm) + 1 - i]) / 2) AS m FROM wave64) SELECT clip, round(m[1], 9) AS first, round(list_max(list_transform(m, lambda x: abs(x))), 9) AS peak FROM m",
        "mos_gate": f"SELECT row_id, {_decision(_mos('dnsmos_'))} FROM common_voice",
        "metadata_prefilter": f"SELECT ws_id, snr {ws_kept}",
        "cascade_verdict": f"{_VERDICTS} SELECT corpus, split, row_key, clip_id, passed, stage AS reject_stage, reason AS reject_reason FROM verdicts",
        "passed_records": passed_cv,
        "rejected_log": f"{_VERDICTS} SELECT clip_id, stage, reason, left(coalesce(truth, ''), 100) AS ground_truth FROM verdicts WHERE NOT passed",
        "promote_fields": _published_sql("ws", "worldspeech", "clean_"),
        "typed_output": _published_sql("fleurs", "fleurs"),
        "renamed_fields": f"SELECT ws_id, original_asr_transcript, {_number('original_cer')} AS original_cer, clean_asr_transcript AS asr_transcript, {_number('clean_cer')} AS cer {ws_kept}",
        "error_stages": f"{readings} SELECT row_key AS row_id, passed, stage AS reject_stage, reason AS reject_reason FROM (SELECT row_key, {_decision(_WITH_ERRORS)} FROM readings WHERE corpus = 'cv')",
        "mirrored_records": f"{_VERDICTS} SELECT CASE WHEN split = 'other' THEN 'other_clean' ELSE split END AS split, count(*) AS n, sum(length(truth))::BIGINT AS chars FROM verdicts WHERE corpus = 'cv' AND passed GROUP BY ALL",
        "resumed_batches": f"{numbered} SELECT split, batch::INTEGER AS batch_idx, {_FUNNEL} FROM b GROUP BY split, batch",
        "prior_stats": f"{numbered} SELECT split, batch::INTEGER AS batch_idx, {_FUNNEL} FROM b WHERE batch % 3 <> 2 OR passed GROUP BY split, batch",
        "zero_filled": "SELECT result_id, passed, CASE WHEN snr_db IS NULL OR isnan(snr_db) THEN 0 ELSE snr_db END AS snr_db, CASE WHEN cer IS NULL OR isnan(cer) THEN 0 ELSE cer END AS cer, CASE WHEN passed AND NOT isnan(duration_s) THEN coalesce(duration_s, 0) ELSE 0 END AS duration_s, coalesce(asr_transcript, '') AS asr_transcript FROM clip_result",
        "clip_id_fallback": "SELECT fl_id, CASE WHEN path <> '' THEN path WHEN id <> 0 THEN id::VARCHAR ELSE fl_id::VARCHAR END AS clip_id FROM fleurs",
        "vote_cast": "SELECT row_id, coalesce(CASE WHEN up_votes = 1 THEN 0 WHEN up_votes = 2 THEN NULL ELSE up_votes END, CASE WHEN up_votes = 2 THEN NULL ELSE 0 END)::INTEGER AS votes FROM common_voice",
        "existing_files_semi": "SELECT row_id, path FROM common_voice SEMI JOIN (SELECT clip_id AS path FROM clip_result WHERE corpus = 'cv') USING (path)",
        "target_lookup": "SELECT corpus, n, target FROM (SELECT corpus, count(*) AS n FROM clip_result GROUP BY corpus) JOIN (VALUES "
        + ", ".join(f"('{k}', '{name}')" for k, (name, _) in sinks.TARGETS.items())
        + ") t(corpus, target) USING (corpus)",
        "missing_splits": "SELECT split FROM common_voice EXCEPT SELECT split FROM clip_result WHERE corpus = 'cv'",
        "union_batches": "SELECT batch_idx, count(*) AS n FROM (SELECT * FROM clip_result WHERE batch_idx % 3 = 0 UNION ALL SELECT * FROM clip_result WHERE batch_idx % 3 = 1 UNION ALL SELECT * FROM clip_result WHERE batch_idx % 3 = 2) GROUP BY batch_idx",
        "selected_corpora": "SELECT result_id, corpus FROM clip_result WHERE corpus IN ('cv', 'ws')",
        "funnel_by_split": f"{_VERDICTS} SELECT corpus, split, {_FUNNEL} FROM verdicts GROUP BY corpus, split",
        "funnel_rollup": f"{_VERDICTS} SELECT corpus, split, grouping(corpus, split)::INTEGER AS level, {_FUNNEL} FROM verdicts GROUP BY ROLLUP (corpus, split)",
        "funnel_of_results": "SELECT corpus, split, batch_idx, grouping(corpus, split, batch_idx)::INTEGER AS level, count(*) AS total, count(*) FILTER (passed) AS passed FROM clip_result GROUP BY ROLLUP (corpus, split, batch_idx)",
        "merged_stats": f"{_VERDICTS} SELECT corpus, {_FUNNEL} FROM verdicts GROUP BY corpus",
        "stage_counts": f"{_VERDICTS} SELECT corpus, split, stage AS reject_stage, count(*) AS n FROM verdicts WHERE NOT passed GROUP BY ALL",
        "stage_count_merge": "SELECT reject_stage, count(*) AS n FROM clip_result WHERE NOT passed AND corpus IS NOT NULL GROUP BY reject_stage",
        "stage_count_other": "SELECT corpus, count(*) FILTER (NOT passed AND reject_stage = 'snr') AS n_other FROM clip_result GROUP BY corpus",
        "clean_hours_and_means": f"""{_VERDICTS} SELECT corpus, round(100.0::DOUBLE * count(*) FILTER (passed) / greatest(count(*), 1), 6) AS pass_percent,
            round(coalesce(sum(duration_s::DOUBLE) FILTER (passed AND NOT isnan(duration_s)), 0) / 3600.0::DOUBLE, 6) AS clean_hours, {_means("round({0}, 6)")} FROM verdicts GROUP BY corpus""",
        "report_text": _report_sql(),
        "batch_assignment": f"SELECT *, (idx // 500)::INTEGER AS batch_idx, 'batch_' || lpad((idx // 500)::VARCHAR, 6, '0') AS batch FROM ({_ordinals('common_voice', 'row_id')})",
        "running_passed": _ordinals("clip_result", "result_id", ", (sum((coalesce(passed, false))::BIGINT) OVER (PARTITION BY coalesce(split, '') ORDER BY result_id))::BIGINT AS passed_so_far"),
        "resume_offset": f"SELECT row_id, split, idx FROM ({_ordinals('common_voice', 'row_id')}) WHERE idx >= 500",
        "latest_checkpoint": "SELECT coalesce(max(batch_idx) FILTER (batch_idx % 3 <> 1 AND batch_idx % 2 = 0), -1)::INTEGER AS latest FROM clip_result",
        "stream_equals_batch": f"{_VERDICTS} SELECT split, {_FUNNEL} FROM verdicts WHERE corpus = 'cv' GROUP BY split",
        "reject_log_roundtrip": f"{_VERDICTS} SELECT stage, count(*) AS n, sum(length(left(coalesce(truth, ''), 100)))::BIGINT AS chars FROM verdicts WHERE NOT passed GROUP BY stage",
        "wav_decode": f"""WITH {_WAVE}, s AS (SELECT clip, pcm, greatest(1.0, list_max(list_transform(pcm, lambda x: abs(x)))) AS top FROM wave)
            SELECT clip, len(pcm)::INTEGER AS n, NULL::VARCHAR AS error, ((len(pcm) * 3 + 1) // 2)::INTEGER AS n_out,
            round(list_max(list_transform(pcm, lambda x: abs(round_even(x / top * 32767, 0)))) / 32768, 4) AS peak FROM s""",
        "nfc_udf": "SELECT row_id, nfc_normalize(sentence) AS composed FROM common_voice",
    }
