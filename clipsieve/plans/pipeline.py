"""The cleaning of a corpus: rows to verdicts in resumable portions, then records, rejects and statistics from those."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from clipsieve.functions import signal
from clipsieve.operators import gates, records, scorers, stats
from clipsieve.operators.batches import with_ordinals
from clipsieve.operators.tables import delete, exists, scratch, spread, table
from clipsieve.plans.policy import DEFAULT, Policy
from clipsieve.sources.audio import loaded, resampled
from clipsieve.sources.readers import prefiltered, read_split
from clipsieve.sources.schema import AUDIO, SPECS, TABLES, CorpusSpec

#: Batches judged by one job: a run that stops loses the work of so many at most.
AT_ONCE = 2000
#: The scores of a model of perceptual quality, by name.
MOS = StructType([StructField(x, DoubleType()) for x in ("sig", "bak", "ovr", "p808")])

Judge = Callable[[DataFrame], DataFrame]


@dataclass
class Cleaned:
    """verdicts: all judged clips, stored once, so that no scorer runs again for what is read from them."""

    verdicts: DataFrame
    records: DataFrame
    rejected: DataFrame
    funnel: DataFrame
    report: str


@dataclass(frozen=True)
class Models:
    """Scorers of samples, see ``operators.scorers``: struct<value, error> for each. Without ``mos`` and ``asr`` their
    results are columns of the rows, or null."""

    vad: Callable[[Column], Column] = scorers.speech_segments
    pitch: Callable[[Column], Column] = scorers.pitch_track
    mos: Callable[[Column], Column] | None = None
    asr: Callable[[Column], Column] | None = None


def scored(rows: DataFrame, spec: CorpusSpec, policy: Policy = DEFAULT) -> DataFrame:
    """The rows of a corpus whose scores are columns, under the names of the cascade.

    The corpus' renames come first, so its own metrics keep their names; a column that a score would take is called
    ``source_`` and its name.
    """
    kept = prefiltered(rows, policy) if spec.prefilter_snr else rows
    kept = kept.withColumnsRenamed({a: b for a, b in spec.renames.items() if a in kept.columns and b not in kept.columns})
    fresh = {m: c for m, c in spec.scores.items() if m != c}
    clash = [m for m in fresh if m in kept.columns]
    kept = kept.withColumnsRenamed({m: f"source_{m}" for m in clash}).withColumnsRenamed({c: m for m, c in fresh.items()})
    return kept.withColumn("ground_truth", F.col(spec.text))


def decided(scores: DataFrame, spec: CorpusSpec, policy: Policy = DEFAULT) -> DataFrame:
    """Verdicts on rows with scores and ground_truth: corpus, split, clip_id and all columns.

    ``cer`` is the error rate that decided, null for clips that didn't come to the reading; a given one isn't used.
    """
    found = gates.judge(gates.reading(scores, "ground_truth", "asr_transcript"), policy)
    own = F.col("segment_id") if "segment_id" in found.columns else None
    ordinal = F.col(spec.row_key)
    clip = records.first_filled(own, ordinal) if own is not None else records.clip_id({"path", "id"} & set(found.columns), ordinal)
    split = F.col("split") if "split" in found.columns else F.lit(spec.splits[0])
    read = F.when(F.col("passed") | (F.col("reject_stage") == "cer"), F.col("reading_cer"))
    return found.withColumns({"corpus": F.lit(spec.key), "split": F.coalesce(split, F.lit("")), "clip_id": clip, "cer": read})


def judged(rows: DataFrame, spec: CorpusSpec, policy: Policy = DEFAULT) -> DataFrame:
    """Verdicts on the rows of a corpus whose scores are columns."""
    return decided(spread(scored(rows, spec, policy)), spec, policy)


def judge_in_portions(rows: DataFrame, key: str, judge: Judge, place: str, size: int, at_once: int = AT_ONCE, portions: int | None = None) -> DataFrame:
    """All verdicts on ``rows`` (with split), with idx and batch_idx: batches of ``size`` rows of a split by ``key``.

    Portions of ``at_once`` batches are judged one after the other, each by one job into a folder of its own, which
    counts once the job has committed it. A later call for the same place goes on after the committed ones, with the
    rows as they were numbered first; a portion that a stopped run left half done is written anew. ``portions`` ends
    the call after so many.
    """
    spark, whole = rows.sparkSession, f"{place}/input"
    if not exists(spark, f"{whole}/_SUCCESS"):
        delete(spark, place)
        numbered = with_ordinals(rows, "split", key, size).withColumn("_portion", F.floor(F.col("batch_idx") / at_once).cast("int"))
        numbered.write.mode("overwrite").partitionBy("_portion").parquet(whole)
    if not exists(spark, f"{whole}/_portion=0"):  # no rows
        return judge(rows.withColumns({"idx": F.lit(0).cast("long"), "batch_idx": F.lit(0)}).limit(0))
    numbered = spark.read.parquet(whole)
    last, done = numbered.agg(F.max("_portion")).first()[0], []
    for i in range(last + 1):
        out = f"{place}/verdicts/portion={i}"
        if not exists(spark, f"{out}/_SUCCESS"):
            if portions == 0:
                break
            judge(numbered.filter(F.col("_portion") == i).drop("_portion")).write.mode("overwrite").parquet(out)
            portions = None if portions is None else portions - 1
        done.append(out)
    return spark.read.parquet(*done) if done else judge(numbered.limit(0).drop("_portion"))


def published(verdicts: DataFrame, spec: CorpusSpec) -> DataFrame:
    """The records of passed clips with the corpus' schema, and their audio if it was prepared."""
    out = verdicts.filter("passed")
    if spec.prefilter_snr:
        back = {f"source_{m}": m for m in spec.scores if f"source_{m}" in out.columns}
        fresh = {m: f"_fresh_{m}" for m in spec.scores}
        out = records.promote(out.withColumnsRenamed(fresh).withColumnsRenamed(back), fresh)
    sound = [StructField("audio", AUDIO)] if "audio" in out.columns and dict(out.dtypes)["audio"].startswith("struct") else []
    schema = StructType([*sound, *spec.output.fields, StructField("split", StringType())])
    return records.typed(out.withColumn("split", records.out_split(F.col("split"))), schema)


def _cleaned(verdicts: DataFrame, spec: CorpusSpec, policy: Policy) -> Cleaned:
    return Cleaned(verdicts, published(verdicts, spec), records.rejected(verdicts, policy), stats.rolled_up(verdicts, "corpus", "split", "batch_idx"), stats.report(spec.key, verdicts))


def clean(rows: DataFrame, spec: CorpusSpec, policy: Policy = DEFAULT, place: str | None = None, at_once: int = AT_ONCE) -> Cleaned:
    """Cleans rows whose scores are columns. Verdicts lie in ``place``, from where a stopped run goes on."""
    kept = scored(rows, spec, policy)
    split = F.col("split") if "split" in kept.columns else F.lit(spec.splits[0])
    kept = kept.withColumn("split", split)
    place = place or scratch(rows.sparkSession)
    return _cleaned(judge_in_portions(kept, spec.row_key, lambda df: decided(spread(df), spec, policy), place, policy.batch_size, at_once), spec, policy)


def clean_clips(spark: SparkSession, lang_dir: str, spec: CorpusSpec = SPECS["cv"], models: Models | None = None, policy: Policy = DEFAULT, place: str | None = None, at_once: int = 20, scores: DataFrame | None = None) -> Cleaned | None:
    """Cleans split files with their clips, up to records with audio; None if no split file has a row.

    ``scores`` (path and any of the metrics and asr_transcript) stands in for models that aren't given. Samples aren't
    shuffled: rows carry the clip's place, and a worker reads it when it judges the row.
    """
    found = [x for x in (read_split(spark, lang_dir, s) for s in spec.splits) if x is not None]
    if not found:
        return None
    rows = records.union_batches(*found).withColumn("ground_truth", F.col(spec.text))
    if scores is not None:
        rows = rows.join(scores, "path", "left")
    by_path, use = replace(spec, row_key="path"), models or Models()
    place = place or scratch(spark)
    verdicts = judge_in_portions(rows, "path", lambda df: judge_clips(df, by_path, use, policy), place, policy.batch_size, at_once)
    return _cleaned(verdicts, by_path, policy)


def judge_clips(rows: DataFrame, spec: CorpusSpec, models: Models, policy: Policy = DEFAULT) -> DataFrame:
    """Verdicts on rows with a clip's place (audio), and the published samples of those that pass (audio).

    A clip whose samples can't be prepared is a crash.
    """
    c = F.col
    heard = judge_audio(loaded(spread(rows), "audio"), policy, models)
    for name in (*gates.METRICS, "asr_transcript"):
        if name not in heard.columns:
            heard = heard.withColumn(name, F.lit(None).cast("string" if name == "asr_transcript" else "double"))
    alive = c("good_speech") & ~F.coalesce(c("snr_db") < policy.snr_min_db, F.lit(False))
    if models.mos:
        heard = heard.withColumn("_mos", models.mos(scorers.masked(c("trimmed"), alive)))
        heard = heard.withColumns({f"dnsmos_{x}": c(f"_mos.value.{x}") for x in ("sig", "bak", "ovr", "p808")} | {"dnsmos_error": c("_mos.error")}).drop("_mos")
        below = [c(f"dnsmos_{x}") < limit for x, limit in (("ovr", policy.dnsmos_min_ovr), ("sig", policy.dnsmos_min_sig), ("bak", policy.dnsmos_min_bak))]
        alive = alive & c("dnsmos_error").isNull() & ~F.coalesce(F.greatest(*below), F.lit(False))
    if models.asr:
        heard = heard.withColumn("_asr", models.asr(scorers.masked(c("trimmed"), alive)))
        heard = heard.withColumns({"asr_transcript": c("_asr.value"), "asr_error": c("_asr.error")}).drop("_asr")
    found = decided(heard, spec, policy)
    found = found.withColumn("_out", resampled(scorers.masked(c("trimmed"), c("passed")), policy.sample_rate, policy.output_sample_rate))
    found = gates.computed(found, {"_samples": c("_out.value").cast("array<double>")})
    broken = c("passed") & c("_out.error").isNotNull()
    found = found.withColumns({
        "audio": F.when(c("passed") & ~broken, F.struct(_published_peak(c("_samples"), policy).alias("array"), F.lit(policy.output_sample_rate).alias("sampling_rate"))),
        "reject_stage": F.when(broken, F.lit("crash")).otherwise(c("reject_stage")),
        "reject_reason": F.when(broken, c("_out.error")).otherwise(c("reject_reason")),
        "passed": c("passed") & ~broken,
    })
    return found.drop("_out", "_samples", "pcm", "trimmed", "segments", "good_speech", "norm_truth", "norm_heard")


def judge_audio(clips: DataFrame, policy: Policy = DEFAULT, models: Models | None = None) -> DataFrame:
    """Adds what samples (pcm, load_error) alone decide: duration, speech segments, trimmed samples, SNR, pitch.

    Each step gets only clips that are alive, so nothing is computed for a rejected clip. Pitch that can't be told is
    null; it never rejects.
    """
    c, use = F.col, models or Models()
    rate = policy.sample_rate
    timed = clips.withColumn("duration_s", F.size("pcm") / F.lit(rate))
    alive = c("load_error").isNull() & (c("duration_s") >= policy.min_duration_s) & (c("duration_s") <= policy.max_duration_s)
    heard = timed.withColumn("_vad", use.vad(scorers.masked(c("pcm"), alive)))
    heard = heard.withColumns({"segments": c("_vad.value"), "vad_error": c("_vad.error")}).drop("_vad")
    some = c("segments").isNotNull()
    cut = gates.computed(heard, {"n_segments": F.when(some, F.size("segments")), "speech_ratio": F.when(some, signal.speech_ratio(c("segments"), F.size("pcm"))), "trimmed": signal.trimmed(c("pcm"), c("segments"))})
    cut = cut.withColumn("trimmed_s", F.when(some, F.size("trimmed") / F.lit(rate)))
    good = (c("n_segments") > 0) & (c("speech_ratio") >= policy.vad_min_speech_ratio) & (c("trimmed_s") >= policy.min_duration_s)
    cut = cut.withColumn("good_speech", F.coalesce(good, F.lit(False)))
    width = int(policy.snr_frame_s * rate)
    loud = gates.computed(cut, {"_energies": F.when(c("good_speech"), F.array_sort(signal.frame_rms(c("trimmed"), width)))})
    with_snr = gates.computed(loud, {"snr_db": F.when(c("good_speech"), signal.snr_of_energies(c("_energies"), policy))}).drop("_energies")
    track = use.pitch(scorers.masked(c("trimmed"), c("good_speech") & ~(c("snr_db") < policy.snr_min_db)))
    pitched = with_snr.withColumn("track", track["value"]).withColumn("_pitch", F.when(c("track").isNotNull(), signal.voiced(c("track.f0"), c("track.confidence"), policy)))
    return pitched.withColumns({"mean_f0_hz": c("_pitch.mean_f0_hz"), "pitch_confidence": c("_pitch.pitch_confidence")}).drop("track", "_pitch")


def _published_peak(samples: Column, policy: Policy) -> Column:
    return signal.peak_normalised(samples, policy).cast("array<float>")


def output_audio(df: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """The published samples: trimmed, at the output rate, with the peak normalised."""
    at_rate = resampled(F.col("trimmed"), policy.sample_rate, policy.output_sample_rate)["value"]
    both = gates.computed(df, {"_out": at_rate.cast("array<double>")}).withColumn("_out", _published_peak(F.col("_out"), policy))
    return both.withColumn("audio", F.struct(F.col("_out").alias("array"), F.lit(policy.output_sample_rate).alias("sampling_rate"))).drop("_out")


def all_verdicts(spark: SparkSession, sf_dir: str, policy: Policy = DEFAULT) -> DataFrame:
    """Verdicts on the three corpora, by one code path: corpus, split, clip_id, row_key, ground_truth, verdict and metrics."""
    parts = []
    for key, spec in SPECS.items():
        found = judged(table(spark, sf_dir, TABLES[key]), spec, policy)
        metrics = [F.col(m) for m in gates.METRICS]
        parts.append(found.select("corpus", "split", "clip_id", F.col(spec.row_key).alias("row_key"), "ground_truth", "passed", "reject_stage", "reject_reason", *metrics, "reading_cer", "reading_ratio"))
    return records.union_batches(*parts)
