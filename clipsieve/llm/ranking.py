"""Ranks, percentiles, caps and cutoffs over very large, skewed columns (problems 2 to 5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipsieve.llm.base import Sorted, free, key_of, small, stored, table

METRICS = ["snr_db", "cer", "duration_s"]
PERCENTS = [1, 5, 10, 25, 50, 75, 90, 95, 99]
EPSILON = 0.001
#: Rows of a contributor that are ranked in one task before all of its rows are.
SALT_ROWS = 200_000

# The stages at which a clip already has the metric, besides clips that passed.
MEASURED_AT = {
    "snr_db": ["snr", "pitch", "dnsmos", "cer"],
    "pitch_confidence": ["pitch", "dnsmos", "cer"],
    "dnsmos_ovr": ["dnsmos", "cer"],
    "cer": ["cer"],
    "duration_s": [],
}
SCORES = [("snr_db", False), ("dnsmos_ovr", False), ("cer", True), ("pitch_confidence", False)]


def measured(metric: str) -> Column:
    """The metric where it was measured: null for null and NaN, and for the 0.0 of a clip that never reached the stage."""
    x = F.col(metric).cast("double")
    reached = F.coalesce(F.col("passed"), F.lit(False)) | F.coalesce(F.col("reject_stage").isin(MEASURED_AT[metric]), F.lit(False))
    return F.when(x.isNotNull() & ~F.isnan(x) & ((x != 0.0) | reached), F.when(x == 0.0, F.lit(0.0)).otherwise(x))


def _long(rows: DataFrame, group: list[str], metrics: list[str]) -> DataFrame:
    pairs = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), measured(m).alias("value")) for m in metrics)))
    return rows.select(*group, pairs.alias("_x")).select(*group, "_x.metric", "_x.value").filter("value is not null")


# ---------------------------------------------------------------- problem 2


def counted(values: DataFrame, group: list[str]) -> DataFrame:
    """The rows of each value: equal values of a group are one row with its count (c), made before anything is sorted."""
    return values.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("c"))


def _placed(counts: DataFrame, group: list[str], weight: str) -> tuple[DataFrame, DataFrame]:
    """The values with the rows up to and with them (_upto), in one distributed sort, and each group's rows (n)."""
    ordered = Sorted(counts.select(*group, "value", weight), group, [F.col("value")])
    totals = ordered.rows.groupBy(*group).agg(F.sum(weight).alias("n"))
    return ordered.running(weight, "_upto"), totals


def percentiles(values: DataFrame, group: list[str], percents: list[int]) -> DataFrame:
    """Exact percentiles of ``value`` in each group: one distributed sort, with the counts of each group in each partition.

    Equal values are counted first, so a value that half of the rows share is one row of the sort. From the counts
    follow the group's offsets and the places of the order statistics next to each target position
    (n - 1) * p / 100; they are interpolated linearly. Group keys must not be null. Groups without values have no row.
    """
    placed, totals = _placed(counted(values, group), group, "c")
    wanted = totals.withColumn("percent", F.explode(F.array(*(F.lit(p) for p in percents))))
    wanted = wanted.withColumn("_low", F.expr("((n - 1) * percent) div 100")).withColumn("_part_of", F.expr("((n - 1) * percent) % 100"))
    ends = wanted.withColumn("_high", F.col("_low") + (F.col("_part_of") > 0).cast("long"))
    # groups times percents rows: the places, not the values, are the side to broadcast
    holds = lambda rank: (F.col(rank) < F.col("_upto")) & (F.col(rank) >= F.col("_upto") - F.col("c"))
    picked = placed.select(*group, "value", "c", "_upto").join(small(stored(ends)), group).filter(holds("_low") | holds("_high"))
    found = picked.groupBy(*group, "percent", "n", "_part_of").agg(F.max(F.when(holds("_low"), F.col("value"))).alias("_a"), F.max(F.when(holds("_high"), F.col("value"))).alias("_b"))
    between = F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_part_of") / 100.0))
    return found.select(*group, "percent", "n", F.round(between, 9).alias("value"))


def summaries(values: DataFrame, group: list[str], epsilon: float = EPSILON) -> DataFrame:
    """Mergeable summaries: every ``step``-th order statistic of a group, and the last, each with the rows it stands for.

    step is the whole part of epsilon * n, at least 1. A point's ``weight`` is the number of rows after the point
    before it, so ranks counted from any union of summaries are wrong by less than the sum of their steps, at most
    epsilon times the number of rows. A value that many rows share is a point for each step it fills.
    """
    placed, totals = _placed(counted(values, group), group, "c")
    totals = totals.withColumn("step", F.greatest(F.lit(1).cast("long"), F.floor(F.col("n") * F.lit(epsilon))))
    rows = placed.join(totals, group)
    whole = F.expr("_upto div step - (_upto - c) div step")
    left = F.when(F.col("_upto") == F.col("n"), F.col("n") % F.col("step")).otherwise(F.lit(0))
    points = rows.withColumns({"_points": whole, "_left": left}).filter("_points + _left > 0")
    weights = F.concat(F.array_repeat(F.col("step"), F.col("_points").cast("int")), F.when(F.col("_left") > 0, F.array("_left")).otherwise(F.array().cast("array<bigint>")))
    return points.select(*group, "value", F.explode(weights).alias("weight"), "step")


def merge(points: DataFrame, group: list[str], percents: list[int]) -> DataFrame:
    """Percentiles of the union of summaries.

    The value is the first point at which the weights reach the target rank. Points are placed by a distributed sort
    like rows, so there may be any number of summaries to a group.
    """
    placed, totals = _placed(points.groupBy(*group, "value").agg(F.sum("weight").alias("weight")), group, "weight")
    wanted = totals.withColumn("percent", F.explode(F.array(*(F.lit(p) for p in percents))))
    wanted = wanted.withColumn("_rank", F.greatest(F.lit(1).cast("long"), F.expr("(n * percent + 99) div 100")))
    hit = placed.join(small(stored(wanted)), group).filter("_upto >= _rank and _upto - weight < _rank")
    return hit.select(*group, "percent", "n", "value")


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "clip_result")
    blank = F.lit("")
    return rows.withColumns({"corpus": F.coalesce("corpus", blank), "split": F.coalesce("split", blank), "day": F.coalesce(F.to_date("scored_at").cast("string"), blank)})


def p2_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact percentiles for each corpus, each split of a corpus, and each day, all by one sort."""
    slash = F.concat_ws("/", "corpus", "split")
    levels = {"corpus": F.col("corpus"), "split": slash, "day": F.col("day")}
    each = F.explode(F.array(*(F.struct(F.lit(level).alias("level"), key.alias("key")) for level, key in levels.items())))
    values = _long(_results(spark, sf_dir), ["corpus", "split", "day"], METRICS).withColumn("_l", each).select("_l.level", "_l.key", "metric", "value")
    return percentiles(values, ["level", "key", "metric"], PERCENTS)


def p2_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mergeable summary for each corpus and day."""
    group = ["corpus", "day", "metric"]
    return summaries(_long(_results(spark, sf_dir), group[:2], METRICS), group)


def p2_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of each corpus from its days' summaries; rank error at most a thousandth of the rows."""
    return merge(p2_summaries(spark, sf_dir), ["corpus", "metric"], PERCENTS)


# ---------------------------------------------------------------- problem 3


def capped(rows: DataFrame, contributor: str, quality: str, identifier: str, cap: int, salt_rows: int = SALT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(kept, left out): identifiers of the first ``cap`` rows of each contributor and of the others.

    The order is by quality (highest first, null and NaN last), then identifier. Contributors with at most ``cap`` rows
    are settled by a count. Those with more are ranked in two steps. The rows of a contributor get a salt by hash, a
    number of them for about ``salt_rows`` rows each, and are ranked within it: what lies beyond the cap there lies
    beyond it in the whole. What is left, of a contributor at most its salts times ``cap``, is ranked by one sort in
    which ranges of (contributor, quality, identifier) are spread over the tasks, so a contributor may have any share.
    Rows without a contributor are kept. Both sides come from the same ranks, so repeated and null identifiers
    count as often as they occur.
    """
    named = rows.select(contributor, quality, identifier).filter(F.col(contributor).isNotNull())
    counts = stored(named.groupBy(contributor).agg(F.count(F.lit(1)).alias("_rows")))
    # fewer than rows / cap contributors
    many = small(counts.filter(F.col("_rows") > cap))
    few = rows.filter(F.col(contributor).isNull()).select(identifier).unionByName(named.join(many, contributor, "left_anti").select(identifier))
    score = F.col(quality).cast("double")
    blank = score.isNull() | F.isnan(score)
    limited = named.join(many, contributor).withColumn("_blank", blank).withColumn("_score", F.when(~blank, -score))
    salts = F.ceil(F.col("_rows") / salt_rows)
    order = [F.col("_blank"), F.col("_score"), F.col(identifier)]
    # a salt's rows, about salt_rows of them
    within = F.row_number().over(Window.partitionBy(contributor, "_salt").orderBy(*order))
    salted = limited.withColumn("_salt", F.pmod(F.xxhash64(identifier, "_score"), salts)).withColumn("_first", within)
    ranked = stored(salted.select(contributor, "_blank", "_score", identifier, "_first"))
    last = Sorted(ranked.filter(F.col("_first") <= cap).drop("_first"), [contributor], order).ranked("_rank")
    beyond = ranked.filter(F.col("_first") > cap).select(identifier)
    return few.unionByName(last.filter(F.col("_rank") <= cap).select(identifier)), beyond.unionByName(last.filter(F.col("_rank") > cap).select(identifier))


def _capped_speakers(spark: SparkSession, sf_dir: str, share: int) -> tuple[DataFrame, DataFrame]:
    cv = table(spark, sf_dir, "common_voice").select("row_id", key_of(F.col("client_id")).alias("speaker"), "dnsmos_ovr")
    return capped(cv, "speaker", "dnsmos_ovr", "row_id", max(1, cv.count() // share))


def p3_found(spark: SparkSession, sf_dir: str, share: int = 100) -> DataFrame:
    """Rows left out when a speaker keeps at most one in ``share`` of the table's rows."""
    return _capped_speakers(spark, sf_dir, share)[1]


def p3_kept(spark: SparkSession, sf_dir: str, share: int = 100) -> DataFrame:
    """Rows that stay."""
    return _capped_speakers(spark, sf_dir, share)[0]


# ---------------------------------------------------------------- problem 4


def _scale(low: str, high: str) -> Column:
    """A power of two that brings numbers from ``low`` to ``high`` to where differences neither overflow nor vanish."""
    most = F.greatest(F.abs(low), F.abs(high))
    return F.when(most > 1e150, F.lit(2.0**-2)).when(most < 1e-150, F.lit(2.0**600)).otherwise(F.lit(1.0))


def cutoffs(scored: DataFrame, group: str, score: str, numerator: int = 4, denominator: int = 5, bins: int = 1024) -> DataFrame:
    """For each group the highest score at or above which at least numerator/denominator of its rows lie; exact.

    Each round counts the scores of a group's open range into bins, zooms into the bin that holds the target rank, and
    so on until one score is left there: about three rounds for 4-byte and six for 8-byte numbers. A round reads the
    scores and shuffles only counts of bins. The least and the greatest score of a range lie in different bins, so a
    range shrinks in every round. Infinite scores are counted beside the bins and are cutoffs like others. The scores
    must not be null or NaN.
    """
    scores = scored.select(group, F.col(score).cast("double").alias("v"))
    top, bottom, finite = F.col("v") == float("inf"), F.col("v") == float("-inf"), F.abs("v") < float("inf")
    totals = scores.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(top).alias("_top"), F.count_if(bottom).alias("_bottom"), F.min(F.when(finite, F.col("v"))).alias("_low"), F.max(F.when(finite, F.col("v"))).alias("_high")
    )
    # the target: the need-th highest score
    aimed = totals.withColumn("need", F.expr(f"(n * {numerator} + {denominator - 1}) div {denominator}"))
    at_end = F.when(F.col("need") <= F.col("_top"), F.lit(float("inf"))).when(F.col("need") > F.col("n") - F.col("_bottom"), F.lit(float("-inf")))
    state = stored(aimed.select(group, "n", F.coalesce(at_end, "_low").alias("low"), F.coalesce(at_end, "_high").alias("high"), (F.col("need") - F.col("_top")).alias("need")))
    while state.filter("low < high").limit(1).count():
        ranges = state.filter("low < high").withColumn("_scale", _scale("low", "high"))
        open_ = scores.join(small(ranges), group).filter("v >= low and v <= high")
        low, high, v = (F.col(x) * F.col("_scale") for x in ("low", "high", "v"))
        at = F.least(F.lit(bins - 1).cast("long"), F.floor((v - low) / (high - low) * bins))
        binned = open_.groupBy(group, at.alias("bin")).agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("bin_low"), F.max("v").alias("bin_high"))
        # as many rows to a group as bins
        above = F.coalesce(F.sum("c").over(Window.partitionBy(group).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        hit = binned.withColumn("_above", above).join(state.select(group, "n", "need"), group).filter("_above < need and need <= _above + c")
        zoomed = hit.select(group, "n", F.col("bin_low").alias("low"), F.col("bin_high").alias("high"), (F.col("need") - F.col("_above")).alias("need"))
        after = stored(state.filter("low >= high").select(group, "n", "low", "high", "need").unionByName(zoomed))
        free(state)
        state = after
    return state.select(group, F.col("low").alias("cutoff"), F.col("n").alias("n_scored"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = table(spark, sf_dir, "worldspeech").select("ws_id", key_of(F.col("source")).alias("source"), F.col("clean_dnsmos_ovr").cast("double").alias("score"))
    return ws.filter("source is not null and score is not null and not isnan(score) and score > 0")


def p4_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source's cutoff that keeps four fifths of its scored segments, with the number kept."""
    scored = _scored(spark, sf_dir)
    kept = scored.join(small(cutoffs(scored, "source", "score")), "source").groupBy("source", "cutoff", "n_scored")
    return kept.agg(F.sum((F.col("score") >= F.col("cutoff")).cast("long")).alias("n_kept"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored segments below their source's cutoff."""
    scored = _scored(spark, sf_dir)
    return scored.join(small(cutoffs(scored, "source", "score")), "source").filter("score < cutoff").select("ws_id")


# ---------------------------------------------------------------- problem 5


def borda(rows: DataFrame, identifier: str, scores: dict[str, tuple[Column, bool, float]]) -> DataFrame:
    """identifier, points and rank from several scores: (value, lower is better, weight).

    Per score, a row with r the average of its competition ranks among the n measured rows (ties share it) gets the
    share of rows it beats, counting half of its ties: (n - r + 0.5) / n. A missing score gets the middle, 0.5. So each
    score spans (0, 1) with mean 0.5, whatever its range. Rows are ranked by the weighted sum, ties by identifier.

    Ranks come from the distinct values with their counts, in one global sort; each value's points go back to its rows
    by a join. A value shared by more than one row in 1,000 is joined by broadcast (there are at most 1,000 such values
    of a score), the others by shuffle, where no key then holds more than a thousandth of the rows. Rows with the same
    identifier share their best points, each with a rank of its own.
    """
    names = list(scores)
    pairs = F.explode(F.array(*(F.struct(F.lit(i).alias("score"), scores[m][0].alias("value")) for i, m in enumerate(names))))
    long = rows.select(identifier, pairs.alias("_x")).select(identifier, "_x.score", "_x.value")
    down = reduce(lambda a, b: a | b, [F.col("score") == i for i, m in enumerate(names) if scores[m][1]], F.lit(False))
    long = long.filter("value is not null").withColumn("value", F.when(down, F.col("value")).otherwise(-F.col("value")) + F.lit(0.0))
    distinct = Sorted(long.groupBy("score", "value").agg(F.count(F.lit(1)).alias("c")), ["score"], [F.col("value")])
    per_part = distinct.rows.groupBy("score", "_part").agg(F.sum("c").alias("_c"))
    sums = Window.partitionBy("score").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = per_part.withColumn("_before", F.coalesce(F.sum("_c").over(sums), F.lit(0))).withColumn("n", F.sum("_c").over(Window.partitionBy("score")))
    # within a partition and score at most a partition's worth of distinct values
    inside = Window.partitionBy("score", "_part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    placed = distinct.rows.join(F.broadcast(per_part.select("score", "_part", "_before", "n")), ["score", "_part"])
    better = F.col("_before") + F.coalesce(F.sum("c").over(inside), F.lit(0))
    # twice the rows at or below: 2 * (n - better) - c, over 2n
    points = (F.lit(2) * (F.col("n") - better) - F.col("c")) / (F.lit(2.0) * F.col("n"))
    values = stored(placed.withColumn("points", points).select("score", "value", "c", "n", "points"))
    often = F.col("c") * 1000 > F.col("n")
    flagged = long.join(F.broadcast(values.filter(often).select("score", "value", F.col("points").alias("_often"))), ["score", "value"], "left")
    rare = flagged.filter("_often is null").join(values.filter(~often).select("score", "value", "points"), ["score", "value"])
    got = flagged.filter("_often is not null").select(identifier, "score", F.col("_often").alias("points")).unionByName(rare.select(identifier, "score", "points"))
    columns = [F.max(F.when(F.col("score") == i, F.col("points"))).alias(f"_p{i}") for i in range(len(names))]
    per_row = rows.select(identifier).join(got.groupBy(identifier).agg(*columns), identifier, "left")
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(f"_p{i}"), F.lit(0.5)) * F.lit(float(scores[m][2])) for i, m in enumerate(names)])
    summed = per_row.select(identifier, total.alias("points"))
    return Sorted(summed.withColumn("_g", F.lit(0)), ["_g"], [F.desc("points"), F.col(identifier)]).ranked("rank").select(identifier, "points", "rank")


def p5_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All clips in one ranking by four scores of equal weight."""
    rows = table(spark, sf_dir, "clip_result")
    return borda(rows, "result_id", {m: (measured(m), lower, 1.0) for m, lower in SCORES})
