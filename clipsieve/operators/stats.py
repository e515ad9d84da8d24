"""Funnel statistics: one aggregation, mergeable over batches, splits and corpora, and the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The labelled stages of the report, in their order.
STAGE_LABELS = {
    "load": "Rejected — load error:      ",
    "duration": "Rejected — too short/long:  ",
    "vad": "Rejected — VAD (no speech): ",
    "snr": "Rejected — SNR too low:     ",
    "dnsmos": "Rejected — DNSMOS too low:  ",
    "cer": "Rejected — sentence verify: ",
    "crash": "Rejected — processing crash:",
}
SUMS = {"total_duration_s": "duration_s", "sum_dnsmos_ovr": "dnsmos_ovr", "sum_snr": "snr_db", "sum_cer": "cer"}
#: How many passed clips have each metric; its mean is over these.
COUNTS = {"n_dnsmos_ovr": "dnsmos_ovr", "n_snr": "snr_db", "n_cer": "cer"}


def measures() -> list[Column]:
    """total, passed, and over passed clips each metric's sum and count; null and NaN aren't measured and left out."""
    passed = F.col("passed")

    def number(name: str) -> Column:
        x = F.col(name).cast("double")
        return F.when(passed & ~F.isnan(x), x)

    counts = [F.count(F.lit(1)).alias("total"), F.count_if(passed).alias("passed")]
    sums = [F.coalesce(F.sum(number(x)), F.lit(0.0)).alias(name) for name, x in SUMS.items()]
    return counts + sums + [F.count(number(x)).alias(name) for name, x in COUNTS.items()]


def of_records(records: DataFrame, *by: str) -> DataFrame:
    """The statistics of published records, where those of their batch are lost: what was rejected isn't known."""
    return funnel(records.withColumn("passed", F.lit(True)), *by)


def prior(stats: DataFrame, records: DataFrame, *by: str) -> DataFrame:
    """The statistics of earlier batches: those stored with a batch, else what its records tell."""
    lost = records.join(stats.select(*by).distinct(), list(by), "left_anti")
    found = of_records(lost, *by)
    return stats.select(*found.columns).unionByName(found)


def funnel(verdicts: DataFrame, *by: str) -> DataFrame:
    return verdicts.groupBy(*by).agg(*measures())


def rolled_up(verdicts: DataFrame, *by: str) -> DataFrame:
    """The funnel at every level of a hierarchy; ``level`` is the grouping number, 0 for the finest."""
    return verdicts.rollup(*by).agg(F.grouping_id().cast("int").alias("level"), *measures())


def stage_counts(verdicts: DataFrame, *by: str) -> DataFrame:
    return verdicts.filter("not passed").groupBy(*by, "reject_stage").agg(F.count(F.lit(1)).alias("n"))


def stage_map(counts: DataFrame, *by: str) -> DataFrame:
    """The counts of each group as a map from stage to count. There are as many entries as stages."""
    return counts.groupBy(*by).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("reject_stage", "n")))).alias("stages"))


def merged_maps(a: Column, b: Column) -> Column:
    """Key-wise sum of two maps of counts."""
    zero = F.lit(0).cast("long")
    return F.map_zip_with(a, b, lambda _, x, y: F.coalesce(x, zero) + F.coalesce(y, zero))


def other_count(verdicts: DataFrame, *by: str) -> DataFrame:
    """Rejections at stages without a label."""
    unlabelled = ~F.col("passed") & ~F.col("reject_stage").isin(list(STAGE_LABELS))
    return verdicts.groupBy(*by).agg(F.count_if(unlabelled).alias("n_other"))


def merged(stats: DataFrame, *by: str) -> DataFrame:
    """Statistics of the union of what rows of statistics describe."""
    return stats.groupBy(*by).agg(*(F.sum(x).alias(x) for x in ["total", "passed", *SUMS, *COUNTS]))


def derived(stats: DataFrame) -> DataFrame:
    """Adds the pass percentage, clean hours, and means over passed clips that have the metric (null without any)."""
    n = {x: F.nullif(F.col(x), F.lit(0)) for x in COUNTS}
    return stats.withColumns(
        {
            "pass_percent": 100.0 * F.col("passed") / F.greatest(F.col("total"), F.lit(1)),
            "clean_hours": F.col("total_duration_s") / 3600.0,
            "mean_dnsmos_ovr": F.col("sum_dnsmos_ovr") / n["n_dnsmos_ovr"],
            "mean_snr": F.col("sum_snr") / n["n_snr"],
            "mean_cer": F.col("sum_cer") / n["n_cer"],
        }
    )


def report(name: str, verdicts: DataFrame) -> str:
    """The funnel as text. Two small aggregates reach the driver: a row, and a row for each stage."""
    total = funnel(verdicts).first().asDict()
    return report_text(name, total, {r.reject_stage: r.n for r in stage_counts(verdicts).collect()})


def report_text(name: str, total: dict, stages: dict[str, int]) -> str:
    """The report's lines from a row of ``funnel`` and counts of stages. A mean of nothing measured is a dash."""
    passed = total["passed"]
    lines = [f"=== {name.upper()} — Cleaning Report ===", f"{'Total input clips:':<28}{total['total']:>8,}"]
    lines += [f"{label}{stages.get(stage, 0):>8,}" for stage, label in STAGE_LABELS.items()]
    if other := sum(n for stage, n in stages.items() if stage not in STAGE_LABELS):
        lines.append(f"{'Rejected — other:':<28}{other:>8,}")
    lines.append("─" * 50)
    lines.append(f"{'Total PASSED (clean):':<28}{passed:>8,}  ({100.0 * passed / max(total['total'], 1):.1f}% of input)")
    lines.append(f"{'Total hours (clean):':<28}{total['total_duration_s'] / 3600.0:>10.2f} hours")
    if passed:
        means = (("Average DNSMOS OVR:", "dnsmos_ovr", 3, ""), ("Average SNR:", "snr", 1, " dB"), ("Average CER:", "cer", 3, ""))
        for label, x, digits, unit in means:
            n = total[f"n_{x}"]
            shown = f"{total[f'sum_{x}'] / n:.{digits}f}" if n else "-"
            lines.append(f"{label:<28}{shown:>10}{unit}")
    return "\n".join(lines)
