"""The queries of this subpackage, and SQL for those that SQL can express over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clipsieve.llm import overlap, packing, ranking, splits, subjects, textform, tokens

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "p1_found": splits.p1_found,
        "p1_split": splits.p1_split,
        "p1_report": splits.p1_report,
        "p1_check": splits.p1_check,
        "p1_members": splits.p1_members,
        "p2_percentiles": ranking.p2_percentiles,
        "p2_summaries": ranking.p2_summaries,
        "p2_combined": ranking.p2_combined,
        "p3_found": ranking.p3_found,
        "p3_kept": ranking.p3_kept,
        "p4_found": ranking.p4_found,
        "p4_cutoffs": ranking.p4_cutoffs,
        "p5_ranking": ranking.p5_ranking,
        "p6_found": overlap.p6_found,
        "p6_links": overlap.p6_links,
        "p6_report": overlap.p6_report,
        "p7_found": textform.p7_found,
        "p7_normalised": textform.p7_normalised,
        "p7_classes": textform.p7_classes,
        "p8_ids": tokens.p8_ids,
        "p8_roundtrip": tokens.p8_roundtrip,
        "p8_check": tokens.p8_check,
        "p9_containers": packing.p9_containers,
        "p9_check": packing.p9_check,
        "p9_report": packing.p9_report,
        "p10_found": subjects.p10_found,
        "p10_composition": subjects.p10_composition,
    }


def _measured(metric: str) -> str:
    stages = ", ".join(f"'{s}'" for s in ranking.MEASURED_AT[metric])
    reached = "coalesce(passed, false)" + (f" OR coalesce(reject_stage IN ({stages}), false)" if stages else "")
    return f"CASE WHEN {metric} IS NOT NULL AND NOT isnan({metric}) AND ({metric} <> 0 OR {reached}) THEN {metric} + 0.0 END"


_KEY = r"nullif(lower(regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')), '')"

_P3 = f"""
WITH named AS (SELECT row_id, {_KEY.format("client_id")} AS speaker, CASE WHEN isnan(dnsmos_ovr) THEN NULL ELSE dnsmos_ovr END AS q FROM common_voice),
ranked AS (SELECT row_id, row_number() OVER (PARTITION BY speaker ORDER BY q DESC NULLS LAST, row_id) AS r FROM named WHERE speaker IS NOT NULL),
cap AS (SELECT greatest(1, count(*) // 100) AS c FROM common_voice),
found AS (SELECT row_id FROM ranked, cap WHERE r > c),
kept AS (SELECT row_id FROM ranked, cap WHERE r <= c UNION ALL SELECT row_id FROM named WHERE speaker IS NULL)
"""

_P4 = f"""
WITH scored AS (
  SELECT ws_id, {_KEY.format("source")} AS source, clean_dnsmos_ovr::DOUBLE AS score FROM worldspeech
  WHERE {_KEY.format("source")} IS NOT NULL AND clean_dnsmos_ovr IS NOT NULL AND NOT isnan(clean_dnsmos_ovr) AND clean_dnsmos_ovr > 0),
counted AS (SELECT source, score, count(*) OVER (PARTITION BY source ORDER BY score DESC RANGE UNBOUNDED PRECEDING) AS at_least, count(*) OVER (PARTITION BY source) AS n FROM scored),
cut AS (SELECT source, max(score) AS cutoff, any_value(n) AS n_scored FROM counted WHERE 5 * at_least >= 4 * n GROUP BY source)
"""


def _p2() -> str:
    keys = {"corpus": "corpus", "split": "corpus || '/' || split", "day": "day"}
    rows = "(SELECT * EXCLUDE (corpus, split), coalesce(corpus, '') AS corpus, coalesce(split, '') AS split, coalesce(strftime(scored_at, '%Y-%m-%d'), '') AS day FROM clip_result)"
    long = " UNION ALL ".join(f"SELECT '{level}' AS level, {key} AS key, '{m}' AS metric, {_measured(m)} AS v FROM {rows}" for m in ranking.METRICS for level, key in keys.items())
    each = " UNION ALL ".join(
        f"SELECT level, key, metric, {p} AS percent, count(*) AS n, round(quantile_cont(v, {p / 100}), 9) AS value FROM long WHERE v IS NOT NULL GROUP BY ALL" for p in ranking.PERCENTS
    )
    return f"WITH long AS ({long}) SELECT level, key, metric, percent::INTEGER AS percent, n, value FROM ({each})"


def _p2_summaries() -> str:
    rows = "(SELECT * EXCLUDE (corpus), coalesce(corpus, '') AS corpus, coalesce(strftime(scored_at, '%Y-%m-%d'), '') AS day FROM clip_result)"
    long = " UNION ALL ".join(f"SELECT corpus, day, '{m}' AS metric, {_measured(m)} AS value FROM {rows}" for m in ranking.METRICS)
    return f"""WITH long AS ({long}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY corpus, day, metric ORDER BY value) AS r, count(*) OVER (PARTITION BY corpus, day, metric) AS n FROM long WHERE value IS NOT NULL),
    stepped AS (SELECT *, greatest(1, floor(n * {ranking.EPSILON}::DOUBLE))::BIGINT AS step FROM ranked),
    points AS (SELECT corpus, day, metric, value, CASE WHEN r % step = 0 THEN step ELSE n % step END AS weight, step FROM stepped WHERE r % step = 0 OR r = n)"""


def _p2_combined() -> str:
    percents = ", ".join(f"({p})" for p in ranking.PERCENTS)
    return f"""{_p2_summaries()},
    reached AS (SELECT corpus, metric, value, sum(weight) OVER (PARTITION BY corpus, metric ORDER BY value) AS upto, sum(weight) OVER (PARTITION BY corpus, metric) AS n FROM points),
    wanted AS (SELECT *, greatest(1, (n * p + 99) // 100) AS target FROM reached, (VALUES {percents}) t(p))
    SELECT corpus, metric, p::INTEGER AS percent, any_value(n)::BIGINT AS n, min(value) AS value FROM wanted WHERE upto >= target GROUP BY corpus, metric, p"""


def _p5() -> str:
    parts = []
    for m, lower in ranking.SCORES:
        order = "ASC" if lower else "DESC"
        parts.append(
            f"SELECT result_id, '{m}' AS m, (2 * (count(*) OVER () - (rank() OVER (ORDER BY v {order}) - 1)) - count(*) OVER (PARTITION BY v)) / (2.0::DOUBLE * count(*) OVER ()) AS p "
            f"FROM (SELECT result_id, {_measured(m)} AS v FROM clip_result) WHERE v IS NOT NULL"
        )
    joined = " ".join(f"LEFT JOIN (SELECT result_id, p AS p{i} FROM s WHERE m = '{m}') USING (result_id)" for i, (m, _) in enumerate(ranking.SCORES))
    total = " + ".join(f"coalesce(p{i}, 0.5::DOUBLE)" for i in range(len(ranking.SCORES)))
    return f"WITH s AS ({' UNION ALL '.join(parts)}), t AS (SELECT result_id, {total} AS points FROM clip_result {joined}) SELECT result_id, points, row_number() OVER (ORDER BY points DESC, result_id) AS rank FROM t"


def oracle_sql() -> dict[str, str]:
    return {
        "p2_percentiles": _p2(),
        "p2_summaries": _p2_summaries() + " SELECT * FROM points",
        "p2_combined": _p2_combined(),
        "p3_found": _P3 + "SELECT row_id FROM found",
        "p3_kept": _P3 + "SELECT row_id FROM kept",
        "p4_found": _P4 + "SELECT ws_id FROM scored JOIN cut USING (source) WHERE score < cutoff",
        "p4_cutoffs": _P4 + "SELECT source, cutoff, n_scored, sum((score >= cutoff)::BIGINT)::BIGINT AS n_kept FROM scored JOIN cut USING (source) GROUP BY ALL",
        "p5_ranking": _p5(),
        # what must hold of operators that SQL can't express
        "p1_check": "SELECT count(*) AS n_rows, 0::BIGINT AS parted_speakers, 0::BIGINT AS parted_sentences, 0::BIGINT AS splits_off FROM common_voice",
        "p8_check": "SELECT count(*) AS documents, count(*) AS same, count(*) FILTER (coalesce(text, '') = '') AS without_ids FROM documents",
        "p9_check": "SELECT count(DISTINCT doc_id) AS documents, 0::BIGINT AS lost, 0::BIGINT AS wrongly_split, 0::BIGINT AS overfull FROM documents",
    }
