from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipsieve.llm import ranking

NAN = float("nan")
RESULT = "result_id long, corpus string, split string, scored_at timestamp, passed boolean, reject_stage string, snr_db double, dnsmos_ovr double, cer double, pitch_confidence double, duration_s double, rank long, points double, metric string, value double"


def values(n: int, seed: int = 1):
    pick = random.Random(seed)
    # a third of the rows in one group, many ties
    return [("hot" if i % 3 == 0 else f"g{pick.randint(0, 4)}", round(pick.gauss(0, 3), pick.choice([0, 1, 6]))) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 3, 700])
def test_percentiles_are_exact(spark, n):
    rows = values(n)
    percents = [0, 1, 25, 50, 75, 99, 100]
    found = {(r.g, r.percent): (r.n, r.value) for r in ranking.percentiles(spark.createDataFrame(rows, "g string, value double"), ["g"], percents).collect()}
    by = {}
    for g, v in rows:
        by.setdefault(g, []).append(v)
    assert set(found) == {(g, p) for g in by for p in percents}
    for (g, p), (count, value) in found.items():
        assert count == len(by[g]) and value == pytest.approx(np.percentile(by[g], p), abs=1e-8)


@pytest.mark.parametrize("epsilon", [0.001, 0.05])
def test_merged_summaries_keep_the_bound(spark, epsilon):
    pick = random.Random(2)
    rows = [(f"d{min(i % 9, 3)}", round(pick.expovariate(1), 2)) for i in range(3000)]
    points = ranking.summaries(spark.createDataFrame(rows, "day string, value double"), ["day"], epsilon)
    assert points.count() <= 4 * (1 / epsilon + 2)
    assert points.agg(F.sum("weight")).first()[0] == 3000
    all_values = sorted(v for _, v in rows)
    for r in ranking.merge(points.withColumn("all", F.lit(1)), ["all"], [1, 10, 50, 90, 99]).collect():
        low, high = np.searchsorted(all_values, r.value, "left"), np.searchsorted(all_values, r.value, "right")
        want = math.ceil(r.n * r.percent / 100)
        assert low - epsilon * 3000 - 1 <= want <= high + epsilon * 3000 + 1


def results(n: int):
    pick = random.Random(4)
    rows = []
    for i in range(n):
        x = lambda: pick.choice([None, NAN, 0.0, 1.0, round(pick.random() * 9, 1)])
        ok = pick.random() < 0.5
        rows.append((i, pick.choice(["cv", "ws", None]), "train", None, ok, "" if ok else pick.choice(["vad", "snr", "dnsmos", "cer"]), x(), x(), x(), x(), x(), 0, 0.0, "clash", 0.0))
    return rows


def measured(r, metric, column):
    v = r[column]
    if v is None or math.isnan(v) or (v == 0 and not r[4] and r[5] not in ranking.MEASURED_AT[metric]):
        return None
    return v


def test_percentile_query(spark, tables):
    rows = results(400)
    d = tables(clip_result=(rows, RESULT))
    found = {(r.level, r.key, r.metric, r.percent): (r.n, r.value) for r in ranking.p2_percentiles(spark, d).collect()}
    own = [v for r in rows if r[1] == "ws" and (v := measured(r, "cer", 8)) is not None]
    assert found["corpus", "ws", "cer", 50] == (len(own), pytest.approx(np.median(own)))
    assert ("day", "", "snr_db", 50) in found and ("split", "/train", "snr_db", 50) in found


@pytest.mark.parametrize("cap", [1, 7, 50])
def test_cap(spark, cap):
    pick = random.Random(cap)
    rows = [("hot" if i % 3 == 0 else pick.choice(["a", "b", None]), pick.choice([None, NAN, 1.0, 2.0, 2.5]), i, "clash") for i in range(300)]
    df = spark.createDataFrame(rows, "who string, q double, i long, rank string")
    # salts of a few rows: they drop less before the last ranking, or nothing
    sides = [ranking.capped(df, "who", "q", "i", cap, salt_rows) for salt_rows in (1000, 20)]
    found, same = ({r.i for r in left_out.collect()} for _, left_out in sides)
    assert found == same and sorted(r.i for r in sides[1][0].collect()) == sorted(set(range(300)) - found)
    want = set()
    for who in ("hot", "a", "b"):
        own = sorted((r for r in rows if r[0] == who), key=lambda r: (r[1] is None or math.isnan(r[1]), -(r[1] or 0) if r[1] is not None and not math.isnan(r[1]) else 0, r[2]))
        want |= {r[2] for r in own[cap:]}
    assert found == want


def test_cap_query(spark, common_voice):
    rows = [{"client_id": [" A", "a ", "b", None, ""][i % 5], "dnsmos_ovr": [3.0, None, NAN, 2.0][i % 4]} for i in range(250)]
    d = common_voice(*rows)
    found = {r.row_id for r in ranking.p3_found(spark, d).collect()}
    want = set()
    for who in ("a", "b"):
        order = {3.0: 0, 2.0: 1}
        own = sorted((i for i, r in enumerate(rows) if (r["client_id"] or "").strip().lower() == who), key=lambda i: (order.get(rows[i]["dnsmos_ovr"], 2), i))
        want |= set(own[2:])
    assert found == want
    assert {r.row_id for r in ranking.p3_kept(spark, d).collect()} == set(range(250)) - want


WS = "ws_id long, source string, clean_dnsmos_ovr float, score double, v double, cutoff double"


def cutoff_of(scores):
    return max(x for x in scores if 5 * sum(y >= x for y in scores) >= 4 * len(scores))


@pytest.mark.parametrize("bins", [2, 3, 1024])
def test_cutoffs(spark, bins):
    pick = random.Random(bins)
    rows = [("hot" if i % 3 == 0 else f"s{pick.randint(0, 3)}", pick.choice([1.0, 2.0, round(pick.random(), 3), pick.random() * 1e-12, -1e300, 1e300])) for i in range(500)] + [("one", 5.0)]
    found = {r.s: (r.cutoff, r.n_scored) for r in ranking.cutoffs(spark.createDataFrame(rows, "s string, x double"), "s", "x", bins=bins).collect()}
    by = {}
    for s, x in rows:
        by.setdefault(s, []).append(x)
    assert found == {s: (cutoff_of(xs), len(xs)) for s, xs in by.items()}


def test_cutoff_query(spark, tables):
    rows = [(i, [" S", "s", "t", None, " "][i % 5], [3.0, 2.5, 2.5, None, NAN, 0.0, 1.0][i % 7], 0.0, 0.0, 0.0) for i in range(140)]
    d = tables(worldspeech=(rows, WS))
    kept = {}
    for i, s, x, *_ in rows:
        key = (s or "").strip().lower()
        if key and x and not math.isnan(x):
            kept.setdefault(key, []).append((i, x))
    cut = {s: cutoff_of([x for _, x in own]) for s, own in kept.items()}
    assert {r.ws_id for r in ranking.p4_found(spark, d).collect()} == {i for s, own in kept.items() for i, x in own if x < cut[s]}
    assert {(r.source, r.cutoff, r.n_scored, r.n_kept) for r in ranking.p4_cutoffs(spark, d).collect()} == {(s, cut[s], len(own), sum(x >= cut[s] for _, x in own)) for s, own in kept.items()}


def test_borda(spark, tables):
    rows = results(300)
    found = {r.result_id: (r.points, r.rank) for r in ranking.p5_ranking(spark, tables(clip_result=(rows, RESULT))).collect()}
    points = {}
    for (metric, lower), column in zip(ranking.SCORES, (6, 7, 8, 9), strict=True):
        own = [v for r in rows if (v := measured(r, metric, column)) is not None]
        for r in rows:
            v = measured(r, metric, column)
            beaten = Fraction(1, 2) if v is None else Fraction(2 * sum((x > v) if lower else (x < v) for x in own) + own.count(v), 2 * len(own))
            points[r[0]] = points.get(r[0], 0) + beaten
    assert all(found[i][0] == pytest.approx(float(p)) for i, p in points.items())
    want = sorted(points, key=lambda i: (-points[i], i))
    assert sorted(found, key=lambda i: found[i][1]) == want and sorted(r for _, r in found.values()) == list(range(1, 301))


def test_range_of_a_score_does_not_matter(spark):
    rows = [(i, float(i % 7), float((i * 5) % 11)) for i in range(60)]
    df = spark.createDataFrame(rows, "i long, a double, b double")
    scores = lambda scale: {"a": (F.col("a") * scale, False, 1.0), "b": (F.col("b"), True, 1.0)}
    assert ranking.borda(df, "i", scores(1)).orderBy("rank").collect() == ranking.borda(df, "i", scores(1e6)).orderBy("rank").collect()


def test_empty_tables(spark, tables, common_voice):
    d = tables(clip_result=([], RESULT), worldspeech=([], WS))
    common_voice()
    for q in ("p2_percentiles", "p2_summaries", "p2_combined", "p3_found", "p3_kept", "p4_found", "p4_cutoffs", "p5_ranking"):
        assert getattr(ranking, q)(spark, d).count() == 0


def test_half_of_the_rows_tied(spark):
    """A value that half of the rows share is one row of the sort."""
    rows = [("g", 0.0 if i % 2 else float(i % 50)) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, value double")
    assert ranking.counted(df, ["g"]).count() == 25
    found = {r.percent: r.value for r in ranking.percentiles(df, ["g"], [10, 50, 75, 99]).collect()}
    assert found == {p: pytest.approx(np.percentile([v for _, v in rows], p)) for p in found}
    points = ranking.summaries(df, ["g"], 0.01).collect()
    assert sum(r.weight for r in points) == 4000 and sum(r.weight for r in points if r.value == 0.0) >= 2000 and len(points) == 100


@pytest.mark.parametrize("bins", [2, 1024])
def test_cutoffs_of_infinite_and_tiny_scores(spark, bins):
    inf, tiny = math.inf, 5e-324
    groups = {
        "mostly top": [inf] * 9 + [1.0], "some top": [inf, inf, 3.0, 2.0, 1.0], "mostly bottom": [1.0] + [-inf] * 9, "ends": [inf, -inf], "only": [-inf] * 3,
        "denormal": [tiny, 2 * tiny, 2 * tiny, 3 * tiny, 9 * tiny], "beside": [1.0, math.nextafter(1.0, 2.0), math.nextafter(1.0, 0.0)] * 2, "wide": [-1.7e308, 1.7e308, 0.0, tiny, -tiny], "signs": [-tiny, 0.0, tiny],
    }
    rows = [(g, x) for g, xs in groups.items() for x in xs]
    found = {r.s: r.cutoff for r in ranking.cutoffs(spark.createDataFrame(rows, "s string, x double"), "s", "x", bins=bins).collect()}
    assert found == {g: cutoff_of(xs) for g, xs in groups.items()}


def test_kept_and_left_out_with_repeated_and_null_identifiers(spark):
    rows = [("a", 1.0, 7)] * 5 + [("a", 2.0, None)] * 3 + [(None, 1.0, 7)]
    kept, left_out = ranking.capped(spark.createDataFrame(rows, "who string, q double, i long"), "who", "q", "i", 4)
    assert sorted(r.i or 0 for r in kept.collect()) == [0, 0, 0, 7, 7] and [r.i for r in left_out.collect()] == [7] * 4
