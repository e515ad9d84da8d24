from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipsieve.llm import overlap


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def near(a, b):
    return distance(a, b) * 10 <= max(len(a), len(b))


def spoil(pick, t, edits):
    letters = "абвгдежзийклмнопрстуфхцчшэюяөү"
    for _ in range(edits):
        i = pick.randrange(len(t))
        t = pick.choice([t[:i] + t[i + 1 :], t[:i] + pick.choice(letters) + t[i:], t[:i] + pick.choice(letters) + t[i + 1 :]])
    return t


def sentences(pick, n):
    words = ["".join(pick.choice(["ба", "гэ", "ху", "ша", "ло", "дү", "нэ", "р", "г"]) for _ in range(pick.randint(2, 5))) for _ in range(300)]
    return [" ".join(pick.choice(words) for _ in range(pick.randint(1, 14))) for _ in range(n)]


def near_texts(spark, train, held):
    sides = [overlap.classes(overlap.hashed(spark.createDataFrame([(t,) for t in texts], "text string"))) for texts in (train, held)]
    return overlap.near_classes(*sides).collect()


def exact(a, b):
    x, y = (Counter(t[i : i + overlap.SHINGLE] for i in range(len(t) - overlap.SHINGLE + 1)) for t in (overlap._PAD + a + overlap._PAD, overlap._PAD + b + overlap._PAD))
    common = sum((x & y).values())
    return common / (sum(x.values()) + sum(y.values()) - common)


def test_similarity_is_exact():
    pick = random.Random(3)
    a = [*sentences(pick, 60), "а" * 50, "😀 үг", "б"]
    b = [spoil(pick, t, len(t) // 8) or "х" for t in a[:40]] + sentences(pick, 20) + ["а" * 20, "үг 😀", "б"]
    assert overlap.similarities(a, b).tolist() == pytest.approx([exact(x, y) for x, y in zip(a, b, strict=True)])


def test_letter_counts_never_lose_a_near_pair():
    pick = random.Random(5)
    texts = [t for t in sentences(pick, 200) if len(t) >= 10] + ["аб" * 900]
    spoilt = [spoil(pick, t, len(t) // 10) for t in texts]
    for t, b, x, y in zip(texts, spoilt, overlap.letter_counts(texts).view(np.uint64).tolist(), overlap.letter_counts(spoilt).view(np.uint64).tolist(), strict=True):
        apart = sum(abs((x >> 8 * i & 255) - (y >> 8 * i & 255)) for i in range(overlap.GROUPS))
        assert apart <= 2 * distance(t, b) if len(t) < 500 else apart <= 2 * (len(t) // 10)


def test_recall_at_the_limit():
    """Of the bands, by their formula and counted on pairs of about the least similarity the edit limit allows."""
    assert 1 - (1 - overlap.LEAST_SIMILARITY**overlap.ROWS) ** overlap.BANDS >= 0.9
    pick = random.Random(11)
    letters = "абвгдежзийклмнопрстуфхцчшэюяөү "
    hit = n = 0
    for _ in range(300):
        t = "".join(pick.choice(letters) for _ in range(400))
        b = list(t)
        for i in range(5, 400, 10):  # all edits apart
            b[i] = "q"
        b = "".join(b)
        assert overlap.similarities([t], [b])[0] < 0.45
        x, y = overlap.band_keys([t, b])
        hit, n = hit + (x == y).any(), n + 1
    assert hit >= 0.88 * n


def test_recall_against_brute_force(spark):
    """Also of pairs with as many edits as the limit allows."""
    pick = random.Random(7)
    train = sentences(pick, 250)
    held = sentences(pick, 60) + [spoil(pick, t, k) for t in train[:200] if len(t) >= 10 for k in (1, len(t) // 10)]
    train, held = sorted(set(train)), sorted({h for h in held if h.strip()})
    found = {(r.text_a, r.text_b): r.edits for r in near_texts(spark, train, held)}
    want = {(a, b): distance(a, b) for a in train for b in held if abs(len(a) - len(b)) * 10 <= max(len(a), len(b)) and near(a, b)}
    assert set(found) <= set(want) and all(found[k] == want[k] for k in found)
    assert len(found) >= 0.98 * len(want) > 200


def test_similarity_never_loses_a_near_pair():
    pick = random.Random(8)
    for t in [*sentences(pick, 200), "а" * 40, "аб" * 30, "үг " * 20]:
        if len(t) >= 10:
            b = spoil(pick, t, len(t) // 10)
            if near(t, b):
                assert overlap.similarities([t], [b])[0] >= overlap.LEAST_SIMILARITY - 1e-12


def test_minwise_hashes_estimate_similarity():
    pick = random.Random(9)
    a = sentences(pick, 1)[0] + " нэмэлт үг хэллэг"
    b = spoil(pick, a, 3)
    hashes, begins = overlap.shingle_hashes([a, b])
    least = np.array([np.minimum.reduceat(hashes * s, begins) for s in overlap._SEEDS])
    assert (least[:, 0] == least[:, 1]).mean() == pytest.approx(exact(a, b), abs=0.15)


def test_hashes_do_not_depend_on_company():
    texts = ["сайн", "а", "сайн байна уу", "ааааааааа"]
    together = overlap.band_keys(texts)
    assert all((overlap.band_keys([t])[0] == together[i]).all() for i, t in enumerate(texts))


def test_recording(spark):
    paths = ["a/B.MP3", "./b.ogg", "b.wav", "c.tar.gz", "", " ", None, "dir/", "x", ".mp3", "a\\b.mp3"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string").orderBy("i")
    assert [r[0] for r in df.select(overlap.recording(F.col("p"))).collect()] == ["b", "b", "b", "c.tar", None, None, None, None, "x", ".mp3", "b"]


ROWS = [
    {"split": "train", "path": "t0.mp3", "sentence": "Нэг хоёр гурав дөрөв тав."},
    {"split": "dev", "path": "d1.mp3", "sentence": "нэг хоёр, гурав  дөрөв тав!"},  # the same when compared
    {"split": "test", "path": "d2.mp3", "sentence": "нэг хоёр гурав дөрөв тав зур"},  # four edits of 28
    {"split": "test", "path": "d3.mp3", "sentence": "нэг хоeр гурав дөрв тав", "segment": "Benchmark"},  # one look-alike, one edit of 24
    {"split": "validated", "path": "t0.mp3", "sentence": "Нэг хоёр гурав дөрөв тав."},  # not a split compared
    {"split": "train", "path": "clips/D2.wav", "sentence": "!!!"},
    {"split": "dev", "path": None, "sentence": "!!!"},
    {"split": "dev", "path": "", "sentence": None},
    {"split": "train", "path": "", "sentence": ""},
    {"split": "train", "path": "t9.mp3", "sentence": "Нэг хоёр гурав дөрөв тав."},  # repeated
    {"split": "dev", "path": "x.mp3", "sentence": "үг"},
    {"split": "train", "path": "y.mp3", "sentence": "үд"},  # one edit of two
    {"split": "dev", "path": "long1.mp3", "sentence": "урт үг " * 3000},
    {"split": "train", "path": "long2.mp3", "sentence": "урт үг " * 2999 + "уртх үг"},
]


def test_found(spark, common_voice):
    d = common_voice(*ROWS)
    found = sorted(tuple(r) for r in overlap.p6_found(spark, d).collect())
    assert found == [(0, 1), (0, 3), (1, 9), (2, 5), (3, 9), (12, 13)]
    report = {(r.split, r.segment): (r.n_clips, r.n_pairs) for r in overlap.p6_report(spark, d).collect()}
    links = sorted(tuple(r) for r in overlap.p6_links(spark, d).collect())
    assert links == [(0, 2, 1, 1, 0), (0, 2, 3, 1, 2), (13, 1, 12, 1, 1)]
    assert report == {("dev", "none"): (2, 3), ("test", "none"): (1, 1), ("test", "benchmark"): (1, 2)}


def test_hot_copies(spark, common_voice):
    """A third of all rows the same text: one class, and each pair of rows once."""
    rows = [{"split": "train" if i % 2 else "dev", "path": f"p{i}", "sentence": "Ижил өгүүлбэр энд байна" if i % 3 == 0 else None} for i in range(60)]
    assert overlap.p6_found(spark, common_voice(*rows)).count() == 100


def test_empty(spark, common_voice):
    d = common_voice()
    assert overlap.p6_found(spark, d).count() == 0 and overlap.p6_report(spark, d).count() == 0
