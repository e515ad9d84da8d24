from __future__ import annotations

import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clipsieve.functions import text


def plain(t: str) -> str:
    """The normaliser in plain Python."""
    t = unicodedata.normalize("NFC", t.lower().strip())
    kept = "".join(c for c in t if 0x1800 <= ord(c) <= 0x18AF or 0x0400 <= ord(c) <= 0x04FF or re.match(r"[\w\s]", c))
    return re.sub(r"\s+", " ", kept).strip()


def apply(spark, fn, values):
    return [r[1] for r in spark.createDataFrame(list(enumerate(values)), "i int, t string").select("i", fn(F.col("t")).alias("x")).orderBy("i").collect()]


SAMPLES = ["  Сайн,  байна уу? ", "ий", "Abc_1!", "a\x1cb", "ᠮᠣᠩᠭᠣᠯ!", "!!!", "", " x y ", "É́é", "x" * 100_000, "ʼn İ", "ΣΑΣ"]


def test_normalise(spark):
    assert apply(spark, text.normalise, SAMPLES) == [plain(t) for t in SAMPLES]
    assert apply(spark, text.normalise, [None]) == [None]


# characters that the JVM knows, too
ASSIGNED = [chr(c) for c in range(1, 0x2000) if unicodedata.ucd_3_2_0.category(chr(c)) not in ("Cn", "Cs")]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=ASSIGNED, max_size=30), min_size=50, max_size=200))
def test_normalise_like_python(spark, values):
    assert apply(spark, text.normalise, values) == [plain(t) for t in values]


def test_nfc(spark):
    values = ["й", "й", "Å", "á", "가", "plain", None, ""]
    assert apply(spark, text.nfc, values) == [None if v is None else unicodedata.normalize("NFC", v) for v in values]


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_cer_and_ratio(spark):
    pairs = [("абв", "абг"), ("а", "бөү"), ("", "x"), ("x", ""), ("ᠮᠣ", "ᠮ"), ("сайн уу", "сайнуу")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string").orderBy("i")
    found = df.select(text.cer(F.col("a"), F.col("b")).alias("c"), text.length_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    for (a, b), r in zip(pairs, found, strict=True):
        assert r.c == (distance(a, b) / len(a) if a else 1.0)
        assert r.r == len(b) / max(len(a), 1)


def test_fixed_rounds_like_binary_floats(spark):
    values = [0.125, 0.345, 2.675, 0.405, 1.005, 0.5, 12345.678, 1e-9, 99.995]
    found = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double").orderBy("i").select(*(text.fixed(F.col("x"), d) for d in (1, 2, 3))).collect()
    assert [tuple(r) for r in found] == [(f"{v:.1f}", f"{v:.2f}", f"{v:.3f}") for v in values]


def test_first_filled(spark):
    rows = [("a", 7, 1), ("", 7, 2), ("", 0, 3), (None, None, 4)]
    found = spark.createDataFrame(rows, "p string, i int, n long").select(text.first_filled(F.col("p"), F.col("i"), F.col("n"))).collect()
    assert [r[0] for r in found] == ["a", "7", "3", "4"]


def test_votes(spark):
    assert apply(spark, lambda c: text.votes(c, lenient=True), ["3", "", None, "x"]) == [3, 0, 0, None]


def test_keys(spark):
    assert apply(spark, text.keys, [" CV, ws", "all"]) == [["cv", "ws"], ["all"]]


def test_nfc_of_spaces_that_change(spark):
    assert apply(spark, text.nfc, ["a\u2000b", "\u2001"]) == ["a\u2002b", "\u2003"]
