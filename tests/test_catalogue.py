"""Queries against their SQL over the smallest tables, where these are present."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")
SOME = ["cascade_verdict", "char_error_rate", "snr_gate", "vad_gate", "passed_records", "funnel_rollup", "batch_assignment", "running_passed", "promote_fields", "stream_equals_batch", "clean_hours_and_means"]


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in DATA.iterdir():
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)


@pytest.mark.parametrize("name", SOME)
def test_like_sql(spark, sql, name):
    a = entry.queries()[name](spark, str(DATA)).toArrow()
    b = sql.sql(entry.oracle_sql()[name]).to_arrow_table()
    columns = sorted(a.column_names)
    assert columns == sorted(b.column_names)
    rows = [sorted(tuple(plain(r[c]) for c in columns) for r in t.to_pylist()) for t in (a, b)]
    assert rows[0] == rows[1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_does_not_know_the_subpackage():
    for f in Path(entry.__file__).parent.joinpath("clipsieve").rglob("*.py"):
        if "llm" not in f.parts:
            assert "llm" not in f.read_text(encoding="utf-8"), f
