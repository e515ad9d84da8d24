"""Projections between source rows, verdicts and published records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clipsieve.functions.text import first_filled
from clipsieve.operators.gates import METRICS
from clipsieve.plans.policy import DEFAULT, Policy


def clip_id(columns: set[str], ordinal: Column) -> Column:
    """The path, else the id, else the ordinal; the empty text and the number zero count as missing."""
    return first_filled(*(F.col(c) for c in ("path", "id") if c in columns), ordinal)


def measured(df: DataFrame) -> DataFrame:
    """``df`` with null for NaN in its columns of numbers: what isn't a number was not measured."""
    return df.withColumns({name: F.when(~F.isnan(name), F.col(name)) for name, kind in df.dtypes if kind in ("float", "double")})


def out_split(split: Column) -> Column:
    """The published name of a split."""
    return F.when(split == "other", F.lit("other_clean")).otherwise(split)


def build_record(df: DataFrame, extra: list[str], renames: dict[str, str] | None = None, metrics: list[str] | None = None) -> DataFrame:
    """Verdict metrics and copied source columns; on a clash the source column, which comes later, wins.

    Source columns that the input lacks are null. Metrics not measured, and numbers that are NaN, are null.
    """
    renames, has = renames or {}, set(df.columns)
    copied = {renames.get(x, x): (F.col(x) if x in has else F.lit(None).cast("string")) for x in extra}
    own = [F.col(m) for m in (metrics or METRICS) if m not in copied]
    return measured(df.select(*own, *(c.alias(name) for name, c in copied.items())))


def zero_filled(df: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Metrics not measured (null or NaN) as 0 and an absent transcript as '', as older outputs have them; rejected clips' duration is 0."""
    df = measured(df)
    kinds = dict(df.dtypes)
    filled = {m: F.coalesce(F.col(m), F.lit("" if kinds[m] == "string" else 0.0).cast(kinds[m])) for m in (metrics or METRICS) if m in kinds}
    if "passed" in kinds and "duration_s" in filled:
        filled["duration_s"] = F.when(F.col("passed"), filled["duration_s"]).otherwise(F.lit(0.0).cast(kinds["duration_s"]))
    return df.withColumns(filled)


def promote(df: DataFrame, fresh: dict[str, str]) -> DataFrame:
    """Fresh metrics under ``clean_*`` names, beside the source's own values; ``sentence`` is the human transcript.

    ``fresh`` maps a metric's name to the column that holds the fresh value. NaN is null.
    """
    taken = set(fresh.values())
    kept = [F.col(c) for c in df.columns if c not in taken]
    return measured(df.select(*kept, F.col("human_transcript").alias("sentence"), *(F.col(c).alias(f"clean_{m}") for m, c in fresh.items())))


def rejected(verdicts: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """The reject log: clip_id, stage, reason, and the beginning of the ground truth."""
    truth = F.substring(F.coalesce("ground_truth", F.lit("")), 1, policy.logged_chars)
    return verdicts.filter("not passed").select("clip_id", F.col("reject_stage").alias("stage"), F.col("reject_reason").alias("reason"), truth.alias("ground_truth"))


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of a fixed schema, cast to it; missing ones and NaN are null, others are left out."""
    has = set(df.columns)
    return measured(df.select(*((F.col(f.name) if f.name in has else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields)))


def union_batches(*batches: DataFrame) -> DataFrame:
    """All rows of all batches, by column name."""
    first, *rest = batches
    for b in rest:
        first = first.unionByName(b, allowMissingColumns=True)
    return first


def missing_names(all_names: DataFrame, present: DataFrame) -> DataFrame:
    """Names of the one table that the other lacks (such as splits without rows)."""
    return all_names.distinct().exceptAll(present.distinct())
