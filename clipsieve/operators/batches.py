"""Ordinals, count-based batches, and resuming after the last of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsieve.operators.tables import Sorted
from clipsieve.plans.policy import DEFAULT


def with_ordinals(df: DataFrame, by: str, key: str, size: int = DEFAULT.batch_size) -> DataFrame:
    """Adds idx, the position in the split by ``key`` from 0, and batch_idx. A null split is the split ''.

    A split may hold any share of the rows: positions come from one distributed sort with counts, not from a window
    over a split.
    """
    filled = df.withColumn(by, F.coalesce(by, F.lit("")))
    ranked = Sorted(filled, [by], [F.col(key)]).ranked("_rank")
    return ranked.withColumn("idx", F.col("_rank") - 1).withColumn("batch_idx", F.floor((F.col("_rank") - 1) / size).cast("int")).drop("_rank")


def running_passed(verdicts: DataFrame, by: str, key: str) -> DataFrame:
    """by, key, idx and passed_so_far: the passed clips of the split up to and with the row."""
    marked = verdicts.select(F.coalesce(by, F.lit("")).alias(by), key, F.col("passed").cast("long").alias("_one"))
    found = Sorted(marked, [by], [F.col(key)]).running("_one", "passed_so_far")
    return found.select(by, key, (F.col("rank") - 1).alias("idx"), "passed_so_far")


def after_batch(df: DataFrame, last: int, size: int = DEFAULT.batch_size) -> DataFrame:
    """Rows (with idx) that come after batch number ``last``; all of them for -1."""
    return df.filter(F.col("idx") >= (last + 1) * size)


def committed_batches(names: DataFrame) -> DataFrame:
    """batch_idx of directories (name, complete) called batch_<number> whose content is complete."""
    number = F.regexp_extract("name", r"^batch_(\d+)$", 1).try_cast("int")
    return names.withColumn("batch_idx", number).filter("batch_idx is not null and complete").select("batch_idx")


def latest_batch(names: DataFrame) -> DataFrame:
    """The greatest committed batch number; -1 if there is none."""
    return committed_batches(names).agg(F.coalesce(F.max("batch_idx"), F.lit(-1)).alias("latest"))


def batch_name(index: str) -> Column:
    return F.concat(F.lit("batch_"), F.lpad(F.col(index).cast("string"), 6, "0"))
