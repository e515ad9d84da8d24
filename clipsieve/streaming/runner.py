"""Resumable cleaning as a stream of micro-batches over a folder of input files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clipsieve.operators.tables import delete, exists
from clipsieve.plans.policy import DEFAULT, Policy
from clipsieve.sources.sinks import write_batches


def namespace(root: str, corpus: str, split: str, policy: Policy = DEFAULT) -> str:
    """Where the state of a corpus' split lives; another policy version has other state."""
    return f"{root}/{corpus}_{split}_{policy.version}"


def run(spark: SparkSession, source: str, schema: StructType, place: str, judge: Callable[[DataFrame], DataFrame], resume: bool = True, files_at_once: int = 1, pattern: str = "*") -> DataFrame:
    """Judges files of the folder ``source`` (those whose name fits ``pattern``) that were not judged before.

    Returns all verdicts, with batch_idx.

    A batch is a set of files. What is done is known from the stream's commit log, not from folders, and a batch that
    is repeated after a failure replaces its own output; so a run that stopped at any point and one that didn't give
    the same rows. Without ``resume`` the earlier state is deleted first.
    """
    if not resume:
        delete(spark, place)
    out = f"{place}/verdicts"

    def write(batch: DataFrame, index: int) -> None:
        write_batches(judge(batch).withColumn("batch_idx", F.lit(index).cast("int")), out)

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).option("pathGlobFilter", pattern).parquet(source)
    query = rows.writeStream.foreachBatch(write).option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    if not exists(spark, out):  # no file so far
        return judge(spark.createDataFrame([], schema)).withColumn("batch_idx", F.lit(0))
    return spark.read.parquet(out)
