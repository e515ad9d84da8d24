"""Stored stages and exact positions in a distributed order."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_stored: list[tuple[SparkSession, str]] = []
_own: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``).

    Where none is set, a run on one machine (a ``local`` master, as in tests) gets a temporary folder; on a cluster it
    is an error, as a folder of one machine wouldn't be seen by the others.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        context = spark.sparkContext
        found = context.getCheckpointDir()
        if not found:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            _own.append(tempfile.mkdtemp(prefix="clipsieve-"))
            context.setCheckpointDir(_own[-1])
            found = context.getCheckpointDir()
    return found.rstrip("/")


def file_system(spark: SparkSession, path: str):  # noqa: ANN202 - Java objects
    """The file system of an address, and the address as its path."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, on whatever file system."""
    system, where = file_system(spark, path)
    return system.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder if it is there, on whatever file system."""
    system, where = file_system(spark, path)
    system.delete(where, True)


def _drop_stored() -> None:
    for spark, path in _stored:
        try:
            delete(spark, path)
        except Exception:  # noqa: BLE001 - the session may be gone
            pass
    for path in _own:
        shutil.rmtree(path, ignore_errors=True)


atexit.register(_drop_stored)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read back.

    It cuts the lineage like a reliable checkpoint, survives the loss of executors, and is computed once. The tables
    are deleted by ``free``, or when the driver's process ends.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.stored_at = path
    return found


def scratch(spark: SparkSession) -> str:
    """A new place in the shared folder, deleted when the driver's process ends."""
    path = f"{shared_dir(spark)}/clipsieve-{uuid.uuid4().hex}"
    _stored.append((spark, path))
    return path


def free(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing will read any more."""
    for t in tables:
        _stored.remove((t.sparkSession, t.stored_at))
        delete(t.sparkSession, t.stored_at)


#: A table in fewer partitions than cores is spread over up to so many.
SPREAD = 32


def spread(df: DataFrame) -> DataFrame:
    """``df`` over enough partitions for work that is heavy for each row.

    A small file is one partition, however many cores there are. Tables in many partitions stay as they are, so large
    ones aren't shuffled.
    """
    enough = min(df.sparkSession.sparkContext.defaultParallelism, SPREAD)
    return df.repartition(enough) if df.rdd.getNumPartitions() < enough else df


#: Tables of up to so many rows are broadcast by ``small``.
FEW = 100_000


def small(df: DataFrame, limit: int = FEW) -> DataFrame:
    """A stored table, to be broadcast if it has at most ``limit`` rows; else Spark chooses how to join it.

    The rows are counted from the files' metadata. The callers' rows are keys and numbers, below 200 bytes each.
    """
    return F.broadcast(df) if df.count() <= limit else df


def join_counted(rows: DataFrame, groups: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """``rows`` joined with ``groups``, one row for each key, which says in ``count`` how many rows the key has.

    Keys with more than a thousandth of all rows (fewer than 1,000 keys, whatever the input) are joined by broadcast,
    the others by shuffle, where no key then holds more than a thousandth. ``count`` isn't kept.
    """
    often = F.col(count) * 1000 > total
    hot = groups.filter(often).drop(count)
    marked = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    rest = marked.filter("_hot is null").select(*(c for c in rows.columns)).join(groups.filter(~often).drop(count), key)
    return marked.filter("_hot").drop("_hot").select(*rest.columns).unionByName(rest)


class Sorted:
    """A table in one global order by (group, order), with where each group lies in it.

    The rows are range-partitioned by group and order together, so a group that holds a third of all rows is spread
    over a third of the partitions, and rows with the same score are still spread by their identifier. ``rows`` has
    ``_at``, a number that rises within a partition without gaps; ``runs`` has, for each group and partition, the
    first ``_at``, the number of rows, and the number of the group's rows in earlier partitions (``_before``).
    ``runs`` has one row for each group plus at most one for each partition. Group keys must not be null.
    """

    def __init__(self, df: DataFrame, group: list[str], order: list[Column], partitions: int | None = None) -> None:
        spark = df.sparkSession
        n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        keys = [*(F.col(g) for g in group), *order]
        placed = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
        self.group = group
        self.rows = stored(placed.withColumn("_at", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_at", 33))
        counts = self.rows.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
        earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        self.runs = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))

    def ranked(self, name: str = "rank") -> DataFrame:
        """The rows with their rank in their group, from 1."""
        on = [*self.group, "_part"]
        return (
            self.rows.join(self.runs.select(*on, "_first", "_before"), on)
            .withColumn(name, F.col("_before") + F.col("_at") - F.col("_first") + 1)
            .drop("_at", "_part", "_first", "_before")
        )

    def running(self, value: str, name: str) -> DataFrame:
        """The rows with their rank and the sum of ``value`` up to and with them, in their group."""
        on = [*self.group, "_part"]
        sums = self.rows.groupBy(*on).agg(F.sum(value).alias("_sum"))
        earlier = Window.partitionBy(*self.group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        before = sums.withColumn("_sum_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).select(*on, "_sum_before")
        # a partition's worth of rows at most
        inside = Window.partitionBy(*on).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
        joined = self.rows.join(self.runs.select(*on, "_first", "_before"), on).join(before, on)
        found = joined.withColumn("rank", F.col("_before") + F.col("_at") - F.col("_first") + 1).withColumn(name, F.col("_sum_before") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        return found.drop("_at", "_part", "_first", "_before", "_sum_before")
