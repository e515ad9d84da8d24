"""Writing: accepted records, the reject log, reports, cards, and committed batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsieve.operators.tables import file_system
from clipsieve.plans.policy import DEFAULT

#: Under which name, and with which title, a corpus is written.
TARGETS = {
    "cv": ("common_voice_clean", "Cleaned Common Voice clips"),
    "fleurs": ("fleurs_clean", "Cleaned FLEURS clips"),
    "ws": ("worldspeech_clean", "Cleaned WorldSpeech clips"),
}


#: Bytes of a record beside its samples, and of a sample.
ROW_BYTES, SAMPLE_BYTES = 600, 4


def mean_bytes(records: DataFrame) -> int:
    """The mean size of a record: its samples by their duration, of which only that column is read, and the rest."""
    if "audio" not in records.columns:
        return ROW_BYTES
    seconds = records.agg(F.avg("duration_s")).first()[0] or 0.0
    return ROW_BYTES + int(seconds * DEFAULT.output_sample_rate) * SAMPLE_BYTES


def write_records(records: DataFrame, path: str, row_bytes: int | None = None, mode: str = "overwrite") -> None:
    """Accepted records by split, in files of about the shard size. A split without rows leaves no folder."""
    rows = max(1, DEFAULT.shard_bytes // (row_bytes or mean_bytes(records)))
    records.write.mode(mode).option("maxRecordsPerFile", rows).partitionBy("split").parquet(path)


def write_rejects(log: DataFrame, path: str, resume: bool = False) -> None:
    """The reject log as CSV, quotes doubled; appended when a run resumes."""
    log.select("clip_id", "stage", "reason", "ground_truth").write.mode("append" if resume else "overwrite").option("escape", '"').csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("clip_id string, stage string, reason string, ground_truth string").csv(path, header=True, escape='"', multiLine=True)


def write_batches(df: DataFrame, path: str) -> None:
    """Rows by batch_idx; a batch that is written again replaces itself, so a replay after a failure changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_idx").parquet(path)


def read_batches(spark: SparkSession, path: str, last: int | None = None) -> DataFrame:
    """Rows of the batches up to and with ``last``."""
    found = spark.read.parquet(path)
    return found if last is None else found.filter(F.col("batch_idx") <= last)


def save_text(spark: SparkSession, text: str, path: str) -> None:
    """A report or card, replacing what was there, on whatever file system."""
    system, where = file_system(spark, path)
    out = system.create(where, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def card(title: str, fields: list[tuple[str, str]], report: str) -> str:
    """A dataset card: title, columns and the cleaning report."""
    rows = "\n".join(f"| `{name}` | {kind} |" for name, kind in fields)
    return f"# {title}\n\n| column | type |\n| --- | --- |\n{rows}\n\n```\n{report}\n```\n"


def publish(key: str, records: DataFrame, report: str, root: str) -> str | None:
    """Records, card and report of a corpus under its published name; None and nothing written without records."""
    if records.isEmpty():
        return None
    name, title = TARGETS[key]
    write_records(records, f"{root}/{name}/data")
    spark = records.sparkSession
    save_text(spark, card(title, records.dtypes, report), f"{root}/{name}/README.md")
    save_text(spark, report, f"{root}/{name}/cleaning_report_{key}.txt")
    return f"{root}/{name}"
