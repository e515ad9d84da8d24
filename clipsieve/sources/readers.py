"""Reading corpora: split files with their clips, mirrored parquet splits, archives, and settings."""

from __future__ import annotations

import os
import tarfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clipsieve.functions.text import votes
from clipsieve.operators.tables import exists
from clipsieve.plans.policy import DEFAULT, Policy
from clipsieve.sources.schema import TSV


def clip_files(spark: SparkSession, clips_dir: str) -> DataFrame:
    """(path, audio): the names of the clip files and where they are. Contents aren't read."""
    files = spark.read.format("binaryFile").load(clips_dir).select("path")
    return files.select(F.regexp_extract("path", r"[^/]+$", 0).alias("path"), F.col("path").alias("audio"))


def existing(rows: DataFrame, files: DataFrame, on: str = "path") -> DataFrame:
    """Rows whose clip exists. Spark broadcasts the names while they are few and shuffles them otherwise."""
    return rows.join(files.select(on).distinct(), on, "left_semi")


def read_split(spark: SparkSession, lang_dir: str, split: str, lenient: bool = False) -> DataFrame | None:
    """A split file's rows whose clip exists, with the clip's place; None without the file. Missing columns are ''."""
    path = f"{lang_dir}/{split}.tsv"
    if not exists(spark, path):
        return None
    # the first line of the file
    line = spark.read.text(path).first()
    header = (line[0] if line else "").rstrip("\r\n").split("\t")
    schema = StructType([StructField(c, StringType()) for c in header])
    rows = spark.read.schema(schema).csv(path, sep="\t", header=True, quote='"', escape='"', multiLine=True, encoding="UTF-8")
    has = set(header)
    # an empty field is read as null; in the source it is ''
    plain = {c: (F.coalesce(F.col(c), F.lit("")) if c in has else F.lit("")) for c in TSV}
    picked = rows.select(*(votes(v, lenient).alias(c) if c.endswith("votes") else v.alias(c) for c, v in plain.items()), F.lit(split).alias("split"))
    return picked.join(clip_files(spark, f"{lang_dir}/clips"), "path")


def read_mirror(spark: SparkSession, root: str) -> DataFrame:
    """All splits of a dataset mirrored as parquet folders ``split=<name>``."""
    return spark.read.option("basePath", root).parquet(root)


def prefiltered(df: DataFrame, policy: Policy = DEFAULT, snr: str = "snr") -> DataFrame:
    """Rows whose given signal-to-noise ratio reaches the limit; null and NaN count as too low. It is pushed to the scan."""
    x = F.col(snr)
    return df.filter((x >= policy.snr_min_db) & ~F.isnan(x))


def download_url(response: Column) -> Column:
    """The download address in a JSON answer."""
    return F.get_json_object(response, "$.downloadUrl")


def extract_archive(archive: str, into: str) -> str:
    """Unpacks a corpus archive once; the folder of the language, which holds validated.tsv."""
    target = Path(into)
    found = sorted(target.rglob("validated.tsv"))
    if not found:
        target.mkdir(parents=True, exist_ok=True)
        with tarfile.open(archive, "r:*") as tar:
            tar.extractall(target, filter="data")
        found = sorted(target.rglob("validated.tsv"))
    if not found:
        raise FileNotFoundError(f"no validated.tsv in {archive}")
    return str(found[0].parent)


def load_settings(path: str) -> dict[str, str]:
    """NAME=value lines as environment defaults; blank lines, comments and other lines are skipped."""
    found = {}
    file = Path(path)
    for line in file.read_text(encoding="utf-8").splitlines() if file.exists() else []:
        name, sign, value = line.strip().partition("=")
        if sign and name and not name.startswith("#"):
            found[name.strip()] = value.strip()
    for name, value in found.items():
        os.environ.setdefault(name, value)
    return found
