"""Cleans corpora: of a folder of tables with scores, or of split files with their clips. See ``--help``."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from clipsieve import ship
from clipsieve.operators.tables import delete, exists
from clipsieve.plans import pipeline
from clipsieve.plans.policy import DEFAULT
from clipsieve.sources import readers, sinks
from clipsieve.sources.schema import SPECS, TABLES

log = logging.getLogger(__name__)


def corpora(names: str) -> list[str]:
    """The corpora of a comma-separated list, each once, in the order of the specifications. Unknown ones are an error."""
    asked = {x for x in names.replace(" ", "").lower().split(",") if x}
    if odd := asked - {*SPECS, "all"}:
        raise SystemExit(f"unknown datasets: {', '.join(sorted(odd))}; known: {', '.join(SPECS)}")
    return [key for key in SPECS if asked & {key, "all"}]


def parse(args: list[str] | None = None) -> argparse.Namespace:
    options = argparse.ArgumentParser(description=__doc__)
    options.add_argument("source", help="folder of parquet tables; with --clips, of split files and a folder clips")
    options.add_argument("out", help="folder for verdicts, records, reject logs and reports")
    options.add_argument("--datasets", type=corpora, default="all", metavar="NAMES", help=f"some of {', '.join(SPECS)}, between commas")
    options.add_argument("--clips", action="store_true", help="judge the samples of cv's clips, up to records with audio")
    options.add_argument("--scores", help="parquet table of path, asr_transcript and dnsmos scores, for models that aren't here")
    options.add_argument("--resume", action=argparse.BooleanOptionalAction, default=True, help="go on after the last finished portion")
    return options.parse_args(args)


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, str]:
    """The report of each corpus cleaned or, when resuming, found done under this policy version.

    A corpus that a run left unfinished goes on after its last finished portion.
    """
    readers.load_settings(".env")
    options = parse(args)
    spark = spark or SparkSession.builder.appName("clipsieve").getOrCreate()
    ship(spark)
    reports = {}
    for key in ["cv"] if options.clips else options.datasets:
        place = f"{options.out}/{key}_{DEFAULT.version}"
        report = f"{place}/cleaning_report_{key}.txt"
        if not options.resume:
            delete(spark, place)
        elif exists(spark, report):
            log.info("%s: done before", key)
            reports[key] = sinks.read_text(spark, report)
            continue
        if options.clips:
            scores = spark.read.parquet(options.scores) if options.scores else None
            done = pipeline.clean_clips(spark, options.source, place=f"{place}/state", scores=scores)
            if done is None:
                continue
        else:
            done = pipeline.clean(spark.read.parquet(f"{options.source}/{TABLES[key]}.parquet"), SPECS[key], place=f"{place}/state")
        sinks.write_rejects(done.rejected, f"{place}/rejected")
        sinks.publish(key, done.records, done.report, place)
        # the report comes last: it says that the corpus is complete
        sinks.save_text(spark, done.report, report)
        reports[key] = done.report
        print(f"\n{done.report}\n")
    return reports


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
