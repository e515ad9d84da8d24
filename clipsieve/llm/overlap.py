"""The same or nearly the same records in different splits (problem 6).

Sentences are compared in the form of problem 7, in lower case, with letters, digits and marks only. Equal sentences
are one class, so copies are never compared with each other. Each class gets minwise hashes of its character shingles,
taken with their number of occurrence, so that an edit changes at most SHINGLE of them; they are cut into bands, and
only classes of a train and of a held-out row that share a bucket become candidates. A candidate must pass two tests
that never lose a pair within the edit limit, on numbers the bands carry along: of lengths, and of how often the letters
of eight groups occur. Then texts are joined to what is left, by number, and verified: exact Jaccard similarity, and edit
distance. Two sentences within the edit limit of a tenth of the longer one always have a similarity of at least 3/7.
Bands find a pair at similarity s with probability 1 - (1 - s^ROWS)^BANDS: 0.91 at 3/7, the least there is (very long
sentences with all edits apart), 0.95 at 0.46 (139 characters), 0.97 at 0.486 (78, the usual length), 0.996 at 0.55.

All joins are sort-merge joins, as both sides grow with the input. A bucket, text or recording that occurs very often
makes a skewed partition, which adaptive execution splits over tasks.

Recordings are the same if the file in ``path`` is, whatever its folder, extension and letter case.

Defined cases: null, blank and letterless sentences and null or blank paths match nothing; rows of other splits
and rows without a row_id are left out; repeated rows each give their own pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from clipsieve.llm.base import WS, stored, table
from clipsieve.llm.textform import corpus_form, in_form

SHINGLE = 4
ROWS = 3
BANDS = 30
LEAST_SIMILARITY = 3 / 7
HELD_OUT = ["dev", "test"]
#: Shingles hashed at once; keeps the working arrays in the processor's cache.
AT_ONCE = 1 << 15
#: Groups of letters whose counts are compared, 8 bits each.
GROUPS = 8
#: Rows of bands in a task of the join.
BAND_ROWS = 500_000

_PAD = "\x02" * (SHINGLE - 1)


def comparable(text: Column) -> Column:
    """Lower case, all but letters, digits and marks as single spaces; null without a letter or digit."""
    bare = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\p{M}]+", " "))
    return F.when(bare.rlike(r"[\p{L}\p{N}]"), bare)


def recording(path: Column) -> Column:
    """The file's name without folder and extension, in lower case; null if nothing is left."""
    name = F.regexp_replace(F.lower(F.regexp_replace(path, f"^{WS}+|{WS}+$", "")), r"^.*[/\\]", "")
    return F.nullif(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""), F.lit(""))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEEDS = (_mix(np.arange(1, ROWS * BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def shingle_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of all texts' shingles, each with its number of occurrence in its text, and where each text begins."""
    padded = [_PAD + t + _PAD for t in texts]
    counts = np.array([len(t) - SHINGLE + 1 for t in padded])
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    h = np.zeros(len(codes) - SHINGLE + 1, dtype=np.uint64)
    for i in range(SHINGLE):
        h = _mix(h * np.uint64(31) + codes[i : len(codes) - SHINGLE + 1 + i])
    text = np.repeat(np.arange(len(texts), dtype=np.uint64), counts)
    begins = np.cumsum(counts) - counts
    # shingles that would run over into the next text are left out
    places = np.arange(counts.sum()) + np.repeat(np.arange(len(texts)) * (SHINGLE - 1), counts)
    keys = np.sort(text << np.uint64(32) | h[places] >> np.uint64(32))
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    first = np.flatnonzero(new)
    occurrence = np.arange(len(keys)) - np.repeat(first, np.diff(np.append(first, len(keys))))
    mixed = _mix((keys & np.uint64(0xFFFFFFFF)) + (occurrence.astype(np.uint64) << np.uint64(32)))
    return (mixed >> np.uint64(32)).astype(np.uint32), begins


def band_keys(texts: list[str]) -> np.ndarray:
    """For each text and band a bucket, the band's number in its upper half."""
    hashes, begins = shingle_hashes(texts)
    least = np.empty((ROWS * BANDS, len(texts)), dtype=np.uint32)
    for i, seed in enumerate(_SEEDS):
        least[i] = np.minimum.reduceat(hashes * seed, begins)
    keys = np.zeros((BANDS, len(texts)), dtype=np.uint64)
    for r in range(ROWS):
        keys = _mix(keys + least[r::ROWS] + np.uint64(r))
    return (keys >> np.uint64(32) | np.arange(BANDS, dtype=np.uint64)[:, None] << np.uint64(32)).view(np.int64).T


def letter_counts(texts: list[str]) -> np.ndarray:
    """How many characters of each of GROUPS groups a text has, up to 255, packed into one number."""
    lengths = np.array([len(t) for t in texts])
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    group = (_mix(codes) % np.uint64(GROUPS)).astype(np.int64)
    counts = np.bincount(np.repeat(np.arange(len(texts)), lengths) * GROUPS + group, minlength=GROUPS * len(texts)).reshape(-1, GROUPS)
    return (np.minimum(counts, 255).astype(np.uint64) << np.arange(0, 8 * GROUPS, 8, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).view(np.int64)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        start = size = 0
        for i, t in enumerate([*texts, None]):
            if t is None or (size and size + len(t) > AT_ONCE):
                if i > start:
                    some = texts[start:i]
                    keys = pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(band_keys(some)).ravel()), BANDS).cast(pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, i - start), pa.array([len(t) for t in some], pa.int32()), pa.array(letter_counts(some)), keys], names=["id", "size", "letters", "keys"])
                start, size = i, 0
            size += len(t or "")


def similarities(a: list[str], b: list[str]) -> np.ndarray:
    """Exact Jaccard similarity of the shingles, with their occurrences, of each text of ``a`` and its partner in ``b``."""
    sides = []
    for texts in (a, b):
        counts = np.array([len(t) + SHINGLE - 1 for t in texts])
        codes = np.frombuffer("".join(_PAD + t + _PAD for t in texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        places = np.arange(counts.sum()) + np.repeat(np.arange(len(texts)) * (SHINGLE - 1), counts)
        sides.append((np.repeat(np.arange(len(texts)), counts), codes[places[:, None] + np.arange(SHINGLE)], counts))
    pair, shingle = (np.concatenate([x[i] for x in sides]) for i in (0, 1))
    side = np.repeat([0, 1], [len(x[0]) for x in sides])
    order = np.lexsort((*shingle.T, pair))
    pair, shingle, side = pair[order], shingle[order], side[order]
    first = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (shingle[1:] != shingle[:-1]).any(axis=1)]))
    of_b = np.add.reduceat(side, first)
    of_a = np.diff(np.append(first, len(pair))) - of_b
    common = np.bincount(pair[first], weights=np.minimum(of_a, of_b), minlength=len(a))
    return common / (sides[0][2] + sides[1][2] - common)


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    found, start, size = [], 0, 0
    both = list(zip(a, b, strict=True))
    for i, (x, y) in enumerate(both):
        if size and size + len(x) + len(y) > 8 * AT_ONCE:
            found.append(similarities(*map(list, zip(*both[start:i], strict=True))))
            start, size = i, 0
        size += len(x) + len(y)
    if both:
        found.append(similarities(*map(list, zip(*both[start:], strict=True))))
    return pd.Series(np.concatenate(found) if found else [], dtype="float64")


def classes(texts: DataFrame) -> DataFrame:
    """The different texts of texts(text, h1, h2), each with a small number: a text has BANDS rows to shuffle."""
    return stored(texts.filter("text is not null").select("h1", "h2", "text").distinct().withColumn("id", F.monotonically_increasing_id()))


def near_classes(train: DataFrame, held_out: DataFrame) -> DataFrame:
    """Each class of ``train`` with each of ``held_out`` within the edit limit: a1, a2, text_a, b1, b2, text_b and edits."""
    n = max(int(train.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(train.count() + held_out.count()) * BANDS // BAND_ROWS))

    def banded(texts: DataFrame) -> DataFrame:
        found = texts.select("id", "text").mapInArrow(_bands, "id long, size int, letters long, keys array<long>")
        return found.select("id", "size", "letters", F.explode("keys").alias("key")).repartition(n, "key")

    a, b = banded(train).alias("a"), banded(held_out).alias("b")
    longer = F.greatest("a.size", "b.size")
    apart = reduce(lambda x, y: x + y, [F.abs(F.shiftrightunsigned("a.letters", 8 * i).bitwiseAND(255) - F.shiftrightunsigned("b.letters", 8 * i).bitwiseAND(255)) for i in range(GROUPS)])
    # an edit changes the length by at most one, and the letters' counts by at most two
    limit = F.expr("greatest(a.size, b.size) div 10")
    close = (F.abs(F.col("a.size") - F.col("b.size")) * 10 <= longer) & (apart <= limit * 2)
    shared = a.join(b.hint("merge"), (F.col("a.key") == F.col("b.key")) & close)
    pairs = shared.select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b")).distinct()
    named = lambda texts, x: texts.withColumnsRenamed({"id": f"id_{x}", "text": f"text_{x}", "h1": f"{x}1", "h2": f"{x}2"})
    texts = pairs.join(named(held_out, "b").hint("merge"), "id_b").join(named(train, "a").hint("merge"), "id_a")
    alike = texts.filter(similarity("text_a", "text_b") >= LEAST_SIMILARITY - 1e-12)
    near = alike.withColumn("edits", F.expr("levenshtein(text_a, text_b, cast(greatest(char_length(text_a), char_length(text_b)) div 10 as int))")).filter("edits >= 0")
    return near.select("a1", "a2", "text_a", "b1", "b2", "text_b", "edits")


def hashed(rows: DataFrame) -> DataFrame:
    """Adds h1 and h2, together the name of a text in joins: 128 bits, so that no two texts of a corpus share it."""
    return rows.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit("second"), "text")})


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    cv = table(spark, sf_dir, "common_voice").filter(F.col("row_id").isNotNull() & F.col("split").isin("train", *HELD_OUT))
    form = corpus_form(spark, sf_dir)
    kept = cv.select("row_id", "split", "segment", recording(F.col("path")).alias("recording"), F.col("sentence").alias("text"))
    return stored(hashed(in_form(kept, "text", form, "text").withColumn("text", comparable(F.col("text")))))


def _near(records: DataFrame) -> DataFrame:
    return stored(near_classes(classes(records.filter("split = 'train'")), classes(records.filter("split <> 'train'"))))


def overlaps(records: DataFrame, *kept: str) -> DataFrame:
    """(train_row, other_row) and the columns ``kept`` of the held-out row: each pair of rows that overlap, once."""
    train = records.filter("split = 'train'").withColumnRenamed("row_id", "train_row")
    other = records.filter("split <> 'train'").withColumnRenamed("row_id", "other_row")
    links = _near(records).select("a1", "a2", "b1", "b2")
    heard = links.join(other.filter("text is not null").select("other_row", *kept, F.col("h1").alias("b1"), F.col("h2").alias("b2")).hint("merge"), ["b1", "b2"])
    by_text = heard.join(train.filter("text is not null").select("train_row", F.col("h1").alias("a1"), F.col("h2").alias("a2")).hint("merge"), ["a1", "a2"])
    by_path = train.filter("recording is not null").select("train_row", "recording").join(other.select("other_row", *kept, "recording").hint("merge"), "recording")
    return by_text.select("train_row", "other_row", *kept).union(by_path.select("train_row", "other_row", *kept)).distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping rows, the smaller row_id first."""
    pairs = overlaps(_records(spark, sf_dir))
    return pairs.select(F.least("train_row", "other_row").alias("row_id_a"), F.greatest("train_row", "other_row").alias("row_id_b"))


def p6_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of different or equal texts across splits, with each side's first row, its number of rows, and the edits.

    The short form of the overlaps by sentence: copies of a text are one class and not multiplied.
    """
    records = _records(spark, sf_dir)
    side = lambda x, where: records.filter("text is not null").filter(where).groupBy(F.col("h1").alias(f"{x}1"), F.col("h2").alias(f"{x}2")).agg(F.min("row_id").alias(f"row_{x}"), F.count(F.lit(1)).alias(f"rows_{x}"))
    found = _near(records).join(side("a", "split = 'train'").hint("merge"), ["a1", "a2"]).join(side("b", "split <> 'train'").hint("merge"), ["b1", "b2"])
    return found.select(F.col("row_a").alias("train_row"), F.col("rows_a").alias("train_rows"), F.col("row_b").alias("other_row"), F.col("rows_b").alias("other_rows"), "edits")


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per split and segment (in lower case, blank and null as none): overlapping clips, and pairs."""
    pairs = overlaps(_records(spark, sf_dir), "split", "segment")
    segment = F.coalesce(F.nullif(F.lower(F.trim("segment")), F.lit("")), F.lit("none"))
    return pairs.groupBy("split", segment.alias("segment")).agg(F.count_distinct("other_row").alias("n_clips"), F.count(F.lit(1)).alias("n_pairs"))
