"""Filling fixed-capacity containers with documents (problem 9).

Sizes are tokens of a public tokenizer. A document above the capacity is cut into full pieces, each a container of its
own, and a last piece; no other document is split. Each input partition packs its pieces by best fit, the largest
first, and closes the containers that are nearly full. What is left are underfull containers: they are the items of a
tree of further rounds. A round has as many nodes as hold the containers at NODE_BINS each, spread over them by hash,
so a node of any round has about the same work whatever the input, and what one node can't fill meets others in the
next. Nodes merge containers by best fit; nearly full ones are closed, and those with less space than the emptiest of
all has content, which no container can enter any more. The tree ends with one node, or when a round of many nodes
merged less than LEAST_GAIN of its containers, as then hardly any two fit together.

Defined cases: null and empty texts have size 0 and go into a container like any other; a
null doc_id stays null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsieve.llm.base import stored, table
from clipsieve.llm.tokens import TOKENIZER, portions, tokenizer

CAPACITY = 4096
NEARLY_FULL = 0.98
NODE_BINS = 16_384
LEAST_GAIN = 0.05
#: Containers are numbered round, node and place together.
ROUND, NODE = 1 << 53, 1 << 28


class BestFit:
    """Open containers by free space. A bit for each amount of free space finds the least that suffices."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.fills, self.open, self.bits = capacity, [], {}, 0

    def put(self, size: int) -> int:
        """The container that gets an item."""
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            bins = self.open[free]
            at = bins.pop()
            if not bins:
                del self.open[free]
                self.bits &= ~(1 << free)
        else:
            at, free = len(self.fills), self.capacity
            self.fills.append(0)
        self.fills[at] += size
        left = free - size
        self.open.setdefault(left, []).append(at)
        self.bits |= 1 << left
        return at


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each item its container, and each container's fill; the largest items first, ties in the order given."""
    fit, placed = BestFit(capacity), np.empty(len(sizes), dtype=np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        placed[i] = fit.put(int(sizes[i]))
    return placed, np.array(fit.fills, dtype=np.int64)


def closed(fills: np.ndarray, capacity: int) -> np.ndarray:
    """Which containers a node closes: nearly full ones."""
    return fills >= NEARLY_FULL * capacity


def _pieces(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """doc (its place), piece, start and size: full pieces and the rest of each document."""
    n = np.maximum(1, -(-sizes // capacity))
    doc = np.repeat(np.arange(len(sizes)), n)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    start = piece * capacity
    return doc, piece, start, np.minimum(sizes[doc] - start, capacity)


def _local(capacity: int, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, tok = TaskContext.get().partitionId(), tokenizer(path)
        ids, sizes = [], []
        for part, texts in portions(batches, 1):
            ids.append(part.column(0))
            sizes.append(tok.count(texts))
        if not ids:
            return
        doc, piece, start, size = _pieces(np.concatenate(sizes), capacity)
        whole = size == capacity
        placed, fills = best_fit(size[~whole], capacity)
        at = np.empty(len(size), dtype=np.int64)
        at[~whole], at[whole] = placed, len(fills) + np.arange(whole.sum())
        fill = np.concatenate([fills, np.full(whole.sum(), capacity)])
        shut = np.concatenate([closed(fills, capacity), np.ones(whole.sum(), dtype=bool)])
        columns = [pa.concat_arrays(ids).take(pa.array(doc)), piece, start, size, node * NODE + at, fill[at], shut[at]]
        yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=["doc_id", "piece", "start", "size", "bin", "fill", "shut"])

    return run


def _merge(capacity: int, level: int):
    def run(bins: pd.DataFrame) -> pd.DataFrame:
        bins = bins.sort_values("bin", ignore_index=True)
        node = int(bins["node"].iloc[0])
        placed, fills = best_fit(bins["fill"].to_numpy(), capacity)
        shut = closed(fills, capacity)
        return pd.DataFrame({"bin": bins["bin"], "to": level * ROUND + node * NODE + placed, "fill": fills[placed], "shut": shut[placed]})

    return run


def pack(documents: DataFrame, capacity: int = CAPACITY, path: str = TOKENIZER) -> DataFrame:
    """doc_id, piece, start, size (in tokens) and container of every document of documents(doc_id, text)."""
    items = documents.select("doc_id", "text").mapInArrow(_local(capacity, path), "doc_id long, piece long, start long, size long, bin long, fill long, shut boolean")
    items = stored(items)
    bins = items.filter("not shut").select("bin", "fill").distinct()
    moved, level, nodes = None, 0, 2
    while nodes > 1:
        n, least = bins.agg(F.count(F.lit(1)), F.min("fill")).first()
        if n < 2:
            break
        level, nodes = level + 1, -(-n // NODE_BINS)
        # a container with less space than any other's content is as full as it will be
        open_ = bins.filter(F.col("fill") + least <= capacity).withColumn("node", F.pmod(F.xxhash64("bin"), F.lit(nodes)))
        merged = stored(open_.groupBy("node").applyInPandas(_merge(capacity, level), "bin long, to long, fill long, shut boolean"))
        step = merged.select("bin", "to")
        # where the containers of the first round have come to so far
        moved = step if moved is None else moved.select("bin", F.col("to").alias("via")).join(step.withColumnRenamed("bin", "via"), "via", "left").select("bin", F.coalesce("to", "via").alias("to")).unionByName(
            step.join(moved.select(F.col("to").alias("bin")), "bin", "left_anti")
        )
        bins = merged.filter("not shut").select(F.col("to").alias("bin"), "fill").distinct()
        if nodes > 1 and merged.select("to").distinct().count() > (1 - LEAST_GAIN) * merged.count():
            break
    found = items.select("doc_id", "piece", "start", "size", "bin")
    if moved is not None:
        found = found.join(moved, "bin", "left").withColumn("bin", F.coalesce("to", "bin"))
    return found.select("doc_id", "piece", "start", "size", F.col("bin").alias("container"))


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document, or piece of one, lies."""
    return pack(table(spark, sf_dir, "documents"))


def p9_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold, counted: documents, and of these none lost, none split below the capacity, no overfull container."""
    placed = stored(p9_containers(spark, sf_dir))
    by_doc = placed.groupBy("doc_id").agg(F.sum("size").alias("size"), F.max("piece").alias("last"), F.count(F.lit(1)).alias("pieces"), F.count_if(F.col("start") != F.col("piece") * CAPACITY).alias("shifted"))
    documents = table(spark, sf_dir, "documents").select("doc_id").distinct()
    wrong = (F.col("pieces") != F.col("last") + 1) | (F.col("shifted") > 0) | ((F.col("pieces") > 1) & (F.col("size") <= CAPACITY))
    found = documents.join(by_doc, "doc_id", "left").agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("size").isNull()).alias("lost"), F.count_if(wrong).alias("wrongly_split"))
    fills = placed.groupBy("container").agg(F.sum("size").alias("fill")).agg(F.count_if(F.col("fill") > CAPACITY).alias("overfull"))
    return found.crossJoin(F.broadcast(fills))  # a row each


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, tokens, and the share of space used."""
    bins = p9_containers(spark, sf_dir).groupBy("container").agg(F.sum("size").alias("fill"))
    return bins.agg(F.count(F.lit(1)).alias("containers"), F.sum("fill").alias("tokens"), F.max("fill").alias("fullest"), (F.sum("fill") / (F.count(F.lit(1)) * CAPACITY)).alias("used"))
