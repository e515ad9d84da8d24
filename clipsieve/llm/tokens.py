"""Encoding of a corpus with a public byte-level BPE tokenizer (problem 8).

A partition's texts are cut into words by the tokenizer's pattern. Words not met before by the worker go to a recursive
DuckDB query: rows of (word, position, token) join the merge table, and each round contracts every word's pair of least
rank, from the left, until no pair can be merged; an ordered aggregation gives the words' ids. The ids of a text are
those of its words in order. (Contracting all disjoint places of the least pair in one round gives the same ids as one
place a round, since a merge can't create a pair of a lower rank than its own.)

Defined cases: the empty text and the null text have the empty list. The names of special tokens are ordinary text.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import count

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsieve.llm.base import table

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
# Fixed value: the public pattern that cuts text before byte-level merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORDS_AT_ONCE = 8_000
#: A worker's cache of words is emptied beyond this; words are then encoded anew.
WORDS_KEPT = 500_000
CHARS_AT_ONCE = 500_000

# The table keeps the last token of each place, -1 where a token was joined to the one before; a round reads the words
# that changed in the round before (state) from the whole (recurring.state).
_CONTRACT = """
WITH RECURSIVE state(w, pos, tok) USING KEY (w, pos) AS (
  SELECT w, pos, tok FROM bytes_in
  UNION ALL
  SELECT w, pos, CASE WHEN gone THEN -1 WHEN take THEN c ELSE tok END AS tok
  FROM (
    SELECT *, coalesce(lag(take) OVER (PARTITION BY w ORDER BY pos), false) AS gone
    FROM (
      SELECT *, hit AND (row_number() OVER (PARTITION BY w, hit, run ORDER BY pos)) % 2 = 1 AS take
      FROM (
        SELECT *, sum((NOT hit)::INTEGER) OVER (PARTITION BY w ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run
        FROM (
          SELECT *, coalesce(rank = best, false) AS hit
          FROM (
            SELECT p.*, m.rank, m.c, min(m.rank) OVER (PARTITION BY p.w) AS best
            FROM (
              SELECT w, pos, tok, lead(tok) OVER (PARTITION BY w ORDER BY pos) AS following
              FROM recurring.state WHERE tok >= 0 AND w IN (SELECT w FROM state)) p
            LEFT JOIN merges m ON m.a = p.tok AND m.b = p.following)
          WHERE best IS NOT NULL)))))
SELECT w, list(tok ORDER BY pos) AS ids FROM state WHERE tok >= 0 GROUP BY w ORDER BY w
"""


def byte_names() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself if it shows, else the next from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    after = count(0x100)
    return [chr(b if b in shown else next(after)) for b in range(256)]


class Tokenizer:
    """Merge table and vocabulary of a byte-level BPE file, and the words already encoded in this worker."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, names = model["vocab"], byte_names()
        self.byte_ids = np.array([vocab[x] for x in names], dtype=np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = pa.table({k: pa.array(v, pa.int32()) for k, v in {
            "a": [vocab[x] for x, _ in pairs], "b": [vocab[y] for _, y in pairs], "rank": range(len(pairs)), "c": [vocab[x + y] for x, y in pairs],
        }.items()})
        of = {c: b for b, c in enumerate(names)}
        self.spelled = [(i, bytes(of[c] for c in x)) for x, i in vocab.items() if all(c in of for c in x)]
        self.pattern = regex.compile(PATTERN)
        self._db: duckdb.DuckDBPyConnection | None = None
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.empty(1 << 16, dtype=np.int32)
        self.used = 0
        self.starts: list[int] = []
        self.lengths: list[int] = []
        self._arrays: tuple[np.ndarray, np.ndarray] | None = None

    @property
    def db(self) -> duckdb.DuckDBPyConnection:
        if self._db is None:
            self._db = duckdb.connect(config={"threads": 1, "memory_limit": "256MB", "temp_directory": ""})
            self._db.register("merges_in", self.merges)
            self._db.execute("CREATE TABLE merges AS SELECT * FROM merges_in")
            self._db.register("spelled_in", pa.table({"id": pa.array([i for i, _ in self.spelled], pa.int32()), "part": pa.array([b for _, b in self.spelled], pa.binary())}))
            self._db.execute("CREATE TABLE spelled AS SELECT * FROM spelled_in")
        return self._db

    def encode_words(self, words: list[str]) -> Iterator[np.ndarray]:
        """Ids of each word, by the recursive query."""
        for i in range(0, len(words), WORDS_AT_ONCE):
            raw = [w.encode("utf-8", "surrogatepass") for w in words[i : i + WORDS_AT_ONCE]]
            lengths = np.array([len(b) for b in raw])
            tokens = self.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)]
            rows = pa.table({"w": np.repeat(np.arange(len(raw), dtype=np.int32), lengths), "pos": np.arange(len(tokens), dtype=np.int64), "tok": tokens})
            self.db.register("bytes_in", rows)
            ids = self.db.sql(_CONTRACT).to_arrow_table().column("ids").combine_chunks()
            ends, values = ids.offsets.to_numpy(), ids.values.to_numpy()
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                yield values[a:b]

    def learn(self, words: set[str]) -> None:
        """Encode words not met before."""
        new = [w for w in words if w not in self.index]
        if not new:
            return
        for word, ids in zip(new, self.encode_words(new), strict=True):
            if self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.empty(len(self.flat) + len(ids), dtype=np.int32)])
            self.flat[self.used : self.used + len(ids)] = ids
            self.index[word] = len(self.starts)
            self.starts.append(self.used)
            self.lengths.append(len(ids))
            self.used += len(ids)
        self._arrays = None

    def _places(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The place of each word of the texts in the cache, and how many words each text has."""
        found = [self.pattern.findall(t) if t else [] for t in texts]
        if len(self.index) > WORDS_KEPT:
            self.forget()
        self.learn({w for words in found for w in words})
        if self._arrays is None:
            self._arrays = np.array(self.starts, dtype=np.int64), np.array(self.lengths, dtype=np.int64)
        index = self.index
        return np.fromiter((index[w] for words in found for w in words), dtype=np.int64), np.array([len(x) for x in found], dtype=np.int64)

    def encode(self, texts: list[str | None]) -> pa.ListArray:
        """The ids of each text; an empty list for the empty and the null text."""
        places, words = self._places(texts)
        starts, lengths = (a[places] for a in self._arrays)
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]
        offsets = np.concatenate([[0], np.concatenate([[0], ends])[np.cumsum(words)]]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))

    def count(self, texts: list[str | None]) -> np.ndarray:
        """The number of ids of each text."""
        places, words = self._places(texts)
        ends = np.concatenate([[0], np.cumsum(self._arrays[1][places])])[np.concatenate([[0], np.cumsum(words)])]
        return np.diff(ends)

    def decode(self, ids: pa.ListArray) -> list[str]:
        """The texts of lists of ids: tokens joined with their bytes, aggregated in order."""
        flat = ids.flatten()
        sizes = np.diff(ids.offsets.to_numpy())
        self.db.register("ids_in", pa.table({"t": np.repeat(np.arange(len(ids)), sizes), "pos": np.arange(len(flat)), "id": flat}))
        rows = self.db.sql("SELECT t, list(part ORDER BY pos) AS parts FROM ids_in JOIN spelled USING (id) GROUP BY t").fetchall()
        texts = {t: b"".join(parts).decode("utf-8", "surrogatepass") for t, parts in rows}
        return [texts.get(t, "") for t in range(len(ids))]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """One for each worker process and file."""
    return Tokenizer(path)


def portions(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of the batches with about CHARS_AT_ONCE characters of text; a longer text is alone."""
    for batch in batches:
        texts = batch.column(column).to_pylist()
        start = size = 0
        for i, t in enumerate(texts):
            if size and size + len(t or "") > CHARS_AT_ONCE:
                yield batch.slice(start, i - start), texts[start:i]
                start, size = i, 0
            size += len(t or "")
        if start < len(texts):
            yield batch.slice(start), texts[start:]


def encoder(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        for part, texts in portions(batches, 1):
            yield pa.RecordBatch.from_arrays([part.column(0), tok.encode(texts)], names=["doc_id", "ids"])

    return run


def encoded(documents: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """doc_id and ids of documents(doc_id, text). Other columns are left out, whatever their names."""
    return documents.select("doc_id", "text").mapInArrow(encoder(path), "doc_id long, ids array<int>")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of each document."""
    return encoded(table(spark, sf_dir, "documents"))


def p8_roundtrip(spark: SparkSession, sf_dir: str, path: str = TOKENIZER) -> DataFrame:
    """For each document: the number of its ids, and whether they decode to its text."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        for part, texts in portions(batches, 1):
            ids = tok.encode(texts)
            same = [a == (b or "") for a, b in zip(tok.decode(ids), texts, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(ids.offsets.to_numpy()), pa.int64()), pa.array(same)], names=["doc_id", "n_ids", "same"])

    return table(spark, sf_dir, "documents").select("doc_id", "text").mapInArrow(check, "doc_id long, n_ids long, same boolean")


def p8_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, how many of them decode to their text, and how many have no ids."""
    found = p8_roundtrip(spark, sf_dir)
    return found.agg(F.count(F.lit(1)).alias("documents"), F.count_if("same").alias("same"), F.count_if(F.col("n_ids") == 0).alias("without_ids"))
