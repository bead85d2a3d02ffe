"""Ranked lexical search by hashed max-sketches, for every item the best documents.

A document is folded into a sketch: every distinct term falls by its fingerprint on one of
`WIDTH` coordinates of each of two rows, and a coordinate keeps the largest number of
occurrences that fell on it. The impact of a term grows with its occurrences, so the smaller
of a term's two coordinates gives a bound from above, and so does the sum over an item's
terms. Bounds of all items are looked up for a slice of documents at once, as one product of
matrices. For each item the documents are then rescored exactly by descending bound, until
the bound is below the tenth score that the task has so far; no document is passed over.

Scores are whole numbers: a term's weight is floor(1000 ln((2N + 2) / (2 df + 1))), its impact
(10^9 tf) div (1000 tf + 8 m) with m = 25 + (75 n N) div L. N counts the documents that hold a
term, L all terms, n those of a document, df the documents that hold the term, tf its
occurrences. Counts come from a pass over all documents that adds up numbers in every task.
Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased, and are
compared by 64-bit fingerprints. Items travel to the tasks in blocks of `BLOCK_BYTES` of text,
two passes over the documents for each; a task sends out at most `depth` rows an item.

Null and empty texts and items hold no terms: such documents are not counted and never found,
such items have no rows. Every row is a document or an item of its own, repeated ones too.
Equal scores go by ascending id, null ids last; equal ids by equal text are alike. Long texts
make a slice of their own. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from skyrisk.llm import hashing
from skyrisk.llm.texts import slices

DEPTH = 10
WIDTH = 512  # coordinates of a row of a sketch
BLOCK_BYTES = 1 << 16  # text of the items that one pass carries
ROWS = 256  # documents whose bounds are looked up at once
_BREAKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


@dataclass
class Terms:
    """Distinct terms of the documents of a slice, sorted by document and fingerprint."""

    doc: np.ndarray
    term: np.ndarray
    tf: np.ndarray
    length: np.ndarray  # terms of each document, with repeats

    @property
    def edges(self) -> np.ndarray:
        return np.searchsorted(self.doc, np.arange(len(self.length) + 1))


def terms(texts: list[bytes]) -> Terms:
    """The terms of some texts, read in one go: texts are parted by a zero byte."""
    hashes, starts, _ = hashing.words(b"\x00".join(texts), _BREAKS)
    ends = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(ends, starts, side="right")
    order = np.lexsort((hashes, doc))
    d, h = doc[order], hashes[order]
    first = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (h[1:] != h[:-1])][: len(d)])
    tf = np.diff(np.r_[first, len(d)])
    return Terms(d[first], h[first], tf, np.bincount(doc, minlength=len(texts)))


def coordinates(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where fingerprints fall in the two rows of a sketch."""
    mask = np.uint64(WIDTH - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(24)) & mask).astype(np.int64)


def sketches(t: Terms) -> np.ndarray:
    """Two rows of maxima for every document of a slice."""
    out = np.zeros((2, len(t.length), WIDTH), np.int64)
    order = np.argsort(t.tf, kind="stable")  # where coordinates meet, the last and largest stays
    for row, at in zip(out, coordinates(t.term[order]), strict=True):
        row[t.doc[order], at] = t.tf[order]
    return out


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Items:
    """A block of items: the distinct terms of all, and each item's own with repeats."""

    def __init__(self, rows: list[tuple[object, bytes]]) -> None:
        t = terms([text for _, text in rows])
        self.known, self.place = np.unique(t.term, return_inverse=True)
        edges = t.edges
        self.own = [(self.place[a:b], t.tf[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
        self.ids = [key for key, _ in rows]

    def weigh(self, total: int, df: np.ndarray) -> None:
        weight = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(n) + 1))) for n in df], np.int64)
        self.weights = [weight[at] * times for at, times in self.own]
        self.matrix = np.zeros((len(self.known), len(self.own)))
        for i, (at, _) in enumerate(self.own):
            self.matrix[at, i] = self.weights[i]


class Best:
    """The best documents of each item so far, of one task."""

    def __init__(self, items: Items, total: int, words: int, depth: int) -> None:
        self.items, self.total, self.words, self.depth = items, total, words, depth
        self.found: list[list[tuple[int, tuple, object]]] = [[] for _ in items.own]
        self.rescored = 0

    def floor(self, item: int) -> int:
        """Documents bounded below this can no longer be among the best."""
        found = self.found[item]
        return found[-1][0] if len(found) == self.depth else 1

    def see(self, keys: list, t: Terms) -> None:
        m = 25 + (75 * t.length.astype(np.int64) * self.total) // max(self.words, 1)
        rows, edges = sketches(t), t.edges
        one, two = coordinates(self.items.known)
        for low in range(0, len(m), ROWS):
            part = slice(low, low + ROWS)
            most = np.minimum(rows[0][part, one], rows[1][part, two])
            bounds = impact(most, m[part, None]).astype(float) @ self.items.matrix  # whole numbers below 2^53
            for i in range(len(self.items.own)):
                self._rescore(i, bounds[:, i], low, keys, t, edges, m)

    def _rescore(self, i: int, bounds: np.ndarray, low: int, keys: list, t: Terms, edges: np.ndarray, m: np.ndarray) -> None:
        some = np.flatnonzero(bounds >= self.floor(i))
        wanted, weights, found = self.items.known[self.items.own[i][0]], self.items.weights[i], self.found[i]
        for p in some[np.argsort(-bounds[some], kind="stable")].tolist():
            if bounds[p] < self.floor(i):
                break
            self.rescored += 1
            d = low + p
            own, tf = t.term[edges[d] : edges[d + 1]], t.tf[edges[d] : edges[d + 1]]
            at = np.searchsorted(own, wanted).clip(max=len(own) - 1)
            score = int((weights * impact(tf[at] * (own[at] == wanted), m[d])).sum())
            if score > 0:
                found.append((score, (keys[d] is None, keys[d] or 0), keys[d]))
                found.sort(key=lambda f: (-f[0], f[1]))
                del found[self.depth :]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, Terms]]:
    for batch in batches:
        for part in slices(batch):
            yield part.column(0).to_pylist(), terms([(x or "").encode() for x in part.column(1).to_pylist()])


def _counts(texts: DataFrame, known: np.ndarray) -> tuple[int, int, np.ndarray]:
    """N, L and the df of known terms: every task adds up its own, then Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents, words, df = 0, 0, np.zeros(len(known), np.int64)
        for _, t in _parts(batches):
            documents += int((t.length > 0).sum())
            words += int(t.length.sum())
            if len(known):
                p = np.searchsorted(known, t.term).clip(max=len(known) - 1)
                df += np.bincount(p[known[p] == t.term], minlength=len(known))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict(
            {"place": pa.array([-2, -1, *at.tolist()], pa.int64()), "n": pa.array([documents, words, *df[at].tolist()], pa.int64())}
        )

    sums = texts.mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    found = {r["place"]: r["n"] for r in sums.collect()}  # one row a term of the block
    return found.get(-2, 0), found.get(-1, 0), np.array([found.get(i, 0) for i in range(len(known))], np.int64)


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple[object, bytes]]]:
    """Items in blocks of bounded size, read one by one."""
    block, size = [], 0
    for r in items.select(F.col(key).alias("key"), F.col(text).alias("text")).toLocalIterator():
        data = (r["text"] or "").encode()
        block.append((r["key"], data))
        size += len(data) + 64
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(
    documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", depth: int = DEPTH,
) -> DataFrame:
    """item key, rank, key, score: the `depth` best documents of every item, all with a score
    above 0 if there are fewer."""
    key_type, item_type = documents.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    texts = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    spark = documents.sparkSession
    schema = f"item {item_type}, place long, doc {key_type}, score long"
    empty = spark.createDataFrame([], schema)

    def one_block(number: int, rows: list[tuple[object, bytes]]) -> DataFrame:
        block = Items(rows)
        total, words, df = _counts(texts, block.known)
        block.weigh(total, df)
        known = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = Best(known.value, total, words, depth)
            for keys, t in _parts(batches):
                best.see(keys, t)
            rows = [(best.items.ids[i], i, key, score) for i, found in enumerate(best.found) for score, _, key in found]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], schema=fields)

        fields = to_arrow_schema(empty.schema)
        return texts.mapInArrow(run, schema).withColumn("block", F.lit(number))

    found = [one_block(i, rows) for i, rows in enumerate(_blocks(items, item_key, item_text))]
    if not found:
        return spark.createDataFrame([], f"{item_key} {item_type}, rank int, {key} {key_type}, score long")
    order = Window.partitionBy("block", "place").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= depth)
    return ranked.select(F.col("item").alias(item_key), "rank", F.col("doc").alias(key), "score")
