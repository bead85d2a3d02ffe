"""Benchmark decontamination by SimHash fingerprints of item-sized windows.

For every item, documents are seen through windows of as many words. Windows that share no
shingle with an item cannot be similar to it, so only windows around shared shingles are
fingerprinted. Item fingerprints are cut into blocks; two fingerprints within `RADIUS` bits
differ by at most RADIUS // BLOCKS bits in some block, so looking every block up with that
tolerance finds all of them. Each candidate is then verified: its shingles and the item's are
compared exactly, as multisets weighted by how rare a shingle is among the items.

Shingles have five words (all words of a shorter item); words are lower-case runs of letters
and digits. At the least similarity the distance exceeds the radius by chance about twice in
a million. Items travel to the tasks in blocks of bounded size, one pass over the documents
for each, so benchmarks of any size are handled.

Null and empty texts and items have no windows and never match. Repeated rows are reported
once per row, repeated items once per item; an empty table gives no rows; ties between windows
go to the first. Null keys are keys like any other: such rows are reported, and removed when
they hold an item. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from skyrisk.llm import hashing
from skyrisk.llm.texts import slices

SIZE, PERCENT = 5, 80
BITS, BLOCKS, RADIUS = 64, 8, 23
BLOCK_WORDS = 200_000  # words of the items that one pass carries

_BREAKS = np.array([not (chr(b).isalnum() if b < 128 else True) for b in range(256)])
_DISTANCE = np.array([[bin(a ^ b).count("1") for b in range(256)] for a in range(256)], np.uint8)


def word_hashes(text: str) -> np.ndarray:
    return hashing.words(text.lower().encode("utf-8", "replace"), _BREAKS)[0]


def _signs(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted signs of the bits of shingles, a row each."""
    bits = np.unpackbits(shingles.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return (bits.astype(np.float32) * 2 - 1) * weights[:, None]


def _fingerprint(sums: np.ndarray) -> np.ndarray:
    """Bytes of fingerprints from rows of summed signs."""
    return np.packbits(sums > 0, axis=1)


class Items:
    """Fingerprints, weights and inverted shingles of a block of items."""

    def __init__(self, rows: list[tuple[int, str]]) -> None:
        self.ids, self.length, self.own = [], [], []
        for key, text in rows:
            h = word_hashes(text or "")
            if len(h):
                self.ids.append(key)
                self.length.append(len(h))
                self.own.append(hashing.runs(h, min(SIZE, len(h))))
        owners = defaultdict(set)
        for i, s in enumerate(self.own):
            for x in s.tolist():
                owners[x].add(i)
        self.shingles = np.array(sorted(owners), np.uint64)
        self.owners = [sorted(owners[x]) for x in self.shingles.tolist()]
        n = max(len(self.ids), 1)
        self.rarity = np.log1p(n / np.array([len(o) for o in self.owners], float))
        self.unknown = float(np.log1p(n))
        self.counted = [self.weigh(s) for s in self.own]
        self.prints = [_fingerprint(_signs(s, self.weights(s)).sum(0, keepdims=True))[0] for s in self.own]
        # near[length][block][value]: which items of the length have a block so near the value.
        self.of_length: dict[int, np.ndarray] = {n: np.flatnonzero(np.array(self.length) == n) for n in set(self.length)}
        self.near = {
            n: np.stack([_DISTANCE[:, [self.prints[i][b] for i in members]] <= RADIUS // BLOCKS for b in range(BLOCKS)])
            for n, members in self.of_length.items()
        }

    def weights(self, shingles: np.ndarray) -> np.ndarray:
        if not len(self.shingles):
            return np.full(len(shingles), self.unknown)
        at = np.searchsorted(self.shingles, shingles).clip(max=len(self.shingles) - 1)
        return np.where(self.shingles[at] == shingles, self.rarity[at], self.unknown)

    def weigh(self, shingles: np.ndarray) -> dict[int, float]:
        """Total weight of each distinct shingle."""
        out: dict[int, float] = defaultdict(float)
        for x, w in zip(shingles.tolist(), self.weights(shingles).tolist(), strict=True):
            out[x] += w
        return out

    def similarity(self, shingles: np.ndarray, item: int) -> float:
        """Weighted Jaccard similarity of multisets."""
        one, two = self.weigh(shingles), self.counted[item]
        both = sum(min(w, two[x]) for x, w in one.items() if x in two)
        return both / (sum(one.values()) + sum(two.values()) - both)

    def matches(self, text: str, percent: int) -> list[tuple[int, float, int, int, int]]:
        """(item, similarity, first word, words, distance): the best window of each item found."""
        h = word_hashes(text)
        best: dict[int, tuple[float, int, int]] = {}
        for size in {min(SIZE, n) for n in self.of_length}:
            s = hashing.runs(h, size)
            if not len(s):
                continue
            at = np.searchsorted(self.shingles, s).clip(max=len(self.shingles) - 1)
            seeds = np.flatnonzero(self.shingles[at] == s)
            if not len(seeds):
                continue
            near: dict[int, set[int]] = defaultdict(set)  # items by the lengths that seeds call for
            for p in seeds.tolist():
                for i in self.owners[at[p]]:
                    if min(SIZE, self.length[i]) == size:
                        near[self.length[i]].add(p)
            for n, places in near.items():
                self._windows(s, n, size, np.array(sorted(places)), percent, best)
        return [(self.ids[i], sim, start, self.length[i], d) for i, (sim, start, d) in sorted(best.items())]

    def _windows(self, s: np.ndarray, n: int, size: int, seeds: np.ndarray, percent: int, best: dict) -> None:
        """Fingerprint the windows of `n` words that hold a seed, look them up, verify."""
        m = n - size + 1  # shingles of a window
        last = max(len(s) - m, 0)
        cuts = np.flatnonzero(np.diff(seeds) > m) + 1
        for group in np.split(seeds, cuts):
            a, b = max(group[0] - m + 1, 0), min(group[-1], last)
            for low in range(a, b + 1, 4096):
                high = min(low + 4095, b)
                part = s[low : high + m]
                sums = np.concatenate([np.zeros((1, BITS), np.float32), np.cumsum(_signs(part, self.weights(part)), 0, dtype=np.float64)])
                starts = np.arange(low, high + 1)
                ends = np.minimum(starts + m, len(s)) - low
                prints = _fingerprint(sums[ends] - sums[starts - low])
                table, members = self.near[n], self.of_length[n]
                found = np.zeros((len(prints), len(members)), bool)
                for block in range(BLOCKS):
                    found |= table[block][prints[:, block]]
                for w, k in zip(*np.nonzero(found), strict=True):
                    i = int(members[k])
                    distance = int(_DISTANCE[prints[w], self.prints[i]].sum())
                    if distance <= RADIUS:
                        start = int(starts[w])
                        sim = self.similarity(s[start : start + m], i)
                        if 100 * sim >= percent - 1e-9 and (i not in best or sim > best[i][0] + 1e-12):
                            best[i] = (sim, start, distance)


def _blocks(items: DataFrame, item_key: str, item_text: str) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of a bounded number of words, read one by one."""
    block, words = [], 0
    rows = items.select(F.col(item_key).alias("key"), F.col(item_text).alias("text")).where("text IS NOT NULL")
    for r in rows.toLocalIterator():
        block.append((r["key"], r["text"]))
        words += len(r["text"].split())
        if words >= BLOCK_WORDS:
            yield block
            block, words = [], 0
    if block:
        yield block


def leaks(
    documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", percent: int = PERCENT,
) -> DataFrame:
    """key, item, similarity, first_word, n_words, distance: for every document and item that
    have a similar enough window, the most similar one."""
    key_type, item_type = documents.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    schema = f"{key} {key_type}, {item_key} {item_type}, similarity double, first_word long, n_words long, distance int"
    texts = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def one_pass(block: list[tuple[int, str]]) -> DataFrame:
        known = documents.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Items(known.value)
            for batch in batches:
                for part in slices(batch):
                    rows, place = [], []
                    for p, t in enumerate(part.column(1)):
                        if t.is_valid and index.ids:
                            found = index.matches(t.as_py(), percent)
                            rows += found
                            place += [p] * len(found)
                    cols = list(zip(*rows, strict=True)) or [[]] * 5
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).take(pa.array(place, pa.int64())), pa.array(cols[0], known_type),
                            pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()),
                            pa.array(cols[4], pa.int32()),
                        ],
                        [key, item_key, "similarity", "first_word", "n_words", "distance"],
                    )

        known_type = to_arrow_type(items.schema[item_key].dataType)
        return texts.mapInArrow(run, schema)

    passes = [one_pass(b) for b in _blocks(items, item_key, item_text)]
    if not passes:
        return documents.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, passes)


def without_leaks(documents: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows that hold no item, with all their columns. Every task judges the texts it has,
    so that rows need no key, and none is shuffled."""

    def one_pass(rows: DataFrame, block: list[tuple[int, str]]) -> DataFrame:
        known = documents.sparkSession.sparkContext.broadcast(block)
        at = rows.columns.index(text)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Items(known.value)
            for batch in batches:
                clean = [not (t.is_valid and index.ids and index.matches(t.as_py(), PERCENT)) for t in batch.column(at)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return rows.mapInArrow(run, rows.schema)

    return reduce(one_pass, _blocks(items, item_key, item_text), documents)
