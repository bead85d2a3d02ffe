"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order. In every block of vectors, each pivot
has an inverted file of the vectors that count it among their nearest `LENGTH`, with the place
it takes there. A query opens the files of its own nearest pivots and adds up how far places
differ (the footrule; a pivot that one side lacks counts as if it came last). The best share
of a block is reranked by exact distances, the best of all blocks are the answer.

Queries and vectors meet in lanes of both, of bounded size, so that a task holds one lane of each
at a time; a vector travels once for each lane of queries and a query once for each lane of
vectors, as rows. A lane's blocks are indexed where they meet its queries, and only the best of
the lane leave. Equal vectors of a block are one entry with several ids. Pivots are a bounded sample
(the smallest id hashes); every vector is indexed. `RERANK` is a share, so it grows with the
table; recall against brute force is measured in the tests and the README.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do those
of another length than most of the pivots. Of repeated ids the least vector counts. Ties go to
the smaller id. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyrisk.llm.shared import landed

PIVOTS, LENGTH = 256, 96
BLOCK = 4096
LANES = 64  # of vectors, as long as none has to be longer than `LANE` for it, or shorter than a block
LANE, QUERY_LANE = 16 * BLOCK, 16384
RERANK = 0.08


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): one non-zero vector of finite numbers per id, doubles unless they come as floats."""
    kind = "array<float>" if dict(df.dtypes)[vector] == "array<float>" else "array<double>"
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast(kind).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ok = F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    return rows.where(ok).groupBy("id").agg(F.min("v").alias("v"))


def permutations(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The nearest pivots of each row, nearest first, ties to the first pivot."""
    d = (pivots * pivots).sum(1)[None] - 2 * (x @ pivots.T)
    m = min(LENGTH, len(pivots))
    return np.argsort(d, axis=1, kind="stable")[:, :m].astype(np.int16)


class InvertedFiles:
    """The files of one block: for every pivot, how far each entry's place is from coming last,
    zero where an entry does not count the pivot among its nearest."""

    def __init__(self, perms: np.ndarray, n_pivots: int) -> None:
        self.n, self.m = perms.shape
        # Sums of the common part of two permutations are at most m (m + 1) / 2.
        self.files = np.zeros((n_pivots, self.n), np.int16 if self.m < 255 else np.int32)
        self.files[perms, np.arange(self.n)[:, None]] = self.m - np.arange(self.m)

    def footrules(self, perm: np.ndarray) -> np.ndarray:
        """Footrule distance of a query's permutation to every entry. Without common pivots it is
        the largest; each common pivot lowers it by twice the lesser distance from the last place."""
        m = self.m
        common = np.minimum(self.files[perm], (m - np.arange(m, dtype=self.files.dtype))[:, None])
        return m * (m + 1) - 2 * common.sum(0, dtype=self.files.dtype).astype(np.int32)


def search_block(queries: tuple[np.ndarray, np.ndarray, np.ndarray], ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, k: int) -> list[tuple]:
    """(query, id, distance) of the nearest k found in one block for each query, given as ids,
    vectors and permutations."""
    qids, q, perms = queries
    distinct, inverse = np.unique(x, axis=0, return_inverse=True)
    by = np.lexsort((ids, inverse.ravel()))
    start = np.searchsorted(inverse.ravel()[by], np.arange(len(distinct) + 1))
    files = InvertedFiles(permutations(distinct, pivots), len(pivots))
    least = min(len(distinct), max(4 * k, int(np.ceil(RERANK * len(distinct)))))
    out = []
    for qid, v, perm in zip(qids.tolist(), q, perms, strict=True):
        footrule = files.footrules(perm)
        near = np.argpartition(footrule, least - 1)[:least] if least < len(distinct) else np.arange(len(distinct))
        d = np.sqrt(((distinct[near] - v) ** 2).sum(1))
        found: list[tuple[float, int]] = []
        for i in np.argsort(d, kind="stable"):
            if len(found) > k and d[i] > found[k][0]:
                break
            members = ids[by[start[near[i]] : start[near[i] + 1]][: k + 1]]
            found += [(float(d[i]), int(j)) for j in members if j != qid]
        out += [(qid, j, s) for s, j in sorted(found)[:k]]
    return out


def _vectors(table: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a lane, by id."""
    lane = table.select(["id", "v"]).combine_chunks()
    ids = lane.column("id").to_numpy()
    x = pa.concat_arrays([c.flatten() for c in lane.column("v").chunks]).to_numpy().astype(np.float64).reshape(-1, size)
    by = np.argsort(ids, kind="stable")
    return ids[by], x[by]


def search_lane(queries: tuple[np.ndarray, np.ndarray], ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Queries, ids and distances of the nearest k found in any block of a lane for each query."""
    best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    n_blocks, asked = max(1, -(-len(ids) // BLOCK)), (*queries, permutations(queries[1], pivots))
    for part in range(n_blocks):
        found = search_block(asked, ids[part::n_blocks], x[part::n_blocks], pivots, k)
        new = [np.array(c, a.dtype) for c, a in zip(zip(*found, strict=True), best, strict=True)] if found else best
        q, i, d = (np.concatenate([a, b]) for a, b in zip(best, new, strict=True)) if found else best
        by = np.lexsort((i, d, q))
        q, i, d = q[by], i[by], d[by]
        start = np.flatnonzero(np.r_[True, q[1:] != q[:-1]][: len(q)])
        rank = np.arange(len(q)) - np.repeat(start, np.diff(np.r_[start, len(q)]))
        best = [c[rank < k] for c in (q, i, d)]
    return tuple(best)


def search(df: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 100, k: int = 10) -> DataFrame:
    """query_id, rank, the key, score (Euclidean distance): the nearest found for every row
    whose key is divisible by `every`, among all other rows."""
    spark = df.sparkSession
    rows = landed(usable(df, key, vector), "vectors")
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(4 * PIVOTS).collect()
    schema = f"query_id long, rank int, {key} long, score double"
    if not sample:
        return spark.createDataFrame([], schema)
    size = Counter(len(r["v"]) for r in sample).most_common(1)[0][0]
    pivots = np.array(list(dict.fromkeys(tuple(r["v"]) for r in sample if len(r["v"]) == size))[:PIVOTS])
    alike = rows.where(F.size("v") == size)
    asked = alike.where(F.col("id") % every == 0)
    n, n_asked = alike.count(), asked.count()
    n_lanes, n_query_lanes = -(-n // min(LANE, max(BLOCK, -(-n // LANES)))), max(1, -(-n_asked // QUERY_LANE))

    def dealt(rows: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int").alias(own)
        return rows.select("id", "v", mine, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other))

    lanes = dealt(alike, "lane", n_lanes, "queries", n_query_lanes).groupBy("lane", "queries")
    asks = dealt(asked, "queries", n_query_lanes, "lane", n_lanes).groupBy("lane", "queries")

    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not (vectors.num_rows and queries.num_rows):
            found = ([], [], [])
        else:
            found = search_lane(_vectors(queries, size), *_vectors(vectors, size), pivots, k)
        types = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(found, types, strict=True)], ["query_id", key, "score"])

    found = lanes.cogroup(asks).applyInArrow(run, f"query_id long, {key} long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", key)).cast("int")
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", key, "score")
