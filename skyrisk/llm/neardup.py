"""Near-duplicate documents by a MinHash LSH forest.

Every distinct shingle set has one signature and, in each tree of the forest, a path: its
minimum hashes from another position on. The paths of a tree are sorted; sets that share the
first `ROOT` hashes form a region, and the longer a path two sets share, the nearer they stand.
All of a small region are compared by sketches of their signatures. In a large one each set
first meets its next neighbours in the order and the set at the end of the most trodden path;
the range partitions split regions of any size, and pieces of a region are first tied together
by their first, last and central sets. Candidates are verified on full shingle sets of the
texts: first each set's best candidate, then every candidate whose ends are not connected yet.

What is then still apart in a large or split region is compared whole (`_settled`): first, in
rounds, with the members nearest to a sample of those apart, wherever in the region they stand
and whatever their ids (the original of a group of near copies); then, when that links little
more, block by block, each set with all members of other components. So a group of thousands
costs a few comparisons per member, and only sets that link with nothing meet the whole region.

Links have an exact similarity of at least `percent` hundredths. Cases: null and empty texts
have no shingles, link with nothing and stay; copies with equal sets form one class from the
start; a key with several texts has a row for each, in the class of that text; rows with a
null key take no part and stay, with a null component; ties between heads of a class go to the
smallest key, then to the least digest of the text; an empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyrisk.llm import hashing
from skyrisk.llm.components import components
from skyrisk.llm.shared import landed, small
from skyrisk.llm.texts import slices

TREES, ROOT, DEPTH = 24, 4, 8
HASHES = TREES * ROOT
SMALL, AHEAD = 12, 1  # size of a region compared at once; neighbours met first in larger ones
BLOCK = 512  # members of a region that a task compares with as many others
NEAREST, SAMPLE = 8, 32  # members that all of a region meet in a round; those that choose them
# Sketches hold four bits of each hash. A pair at the least similarity falls below the bound
# by five standard deviations or not at all.
SKETCH_DEVIATIONS = 5.0

_rng = np.random.default_rng(10)
_A = _rng.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum of every hash function over a non-empty set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, np.uint32(0xFFFFFFFF))
    for i in range(0, len(x), 1 << 14):
        out = np.minimum(out, (_A[:, None] * x[None, i : i + (1 << 14)] + _B[:, None]).min(1))
    return out


def _tag(text: str) -> Column:
    """Tells the texts of a repeated key apart, null from empty included."""
    return F.md5(F.coalesce(F.concat(F.lit("t"), F.col(text)), F.lit("")).cast("binary"))


def described(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """key, tag of the text, n (set size), digest of the set, signature; the last two are null
    for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                n, digests, signatures = [], [], []
                for t in part.column(1):
                    s = hashing.shingles(t.as_buffer().to_pybytes() if t.is_valid else b"", size)
                    n.append(len(s))
                    digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    signatures.append(signature(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
                    ["key", "tag", "n", "digest", "signature"],
                )

    schema = "key long, tag string, n long, digest binary, signature binary"
    return df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), _tag(text).alias("tag")).mapInArrow(run, schema)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per set and tree: path, and a sketch of the signature."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            m = part.num_rows
            s = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(m, HASHES)
            low = (s & 15).astype(np.uint8)
            sketch = low[:, ::2] << 4 | low[:, 1::2]
            path = np.stack([np.roll(s, -ROOT * t, 1)[:, :DEPTH] for t in range(TREES)], 1).astype(">u4")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.tile(np.arange(TREES, dtype=np.int32), m)),
                    _fixed(np.ascontiguousarray(path).view(np.uint8).reshape(m * TREES, 4 * DEPTH)),
                    pa.array(np.repeat(part.column(0).to_numpy(), TREES)),
                    _fixed(np.repeat(sketch, TREES, 0)),
                ],
                ["tree", "path", "id", "sketch"],
            )


def _fixed(rows: np.ndarray) -> pa.Array:
    """Binary values of equal length from a matrix of bytes."""
    n, size = rows.shape
    offsets = np.arange(n + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _central(path: np.ndarray) -> int:
    """The row at the end of the most trodden path."""
    rows = np.arange(len(path))
    for d in range(ROOT, DEPTH):
        values, inverse, counts = np.unique(path[rows, d], return_inverse=True, return_counts=True)
        rows = rows[inverse == counts.argmax()]
    return int(rows[0])


def _similar(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity estimated from sketches, in [0, 1]."""
    d = a ^ b
    same = ((d & 15) == 0).sum(-1) + ((d >> 4) == 0).sum(-1)
    return (same / HASHES - 1 / 16) * 16 / 15


def _candidates(least: float):
    """Candidate pairs of sorted rows. Kind 0 is a pair; kind 1 hands the first, the last and
    the central row of a partition's piece of a region on, for `_seams`; kind 2 is a region, or
    a piece of one, that was not compared whole, with its size in `a`."""

    def pairs_of(path: np.ndarray, ids: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = len(ids)
        if m <= SMALL:
            i, j = np.triu_indices(m, 1)
        else:
            steps = [(np.arange(m - s), np.arange(s, m)) for s in range(1, min(AHEAD, m - 1) + 1)]
            steps.append((np.arange(m), np.full(m, _central(path))))
            i, j = (np.concatenate(x) for x in zip(*steps, strict=True))
        parts = range(0, len(i), 1 << 14)
        ok = np.concatenate([_similar(sketch[i[p : p + (1 << 14)]], sketch[j[p : p + (1 << 14)]]) >= least for p in parts]) & (ids[i] != ids[j])
        i, j = ids[i[ok]], ids[j[ok]]
        return np.minimum(i, j), np.maximum(i, j)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        first = True
        for tree, path, ids, sketch, last in _regions(batches, held):
            if len(ids) > 1:
                a, b = pairs_of(path, ids, sketch)
                if len(a):
                    yield _pairs(a, b)
            if first or last or len(ids) > SMALL:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([2], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([1], pa.int64()), pa.array(tree[:1]),
                        _fixed(np.ascontiguousarray(path[:1].astype(">u4")).view(np.uint8).reshape(1, -1)), pa.nulls(1, pa.binary()),
                    ],
                    ["kind", "a", "b", "tree", "path", "sketch"],
                )
            if first or last:
                ends = [0, _central(path), len(ids) - 1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([1] * 3, pa.int32()), pa.array(ids[ends]), pa.array(ids[ends]), pa.array(tree[ends]),
                        _fixed(np.ascontiguousarray(path[ends].astype(">u4")).view(np.uint8).reshape(3, -1)), _fixed(sketch[ends]),
                    ],
                    ["kind", "a", "b", "tree", "path", "sketch"],
                )
            first = False

    return run


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(len(a), np.int32)), pa.array(a), pa.array(b), pa.nulls(len(a), pa.int32()), none, none],
        ["kind", "a", "b", "tree", "path", "sketch"],
    )


def _regions(batches: Iterator[pa.RecordBatch], held: list) -> Iterator[tuple]:
    """Regions of a sorted partition, in order; the last is marked."""

    def unpack(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        path = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u4").reshape(-1, DEPTH).astype(np.uint32)
        sketch = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        return batch.column(0).to_numpy(), path, batch.column(2).to_numpy(), sketch

    rest: tuple[np.ndarray, ...] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = unpack(batch)
        if rest is not None:
            rows = tuple(np.concatenate(x) for x in zip(rest, rows, strict=True))
        tree, path = rows[0], rows[1]
        new = (tree[1:] != tree[:-1]) | (path[1:, :ROOT] != path[:-1, :ROOT]).any(1)
        edges = np.r_[0, np.flatnonzero(new) + 1]
        for a, b in zip(edges, edges[1:], strict=False):
            # Lone sets have no candidates, but the first of a partition may belong to a region before.
            if b - a > 1 or a == 0:
                yield (*(x[a:b] for x in rows), False)
        rest = tuple(x[edges[-1] :] for x in rows)
    if rest is not None:
        yield (*rest, True)


def _seams(least: float):
    """Pairs among rows handed on, in the order of the forest: neighbours of one region."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, path, ids, sketch, _ in _regions(batches, []):
            for step in range(1, 4):
                if len(ids) > step:
                    i, j = np.arange(len(ids) - step), np.arange(step, len(ids))
                    ok = (_similar(sketch[i], sketch[j]) >= least) & (ids[i] != ids[j])
                    a, b = ids[i[ok]], ids[j[ok]]
                    if len(a):
                        yield _pairs(np.minimum(a, b), np.maximum(a, b))

    return run


PAIR = "kind int, a long, b long, tree int, path binary, sketch binary"


def _least(percent: int) -> float:
    """Estimates of pairs that may link are at least this."""
    p = percent / 100
    agree = 1 / 16 + p * 15 / 16
    return p - SKETCH_DEVIATIONS * float(np.sqrt(agree * (1 - agree) / HASHES)) * 16 / 15


def _forest(sets: DataFrame) -> DataFrame:
    return sets.select("id", "signature").mapInArrow(_paths, "tree int, path binary, id long, sketch binary")


def _region() -> Column:
    return F.xxhash64("tree", F.substring("path", 1, 4 * ROOT)).alias("region")


def candidates(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(a, b, votes): pairs of ids of `sets` (id, signature), and the trees that met them; and
    the regions of which not all pairs were looked at."""
    least = _least(percent)
    ordered = _forest(sets).repartitionByRange("tree", "path", "id").sortWithinPartitions("tree", "path", "id")
    found = landed(ordered.mapInArrow(_candidates(least), PAIR), "candidates")
    # A few rows per partition of the forest, whatever the number of documents; the pieces of a
    # region meet again in one task.
    ends = found.where("kind = 1").select("tree", "path", "a", "sketch").repartition(_region()).sortWithinPartitions("tree", "path", "a")
    seams = ends.mapInArrow(_seams(least), PAIR)
    pairs = found.where("kind = 0").select("a", "b").unionByName(seams.select("a", "b")).groupBy("a", "b").agg(F.count("*").alias("votes"))
    pieces = found.where("kind = 2").groupBy(_region()).agg(F.sum("a").alias("n"), F.sum("b").alias("pieces"))
    return pairs, pieces.where((F.col("n") > SMALL) | ((F.col("pieces") > 1) & (F.col("n") > 1))).select("region")


def _members(column: pa.Array, i: int) -> tuple[np.ndarray, ...]:
    """Ids, components, set sizes and signatures of the members in one row."""
    ids, component, n, signature = column[i].values.flatten()
    s = np.frombuffer(b"".join(signature.to_pylist()), np.uint32).reshape(-1, HASHES)
    return ids.to_numpy(), component.to_numpy(), n.to_numpy(), s


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of each block that agree most with the sample of their region."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, component, n, s = _members(batch.column("m"), i)
            sample = _members(batch.column("sample"), i)[3]
            agree = sum((s == x).sum(1) for x in sample)
            best = np.lexsort((ids, -agree))[:NEAREST]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(best), batch.column("region")[i].as_py())), pa.array(agree[best].astype(np.int64)), pa.array(ids[best]),
                    pa.array(component[best]), pa.array(n[best]), _fixed(np.ascontiguousarray(s[best]).view(np.uint8)),
                ],
                ["region", "agree", "id", "component", "n", "signature"],
            )


def _maybe(m: tuple[np.ndarray, ...], other: tuple[np.ndarray, ...], least: float, percent: int, tree: int | None) -> tuple[np.ndarray, ...]:
    """Pairs between two groups of members that may link and are in different components, with
    the hashes they share. With `tree`, only those that share no region of a tree before."""
    ids, component, n, s = m
    ids_2, component_2, n_2, s_2 = other
    found = []
    for i in range(len(ids)):
        at = np.flatnonzero((component_2 != component[i]) & (100 * np.minimum(n_2, n[i]) >= percent * np.maximum(n_2, n[i])))
        same = s_2[at] == s[i]
        votes = same.sum(1)
        ok = votes >= least * HASHES
        if tree is not None and ok.any():
            ok[ok] = same[ok].reshape(-1, TREES, ROOT).all(2).argmax(1) == tree
        at, votes = at[ok], votes[ok]
        found.append((np.minimum(ids_2[at], ids[i]), np.maximum(ids_2[at], ids[i]), votes))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _between(least: float, percent: int):
    """Pairs between the members `m` and `other` of a row that may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a, b, votes = _maybe(_members(batch.column("m"), row), _members(batch.column("other"), row), least, percent, None)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(votes.astype(np.int64))], ["a", "b", "votes"])

    return run


def _packed(least: float, percent: int):
    """All such pairs of a row in one row, the likeliest first, and the members they are of. The
    name of the row tells its two blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                tree = batch.column("tree")[row].as_py()
                a, b, votes = _maybe(_members(batch.column("m"), row), _members(batch.column("other"), row), least, percent, tree)
                if len(a):
                    order = np.argsort(-votes, kind="stable")
                    ids = np.unique(np.r_[a, b])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("cell").slice(row, 1), pa.array([a[order].tobytes()], pa.binary()), pa.array([b[order].tobytes()], pa.binary()),
                            pa.array([ids.tolist()], pa.list_(pa.int64())),
                        ],
                        ["cell", "a", "b", "ids"],
                    )

    return run


def _forested(percent: int):
    """Links that connect what the pairs of a row connect: a pair is verified on the full sets
    unless links of the row connect its ends already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                members = batch.column("sets")[row].values
                sets = {i: np.frombuffer(x.as_buffer(), np.uint64) for i, x in zip(members.field("id").to_pylist(), members.field("shingles"), strict=True)}
                above = {i: i for i in sets}

                def root(i: int) -> int:
                    while above[i] != i:
                        above[i] = above[above[i]]
                        i = above[i]
                    return i

                links = []
                for i, j in zip(*(np.frombuffer(batch.column(c)[row].as_buffer(), np.int64).tolist() for c in ("a", "b")), strict=True):
                    p, q = root(i), root(j)
                    if p != q:
                        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                        if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                            above[p] = q
                            links.append((i, j))
                if links:
                    x, y = zip(*links, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    return run


def _shingled(known: DataFrame, size: int) -> DataFrame:
    """id and sorted shingles, as bytes, of texts (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = [hashing.shingles(t.as_buffer().to_pybytes(), size).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["id", "shingles"])

    return known.mapInArrow(run, "id long, shingles binary")


@lru_cache(maxsize=64)
def _set_of(text: bytes, size: int) -> np.ndarray:
    return hashing.shingles(text, size)


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar enough; texts has (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (_set_of(v.as_buffer().to_pybytes(), size) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            part = batch.select([0, 1])
            yield part.filter(pa.array(keep, pa.bool_()))

    one = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _linked(pairs: DataFrame, links: DataFrame | None, known: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The links with those among the pairs (a, b, votes), and the components of all of them.
    Pairs whose ends are connected by then are not looked at."""
    ends = landed(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ends")
    texts = landed(known.join(small(ends), "id"), "texts")
    best = (
        pairs.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("o")), F.struct(F.col("b").alias("v"), F.col("a").alias("o")))).alias("x"), "votes")
        .groupBy("x.v").agg(F.max(F.struct("votes", -F.col("x.o"))).alias("m"))
        .select(F.least("v", -F.col("m.col2")).alias("a"), F.greatest("v", -F.col("m.col2")).alias("b")).distinct()
    )
    first = landed(verified(best, texts, size, percent), "first_links")
    links = first if links is None else links.unionByName(first)
    joined = components(links)
    label = lambda side: joined.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
    apart = (
        pairs.join(label("a"), "a", "left").join(label("b"), "b", "left")
        .select("a", "b", F.coalesce("c_a", "a").alias("c_a"), F.coalesce("c_b", "b").alias("c_b")).where("c_a != c_b")
    )
    second = landed(verified(apart, texts, size, percent), "second_links")
    if second.isEmpty():
        return links, joined
    links = links.unionByName(second)
    return links, components(links)


def _blocks(members: DataFrame, joined: DataFrame, sets: DataFrame) -> tuple[DataFrame, int]:
    """The regions that hold several components, as rows of at most about `BLOCK` members:
    those of the region's largest component, and those apart from it; and how many are apart."""
    named = landed(
        members.join(joined.withColumnRenamed("node", "id"), "id", "left").select("region", "tree", "id", F.coalesce("component", "id").alias("component")),
        "named",
    )
    sizes = named.groupBy("region", "component").agg(F.count("*").alias("n"))
    most = sizes.groupBy("region").agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("size")).where("size > most.n")
    most = landed(most.select("region", F.col("most.component").alias("largest"), F.col("most.n").alias("inside"), (F.col("size") - F.col("most.n")).alias("outside")), "contested")
    apart = F.col("component") != F.col("largest")
    n_blocks = F.ceil(F.when(apart, F.col("outside")).otherwise(F.col("inside")) / BLOCK)
    rows = named.join(small(most), "region").select("region", "tree", apart.alias("apart"), F.pmod(F.xxhash64("id"), n_blocks).alias("block"), "id", "component")
    blocks = rows.join(sets.select("id", "n", "signature"), "id").groupBy("region", "tree", "apart", "block").agg(
        F.collect_list(F.struct("id", "component", "n", "signature")).alias("m")
    )
    return landed(blocks, "blocks"), most.agg(F.sum("outside")).first()[0] or 0


def _settled(links: DataFrame, joined: DataFrame, regions: DataFrame, sets: DataFrame, known: DataFrame, size: int, percent: int) -> DataFrame:
    """The components once all pairs of the regions are linked, unlike or connected."""
    least = _least(percent)
    roots = _forest(sets).select(_region(), "tree", "id")
    members = landed(roots.join(small(landed(regions, "regions")), "region"), "members")
    before = None
    while True:
        blocks, apart = _blocks(members, joined, sets)
        if not apart:
            return joined
        if before is not None and 10 * apart > 9 * before:
            break
        before = apart
        # Blocks are dealt by a hash of the id, so one of them is a sample.
        sample = blocks.where("apart AND block = 0").select("region", F.slice("m", 1, SAMPLE).alias("sample"))
        near = blocks.join(sample, "region").select("region", "m", "sample").mapInArrow(
            _nearest, "region long, agree long, id long, component long, n long, signature binary"
        )
        rank = F.row_number().over(Window.partitionBy("region").orderBy(F.desc("agree"), "id"))
        nearest = near.withColumn("rank", rank).where(F.col("rank") <= NEAREST).groupBy("region").agg(
            F.collect_list(F.struct("id", "component", "n", "signature")).alias("other")
        )
        met = blocks.where("apart").join(landed(nearest, "nearest"), "region").select("tree", "m", "other")
        pairs = met.mapInArrow(_between(least, percent), "a long, b long, votes long").groupBy("a", "b").agg(F.max("votes").alias("votes"))
        links, joined = _linked(landed(pairs, "pairs"), links, known, size, percent)
    # Each block of those apart with every other block; a pair of blocks is a task's row.
    names = blocks.select("region", "apart", "block")
    one, two = names.where("apart").select("region", "block"), names.select("region", F.col("apart").alias("apart_2"), F.col("block").alias("block_2"))
    both = landed(one.join(two, "region").where("NOT apart_2 OR block_2 >= block"), "block_pairs")
    left = blocks.where("apart").select("region", "tree", "block", "m")
    right = blocks.select("region", F.col("apart").alias("apart_2"), F.col("block").alias("block_2"), F.col("m").alias("other"))
    cell = F.concat_ws(" ", "region", "block", "apart_2", "block_2").alias("cell")
    met = both.join(left, ["region", "block"]).join(right, ["region", "apart_2", "block_2"]).select("tree", cell, "m", "other")
    packed = landed(met.mapInArrow(_packed(least, percent), "cell string, a binary, b binary, ids array<long>"), "packed")
    # The full sets of the members that pairs are left of, once for each pair of blocks.
    needed = landed(packed.select("cell", F.explode("ids").alias("id")), "needed")
    texts = known.join(small(landed(needed.select("id").distinct(), "ends")), "id").select("id", "text")
    shingled = landed(_shingled(texts, size), "shingles")
    cells = needed.join(shingled, "id").groupBy("cell").agg(F.collect_list(F.struct("id", "shingles")).alias("sets"))
    found = landed(packed.drop("ids").join(cells, "cell").mapInArrow(_forested(percent), "a long, b long"), "last_links")
    return joined if found.isEmpty() else components(links.unionByName(found))


def _classes(rows: DataFrame) -> tuple[DataFrame, bool]:
    """One row for equal sets: digest, id, signature, n, and the least key and tag among its
    rows; and whether any key has several texts. The id is that key or, if it has several
    texts, a hash."""
    whole = rows.where("key IS NOT NULL AND digest IS NOT NULL")
    least = F.min(F.struct("key", "tag", "signature", "n")).alias("least")
    classes = whole.groupBy("digest").agg(least).select("digest", F.col("least.key").alias("head"), F.col("least.tag").alias("head_tag"), "least.signature", "least.n")
    several = landed(whole.groupBy("key").agg((F.min("tag") != F.max("tag")).alias("several")).where("several").select(F.col("key").alias("_head")), "several")
    if several.isEmpty():
        return landed(classes.withColumn("id", F.col("head")), "classes"), False
    own = F.when(F.col("_head").isNull(), F.col("head")).otherwise(F.xxhash64("head", "digest"))
    return landed(classes.join(several, F.col("head") == F.col("_head"), "left").withColumn("id", own).drop("_head"), "classes"), True


def _joined(df: DataFrame, key: str, text: str, size: int, percent: int) -> tuple[DataFrame, DataFrame, bool]:
    """Rows (key, tag, n, id and component of the class, its head and head_tag), the classes with
    their components, and whether ids may differ from keys."""
    rows = landed(described(df, key, text, size), "sets")
    sets, renamed = _classes(rows)
    pairs, regions = candidates(sets, percent)
    # A set is verified on the text of its head.
    heads = sets.select("id", F.col("head").alias("key"), F.col("head_tag").alias("tag"))
    texts = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    if renamed:
        known = texts.withColumn("tag", _tag("text")).join(heads, ["key", "tag"]).select("id", "text")
    else:
        known = texts.select(F.col("key").alias("id"), "text")
    links, joined = _linked(landed(pairs, "pairs"), None, known, size, percent)
    final = _settled(links, joined, regions, sets, known, size, percent)
    named = sets.select("digest", "id", "head", "head_tag").join(final.select(F.col("node").alias("id"), "component"), "id", "left")
    named = named.withColumn("component", F.coalesce("component", "id"))
    return rows.drop("signature").join(named, "digest", "left"), named, renamed


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """key, n_shingles, component_id (smallest key reachable by links), kept (is it that one?)."""
    rows, classes, renamed = _joined(df, key, text, size, percent)
    if renamed:
        smallest = classes.groupBy("component").agg(F.min("head").alias("smallest"))
        rows = rows.join(smallest, "component", "left")
    else:
        rows = rows.withColumn("smallest", F.col("component"))
    component = F.when(F.col("key").isNotNull(), F.coalesce("smallest", "key"))
    out = rows.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `df` that stay when each group keeps one text: that of the smallest key, where
    that key heads one class. Repeated rows of a key and text stay once, the first by their
    columns; rows that are in no group, having no shingles or no key, stay."""
    rows = _joined(df, key, text, size, percent)[0].where("key IS NOT NULL")
    first = (F.col("id") == F.col("component")) & (F.col("key") == F.col("head")) & (F.col("tag") == F.col("head_tag"))
    stays = F.coalesce(first, F.col("id").isNull())
    found = landed(rows.groupBy("key", "tag").agg(F.max(stays).alias("stays"), F.count("*").alias("times")).where("NOT stays OR times > 1"), "decided")
    on = (F.col(key).cast("long") == F.col("_key")) & (_tag(text) == F.col("_tag"))
    named = [F.col("key").alias("_key"), F.col("tag").alias("_tag")]
    left = df.join(small(found.select(*named)), on, "left_anti")
    again = found.where("stays").select(*named)
    if again.isEmpty():
        return left
    repeated = df.join(small(again), on, "left_semi")
    order = Window.partitionBy(key, _tag(text)).orderBy(F.to_json(F.struct(*df.columns)))
    return left.unionByName(repeated.withColumn("_place", F.row_number().over(order)).where("_place = 1").select(*df.columns))
