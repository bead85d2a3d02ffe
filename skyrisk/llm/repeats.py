"""Repeated byte strings by a sampled, distributed suffix array.

A string of `length` bytes that occurs twice has the same anchors in both places: positions
whose run of a quarter of it has the least hash among all runs of some window of that
length. So it is enough to sort the suffixes that begin at anchors, and to look a bounded way
back. Anchors whose run is unique in the corpus cannot lie in a repeated string and go first;
counting them takes one aggregation. The suffixes of each remaining run are ordered by
deep-shallow sorting (see `sorting`). For a suffix, its neighbours in that order share the
longest continuations; with the common bytes before the anchor they tell how far repeated
strings reach to either side.

Surroundings of an anchor (all windows that hold its run) that occur as a whole elsewhere need
no comparison: they are told by two 64-bit hashes, of the run and of all their bytes, counted
before the shuffle, and one of each kind stands for all. Only surroundings of their own are
brought together and sorted, with one of each kind. Where a run has more than `HOT` kinds it is not brought together: the windows
are taken apart by where they begin, into parts whose windows share a longer core, and treated
likewise under the core; hot cores are taken apart again, down to single windows, whose core is
the window itself. So no task ever holds a hot group. Surroundings that come again within one
text, as where a text repeats a word for long, are one row if their spans touch.

Positions are bytes of UTF-8. Matches stay within a text but may overlap. Equal texts are one
text with several rows: if long enough, all their bytes are repeated. Null and empty texts,
and texts shorter than `length`, have no repeats. Texts of any length are handled whole; repeated rows are equal texts; null keys are like any other;
an empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyrisk.llm import hashing
from skyrisk.llm.shared import landed, small
from skyrisk.llm.sorting import common, sort_groups
from skyrisk.llm.texts import slices

HOT = 1024  # kinds of surroundings of one run, or of one core, that one task compares
PARTS = 16  # parts that the windows around a hot anchor are taken apart into
AGAIN = 4  # parts that the windows of a hot core are taken apart into


def _run(length: int) -> int:
    """Bytes of an anchor's run."""
    return max(1, length // 4)


def _sliding(a: np.ndarray, size: int, best: np.ufunc) -> np.ndarray:
    """Least or greatest value of every run of `size` values."""
    n = len(a) - size + 1
    blocks = np.pad(a, (0, -len(a) % size), mode="edge").reshape(-1, size)
    up = best.accumulate(blocks, axis=1).ravel()
    down = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(down[:n], up[size - 1 : size - 1 + n])


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the runs that are least in some window of `length` bytes."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = hashing.grams(data, _run(length))
    window = length - _run(length) + 1
    least = _sliding(h, window, np.minimum)
    at = np.flatnonzero(_sliding(np.pad(least, window - 1), window, np.maximum) == h)
    return at, h[at]


COVER_TYPES = (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
COVER_NAMES = ["cover", "tid", "pos", "last", "n", "low", "high"]
COVER = "cover long, tid binary, pos int, last int, n int, low int, high int"


def _covers(length: int):
    """Anchors with the hash of the bytes around them: all windows that hold the anchor's run.
    The hash depends on how the text's ends cut them. Anchors of a text with the same run and
    hash whose spans touch are one row, from `pos` to `last`."""
    back = length - _run(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out: tuple[list, ...] = ([], [], [], [], [], [], [], [])
                for tid, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    data = text.as_buffer().to_pybytes() if text.is_valid else b""
                    chains: dict[tuple[int, int], list] = {}  # the open row of each run and hash
                    for pos, h in zip(*(x.tolist() for x in _signed(*anchors(np.frombuffer(data, np.uint8), length))), strict=True):
                        low, high = max(0, length - len(data) + pos), min(back, pos)
                        cover = _digest(data[pos - high : pos - low + length], low, b"cover")
                        chain = chains.get((h, cover))
                        if chain and pos - high <= chain[4] - low + length:
                            chain[4], chain[5] = pos, chain[5] + 1
                        else:
                            if chain:
                                _put(out, chain)
                            chains[h, cover] = [h, cover, tid, pos, pos, 1, low, high]
                    for chain in chains.values():
                        _put(out, chain)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), *COVER_TYPES), strict=True)], ["run", *COVER_NAMES])

    return run


def _signed(at: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return at, h.view(np.int64)


def _put(columns: tuple[list, ...], row: list | tuple) -> None:
    for column, value in zip(columns, row, strict=True):
        column.append(value)


def _contexts(length: int):
    """The bytes around each spot of a text, and how many of them come before it."""
    back = length - _run(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 18):
                out: tuple[list, ...] = ([], [], [], [], [], [], [], [])
                for tid, text, spots in zip(*(part.column(i) for i in range(3)), strict=True):
                    data, owner = text.as_buffer().to_pybytes(), tid.as_py()
                    for s in spots.as_py():
                        a = max(0, s["pos"] - back)
                        row = (s["run"], s["covers"], owner, s["pos"], s["low"], s["high"], s["pos"] - a, data[a : s["pos"] + length])
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                types = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], CONTEXT_NAMES)

    return run


def extents(contexts: list[tuple[int, bytes]], low: list[int], high: list[int], order: list[int], length: int) -> list[tuple[int, int] | None]:
    """For contexts (bytes before the anchor, bytes) of one run, in suffix order: the furthest
    beginning and the nearest one, as offsets before the anchor, of windows shared with
    another context; None without one. Offsets lie between `low` and `high`."""
    m = len(order)
    after = [contexts[i][1][contexts[i][0] :] for i in order]
    before = [contexts[i][1][: contexts[i][0]][::-1] for i in order]
    shared = np.array([common(a, b) for a, b in zip(after, after[1:], strict=False)], np.int64)
    # The common bytes before two anchors, likewise, in the order of what comes before.
    by_before = sorted(range(m), key=before.__getitem__)
    rank = np.empty(m, np.int64)
    rank[by_before] = np.arange(m)
    shared_before = np.array([common(before[i], before[j]) for i, j in zip(by_before, by_before[1:], strict=False)], np.int64)
    least, most = np.array(low)[order], np.array(high)[order]
    out: list[tuple[int, int] | None] = [None] * m
    for k, i in enumerate(order):
        right, left = _shared_with(shared, k), _shared_with(shared_before, rank[k])[rank]
        lo = np.maximum(np.maximum(least, least[k]), length - np.minimum(right, length))
        hi = np.minimum(np.minimum(most, most[k]), left)
        fits = lo <= hi
        fits[k] = False
        if fits.any():
            out[i] = (int(hi[fits].max()), int(lo[fits].min()))
    return out


def _shared_with(shared: np.ndarray, k: int) -> np.ndarray:
    """Bytes that the `k`-th of sorted strings has in common with each, from those of neighbours."""
    out = np.empty(len(shared) + 1, np.int64)
    out[k] = np.iinfo(np.int64).max
    np.minimum.accumulate(shared[k:], out=out[k + 1 :])
    np.minimum.accumulate(shared[:k][::-1], out=out[:k][::-1])
    return out


def _compare(length: int):
    """Sort the suffixes of every group and give the span of repeated windows around each."""

    def spans(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows).combine_chunks()
        group = t.column("run").to_numpy()
        off, low, high = (t.column(c).to_pylist() for c in ("off", "low", "high"))
        ctx = t.column("ctx").to_pylist()
        order = sort_groups([c[o:] for c, o in zip(ctx, off, strict=True)], group)
        edges = np.r_[np.flatnonzero(np.r_[True, group[1:] != group[:-1]]), len(group)]
        found: list[int] = []
        start: list[int] = []
        end: list[int] = []
        pos = t.column("pos").to_pylist()
        for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
            if b - a > 1:
                own = (order[a:b] - a).tolist()
                for i, e in enumerate(extents(list(zip(off[a:b], ctx[a:b], strict=True)), low[a:b], high[a:b], own, length), a):
                    if e:
                        found.append(i)
                        start.append(pos[i] - e[0])
                        end.append(pos[i] - e[1] + length)
        tid = t.column("tid").combine_chunks().take(pa.array(found, pa.int64()))
        tid = tid.combine_chunks() if isinstance(tid, pa.ChunkedArray) else tid
        return pa.RecordBatch.from_arrays([tid, pa.array(start, pa.int64()), pa.array(end, pa.int64())], ["tid", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                part = batch.slice(at, 4000)
                group = part.column(0).to_numpy()
                cut = np.flatnonzero(group != group[-1])
                last = int(cut[-1]) + 1 if len(cut) else 0
                if held and (last or held[-1].column(0)[-1].as_py() != group[-1]):
                    # What is held ends within the part, at the latest where its last group begins.
                    yield spans([*held, part.slice(0, last)])
                    held = []
                elif last:
                    yield spans([part.slice(0, last)])
                held.append(part.slice(last))
        if held:
            yield spans(held)

    return run


def _cores(length: int, step: int):
    """A row per part of `step` windows around a hot anchor: hashes of the bytes common to all
    windows of the part, and of all bytes they cover in this text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                out: tuple[list, ...] = ([], [], [], [], [], [], [], [], [], [])
                for tid, pos, off, ctx, first, until in zip(*(batch.slice(at, 500).column(i).to_pylist() for i in range(6)), strict=True):
                    least = max(0, length - (len(ctx) - off))
                    for a in range(first, until + 1, step):
                        b = min(a + step - 1, until)
                        low, high = max(a, least), min(b, off)
                        if low <= high:
                            core, cover = ctx[off - a : off - b + length], ctx[off - high : off - low + length]
                            _put(out, (_digest(core, a, b"core"), _digest(cover, low, b"cover"), tid, pos, pos, 1, low, high, a, b))
                types = (pa.int64(), *COVER_TYPES, pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["core", *COVER_NAMES, "first", "until"])

    return run


CONTEXT_NAMES = ["run", "covers", "tid", "pos", "low", "high", "off", "ctx"]
CONTEXT = "run long, covers long, tid binary, pos int, low int, high int, off int, ctx binary"


def _digest(data: bytes, salt: int, kind: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8, salt=salt.to_bytes(4), person=kind).digest(), signed=True)


def _told(rows: DataFrame, by: str, name: str) -> DataFrame:
    """Rows with the number of rows that have the same cover, and of covers of the same `by`."""
    rows = landed(rows, name).withColumn("place", F.xxhash64("tid", "pos"))
    covers = landed(rows.groupBy(by, "cover").agg(F.sum("n").alias("alike"), F.min("place").alias("least")), f"{name}_covers")
    # Tables of their own, so that a hot key's part of a join can be split.
    kinds = landed(
        covers.groupBy(by).agg(F.count("*").alias("covers"), F.max("alike").alias("most")).where("covers > 1 OR most > 1").select(by, "covers"),
        f"{name}_kinds",
    )
    known = landed(covers.join(kinds, by), f"{name}_known")
    return landed(rows.join(known, [by, "cover"]), f"{name}_told")


def _whole(told: DataFrame, length: int) -> DataFrame:
    """Spans of surroundings that are found elsewhere as a whole."""
    return told.where("alike > 1").select(
        "tid", (F.col("pos") - F.col("high")).cast("long").alias("start"), (F.col("last") - F.col("low") + length).cast("long").alias("end")
    )


OPEN = "covers > 1 AND (alike = 1 OR place = least)"  # what is compared: the others, and one of each kind


def _hot_spans(hot: DataFrame, length: int) -> DataFrame:
    """(tid, start, end) of the repeated windows around hot anchors."""
    back = length - _run(length)
    step = -(-(back + 1) // PARTS)
    surroundings = hot.select("tid", "pos", "off", "ctx")
    parts = surroundings.withColumns({"first": F.lit(0), "until": F.lit(back)})
    found = []
    while True:
        told = _told(parts.mapInArrow(_cores(length, step), f"core long, {COVER}, first int, until int"), "core", "cores")
        found.append(_whole(told, length))
        if step == 1:  # the cores are the windows, of one kind each
            break
        open_ = told.where(OPEN)
        few = open_.where(F.col("covers") <= HOT).select(F.col("core").alias("run"), "tid", "pos", "low", "high")
        found.append(_compared(few.join(surroundings, ["tid", "pos"]), length))
        many = landed(open_.where(F.col("covers") > HOT).select("tid", "pos", "first", "until"), "hot_cores")
        if many.isEmpty():
            break
        parts = surroundings.join(many, ["tid", "pos"]).select("tid", "pos", "off", "ctx", "first", "until")
        step = -(-step // AGAIN)
    return reduce(DataFrame.unionByName, found)


def _compared(rows: DataFrame, length: int) -> DataFrame:
    ordered = rows.select("run", "tid", "pos", "low", "high", "off", "ctx").repartition("run").sortWithinPartitions("run")
    return ordered.mapInArrow(_compare(length), "tid binary, start long, end long")


def _with_texts(texts: DataFrame, spots: DataFrame) -> DataFrame:
    """(tid, text, spots) of the texts that have spots. One row stands for equal texts: copies
    meet before the shuffle already. Texts without spots are ruled out where they are read."""
    spots = landed(spots, "spots")
    chosen = texts.join(small(spots.select("tid")), "tid", "left_semi")
    return chosen.groupBy("tid").agg(F.min("text").alias("text")).join(spots, "tid").select("tid", "text", "spots")


def spans(df: DataFrame, text: str = "text", length: int = 400) -> DataFrame:
    """(tid, start, end): byte spans of repeated strings, by the MD5 of the text. Spans of a
    text may overlap; together they cover its repeated bytes, but for those of equal texts."""
    texts = df.select(F.unhex(F.md5(F.col(text).cast("binary"))).alias("tid"), F.col(text).cast("binary").alias("text")).where("text IS NOT NULL")
    found = landed(texts.mapInArrow(_covers(length), f"run long, {COVER}"), "anchors")
    owner, again = F.xxhash64("tid", "pos"), F.max(F.col("n") > 1).alias("again")
    repeated = landed(found.groupBy("run").agg(F.min(owner).alias("a"), F.max(owner).alias("b"), again).where("a != b OR again").select("run"), "repeated")
    # Copies of a text have equal rows.
    told = _told(found.join(repeated, "run", "left_semi").dropDuplicates(["run", "cover", "tid", "pos"]), "run", "runs")
    spot = F.struct("pos", "run", "low", "high", "covers")
    open_ = told.where(OPEN).groupBy("tid").agg(F.collect_set(spot).alias("spots"))
    contexts = landed(_with_texts(texts, open_).mapInArrow(_contexts(length), CONTEXT), "contexts")
    compared = _compared(contexts.where(F.col("covers") <= HOT), length)
    return _whole(told, length).unionByName(compared).unionByName(_hot_spans(contexts.where(F.col("covers") > HOT), length))


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = 400) -> DataFrame:
    """key, n_bytes, removed (array of start, end: maximal runs), kept (the other bytes)."""
    key_type = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text")).withColumn("tid", F.unhex(F.md5("text")))
    found = spans(df, text, length).groupBy("tid").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    copies = rows.groupBy("tid").agg(F.count("*").alias("copies")).where("copies > 1")
    touched = landed(found.join(copies, "tid", "full").select("tid", "spans", F.col("copies").isNotNull().alias("copied")), "touched")
    tids = small(touched.select("tid"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for part in slices(batch):
                sizes, removed, kept = [], [], []
                for data, covered, copied in zip(*(part.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                    pieces = [(0, len(data))] if copied and len(data) >= length else sorted((s["start"], s["end"]) for s in covered or [])
                    joined: list[list[int]] = []
                    for a, b in pieces:
                        if joined and a <= joined[-1][1]:
                            joined[-1][1] = max(joined[-1][1], b)
                        else:
                            joined.append([a, b])
                    at, left = 0, []
                    for a, b in joined:
                        left.append(data[at:a])
                        at = b
                    sizes.append(len(data))
                    removed.append([{"start": a, "end": b} for a, b in joined])
                    kept.append(b"".join([*left, data[at:]]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(removed, run_type), pa.array(kept, pa.binary())], [key, "n_bytes", "removed", "kept"])

    # Texts without repeats are not shuffled.
    changed = rows.join(tids, "tid", "left_semi").join(touched, "tid").select("key", "text", "spans", "copied")
    same = rows.join(tids, "tid", "left_anti").select("key", "text", F.lit(None).cast(touched.schema["spans"].dataType).alias("spans"), F.lit(False).alias("copied"))
    known = changed.unionByName(same)
    return known.mapInArrow(run, f"{key} {key_type}, n_bytes long, removed array<struct<start:long,end:long>>, kept binary")


def digests(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = 400, texts: bool = False) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256 of every row; with `texts` also what is kept,
    as kept_text (what a cut leaves of a character is replaced)."""
    total = F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    kept = [F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text")] if texts else []
    return without_repeats(df, key, text, length).select(
        key, "n_bytes", total.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), *kept
    )
