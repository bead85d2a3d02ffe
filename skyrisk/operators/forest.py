"""Random forests whose trees are grown and asked in tasks.

The estimator takes Spark's parameters and grows what Spark's does: Poisson bootstraps, binned
inputs, the best Gini gain among some inputs of each node, nodes split down to `maxDepth` or pure
leaves; a node in which these inputs are constant tries more, until one is not. Where the nodes lie differs. Spark's driver holds every node of the trees that grow, and
every level is a job whose tasks each send a histogram of every node. Here nodes of more than
`LOCAL_ROWS` rows are split level by level from summed histograms; the rows of any smaller node are
dealt to one task, which grows all that is below it and writes it. The driver holds the nodes above
those only.

Draws hang on the row and the tree, tried inputs on the path to the node: where a node is split,
and how rows are partitioned, changes nothing of it but the last digits of sums.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier as Parameters
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.util import DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyrisk.sources.shared import fresh_folder, ship, stored

LOCAL_ROWS = 200_000  # rows of a node whose subtree one task grows
ASKED_BYTES = 32 << 20  # nodes sent to all tasks at once, at most, unless one part has more
LEAST_GAIN = 1e-8  # what is below comes from rounding

PACKED = np.dtype([("id", "<i8"), ("weight", "<f8"), ("label", "u1"), ("count", "u1")])
NODES = "tree int, node int, feature binary, cut binary, below binary, votes binary, gains array<double>"


# --- One node and what is below it -------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """64 bits that look drawn by lot, the same for the same input (splitmix64)."""
    x = np.atleast_1d(x).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def root_keys(seed: int, trees: int) -> np.ndarray:
    return mixed(mixed(np.array([seed & (2**64 - 1)], np.uint64)) + np.arange(trees, dtype=np.uint64))


def child_keys(keys: np.ndarray) -> np.ndarray:
    """Keys of the left and right child of each node, side by side."""
    return np.stack([mixed(keys ^ np.uint64(1)), mixed(keys ^ np.uint64(2))], axis=1).ravel()


_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 20)]))


def draws(ids: np.ndarray, root: np.uint64) -> np.ndarray:
    """How often a tree draws each row: Poisson with mean 1."""
    u = (mixed(mixed(ids) ^ root) >> np.uint64(11)).astype(np.float64) * 2.0**-53
    return np.searchsorted(_POISSON, u, side="right").astype(np.uint8)


def lots(keys: np.ndarray, n_features: int) -> np.ndarray:
    """All inputs in the order in which each node tries them."""
    drawn = mixed(mixed(keys)[:, None] + np.arange(n_features, dtype=np.uint64)).reshape(len(keys), n_features)
    return np.argsort(drawn, axis=1, kind="stable")


def best_splits(
    node: np.ndarray, group: np.ndarray, sums: np.ndarray, counts: np.ndarray, total: np.ndarray, size: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray]:
    """Best gain of each node, and the cell after which it is cut.

    Cells are sorted by node, by tried input (`group`, unique over nodes) and by bin, with the weight
    of each class in `sums` and rows in `counts`. `total` and `size` are those of the nodes.
    """
    first = np.r_[True, group[1:] != group[:-1]]
    of = np.cumsum(first) - 1
    all_sums, all_counts = np.cumsum(sums, axis=0), np.cumsum(counts)
    left = all_sums - (all_sums - sums)[first][of]
    n_left = all_counts - (all_counts - counts)[first][of]
    right, n_right = total[node] - left, size[node] - n_left
    w_left, w_right, whole = left.sum(1), right.sum(1), total.sum(1)
    ok = (n_left >= least) & (n_right >= least) & (w_left > 0) & (w_right > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        score = (left * left).sum(1) / w_left + (right * right).sum(1) / w_right
    gain = np.where(ok, score, -np.inf) / whole[node] - ((total / whole[:, None]) ** 2).sum(1)[node]
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    best = np.maximum.reduceat(gain, starts)
    hits = np.flatnonzero(gain == best[node])
    return best, hits[np.r_[True, node[hits][1:] != node[hits][:-1]]]


@dataclass(frozen=True)
class Rules:
    """What ends a branch, and what a node may try."""

    classes: int
    bins: int
    tried: int
    max_depth: int
    least: int


@dataclass
class Nodes:
    """Nodes by number. A leaf has feature -1, its row of `votes` in `below`; any other node sends
    values up to `cut` to node `below`, larger ones to the next."""

    feature: np.ndarray
    cut: np.ndarray
    below: np.ndarray
    votes: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(rows):
            f = self.feature[at[rows]]
            rows, f = rows[f >= 0], f[f >= 0]
            now = at[rows]
            at[rows] = self.below[now] + (x[rows, f] > self.cut[now])
        return at


def _searched(
    bins: np.ndarray, label: np.ndarray, weight: np.ndarray, count: np.ndarray,
    rows: np.ndarray, at: np.ndarray, order: np.ndarray, total: np.ndarray, size: np.ndarray, rules: Rules,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best gain, input and cut of each node; `at` is the node of each row. A node tries the first
    inputs of its order; while all are constant in it, one more."""
    C, B, k = rules.classes, rules.bins, len(order)
    best, feature, cut = np.full(k, -np.inf), np.zeros(k, np.int8), np.zeros(k, np.int32)
    todo, low, high = np.arange(k), 0, rules.tried
    while len(todo) and low < order.shape[1]:
        picks = order[todo, low:high]
        m = picks.shape[1]
        code = ((at[:, None] * m + np.arange(m)) * B + bins[rows[:, None], picks[at]]).ravel()
        # Codes and places in one number: numbers alone sort several times faster than places by code.
        shift = len(code).bit_length()
        both = np.sort(code << shift | np.arange(len(code)))
        code, source = both >> shift, rows[(both & ((1 << shift) - 1)) // m]
        first = np.r_[True, code[1:] != code[:-1]]
        cell, code = np.cumsum(first) - 1, code[first]
        sums = np.bincount(cell * C + label[source], weight[source], len(code) * C).reshape(-1, C)
        node, group = code // (m * B), code // B
        gain, chosen = best_splits(node, group, sums, np.bincount(cell, count[source]), total[todo], size[todo], rules.least)
        best[todo], feature[todo], cut[todo] = gain, picks[np.arange(len(todo)), code[chosen] // B % m], code[chosen] % B
        constant = np.bincount(node[1:][group[1:] == group[:-1]], minlength=len(todo)) == 0
        keep = constant[at]
        rows, at, todo = rows[keep], (np.cumsum(constant) - 1)[at[keep]], todo[constant]
        low, high = high, high + 1
    return best, feature, cut


def grow(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, count: np.ndarray, key: int, depth: int, rules: Rules) -> tuple[Nodes, np.ndarray]:
    """All nodes below one, level by level, with cuts in numbers of bins; and the gain of each input."""
    C, n_features = rules.classes, bins.shape[1]
    weight = weight * count
    rows, node, keys = np.arange(len(bins)), np.zeros(len(bins), np.int64), np.array([key], np.uint64)
    features, cuts, belows, votes, gains = [], [], [], [], np.zeros(n_features)
    k, base, n_leaves = 1, 0, 0
    while k:
        total = np.bincount(node * C + label[rows], weight[rows], k * C).reshape(k, C)
        size = np.bincount(node, count[rows], k)
        feature, cut, below = np.full(k, -1, np.int8), np.zeros(k, np.int32), np.zeros(k, np.int32)
        split = np.zeros(k, bool)
        live = ((total > 0).sum(1) > 1) & (depth < rules.max_depth)
        if live.any():
            use = live[node]
            order = lots(keys[live], n_features)
            best, feature[live], cut[live] = _searched(bins, label, weight, count, rows[use], (np.cumsum(live) - 1)[node[use]], order, total[live], size[live], rules)
            split[live] = best > LEAST_GAIN
            feature[~split] = -1
            gains += np.bincount(feature[split], best[best > LEAST_GAIN] * total[split].sum(1), n_features)
        leaf = ~split
        below[leaf] = n_leaves + np.arange(leaf.sum())
        below[split] = base + k + 2 * np.arange(split.sum())
        votes.append(total[leaf] / total[leaf].sum(1, keepdims=True))
        features.append(feature), cuts.append(cut), belows.append(below)
        go = split[node]
        rows, parent = rows[go], node[go]
        node = 2 * (np.cumsum(split) - 1)[parent] + (bins[rows, feature[parent]] > cut[parent])
        keys = child_keys(keys[split])
        n_leaves, base, k, depth = n_leaves + int(leaf.sum()), base + k, 2 * int(split.sum()), depth + 1
    return Nodes(*(np.concatenate(p) for p in (features, cuts, belows, votes))), gains


# --- Training rows ----------------------------------------------------------------------


@dataclass(frozen=True)
class Prepared:
    """Training rows in blocks, written once for all parts of a forest: each row's number, weight and
    label, and the bin of each input. A value is in the bin of the first cut that it does not exceed."""

    blocks: DataFrame
    cuts: Sequence[Sequence[float]]
    classes: int
    rows: int


def _cuts(rows: DataFrame, n_features: int, bins: int) -> list[list[float]]:
    """Where each input may be cut: between all its values if they are few, else at quantiles."""
    x = [F.col("x")[i] for i in range(n_features)]
    shares = F.array(*[F.lit((i + 1) / bins) for i in range(bins - 1)])
    seen = rows.agg(
        *[F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(x)],
        *[F.percentile_approx(c, shares, 10_000).alias(f"q{i}") for i, c in enumerate(x)],
        *[F.max(c).alias(f"m{i}") for i, c in enumerate(x)],
    ).first()
    few = [i for i in range(n_features) if seen[f"n{i}"] <= 2 * bins]
    values = rows.agg(*[F.sort_array(F.collect_set(x[i])).alias(f"v{i}") for i in few]).first() if few else {}
    out = []
    for i in range(n_features):
        if i in few and len(values[f"v{i}"]) <= bins:
            v = values[f"v{i}"]
            out.append([(a + b) / 2 for a, b in zip(v, v[1:], strict=False)])
        else:
            out.append([q for q in sorted(set(seen[f"q{i}"])) if q < seen[f"m{i}"]])
    return out


def prepared(df: DataFrame, features: str, label: str, weight: str | None, bins: int) -> Prepared:
    ship(df.sparkSession)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = stored(
        df.select(F.monotonically_increasing_id().alias("id"), vector_to_array(features).alias("x"), F.col(label).cast("int").alias("label"), w.alias("weight")),
        "forest_rows",
    )
    about = rows.agg(F.count(F.lit(1)).alias("n"), F.max("label").alias("top"), F.max(F.size("x")).alias("width")).first()
    cuts = _cuts(rows, about["width"], bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                packed = np.zeros(batch.num_rows, PACKED)
                for name in ("id", "label", "weight"):
                    packed[name] = batch.column(name).to_numpy(zero_copy_only=False)
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
                places = [np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(cuts)]
                yield _row([packed.tobytes()], [np.stack(places, axis=1).astype(np.uint8).tobytes()], names=["rows", "bins"])

    blocks = stored(rows.mapInArrow(run, "rows binary, bins binary"), "forest_blocks")
    return Prepared(blocks, cuts, max(2, about["top"] + 1), about["n"])


def _row(*values: list, names: Sequence[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in values], list(names))


def _blocks(batches: Iterator[pa.RecordBatch], n_features: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for rows, bins in zip(batch.column(0), batch.column(1), strict=True):
            yield np.frombuffer(rows.as_py(), PACKED), np.frombuffer(bins.as_py(), np.uint8).reshape(-1, n_features)


# --- Nodes of many rows, split level by level ----------------------------------------------


@dataclass
class Top:
    """The first nodes of a tree. A leaf here is a node whose subtree a task grows; `below` is its number."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    below: list[int] = field(default_factory=lambda: [0])
    keys: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=lambda: [0])
    gains: dict[int, float] = field(default_factory=dict)

    def nodes(self) -> Nodes:
        return Nodes(np.array(self.feature, np.int8), np.array(self.cut), np.array(self.below), np.zeros((0, 0)))

    def split(self, at: int, feature: int, cut: int, gain: float) -> list[int]:
        """Give a node two children; their numbers."""
        left = len(self.feature)
        self.feature[at], self.cut[at], self.below[at] = feature, cut, left
        self.gains[feature] = self.gains.get(feature, 0.0) + gain
        for child, key in zip((left, left + 1), child_keys(np.array([self.keys[at]], np.uint64)).tolist(), strict=True):
            self.feature.append(-1), self.cut.append(0), self.below.append(child)
            self.keys.append(key), self.depth.append(self.depth[at] + 1)
        return [left, left + 1]


def _tops(data: Prepared, roots: np.ndarray, rules: Rules) -> list[Top]:
    """Trees split until no node has more than `LOCAL_ROWS` rows, by a job a level."""
    m, C, B = len(data.cuts), rules.classes, rules.bins
    tops = [Top(keys=[int(r)]) for r in roots]
    wide = [(t, 0) for t in range(len(tops))] if data.rows > LOCAL_ROWS else []
    while wide:
        nodes = {t: tops[t].nodes() for t, _ in wide}
        place = {t: {at: i for i, (u, at) in enumerate(wide) if u == t} for t in nodes}
        picks = lots(np.array([tops[t].keys[at] for t, at in wide], np.uint64), m)

        def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((len(wide), m, B, C + 1))
            for rows, bins in _blocks(batches, m):
                for t, tree in nodes.items():
                    count = draws(rows["id"], roots[t])
                    number = np.full(len(tree.feature), -1)
                    number[list(place[t])] = list(place[t].values())
                    at = number[tree.leaves(bins)]
                    r = np.flatnonzero((at >= 0) & (count > 0))
                    at, weight, n = at[r], rows["weight"][r] * count[r], count[r].astype(float)
                    cell = (at[:, None] * m + np.arange(m)) * B + bins[r[:, None], picks[at]]
                    flat = sums.reshape(-1)
                    flat += np.bincount((cell * (C + 1) + rows["label"][r][:, None]).ravel(), np.repeat(weight, m), flat.size)
                    flat += np.bincount((cell * (C + 1) + C).ravel(), np.repeat(n, m), flat.size)
            for i in np.flatnonzero(sums.any(axis=(1, 2, 3))).tolist():
                yield _row(pa.array([i], pa.int32()), [sums[i].tobytes()], names=["wide", "sums"])

        def best(table: pa.Table) -> pa.Table:
            sums = sum(np.frombuffer(s.as_py()).reshape(m * B, C + 1) for s in table.column("sums"))
            total, size = sums[:B, :C].sum(0)[None], sums[:B, C].sum()[None]
            varied = (sums[:, C].reshape(m, B) > 0).sum(1) > 1
            gain, cell, left = -1.0, 0, 0.0
            if (total > 0).sum() > 1 and varied.any():
                # The first inputs, and as many more as it takes to find one that is not constant.
                last = max(rules.tried, int(np.argmax(varied)) + 1)
                full = np.flatnonzero(sums[: last * B, C] > 0)
                gains, cells = best_splits(np.zeros(len(full), int), full // B, sums[full, :C], sums[full, C], total, size, rules.least)
                gain, cell = float(gains[0]), int(full[cells[0]])
                left = float(sums[cell // B * B : cell + 1, C].sum())
            out = [[table.column("wide")[0].as_py()], [gain], [cell // B], [cell % B], [left], [float(size[0])], [float(total.sum())]]
            return pa.table(dict(zip(("wide", "gain", "slot", "cut", "low", "size", "total"), out, strict=True)))

        summed = data.blocks.mapInArrow(histograms, "wide int, sums binary").groupBy("wide")
        found = summed.applyInArrow(best, "wide long, gain double, slot long, cut long, low double, size double, total double").collect()
        after = []
        for r in sorted(found, key=lambda r: r["wide"]):
            t, at = wide[r["wide"]]
            if r["size"] > LOCAL_ROWS and r["gain"] > LEAST_GAIN and tops[t].depth[at] < rules.max_depth:
                children = tops[t].split(at, int(picks[r["wide"], r["slot"]]), int(r["cut"]), r["gain"] * r["total"])
                sizes = (r["low"], r["size"] - r["low"])
                after += [(t, c) for c, n in zip(children, sizes, strict=True) if n > LOCAL_ROWS]
        wide = after
    return tops


# --- The forest ---------------------------------------------------------------------------


def _grown(data: Prepared, tops: Sequence[Top], roots: np.ndarray, rules: Rules) -> DataFrame:
    """A row for each node below which a task grows the rest; its rows are dealt to one task."""
    n_features = len(data.cuts)
    nodes = [t.nodes() for t in tops]
    ends = [(t, at) for t, top in enumerate(tops) for at, f in enumerate(top.feature) if f < 0]
    number = {end: i for i, end in enumerate(ends)}
    keys, depths = [tops[t].keys[at] for t, at in ends], [tops[t].depth[at] for t, at in ends]
    cuts = np.zeros((n_features, rules.bins))
    for i, c in enumerate(data.cuts):
        cuts[i, : len(c)] = c

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bins in _blocks(batches, n_features):
            for t, tree in enumerate(nodes):
                count = draws(rows["id"], roots[t])
                at = np.where(count > 0, tree.leaves(bins), -1)
                for end in np.unique(at[at >= 0]).tolist():
                    r = np.flatnonzero(at == end)
                    drawn = rows[r].copy()
                    drawn["count"] = count[r]
                    yield _row(pa.array([number[t, end]], pa.int32()), [drawn.tobytes()], [bins[r].tobytes()], names=["number", "rows", "bins"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for n, block in zip(batch.column(0).to_pylist(), _blocks(iter([batch.select([1, 2])]), n_features), strict=True):
                held.setdefault(n, []).append(block)
        for n in sorted(held):
            parts = held.pop(n)
            rows, bins = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            by = np.argsort(rows["id"], kind="stable")
            rows, bins = rows[by], bins[by]
            tree, gains = grow(bins, rows["label"].astype(np.int64), rows["weight"], rows["count"].astype(np.int64), keys[n], depths[n], rules)
            value = np.where(tree.feature >= 0, cuts[tree.feature, tree.cut], 0.0)
            packed = [[a.tobytes()] for a in (tree.feature, value, tree.below, tree.votes)]
            yield _row(pa.array([ends[n][0]], pa.int32()), pa.array([ends[n][1]], pa.int32()), *packed, [gains.tolist()], names=[c.split()[0] for c in NODES.split(", ")])

    dealt = data.blocks.mapInArrow(deal, "number int, rows binary, bins binary").repartitionById(len(ends), "number")
    return dealt.mapInArrow(run, NODES)


def _roots_of(data: Prepared, tops: Sequence[Top]) -> list[dict]:
    """The first nodes of each tree: cuts are values, a leaf's `below` is the node of its subtree."""
    out = []
    for top in tops:
        value = [float(data.cuts[f][c]) if f >= 0 else 0.0 for f, c in zip(top.feature, top.cut, strict=True)]
        gains = [float(top.gains.get(i, 0.0)) for i in range(len(data.cuts))]
        out.append({"feature": top.feature, "cut": value, "below": top.below, "gains": gains})
    return out


class RandomForestClassifier(Parameters):
    """Spark's estimator by its parameters; it is fitted on rows, or on rows once `prepared`."""

    def _fit(self, dataset: DataFrame | Prepared) -> RandomForestClassificationModel:
        bins = self.getMaxBins()
        if bins > 256 or self.getFeatureSubsetStrategy() != "sqrt":
            raise ValueError("At most 256 bins, and as many tried inputs as the root of all")
        data = dataset
        if isinstance(dataset, DataFrame):
            weight = self.getWeightCol() if self.isSet("weightCol") else None
            data = prepared(dataset, self.getFeaturesCol(), self.getLabelCol(), weight, bins)
        spark = data.blocks.sparkSession
        ship(spark)
        width = len(data.cuts)
        rules = Rules(data.classes, bins, int(np.ceil(np.sqrt(width))), self.getMaxDepth(), self.getMinInstancesPerNode())
        roots = root_keys(self.getSeed(), self.getNumTrees())
        tops = _tops(data, roots, rules)
        path = fresh_folder(spark, "trees")
        _grown(data, tops, roots, rules).write.parquet(f"{path}/nodes")
        model = RandomForestClassificationModel(path)
        model.note = {"classes": data.classes, "inputs": width, "trees": _roots_of(data, tops)}
        model.keep_note(path)
        return model


@dataclass(frozen=True)
class Tree:
    """A whole tree: its first nodes, and what is below each of them."""

    top: Nodes
    subtrees: dict[int, Nodes]
    gains: np.ndarray

    def votes(self, x: np.ndarray) -> np.ndarray:
        """Shares of the classes in the leaf of each row."""
        start = self.top.below[self.top.leaves(x)]
        out = None
        for node, tree in self.subtrees.items():
            mine = np.flatnonzero(start == node)
            found = tree.votes[tree.below[tree.leaves(x[mine])]]
            out = np.zeros((len(x), tree.votes.shape[1])) if out is None else out
            out[mine] = found
        return out

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.gains / (self.gains.sum() or 1.0))

    @property
    def toDebugString(self) -> str:
        lines = [f"{'top':>4} {f} <= {c:g}, {b}" for f, c, b in zip(self.top.feature, self.top.cut, self.top.below, strict=True)]
        for node, tree in sorted(self.subtrees.items()):
            lines += [f"{node:>4} {f} <= {c:g}, {b}" for f, c, b in zip(tree.feature, tree.cut, tree.below, strict=True)]
        return "\n".join(lines)


class RandomForestClassificationModel(Model, MLWritable, MLReadable):
    """A forest in its folder. Its trees come to the driver only when they are asked for."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.path = path

    def nodes(self) -> DataFrame:
        return SparkSession.active().read.schema(NODES).parquet(f"{self.path}/nodes")

    @cached_property
    def note(self) -> dict:
        """Number of classes and inputs, and the first nodes of each tree."""
        return json.loads(SparkSession.active().read.text(f"{self.path}/note").first()["value"])

    def keep_note(self, path: str) -> None:
        SparkSession.active().range(1).select(F.lit(json.dumps(self.note)).alias("value")).coalesce(1).write.text(f"{path}/note")

    @property
    def numClasses(self) -> int:
        return self.note["classes"]

    @property
    def getNumTrees(self) -> int:
        return len(self.note["trees"])

    @property
    def trees(self) -> list[Tree]:
        none = np.zeros((0, self.numClasses))
        tops = [Nodes(np.array(r["feature"], np.int8), np.array(r["cut"]), np.array(r["below"], np.int32), none) for r in self.note["trees"]]
        gains, below = [np.array(r["gains"]) for r in self.note["trees"]], [{} for _ in tops]
        for r in sorted(self.nodes().toArrow().to_pylist(), key=lambda r: (r["tree"], r["node"])):
            feature, cut, found, votes = (np.frombuffer(r[c], kind) for c, kind in zip(("feature", "cut", "below", "votes"), (np.int8, np.float64, np.int32, np.float64), strict=True))
            below[r["tree"]][r["node"]] = Nodes(feature, cut, found, votes.reshape(-1, self.numClasses))
            gains[r["tree"]] = gains[r["tree"]] + np.array(r["gains"])
        return [Tree(*parts) for parts in zip(tops, below, gains, strict=True)]

    @property
    def importance_sums(self) -> list[float]:
        """Importances added up over the trees, each tree's adding up to one; no nodes are read for it."""
        gains = np.array([r["gains"] for r in self.note["trees"]])
        inputs = range(self.note["inputs"])
        for r in self.nodes().groupBy("tree").agg(*[F.sum(F.col("gains")[i]).alias(f"g{i}") for i in inputs]).collect():
            gains[r["tree"]] += [r[f"g{i}"] for i in inputs]
        whole = gains.sum(1, keepdims=True)
        return (gains / np.where(whole > 0, whole, 1.0)).sum(0).tolist()

    @property
    def featureImportances(self) -> DenseVector:
        sums = np.array(self.importance_sums)
        return DenseVector(sums / (sums.sum() or 1.0))

    def predictRaw(self, value: DenseVector) -> DenseVector:
        x = value.toArray()[None]
        return Vectors.dense(sum(t.votes(x)[0] for t in self.trees))

    def bytes(self) -> int:
        """Size of the nodes, unpacked."""
        parts = [F.length(c) for c in ("feature", "cut", "below", "votes")]
        return self.nodes().agg(F.sum(sum(parts[1:], parts[0]))).first()[0]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        total, best = F.aggregate("_votes", F.lit(0.0), lambda a, b: a + b), F.array_max("_votes")
        out = dataset.withColumn("_votes", voted([self])(vector_to_array("features")))
        return out.withColumns(
            {
                "rawPrediction": array_to_vector("_votes"),
                "probability": array_to_vector(F.transform("_votes", lambda v: v / total)),
                "prediction": (F.array_position("_votes", best) - 1).cast("double"),
            }
        ).drop("_votes")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, instance: RandomForestClassificationModel) -> None:
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, SparkSession.active())
        self.instance.nodes().write.parquet(f"{path}/nodes")
        self.instance.keep_note(path)


class _Reader(MLReader):
    def load(self, path: str) -> RandomForestClassificationModel:
        return RandomForestClassificationModel(path)


def voted(models: Sequence[RandomForestClassificationModel]) -> Callable[[Column], Column]:
    """From an array of inputs to the summed votes of some forests, whose nodes go to all tasks."""
    spark = SparkSession.active()
    ship(spark)
    sent = spark.sparkContext.broadcast([m.trees for m in models])

    @F.pandas_udf("array<double>")
    def votes(inputs: pd.Series) -> pd.Series:
        x = np.stack(inputs.to_numpy()) if len(inputs) else np.zeros((0, 0))
        parts = [sum(t.votes(x) for t in trees) for trees in sent.value if len(x)]
        return pd.Series(list(sum(parts)) if parts else [], dtype=object)

    return votes
