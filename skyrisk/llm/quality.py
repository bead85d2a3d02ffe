"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow trees are grown on bootstrap samples of labelled rows, every path to a node becomes
a rule (a conjunction of bounds on statistics), and a lasso logistic regression gives most
rules no weight. What remains is compiled into one Spark column expression, so that scoring
is a projection of the table: no shuffle, no Python.

The trees see a bounded sample of the labelled rows (`SAMPLE`, the smallest key hashes), the
statistics whole texts. Null and empty texts have statistics of zero and get a score like
any other; rows with a null label teach nothing; of repeated labels of a key the lowest
counts; without labelled rows every score is 0.5, with one class it is the smoothed share.
An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyrisk.llm.texts import held_out

SAMPLE = 20_000  # labelled rows that the trees and weights are fitted on, at most
TREES, DEPTH, LEAST_LEAF, CUTS = 24, 3, 20, 24
PENALTY = 0.002

UPPER, DIGITS, MARKS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#$%&*@~^=<>{}[]\\"


def _count(text: Column, characters: str) -> Column:
    """How many of these characters a text holds."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text, as expressions over the text alone."""
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(t), F.lit(1)).cast("double")
    words, lines = F.split(t, "[ \t\n\r]+"), F.split(t, "\n")
    share = lambda c: _count(t, c) / n
    return {
        "chars_log": F.log1p(F.length(t).cast("double")),
        "upper": share(UPPER),
        "digits": share(DIGITS),
        "marks": share(MARKS),
        "bangs": share("!?"),
        "bars": share("|"),
        "stops": share(".,;:"),
        "word_length": n / F.size(words),
        "distinct_words": F.size(F.array_distinct(words)) / F.size(words),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
        "words_log": F.log1p(F.size(words).cast("double")),
    }


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above?, bound), all of them hold


@dataclass(frozen=True)
class RuleModel:
    """Weights of rules; `names` are the statistics that rules refer to by position."""

    names: tuple[str, ...]
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, column: str = "`{}`") -> Column:
        """The probability of label 1, from columns with the names of the statistics."""
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for i, above, bound in rule:
                x = F.col(column.format(self.names[i]))
                holds = holds & ((x > bound) if above else (x <= bound))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _grow(x: np.ndarray, y: np.ndarray, path: Rule, rng: np.random.Generator, rules: set[Rule]) -> None:
    """Split at the bound that lowers the squared error most; every node is a rule."""
    if path:
        rules.add(tuple(sorted(path)))
    if len(path) == DEPTH or len(y) < 2 * LEAST_LEAF or y.min() == y.max():
        return
    best = (1e-9, -1, 0.0)
    for i in rng.permutation(x.shape[1])[: max(1, (x.shape[1] * 2 + 2) // 3)]:
        cuts = np.unique(np.quantile(x[:, i], np.linspace(0.02, 0.98, CUTS)))
        below = x[:, i][:, None] <= cuts
        n, s = below.sum(0), y @ below
        fits = (n >= LEAST_LEAF) & (len(y) - n >= LEAST_LEAF)
        if fits.any():
            gain = np.where(fits, s**2 / np.maximum(n, 1) + (y.sum() - s) ** 2 / np.maximum(len(y) - n, 1), 0) - y.sum() ** 2 / len(y)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), int(i), float(cuts[k]))
    _, i, bound = best
    if i >= 0:
        left = x[:, i] <= bound
        _grow(x[left], y[left], (*path, (i, False, bound)), rng, rules)
        _grow(x[~left], y[~left], (*path, (i, True, bound)), rng, rules)


def applies(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for i, above, bound in rule:
        out &= (x[:, i] > bound) if above else (x[:, i] <= bound)
    return out


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty on standardised columns, by accelerated
    proximal gradients; bias and weights for the columns as given. The columns stay as they
    are, in single precision: their means and deviations enter the products instead."""
    z = np.ascontiguousarray(z, np.float32)
    mean = z.mean(0, dtype=np.float64)
    std = np.sqrt(np.maximum((z * z).mean(0, dtype=np.float64) - mean**2, 0))
    scale = np.where(std > 1e-9, 1 / np.where(std > 1e-9, std, 1), 0)

    def ahead(v: np.ndarray) -> np.ndarray:
        return z @ (v * scale).astype(np.float32) - float(mean @ (v * scale))

    def back(error: np.ndarray) -> np.ndarray:
        return (z.T @ error.astype(np.float32) - mean * error.sum()) * scale

    v = np.ones(z.shape[1])
    largest = 0.0
    for _ in range(30):  # the largest eigenvalue, by powers
        v = back(ahead(v))
        largest = float(np.linalg.norm(v))
        v = v / max(largest, 1e-12)
    rate = 4 * len(y) / max(1.05 * largest, len(y))
    b = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    w = v = np.zeros(z.shape[1])
    t = 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(ahead(v) + b))) - y
        b -= rate * error.mean()
        new = v - rate * back(error) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v, w = new + (before - 1) / t * (new - w), new
    w = w * scale
    return b - float(mean @ w), w


def fit_rules(x: np.ndarray, y: np.ndarray, names: tuple[str, ...], seed: int = 7) -> RuleModel:
    """Grow trees, list their rules, weigh the rules."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return RuleModel(names, float(np.log(share / (1 - share))), ())
    rng = np.random.default_rng(seed)
    rules: set[Rule] = set()
    for _ in range(TREES):
        rows = rng.integers(0, len(y), len(y))
        _grow(x[rows], y[rows], (), rng, rules)
    # The shortest of rules that hold for the same rows.
    unique = {hashlib.sha256(applies(r, x)).digest(): r for r in sorted(rules, key=lambda r: (-len(r), r))}
    listed = sorted(unique.values())
    if not listed:
        return fit_rules(x, y[:0], names)
    bias, weights = lasso(np.column_stack([applies(r, x) for r in listed]), y, PENALTY)
    return RuleModel(names, bias, tuple((r, float(w)) for r, w in zip(listed, weights, strict=True) if abs(w) > 1e-4))


def labelled(documents: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(_key, _text, _label) of a bounded number of labelled rows that may teach. The bound on
    keys holds for the broadcast; repeated keys are bounded again by the caller."""
    known = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key, 3, 1))
        .groupBy(F.col(key).alias("_key")).agg(F.min(label).cast("double").alias("_label"))
        .orderBy(F.xxhash64("_key"), "_key").limit(sample)
    )
    texts = documents.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return texts.join(F.broadcast(known), "_key")


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text") -> RuleModel:
    """Learn from labelled rows outside the held-out third. The bounded sample of their
    statistics meets in one task, which grows the trees; the driver receives the rules."""
    rows = labelled(documents, labels, label, key, text)
    names = tuple(statistics(F.col("_text")))
    stats = rows.select("_key", "_label", *[c.alias(n) for n, c in statistics(F.col("_text")).items()])
    sample = stats.orderBy(F.xxhash64("_key"), *names).limit(SAMPLE).select("_label", *names).coalesce(1)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.column_stack([c.to_numpy() for c in b.columns]) for b in batches] or [np.zeros((0, 1 + len(names)))]
        got = np.concatenate(parts).astype(float)
        model = fit_rules(got[:, 1:], got[:, 0], names)
        yield pa.RecordBatch.from_pydict({"bias": [model.bias], "rules": [json.dumps(model.rules)]})

    # One row; no row at all, if the sample has no partition.
    found = sample.mapInArrow(learn, "bias double, rules string").collect()
    if not found:
        return fit_rules(np.zeros((0, len(names))), np.zeros(0), names)
    rules = tuple((tuple((i, above, bound) for i, above, bound in rule), weight) for rule, weight in json.loads(found[0]["rules"]))
    return RuleModel(names, found[0]["bias"], rules)


def score(documents: DataFrame, model: RuleModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, score, predicted of every row."""
    stats = documents.select(key, *[c.alias(f"_{n}") for n, c in statistics(F.col(text)).items()])
    scored = stats.select(key, held_out(key, 3, 1).alias("held_out"), model.score("`_{}`").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(documents: DataFrame, model: RuleModel, text: str = "text") -> DataFrame:
    """The rows whose score is at least 0.5, with their columns as they were."""
    names = documents.columns
    stats = documents.select(*names, *[c.alias(f"_stat_{n}") for n, c in statistics(F.col(text)).items()])
    return stats.where(model.score("`_stat_{}`") >= 0.5).select(*names)
