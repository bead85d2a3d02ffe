"""Toxicity by weak supervision.

Voters are words and word beginnings that stand out in documents marked toxic, a fixed list
of insults, and patterns over them (several different hits, dense hits, direct address, no
hit at all). A generative label model estimates from the votes, by expectation maximisation,
how often each voter fires in either class and how strongly voters depend on each other
within a class; the votes of dependent voters are discounted. A linear classifier is then
trained on the posterior labels. Scoring is one pass over the table without a shuffle.

Labels teach twice: they choose the terms, and they are one more voter of the label model.
Both use a bounded sample of labelled rows (`SAMPLE`, the smallest key hashes), with whole
texts. Null and empty texts get the score of a text without hits; rows with a null label
teach nothing; of repeated labels of a key the lowest counts; without labelled rows the fixed
list votes alone. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyrisk.llm.quality import labelled
from skyrisk.llm.texts import held_out, per_text, slices

SAMPLE = 12_000  # labelled rows that choose terms and train, at most
CANDIDATES, TERMS, LEAST_DOCUMENTS = 20_000, 160, 6
STARTS = (4, 5, 6, 8)  # lengths in bytes of word beginnings
TOXIC_AT = 0.7

# Insults that vote whatever the labels say.
INSULTS = tuple(
    b"idiot idiots moron morons stupid dumb fool fools loser losers trash garbage scum filth filthy clown pathetic"
    b" disgusting worthless useless vermin imbecile cretin bastard jerk creep".split()
)
ADDRESS = re.compile(rb"\b(?:you|your|u r|du|tu|vous|ihr)\b")
SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
BREAKS = bytes.maketrans(SIGNS, b" " * len(SIGNS))


def words_of(text: str) -> list[bytes]:
    """Lower-case words of a whole text; ASCII punctuation separates."""
    return text.lower().encode("utf-8", "replace").translate(BREAKS).split()


def terms_of(word: bytes) -> Iterator[bytes]:
    """The word itself (marked by a trailing space) and its beginnings."""
    yield word + b" "
    for n in STARTS:
        if len(word) >= n:
            yield word[:n]


class Lexicon:
    """Looks terms up in texts: most words are ruled out by their first bytes."""

    def __init__(self, terms: list[bytes]) -> None:
        self.place = {t: i for i, t in enumerate(terms)}
        self.heads = {t[: STARTS[0]] for t in terms}

    def hits(self, words: list[bytes]) -> Counter:
        """Position of each term found, with the number of words that have it."""
        first, place, out = STARTS[0], self.place, Counter()
        for w in [w for w in words if w[:first] in self.heads or w + b" " in place]:
            out.update(place[t] for t in terms_of(w) if t in place)
        return out


def _features(text: str, lexicon: Lexicon, n_terms: int) -> tuple[list[int], list[float]]:
    """Terms that a text has, and values of the pattern voters."""
    words = words_of(text)
    hits = lexicon.hits(words)
    found = [i for i in hits if i < n_terms]
    insults = [i for i in hits if i >= n_terms]
    most = max(hits.values(), default=0)
    addressed = bool(hits) and bool(ADDRESS.search(text.lower().encode("utf-8", "replace")))
    return found, [float(len(insults)), float(len(found)), 1000.0 * most / max(len(words), 50), float(addressed)]


def _table(found: list[list[int]], values: np.ndarray, n_terms: int) -> np.ndarray:
    """Feature rows: term indicators, then logs of the pattern values, then 'no hit'."""
    x = np.zeros((len(found), n_terms + 5))
    for r, f in enumerate(found):
        x[r, f] = 1
    if len(found):
        x[:, n_terms : n_terms + 4] = np.log1p(values)
        x[:, -1] = (values[:, 0] + values[:, 1]) == 0
    return x


def votes_of(x: np.ndarray, n_terms: int, gold: np.ndarray) -> np.ndarray:
    """1 toxic, -1 not, 0 abstains. Columns: terms, insults, several hits, dense hits, direct
    address, no hit, and the labels as a voter of their own."""
    insults, found, dense, addressed, none = x[:, n_terms:].T
    v = np.zeros((len(x), n_terms + 6), np.int8)
    v[:, :n_terms] = x[:, :n_terms] > 0
    v[:, n_terms] = insults > 0
    v[:, n_terms + 1] = found >= np.log1p(2)
    v[:, n_terms + 2] = dense >= np.log1p(8)
    v[:, n_terms + 3] = addressed > 0
    v[:, n_terms + 4] = -(none > 0).astype(np.int8)
    v[:, n_terms + 5] = np.where(np.isnan(gold), 0, np.where(gold > 0, 1, -1))
    return v


@dataclass
class LabelModel:
    """Rates at which voters vote for and against in either class, and their discounts."""

    prior: float
    rates: np.ndarray  # class x vote (against, for) x voter
    discount: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        ratio = np.log(self.rates[1] / self.rates[0]) * self.discount
        silent = np.log((1 - self.rates[1].sum(0)) / (1 - self.rates[0].sum(0))) * self.discount
        logit = np.log(self.prior / (1 - self.prior)) + (votes > 0) @ ratio[1] + (votes < 0) @ ratio[0] + (votes == 0) @ silent
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def fit_label_model(votes: np.ndarray, prior: float, rounds: int = 30) -> LabelModel:
    """Expectation maximisation, starting from the mean vote. The last voter are the labels.
    The other votes that vary together within a class count for less: m alike voters have
    the weight of the square root of m."""
    n, m = votes.shape
    model = LabelModel(prior, np.full((2, 2, m), 1 / 3), np.ones(m))
    strength = votes.clip(0, 1).sum(1) - 2.0 * votes.clip(-1, 0).__neg__().sum(1)
    p = 1 / (1 + np.exp(-np.clip(2.0 * strength + 6.0 * votes[:, -1], -30, 30)))
    for _ in range(rounds):
        weights = np.stack([1 - p, p])
        for sign, s in ((1, 1), (0, -1)):
            fired = weights @ (votes == s)
            model.rates[:, sign] = (fired + 0.5) / (weights.sum(1)[:, None] + 1.5)
        together = np.zeros((m, m))
        for w in weights:
            mean = w @ votes / max(w.sum(), 1e-9)
            d = votes - mean
            together += (d * w[:, None]).T @ d
        scale = np.sqrt(np.maximum(np.diag(together), 1e-9))
        related = (together / scale[:, None] / scale)[:-1, :-1]
        model.discount[:-1] = 1 / np.sqrt(np.where(related > 0.3, related, 0).sum(1).clip(1))
        model.prior = float(np.clip(0.5 * prior + 0.5 * p.mean(), 1e-3, 0.999))
        p = model.posterior(votes)
    return model


def fit_linear(x: np.ndarray, p: np.ndarray, steps: int = 400, ridge: float = 1e-3) -> tuple[float, np.ndarray]:
    """Logistic regression on soft labels by accelerated gradients."""
    scale = np.maximum(x.std(0), 0.05)
    s = np.column_stack([np.ones(len(x)), x / scale])
    rate = 4 * len(s) / max(np.linalg.norm(s.T @ s, 2), 1)
    w = v = np.zeros(s.shape[1])
    t = 1.0
    for _ in range(steps):
        g = s.T @ (1 / (1 + np.exp(-np.clip(s @ v, -50, 50))) - p) / len(s) + ridge * np.r_[0, v[1:]]
        new = v - rate * g
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v, w = new + (before - 1) / t * (new - w), new
    return float(w[0]), w[1:] / scale


@dataclass(frozen=True)
class ToxicityModel:
    terms: tuple[bytes, ...]
    bias: float
    weights: np.ndarray

    def lexicon(self) -> Lexicon:
        return Lexicon([*self.terms, *(w + b" " for w in INSULTS)])

    def scores(self, texts: list[str], lexicon: Lexicon) -> np.ndarray:
        n = len(self.terms)
        both = [_features(t, lexicon, n) for t in texts]
        x = _table([f for f, _ in both], np.array([v for _, v in both]).reshape(-1, 4), n)
        return 1 / (1 + np.exp(-np.clip(self.bias + x @ self.weights, -50, 50)))


def _count_terms(rows: DataFrame, known: frozenset[bytes] | None) -> DataFrame:
    """(term, toxic, clean): documents with the term, by class; all terms or known ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                counts = (Counter(), Counter())
                for text, label in zip(part.column("_text").to_pylist(), part.column("_label").to_pylist(), strict=True):
                    terms = {t for w in set(words_of(text or "")) for t in terms_of(w)}
                    counts[label > 0].update(terms if known is None else terms & known)
                terms = list(counts[0].keys() | counts[1].keys())
                yield pa.RecordBatch.from_pydict(
                    {
                        "term": pa.array(terms, pa.binary()),
                        "toxic": pa.array([counts[1][t] for t in terms], pa.int64()),
                        "clean": pa.array([counts[0][t] for t in terms], pa.int64()),
                    }
                )

    counted = rows.select("_text", "_label").mapInArrow(run, "term binary, toxic long, clean long")
    return counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _choose(counts: list[tuple[bytes, int, int]], toxic: int, clean: int) -> tuple[bytes, ...]:
    """Terms by how much likelier they are in toxic documents; of terms in the same number of
    documents of both kinds with the same beginning, the shortest."""
    odds = lambda c: np.log((c[1] + 0.5) / (toxic + 1)) - np.log((c[2] + 0.5) / (clean + 1))
    telling = sorted((c for c in counts if odds(c) > 2.5), key=lambda c: (-odds(c) * np.log1p(c[1]), len(c[0]), c[0]))
    taken: dict[tuple, bytes] = {}
    for term, a, b in telling:
        taken.setdefault((term[: STARTS[0]], a, b), term)
    return tuple(list(taken.values())[:TERMS])


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text") -> ToxicityModel:
    """Choose terms, estimate the label model, train the classifier."""
    rows = labelled(documents, labels, label, key, text, SAMPLE)
    common = (
        _count_terms(rows.where("_label > 0"), None).where(F.col("toxic") >= LEAST_DOCUMENTS)
        .orderBy(F.desc("toxic"), "term").limit(CANDIDATES).select("term").collect()
    )
    known = frozenset(bytes(r["term"]) for r in common)
    counts = [(bytes(r["term"]), r["toxic"], r["clean"]) for r in _count_terms(rows, known).collect()] if known else []
    sizes = {r["_label"]: r["n"] for r in rows.groupBy(F.col("_label") > 0).agg(F.count("*").alias("n")).toDF("_label", "n").collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    terms = _choose(counts, toxic, clean)
    draft = ToxicityModel(terms, 0.0, np.zeros(0))

    def features(texts: list[str]) -> dict:
        lexicon = draft.lexicon()
        both = [_features(t, lexicon, len(terms)) for t in texts]
        return {
            "found": pa.array([f for f, _ in both], pa.list_(pa.int32())),
            "patterns": pa.array([v for _, v in both], pa.list_(pa.float64())),
        }

    seen = per_text(rows.select(F.struct("_key", "_label").alias("k"), "_text"), "k", "_text", "found array<int>, patterns array<double>", features)
    got = seen.select("k._key", "k._label", "found", "patterns").orderBy(F.xxhash64("_key"), "found").limit(SAMPLE).toPandas()
    n = len(terms)
    x = _table([list(f) for f in got["found"]], np.array(got["patterns"].tolist()).reshape(-1, 4), n)
    gold = got["_label"].to_numpy(float)
    # Without labels: one text with an insult and several without any stand for the votes.
    if not len(x):
        x, gold = _table([[], [], [], []], np.array([[1.0, 0, 20, 1], [0, 0, 0, 0], [0, 0, 0, 0], [0, 0, 0, 0]]), n), np.full(4, np.nan)
    prior = (toxic + 0.5) / (toxic + clean + 10)
    votes = votes_of(x, n, gold)
    posterior = fit_label_model(votes, prior).posterior(votes)
    return ToxicityModel(terms, *fit_linear(x, posterior))


def score(documents: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, score, predicted of every row."""

    def rows(texts: list[str]) -> dict:
        return {"score": model.scores(texts, model.lexicon())}

    scored = per_text(documents, key, text, "score double", rows)
    return scored.select(key, held_out(key, 3, 1).alias("held_out"), "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"))
