"""Trained operators: held-out accuracy, exact base figures, edge rows."""

import math
import random
import re
import string
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from skyrisk.llm import attention, lm, quality, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def is_held(key, modulus, remainder):
    return key is not None and zlib.crc32(str(key).encode()) % modulus == remainder


@pytest.fixture(scope="module")
def corpus(prose):
    rows, labels = [], []
    for i in range(600):
        t = prose(random.Random(i).randint(20, 120), i)
        bad, rude = i % 5 == 0, i % 7 == 0
        if bad:
            t = [t.upper().replace(" ", "!! "), t.replace(" ", "$$$ "), " ".join(w + " " + w for w in t.split()[:9] * 3)][i % 3]
        if rude:
            t = t.replace(" ", " idiot ", 2).replace(" ", " grumfle", 3)
        rows.append((i, t))
        labels.append((i, int(not bad), int(rude)))
    return rows, labels


@pytest.mark.parametrize("operator, label, place", [(quality, "quality", 1), (toxicity, "toxic", 2)])
def test_held_out_accuracy_and_edge_rows(spark, documents, edge, corpus, operator, label, place):
    rows, labels = corpus
    marks = spark.createDataFrame([*labels, (3, None, None), (None, 1, 1), (10**9, 1, 1)], "doc_id long, quality int, toxic int")
    extra = [(10**6 + (i or 0), t) for i, t in edge]
    model = operator.fit(documents(rows + extra), marks)
    got = operator.score(documents(rows + extra), model).collect()
    assert len(got) == len(rows + extra)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= (0.5 if operator is quality else 0.7)) for r in got)
    assert all(r["held_out"] == is_held(r["doc_id"], 3, 1) for r in got)
    truth = {r[0]: r[place] for r in labels}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert operator.score(documents([]), model).count() == 0


def statistics_by_hand(text):
    t = text or ""
    n, words, lines = max(len(t), 1), re.split("[ \t\n\r]+", t), t.split("\n")
    count = lambda letters: sum(c in letters for c in t) / n
    return {
        "chars_log": math.log1p(len(t)), "upper": count(string.ascii_uppercase), "digits": count(string.digits),
        "marks": count("#$%&*@~^=<>{}[]\\"), "bangs": count("!?"), "bars": count("|"), "stops": count(".,;:"),
        "word_length": n / len(words), "distinct_words": len(set(words)) / len(words),
        "distinct_lines": len(set(lines)) / len(lines), "words_log": math.log1p(len(words)),
    }


def test_quality_scores_equal_rules_by_hand(spark, documents, edge, corpus):
    rows, labels = corpus
    model = quality.fit(documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert len(model.rules) > 3
    want = Counter()
    for key, text in [*rows, *edge]:
        x = statistics_by_hand(text)
        total = model.bias
        for rule, weight in model.rules:
            if all((x[model.names[i]] > bound) == above for i, above, bound in rule):
                total += weight
        want[key, round(1 / (1 + math.exp(-total)), 9)] += 1
    got = quality.score(documents([*rows, *edge]), model).collect()
    assert Counter((r["doc_id"], round(r["score"], 9)) for r in got) == want


def test_without_labels_every_score_is_defined(spark, documents, edge):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = documents(edge)
    assert {r["score"] for r in quality.score(df, quality.fit(df, none)).collect()} == {0.5}
    scores = toxicity.score(documents([(1, "you idiot, you moron"), (2, "fine words")]), toxicity.fit(df, none)).collect()
    assert {r["doc_id"]: r["score"] for r in scores}[1] > {r["doc_id"]: r["score"] for r in scores}[2]


def test_good_documents_keep_their_columns(spark, documents, corpus):
    rows, labels = corpus
    df = documents(rows)
    model = quality.fit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    out = quality.keep_good(df, model)
    assert out.columns == df.columns and out.count() == sum(r["predicted"] for r in quality.score(df, model).collect())


def test_lasso_drops_idle_columns():
    r = np.random.default_rng(1)
    z = (r.random((2000, 20)) < 0.5).astype(float)
    y = (r.random(2000) < 1 / (1 + np.exp(-(3 * z[:, 0] - 3 * z[:, 1])))).astype(float)
    _, w = quality.lasso(z, y, 0.02)
    assert w[0] > 1 and w[1] < -1 and (np.abs(w[2:]) < 0.1).all()


def test_label_model_finds_rates_and_discounts_copies():
    r = np.random.default_rng(2)
    y = r.random(4000) < 0.3
    vote = lambda hit, miss: (r.random(4000) < np.where(y, hit, miss)).astype(np.int8)
    v = np.stack([vote(0.8, 0.05), vote(0.7, 0.1), vote(0.6, 0.02), vote(0.6, 0.02), -vote(0.1, 0.8), np.zeros(4000, np.int8)], 1)
    v[:, 3] = v[:, 2]  # a copy of another voter
    model = toxicity.fit_label_model(v, 0.3)
    assert model.rates[1, 1, 0] == pytest.approx(0.8, abs=0.08) and model.rates[0, 1, 0] == pytest.approx(0.05, abs=0.05)
    assert model.discount[2] == pytest.approx(2**-0.5, abs=0.1) and model.discount[0] > 0.9
    assert ((model.posterior(v) > 0.5) == y).mean() > 0.9


def test_base_scores_equal_their_definition(documents, edge, prose):
    rows = [*edge, *[(100 + i, prose(60, i).upper() if i % 2 else prose(60, i)) for i in range(60)]]
    tokens = [(i, [*(t or "").encode().lower().split(), None]) for i, t in rows]
    counts = Counter(w for i, ws in tokens if not is_held(i, 10, 0) for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, ws in tokens:
        base = math.fsum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        want[(i, is_held(i, 10, 0), len(ws), sum(counts[w] > 0 for w in ws), n, round(base, 6))] += 1
    got = lm.score(documents(rows), WORDS).collect()
    assert Counter((*r[:5], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert lm.score(documents([]), WORDS).count() == 0


def test_gradients_equal_differences():
    p = {k: v.astype(np.float64) for k, v in attention.initial().items()}
    r = np.random.default_rng(0)
    rows, goal = r.integers(0, 50, (3, attention.WINDOW)), r.integers(0, attention.CLASSES, (3, attention.WINDOW))
    known = r.random(rows.shape) < 0.8
    _, g = attention._gradients(p, rows, goal, known)
    for name in p:
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        old = p[name][at]
        losses = []
        for step in (1e-4, -1e-4):
            p[name][at] = old + step
            losses.append(attention._gradients(p, rows, goal, known)[0])
        p[name][at] = old
        assert g[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-4, rel=1e-3, abs=1e-6)


@pytest.mark.parametrize("bias", [0.0, 200.0, -200.0])
def test_gradients_are_as_narrow_as_the_weights(bias):
    p, r = attention.initial(), np.random.default_rng(0)
    p["bias"] += np.float32(bias)
    rows, goal = r.integers(0, 50, (3, attention.WINDOW)), r.integers(0, attention.CLASSES, (3, attention.WINDOW))
    known = r.random(rows.shape) < 0.8
    _, g = attention._gradients(p, rows, goal, known)
    _, exact = attention._gradients({k: v.astype(np.float64) for k, v in p.items()}, rows, goal, known)
    for name in p:
        assert g[name].dtype == np.float32 and g[name].shape == p[name].shape
        assert np.allclose(g[name], exact[name], rtol=1e-3, atol=1e-5)


def test_each_token_is_scored_once_from_its_window():
    counts = np.random.default_rng(0).integers(0, 9, 3000).astype(float)
    vocabulary, p = attention.Vocabulary(counts), attention.initial()
    lengths = np.array([1, 5, 20, 21, 36, 37, 200])
    flat = np.random.default_rng(1).integers(0, 3000, lengths.sum())
    got = attention.log_probabilities(p, vocabulary, flat, lengths, start=7)
    at = 0
    for n, total in zip(lengths, got, strict=True):
        ids = flat[at : at + n]
        at += n
        before = vocabulary.place[np.r_[7, ids[:-1]]]
        want = 0.0
        for i in range(n):
            # The window that scores token i: the first that reaches it.
            begin = 0 if i < attention.WINDOW else -(-(i - attention.WINDOW + 1) // attention.STRIDE) * attention.STRIDE
            logits = attention.forward(p, before[None, begin : i + 1])[0][0, -1].astype(float)
            want += (logits[vocabulary.of[ids[i]]] - np.log(np.exp(logits).sum())) / np.log(10) + vocabulary.log_share[ids[i]]
        assert total == pytest.approx(want, rel=1e-4)


def test_every_token_of_every_training_text_teaches(spark):
    lengths = np.array([1, 31, 32, 33, 20_000])
    flat = np.random.default_rng(1).integers(0, 3000, lengths.sum()).astype(np.uint32)
    vocabulary = attention.Vocabulary(np.bincount(flat, minlength=3000).astype(float))
    rows, goal, known = attention.examples(vocabulary, flat, lengths, start=7)
    assert (goal[known] == vocabulary.of[flat]).all() and (rows[[0, 1, 2], 0] == vocabulary.place[7]).all()
    texts = [(flat[i : i + 3].astype("<u4").tobytes(),) for i in range(4000)]
    df = spark.createDataFrame(texts, "ids binary").repartition(3)
    seen = df.mapInArrow(lm._round(vocabulary, attention.initial(), 4e-3, 7), "weights binary, tokens long")
    assert sum(r["tokens"] for r in seen.collect()) == 12_000


def test_scored_tokens_see_half_a_window():
    _, begin, scored = attention.windows(np.array([5, 32, 33, 500]))
    assert (scored - begin)[begin > 0].min() >= attention.WINDOW // 2 and attention.CLASSES >= 32


def test_shares_sum_to_one_in_each_class():
    vocabulary = attention.Vocabulary(np.random.default_rng(0).integers(0, 9, 3000).astype(float))
    assert np.bincount(vocabulary.of, 10**vocabulary.log_share, attention.CLASSES) == pytest.approx(np.ones(attention.CLASSES))


def test_a_small_corpus_is_gone_over_once_a_round_like_any_other(spark):
    rng, vocabulary = np.random.default_rng(5), attention.Vocabulary(np.arange(1.0, 41.0))
    texts = [rng.integers(0, 40, n).astype("<u4") for n in (50, 3, 90)]
    df = spark.createDataFrame([(False, bytearray(t.tobytes())) for t in texts], "held_out boolean, ids binary").coalesce(1)
    expected = attention.initial()
    for i in range(lm.ROUNDS):
        fit = attention.Fit(expected, 4e-3 / (1 + i))
        fit.over(*attention.examples(vocabulary, np.concatenate(texts), np.array([len(t) for t in texts]), 7))
        expected = fit.p
    got = lm._trained(df, vocabulary, 7)
    assert np.allclose(attention.vector(got), attention.vector(expected), atol=1e-5)


def test_words_are_runs_without_ascii_white_space():
    texts = [*("a" + chr(c) + "B" for c in range(1, 300)), None, "", " \x0b ", " Éa  B c ", "\x85x "]
    words, of = lm.tokens(pa.array(texts, pa.string()))
    want = [(w, i) for i, t in enumerate(texts) for w in (t or "").encode().lower().split()]
    assert list(zip(words.to_pylist(), of.tolist(), strict=True)) == want


def test_a_block_of_words_takes_little_memory_beside_its_texts():
    rng = np.random.default_rng(0)
    texts = [" ".join(map(str, rng.integers(0, 10**12, 2000))) for _ in range(100)]  # 200 000 distinct words
    size = sum(map(len, texts))
    held = [i % 10 == 0 for i in range(100)]
    batch = pa.RecordBatch.from_arrays([pa.array([0] * 100, pa.int32()), pa.array(held), pa.array(texts)], ["block", "held", "text"])
    tracemalloc.start()
    found = sum(b.num_rows for b in lm._block_words(iter([batch])))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert found == len({w for t in texts for w in t.split()}) and peak < 4 * size


def test_positions_that_only_give_context_are_not_scored(monkeypatch):
    vocabulary, seen, forward = attention.Vocabulary(np.ones(3000)), [], attention.forward
    monkeypatch.setattr(attention, "forward", lambda *a: (seen.append((r := forward(*a))[0][..., 0].size), r)[1])
    flat = np.random.default_rng(1).integers(0, 3000, 5000)
    attention.log_probabilities(attention.initial(), vocabulary, flat, np.array([5000]), start=7)
    assert sum(seen) < 5000 + attention.WINDOW
