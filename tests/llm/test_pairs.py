"""Operators on pairs of texts, against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyrisk.llm import components, decontaminate, neardup, repeats, sorting


def changed(text, share, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choices("xyz", k=5)) if r.random() < share else w for w in text.split())


def shingle_set(text, k):
    words = bytes(text or "", "utf-8").lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute_groups(rows, k, percent):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, shingle_set(t, k))
    label = {i: i for i in sets}
    moved = True
    while moved:
        moved = False
        for i in sets:
            for j in sets:
                both = len(sets[i] & sets[j])
                if both and 100 * both >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    moved = True
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(documents, prose, edge, size):
    rows = list(edge)
    for g in range(12):
        base = prose(120, g)
        rows += [(100 * g + 10 + c, base if c == 0 else changed(base, 0.01 * c, c)) for c in range(6)]
    hub = prose(200, 77)
    rows += [(5000 + c, changed(hub, 0.03, c)) for c in range(30)] + [(4999, hub), (6000, hub.upper()), (6001, " ".join(hub.split()) + " ")]
    want = brute_groups(rows, size, 80)
    got = neardup.groups(documents(rows), size=size, percent=80).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])
        else:
            assert r["component_id"] is None and r["kept"]


def test_large_regions_are_tied_together(documents, prose, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 3)
    base = prose(150, 5)
    rows = [(c, changed(base, 0.04, c) if c else base) for c in range(60)]
    got = {r["doc_id"]: r["component_id"] for r in neardup.groups(documents(rows), size=2).collect()}
    assert got == {i: c for i, (_, c) in brute_groups(rows, 2, 80).items()}


def test_copies_meet_through_an_original_of_any_id(documents, prose):
    hub = prose(1200, 78)
    rows = [(c, changed(hub, 0.047, c)) for c in range(150)] + [(10**6, hub)]
    want = brute_groups(rows, 2, 80)
    sets = [shingle_set(t, 2) for _, t in rows[:-1]]
    linked = sum(100 * len(x & y) >= 80 * len(x | y) for x in sets for y in sets if x is not y)
    assert linked < len(sets) / 4 and Counter(c for _, c in want.values()).most_common(1)[0][1] > 100
    got = {r["doc_id"]: r["component_id"] for r in neardup.groups(documents(rows), size=2).collect()}
    assert got == {i: c for i, (_, c) in want.items()}


def test_what_no_representative_links_is_compared_whole(documents, prose, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 20)
    base = prose(400, 79)
    # Variants that are nearly alike, and a twin of some of them far off in the order of ids.
    rows = [(c, changed(base, 0.07, c)) for c in range(60)]
    rows += [(10**6 - c, changed(rows[c][1], 0.04, 99 + c)) for c in range(0, 60, 3)]
    want = brute_groups(rows, 2, 80)
    got = {r["doc_id"]: r["component_id"] for r in neardup.groups(documents(rows), size=2).collect()}
    assert got == {i: c for i, (_, c) in want.items()} and len(set(got.values())) > 20


def test_one_of_each_keeps_columns(documents, prose):
    t = prose(60, 1)
    df = documents([(3, t), (1, t), (1, t), (2, prose(60, 2)), (9, None), (None, t)])
    out = neardup.one_of_each(df)
    assert out.columns == df.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter([1, 2, 9, None])
    assert neardup.groups(documents([])).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 50)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 150)}


def test_components_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(components, "CHUNK", 3)
    r = random.Random(1)
    links = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(45)] + [(7, 7), (None, 3), (200, 200)]
    want = {}
    for a, b in links:
        if a is not None:
            want.setdefault(a, a), want.setdefault(b, b)
    for _ in want:
        for a, b in links:
            if a is not None:
                want[a] = want[b] = min(want[a], want[b])
    frame = spark.createDataFrame(links, "a long, b long").repartition(3)
    assert {r["node"]: r["component"] for r in components.components(frame).collect()} == want
    assert components.components(frame.limit(0)).count() == 0


def brute_leaks(rows, items):
    """Every item-sized window of every document, compared outright."""
    index = decontaminate.Items(items)
    out = {}
    for key, text in rows:
        h = decontaminate.word_hashes(text or "")
        for i, n in enumerate(index.length):
            size = min(decontaminate.SIZE, n)
            s = decontaminate.hashing.runs(h, size)
            m = n - size + 1
            sims = [index.similarity(s[a : a + m], i) for a in range(max(len(s) - m, 0) + 1)] if len(s) else []
            if sims and max(sims) >= 0.8 - 1e-9:
                out[(key, index.ids[i])] = max(sims)
    return out


def test_leaks_equal_brute_force(spark, documents, prose, edge):
    items = [(i, prose(15 + 7 * i, 900 + i)) for i in range(6)] + [(6, "three short words"), (7, ""), (8, None), (9, prose(15, 900)), (10, "Ünïted, été: 12 words?")]
    rows = list(edge)
    for d in range(60):
        words = prose(150, d).split()
        item = items[d % 6][1].split()
        if d % 2:
            r = random.Random(d)
            for _ in range(d % 5):
                item[r.randrange(len(item))] = "other"
            words[40:40] = [w.upper() + "," for w in item]
        rows.append((100 + d, " ".join(words)))
    rows += [(300, "say three short words."), (301, "a ünïted été 12 words b")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_leaks(rows, items)
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.leaks(documents(rows), bench).collect()}
    assert got == pytest.approx(want) and len(want) > 10
    left = decontaminate.without_leaks(documents(rows), bench)
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(i for i, _ in rows if i not in {k[0] for k in want})
    assert decontaminate.leaks(documents([]), bench).count() == 0
    assert decontaminate.leaks(documents(rows), bench.limit(0)).count() == 0


def test_items_travel_in_blocks(spark, documents, prose, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 30)
    items = [(i, prose(20, i)) for i in range(5)]
    rows = [(i, "before it " + t + " and behind") for i, t in items]
    got = decontaminate.leaks(documents(rows), spark.createDataFrame(items, "item_id int, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(i, i) for i in range(5)]


def test_deep_shallow_sorting_sorts_groups():
    r = random.Random(6)
    heads = ["", "a" * 63, "a" * 64, "a" * 70 + "b", "a\0"]
    strings = [(r.choice(heads) + "".join(r.choices("ab\0", k=r.randint(0, 30)))).encode() for _ in range(400)]
    group = np.sort(np.array([r.randint(0, 6) for _ in strings]))
    order = sorting.sort_groups(strings, group)
    for g in range(7):
        rows = np.flatnonzero(group == g)
        assert [strings[i] for i in order[rows]] == sorted(strings[i] for i in rows) and set(order[rows]) == set(rows)


def brute_repeats(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = Counter()
    for (key, _), t in zip(rows, texts, strict=True):
        cover = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                cover[i : i + length] = True
        kept = bytes(b for b, c in zip(t, cover, strict=False) if not c)
        spans = int((np.diff(np.r_[0, cover.astype(int)]) == 1).sum())
        out[(key, len(t), int(cover.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("hot", [256, 2])
def test_repeats_equal_brute_force(documents, prose, edge, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    shared = [prose(40, 500 + i) for i in range(3)]
    rows = list(edge)
    for d in range(24):
        cut = random.Random(d)
        s = shared[d % 3]
        a, b = cut.randint(0, 40), cut.randint(0, 40)
        rows.append((20 + d, prose(15, d) + s[a : len(s) - b] + prose(15, 99 + d)))
    rows += [(60, prose(30, 7) + "éü" + prose(30, 7)), (61, prose(80, 3)), (62, prose(80, 3)), (63, "abc " * 60)]
    got = Counter(tuple(r) for r in repeats.digests(documents(rows), length=80).collect())
    assert got == brute_repeats(rows, 80)
    assert repeats.digests(documents([]), length=80).count() == 0


def test_hot_cores_are_taken_apart_until_single_windows(documents, prose, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 1)
    shared = prose(60, 5)
    rows = [(d, prose(8, d) + shared[d : len(shared) - 2 * d] + prose(8, 70 + d)) for d in range(12)]
    rows += [(20, "ab" * 300 + prose(20, 1) + "ab" * 200), (21, "abcabcabd" * 60), (22, "ab" * 60)]
    got = repeats.digests(documents(rows), length=80, texts=True).collect()
    assert Counter(tuple(r)[:5] for r in got) == brute_repeats(rows, 80)
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in got)


def test_repeats_of_texts_longer_than_a_slice(documents, prose):
    passage = prose(200, 8)
    rows = [(1, prose(90_000, 1) + passage + prose(90_000, 2)), (2, prose(100, 3)), (3, prose(95_000, 4) + passage), (4, None)]
    assert len(rows[0][1]) > 1 << 20
    got = Counter(tuple(r) for r in repeats.digests(documents(rows)).collect())
    assert got == brute_repeats(rows, 400)
    assert sum(n_removed > 0 for _, _, n_removed, _, _ in got) == 2


def test_extents_of_large_groups_equal_all_pairs():
    r, length = random.Random(4), 12
    words = ["".join(r.choices("ab", k=12)) for _ in range(3)]
    contexts = []
    for _ in range(60):
        before, after = (r.choice(words) + r.choice(words))[r.randint(0, 20) :][-9:], (r.choice(words) + r.choice(words))[: r.randint(3, 12)]
        contexts.append((len(before), (before + "xyz" + after).encode()))
    low = [max(0, length - (len(c) - o)) for o, c in contexts]
    high = [min(9, o) for o, _ in contexts]
    order = sorted(range(60), key=lambda i: contexts[i][1][contexts[i][0] :])
    want: list = []
    for i, (o, c) in enumerate(contexts):
        held = [
            w for w in range(low[i], high[i] + 1)
            if any(j != i and low[j] <= w <= high[j] and c[o - w : o - w + length] == d[p - w : p - w + length] for j, (p, d) in enumerate(contexts))
        ]
        want.append((max(held), min(held)) if held else None)
    assert repeats.extents(contexts, low, high, order, length) == want
    assert any(want) and not all(want)


def test_a_key_with_several_texts_keeps_each_once(spark, documents, prose):
    one, two, three = prose(80, 1), prose(80, 2), prose(80, 3)
    rows = [(1, one), (1, two), (1, one), (2, two), (3, three), (2, one + " end"), (None, one), (4, ""), (4, ""), (4, None)]
    got = Counter((r["doc_id"], r["component_id"]) for r in neardup.groups(documents(rows), size=2).collect())
    assert got == Counter([(1, 1), (1, 1), (1, 1), (2, 1), (3, 3), (2, 1), (None, None), (4, 4), (4, 4), (4, 4)])
    kept = neardup.one_of_each(documents(rows), size=2)
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter([(1, one), (1, two), (3, three), (None, one), (4, ""), (4, None)])
    assert kept.columns == documents(rows).columns


def test_leaks_go_whatever_their_key(spark, documents, prose):
    items = [(1, prose(20, 5)), (2, None)]
    rows = [(None, prose(10, 1) + " " + prose(20, 5)), (None, "clean"), (7, prose(20, 5)), (7, "clean too"), (8, None)]
    for kind in ("short", "long", "string", "decimal(9,0)", "int"):
        bench = spark.createDataFrame(items, "item_id long, text string").withColumn("item_id", F.col("item_id").cast(kind))
        assert decontaminate.leaks(documents(rows), bench).count() == 2
    left = decontaminate.without_leaks(documents(rows), bench)
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter([(None, "clean"), (7, "clean too"), (8, None)])
