"""URL filter, ranked search and conversation repair against brute force."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyrisk.llm import conversations, lexical, urlfilter

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
URLS = [
    "http://a.net/", "https://EXAMPLE.net/en/1", "http://sub.Example.NET/en", "http://notexample.net/en/1", "http://example.com/de/x?q#f", "http://example.com/dex/",
    "http://www.spam.org/fr/1", "http://spam.org/it/1", "http://www.SPAM.org:80/it/1/?utm=1", "http://xorg/fr/", "http://org/fr/", "http://.net/", "net/", "", None, "://", "a://b://c.net/",
    "http://a.net", "http://a.net#/", "http://éa.net/é", "http://a.net/\n", "http://" + "a." * 300 + "net/" + "x" * 5000, "http://spam.org/it/1", "http://spam.org/it/1",
]


def verdict_of(url, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    rest = re.split(r"[?#]", rest, maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    host, path = re.sub("[A-Z]", lambda m: m[0].lower(), host), slash + path
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    own = (re.sub(r"^www\.|(\.|:80|:443)\Z", "", host), path.rstrip("/"))
    on = bool(host) and own in listed
    rule, verdict = max(fits)[1:] if fits else (None, "block" if on else "allow")
    return host, path, rule, verdict, on


def judged(spark, urls, listed):
    pages = spark.createDataFrame([(i // 2, u, "x", 1, "y") for i, u in enumerate(urls)], "page_id long, url string, host string, n int, best string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    marked = spark.createDataFrame(listed, "host string, path string")
    return urlfilter.judge(pages.repartition(3), rules, marked)


def test_urls_are_judged_as_by_hand(spark):
    listed = [("spam.org", "/it/1"), ("a.net", "/q"), (None, "/"), ("xorg", None), ("spam.org", "/it/1")]
    urls = URLS + URLS[:5]
    got = Counter(tuple(r) for r in judged(spark, urls, listed).collect())
    assert got == Counter((i // 2, *verdict_of(u, set(listed))) for i, u in enumerate(urls))
    assert judged(spark, [], listed).count() == 0
    assert all(r["listed"] is False for r in judged(spark, URLS, []).collect())


def test_false_positives_of_a_full_filter_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "MOST_BLOCKS", 1)
    listed = [("site.org", f"/{i}") for i in range(0, 3000, 2)]
    urls = [f"http://site.org/{i}" for i in range(600)]
    found = judged(spark, urls, listed)
    assert sorted(r["path"] for r in found.where("listed").collect()) == sorted(f"/{i}" for i in range(0, 600, 2))
    entries = urlfilter._entries(spark.createDataFrame(RULES, "host string, path string, verdict string"), spark.createDataFrame(listed, "host string, path string"))
    rows = urlfilter.parsed(spark.createDataFrame(list(enumerate(urls)), "id long, url string"), "id", "url")
    assert urlfilter.possible(rows, entries).count() > 550  # nearly everything passes one block
    monkeypatch.setattr(urlfilter, "MOST_BLOCKS", 1 << 17)
    assert 300 <= urlfilter.possible(rows, entries).count() < 320


WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(documents, items, depth=10):
    """The stated score of every document, word by word."""
    split = [(k, Counter(WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))) for k, t in documents]
    total, words = sum(bool(c) for _, c in split), sum(c.total() for _, c in split)
    out = Counter()
    for item, text in items:
        asked = Counter(WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        scores = []
        for key, c in split:
            score = 0
            for term, times in asked.items():
                if c[term]:
                    df = sum(term in other for _, other in split)
                    m = 25 + 75 * c.total() * total // words
                    score += times * math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1))) * (10**9 * c[term] // (1000 * c[term] + 8 * m))
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out.update((item, i, s[3], -s[0]) for i, s in enumerate(sorted(scores, key=lambda s: s[:3])[:depth], 1))
    return out


def test_ranks_equal_scores_of_all_documents(spark, documents, edge, prose):
    rows = edge + [(100 + i, prose(random.Random(i).randint(1, 90), i)) for i in range(120)] + [(300 + i, "Same tie, SAME ÉÉ tie_tie") for i in range(14)] + [(400, prose(20_000, 9))]
    items = [(1, prose(12, 3)), (2, "same éé ÉÉ tie tie"), (2, "one word"), (3, None), (4, ""), (None, "é" * 50 + " odd 7"), (5, "nowhere-to-be-found")]
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = Counter(tuple(r) for r in lexical.search(documents(rows), asked).collect())
    assert got == ranked(rows, items)
    assert lexical.search(documents([]), asked).count() == 0
    assert lexical.search(documents(rows), asked.where("false")).count() == 0


def test_blocks_of_items_give_the_same(spark, documents, prose, monkeypatch):
    rows = [(i, prose(30, i)) for i in range(60)]
    items = [(i, prose(8, i + 20)) for i in range(9)]
    asked = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 150)
    assert Counter(tuple(r) for r in lexical.search(documents(rows), asked).collect()) == ranked(rows, items)


def test_bounds_hold_and_spare_work(prose):
    texts = [prose(60, i).encode() for i in range(400)]
    t, block = lexical.terms(texts), lexical.Items([(0, prose(10, 7).encode())])
    df = np.array([(t.term == x).sum() for x in block.known])
    block.weigh(len(texts), df)
    best = lexical.Best(block, len(texts), int(t.length.sum()), 10)
    best.see(list(range(400)), t)
    assert 10 <= best.rescored < 400


CLASS = {"s": 0, "u": 1, "a": 2}


def damaged(rows):
    """(conv, turn, role, text) after the damage, conversation by conversation, in order."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        how = zlib.crc32(key.encode()) % 20
        if how == 0:
            continue
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        role = "user" if how == 4 else role
        out[conv] += [(turn, role, text)] * (2 if how == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, hashlib.md5(f"{len(x[1])}:{x[1]}{x[2]}".encode()).digest())) for c, r in out.items()}


def repaired(rows):
    """Least (cost, audit) over all edits, by Dijkstra over (place, output so far)."""
    seen, bad, faults = set(), [], Counter()
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        kind = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        faults[kind] += 1
        bad.append(kind)
    # state: roles written so far, folded to what matters next
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, place, last, written = heapq.heappop(queue)
        if (place, last) in done:
            continue
        if place == len(rows) and last in ("", "a"):
            break
        done.add((place, last))
        nxt = "a" if last == "u" else "u"
        full = {"u": "user", "a": "assistant"}[nxt]
        heapq.heappush(queue, (cost + 2, audit + "I", place, nxt, (*written, full + ":")))
        if place < len(rows):
            _, role, text = rows[place]
            heapq.heappush(queue, (cost + 3, audit + "D", place + 1, last, written))
            if bad[place] not in ("blank", "duplicate"):
                extra = bad[place] == "truncated"
                heapq.heappush(queue, (cost + 2 + extra, audit + "R", place + 1, nxt, (*written, f"{full}:{text}")))
                if role[:1] == nxt or (role[:1] == "s" and last == ""):
                    heapq.heappush(queue, (cost + extra, audit + "K", place + 1, role[:1], (*written, f"{role}:{text}")))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(written).encode()).hexdigest()


def talk(seed, conv, n):
    r = random.Random(seed)
    texts = ["Yes.", "No", "Well?\t", " \n", "", None, "é!", "a. b", "Yes."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    return [(conv, r.choice([i, i, i, i + 1, None]), r.choice(roles), r.choice([*texts, f"Words {i}.", f"More {i}.", f"Cut {i}"])) for i in range(n)]


@pytest.mark.parametrize("segment", [3, 2048])
def test_repairs_are_the_cheapest_and_least(spark, segment):
    rows = [x for c in range(60) for x in talk(c, c, c % 13)] + talk(99, None, 9) + talk(7, 1000, 150) + [(2000, 5, "user", "Hi.")] * 40 + [(2001, i, "user", "Hi.") for i in range(30)]
    rows += [(c, 0, "user", "x.") for c in range(3000, 3060)]  # some are dropped whole
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "conv_id long, turn long, role string, text string, n int, piece string, part int")
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.repair(frame.repartition(3), segment=segment).collect()}
    want = {c: repaired(r) for c, r in damaged(rows).items()}
    assert got == want
    assert (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in want.values()
    assert conversations.repair(frame.where("false")).count() == 0


def test_prices_equal_plain_distances():
    """Prices of all nodes against Bellman-Ford, on random segments and ends."""
    r = random.Random(5)
    for _ in range(300):
        rows = bytes(r.choice([0, 1, 2, 3, 1, 2, 4, 5, 9, 10]) for _ in range(r.randint(1, 12)))
        end = tuple(r.choice([0, 1, 2, 5]) for _ in range(4)) if r.random() < 0.5 else tuple(0 if s == e else conversations._FAR for s in range(4) for e in [r.randint(0, 3)])
        if min(end) >= conversations._FAR:
            continue
        lattice = conversations.Lattice(rows, end)
        dist = [[conversations._FAR] * 4 for _ in rows] + [list(end)]
        for _ in range(4):
            for place in range(len(rows) - 1, -1, -1):
                for s in range(4):
                    dist[place][s] = min([dist[place][s]] + [c + dist[place + step][to] for _, c, step, to in conversations._ARCS[rows[place]][s]])
        assert [[min(x, conversations._FAR) for x in p] for p in lattice.price] == dist


def test_a_long_conversation_of_one_fault_after_another(spark):
    n = 12_000
    rows = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    got = conversations.repair(rows).collect()[0]
    assert tuple(got)[1:] == repaired(damaged([(1, i, "assistant", f"t{i}") for i in range(n)])[1])
