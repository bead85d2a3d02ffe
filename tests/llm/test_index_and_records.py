"""Neighbour search against brute force; WARC records read back; the pipeline."""

import base64
import gzip
import hashlib

import numpy as np
import pytest

import corpus_pipeline
from skyrisk.llm import neighbours, registry, warc

SF = "/root/testdata/sf0.001"


def brute(rows, k=10):
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and len(v) == 16 and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    out = {}
    for q in ok:
        if q % 100 == 0:
            d = sorted((float(np.sqrt(((ok[i] - ok[q]) ** 2).sum())), i) for i in ok if i != q)
            out[q] = d[:k]
    return out


def searched(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "vec_id AS id", "'x' AS v", "1 AS block", "2 AS score")
    out = {}
    for r in neighbours.search(df).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_few_vectors_are_found_exactly(spark):
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=16).tolist()) for i in range(30)]
    rows += [(i, rows[1][1]) for i in range(100, 130)]  # ties and copies of a query
    rows += [(200, None), (201, [0.0] * 16), (202, [float("nan")] * 16), (203, [None] + [1.0] * 15), (204, [float("inf")] + [1.0] * 15), (300, []), (None, [1.0] * 16), (205, [1.0, 2.0])]
    got, want = searched(spark, rows), brute(rows)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
        assert [s for s, _ in got[q]] == pytest.approx([s for s, _ in want[q]])
    assert searched(spark, rows[-8:-3]) == {}
    assert searched(spark, []) == {}


def test_recall_is_over_nine_tenths(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 1000)
    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=16).tolist()) for i in range(3000)]
    got, want = searched(spark, rows), brute(rows)
    assert got.keys() == want.keys()
    assert np.mean([len(set(got[q]) & set(want[q])) / 10 for q in want]) >= 0.9


@pytest.mark.parametrize("lane,queries", [(200, 3), (10_000, 10_000)])
def test_lanes_of_vectors_and_queries_lose_nothing(spark, monkeypatch, lane, queries):
    for name, value in (("BLOCK", 150), ("LANES", 2), ("LANE", lane), ("QUERY_LANE", queries), ("RERANK", 1.0)):
        monkeypatch.setattr(neighbours, name, value)
    r = np.random.default_rng(7)
    rows = [(i, r.normal(size=16).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(1100)]  # large groups of equal vectors, some of them queries
    got, want = searched(spark, rows), brute(rows)
    assert got.keys() == want.keys() and len(want) == 20
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
        assert [s for s, _ in got[q]] == pytest.approx([s for s, _ in want[q]])


def test_a_query_travels_as_a_row_not_in_a_block_of_queries(spark):
    r = np.random.default_rng(8)
    df = spark.createDataFrame([(i, r.normal(size=16).tolist()) for i in range(300)], "vec_id long, embedding array<float>")
    plan = neighbours.search(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "qvectors" not in plan


def test_footrules_equal_their_definition():
    r = np.random.default_rng(1)
    perms = np.array([r.permutation(20)[:8] for _ in range(30)], np.int16)
    files = neighbours.InvertedFiles(perms, 20)
    place = lambda p: np.array([np.flatnonzero(p == i)[0] if i in p else 8 for i in range(20)])
    for q in perms:
        assert files.footrules(q).tolist() == [int(np.abs(place(q) - place(p)).sum()) for p in perms]


PAGES = [
    (1, "http://a.example/x/", "<html lang=fr><head><title>T &amp; U</title><style>p{}</style></head><body><p>One <b>two</b></p><script>no()</script><a href='../y'>three</a><!-- hidden --></body></html>"),
    (2, None, None), (3, "http://b.example", ""), (4, "http://c.example", "no tags < here & there é"), (4, "http://c.example", "no tags < here & there é"), (5, "::bad[", "<a href='http://[x'>l</a>" + "w " * 20000),
]


def test_derived_records_refer_to_their_source(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'x' AS record_id", "'y' AS message", "'z' AS page")
    sources = warc.responses(pages).collect()
    derived = warc.derive(warc.responses(pages)).collect()
    assert len(derived) == 2 * len(PAGES)
    by_id = {r["record_id"]: r for r in sources}
    for r in derived:
        body = warc.split_http(by_id[r["refers_to"]]["message"])[2]
        assert r["payload_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert r["block_digest"] == warc.digest(r["block"].encode()) and r["content_length"] == len(r["block"].encode())
        assert r["target_uri"] == by_id[r["refers_to"]]["target_uri"]
    of = {(r["page_id"], r["warc_type"]): r["block"] for r in derived}
    assert of[1, "conversion"] == "One two\nthree"
    assert "title: T & U\r\nlanguage: fr\r\noutlink: http://a.example/y\r\n" in of[1, "metadata"]
    assert of[2, "conversion"] == "" and of[4, "conversion"] == "no tags < here & there é"
    assert len({r["record_id"] for r in derived if r["page_id"] != 4}) == 2 * (len(PAGES) - 2)
    assert warc.derive(warc.responses(pages.limit(0))).count() == 0


def test_serialised_records_parse_again(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    derived = warc.derive(warc.responses(pages))
    blocks = {r["record_id"]: r for r in derived.collect()}
    archive = b"".join(bytes(r["record"]) for r in warc.serialised(derived).collect())
    data, seen = gzip.decompress(archive), 0
    while data:
        head, _, data = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        n = int(fields["Content-Length"])
        assert lines[0] == "WARC/1.1" and data[n : n + 4] == b"\r\n\r\n"
        assert data[:n].decode() == blocks[fields["WARC-Record-ID"]]["block"]
        data, seen = data[n + 4 :], seen + 1
    assert seen == 2 * len(PAGES)


def test_pipeline_stages_take_effect(spark):
    docs = registry.table(spark, SF, "documents")
    before = {r["doc_id"]: r for r in docs.collect()}
    seen = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.landed(stage(spark, docs, SF), "test")
        if i < 4:
            assert out.dtypes == docs.dtypes
        seen.append({r["doc_id"] for r in out.select("doc_id").collect()})
        docs = out
    assert set(before) > seen[0] > seen[1] >= seen[2] == seen[3] == seen[4]
    assert [s[0].split()[0] for s in corpus_pipeline.STAGES] == ["quality", "minhash", "benchmark", "secret", "sentencepiece"]


def test_every_operator_is_registered_once():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES)
    assert numbers == list(range(1, 11))


@pytest.mark.parametrize("page, text", [
    ("<html><head><title>T</title><body>seen <b>here</b></body>", "seen here"),
    ("<head><title>T</title><script>'<p>no'</script><p>seen</p>", "seen"),
    ("<head><meta charset=x><title>T</title>only text", "only text"),
    ("<head><title>T</title>in head</head><div>seen</div>", "seen"),
    ("<header>seen</header><!-- <head> --> too", "seen\ntoo"),
])
def test_head_without_end_tag_hides_no_text(page, text):
    assert warc.plain_text(page) == text
