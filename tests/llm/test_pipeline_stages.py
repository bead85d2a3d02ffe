"""Stages of the pipeline on nulls, empty and repeated rows, an empty table and more columns."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, prose):
    """Labels and a benchmark beside which the stages run."""
    root = str(tmp_path_factory.mktemp("tables"))
    labels = [(i, int(i % 3 > 0), 0) for i in range(300)] + [(None, 1, 1), (3, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    items = [(1, prose(25, 7700)), (2, None), (3, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


@pytest.fixture(scope="module")
def rows(prose, edge):
    good = [(i, prose(40, i)) for i in range(300) if i % 3]
    bad = [(i, "$$$ " * 40) for i in range(300) if not i % 3]
    item = prose(25, 7700)
    return [*edge, *good, *bad, (900, prose(10, 1) + " " + item + " " + prose(10, 2)), (None, item), (901, "password: hunter2hunter2")]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_a_stage_takes_any_rows(spark, documents, folder, rows, name, stage):
    docs = documents(rows)
    out = stage(spark, docs, folder)
    last = name == corpus_pipeline.STAGES[-1][0]
    if not last:
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
    got = out.collect()
    ids = Counter(r["doc_id"] for r in got)
    assert not ids - Counter(i for i, _ in rows)
    if name == "quality classifier":
        good = [ids[i] for i in range(10, 300) if i % 3]
        assert sum(good) > 0.95 * len(good) and sum(ids[i] for i in range(9, 300, 3)) < 5
    elif name == "minhash near-dedup":
        # Several texts of a key each stay; copies, and repeated rows, stay once.
        assert [ids[i] for i in range(5)] == [1, 2, 2, 1, 2]
    elif name == "benchmark decontamination":
        assert ids == Counter(i for i, t in rows) - Counter([900, None])
    elif name == "secret scans":
        assert sum(ids.values()) == len(rows) and not any("hunter2hunter2" in (r["text"] or "") for r in got)
        assert all(r["n_chars"] == len(r["text"]) for r in got if r["text"] is not None)
    else:
        assert sum(ids.values()) == len(rows)
    assert stage(spark, docs.where(F.lit(False)), folder).count() == 0
