"""Late, repeated and shuffled files give what a batch over all of them gives."""

import random
from datetime import date, datetime, timedelta

import pytest
from helpers import points, raw_weather, rows
from pyspark.sql import functions as F

from skyrisk import schemas
from skyrisk.operators.windows import dedupe_latest
from skyrisk.streaming import late

CODES = {"a1": "59", "a2": "59", "b1": "2A"}
DAY = date(2026, 7, 1)


def run(spark, tmp_path, files, delay="100 days"):
    """Land the files one by one; the rows that went out after each."""
    landing, sink, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    landing.mkdir(exist_ok=True)
    counts = []
    for i, items in enumerate(files):
        frame = raw_weather(spark, [x[:3] for x in items]).withColumn("insere_a", F.lit(datetime(2026, 8, 1) + timedelta(hours=i)))
        frame.coalesce(1).write.mode("append").parquet(str(landing))
        stream = spark.readStream.schema(schemas.RAW_WEATHER).parquet(str(landing))
        seed = points(spark, list(CODES), list(CODES.values()))
        out = late.complete_days(late.arriving(stream, seed, delay))
        query = out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", progress).trigger(availableNow=True).start()
        query.awaitTermination()
        counts.append(spark.read.parquet(sink).count())
    return spark.read.parquet(sink), counts


def test_a_day_goes_out_once_its_area_is_complete(spark, tmp_path):
    files = [
        [(DAY, "a1", {"precipitation_sum": 2.0})],
        [(DAY, "b1", {})],
        [(DAY, "a1", {"precipitation_sum": 3.0}), (DAY, "a2", {})],
        [(DAY, "a2", {"precipitation_sum": 5.0})],
    ]
    out, counts = run(spark, tmp_path, files)
    assert counts == [0, 1, 3, 4]
    latest = dedupe_latest(out, ["code_insee", "jour"], ["insere_a", "row_hash"])
    assert rows(latest, "code_insee", "precipitation_sum", "complet") == [("a1", 3.0, True), ("a2", 5.0, True), ("b1", 1.0, True)]


def test_shuffled_files_equal_the_batch_and_state_is_dropped(spark, tmp_path):
    r = random.Random(3)
    items = [(DAY + timedelta(n), c, {"precipitation_sum": float(r.randint(0, 9))}) for n in range(6) for c in CODES if (n, c) != (2, "a2")]
    items += r.sample(items, 5)
    r.shuffle(items)
    files = []
    for i in range(0, len(items), 8):  # a key once a file, as loads have it
        files.append(list({(d, c): (d, c, v) for d, c, v in items[i : i + 8]}.values()))
    far = DAY + timedelta(400)
    files += [[(far, "b1", {})], [(far + timedelta(1), "b1", {})], [(DAY, "b1", {"precipitation_sum": 99.0})]]
    out, _ = run(spark, tmp_path, files)
    batch = {}
    for items in files[:-1]:  # what came after the watermark is ignored
        batch |= {(c, d): v.get("precipitation_sum", 1.0) for d, c, v in items}
    latest = dedupe_latest(out, ["code_insee", "jour"], ["insere_a", "row_hash"])
    assert {(r["code_insee"], r["jour"]): r["precipitation_sum"] for r in latest.collect()} == batch
    partial = out.where("NOT complet")
    assert rows(partial, "code_insee", "jour") == [("a1", DAY + timedelta(2))]
