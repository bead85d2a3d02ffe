"""Landing files to validated batches: what is accepted, what is refused."""

import gzip
import json
from datetime import date, datetime

import pytest
from helpers import AT, bulletin, daily, manifest, payloads, points, raw_bulletins, rows, sha

from skyrisk import schemas
from skyrisk.operators.quality import ContractError
from skyrisk.plans import ingest
from skyrisk.sources import landing

DAY = date(2026, 9, 1)


def test_a_complete_bulletin_is_keyed_and_ordered(spark):
    out = ingest.prepare_bulletin_payload(raw_bulletins(spark, bulletin()), AT)
    got = out.collect()
    assert out.columns == schemas.RAW_BULLETINS.names and len(got) == 96
    assert [r["dep_code"] for r in got] == sorted(schemas.AREA_CODES)
    assert got[0]["row_hash"] == sha("2025-07-01T06:00:00+00:00|01") and got[0]["insere_a"] == AT


def test_codes_are_normalised(spark):
    codes = ["1" if c == "01" else c.lower() if c[0] == "2" else f" {c}" for c in schemas.AREA_CODES]
    out = ingest.prepare_bulletins(raw_bulletins(spark, bulletin(codes=codes)), AT)
    assert {r["dep_code"] for r in out.collect()} == set(schemas.AREA_CODES)


@pytest.mark.parametrize(
    "position,bad,rule",
    [
        (0, None, "timestamp"),
        (0, "no date", "timestamp"),
        (1, "99", "known_area"),
        (2, " ", "not_blank"),
        (2, None, "not_blank"),
        (3, "5", "whole_between:niveau_j1"),
        (3, None, "whole_between:niveau_j1"),
        (4, "2.5", "whole_between:niveau_j2"),
        (4, "x", "whole_between:niveau_j2"),
    ],
)
def test_one_bad_field_refuses_the_bulletin(spark, position, bad, rule):
    records = bulletin()
    first = list(records[0])
    first[position] = bad
    with pytest.raises(ContractError, match=rule):
        ingest.prepare_bulletins(raw_bulletins(spark, [tuple(first), *records[1:]]), AT)


def test_incomplete_repeated_or_empty_bulletins_are_refused(spark):
    with pytest.raises(ContractError, match="group_size"):
        ingest.prepare_bulletins(raw_bulletins(spark, bulletin(codes=["01"])), AT)
    with pytest.raises(ContractError, match="row_count"):
        ingest.prepare_bulletin_payload(raw_bulletins(spark, bulletin(codes=["01"])), AT)
    with pytest.raises(ContractError, match="unique"):
        ingest.prepare_bulletins(raw_bulletins(spark, bulletin(codes=[*schemas.AREA_CODES[:-1], "01"])), AT)
    with pytest.raises(ContractError, match="not_empty"):
        ingest.prepare_bulletins(raw_bulletins(spark, bulletin()).limit(0), AT)
    with pytest.raises(ContractError, match="niveau_j2"):
        ingest.prepare_bulletins(raw_bulletins(spark, bulletin()).drop("niveau_j2"), AT)


def write_archive(path, header, records, sep):
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(sep.join(header) + "\n")
        f.writelines(sep.join(r) + "\n" for r in records)


def test_json_and_archives_give_the_same_rows(spark, tmp_path):
    api = [dict(reference_time=t, dep_code=c, dep_nom=n, niveau_j1=1, niveau_j2=2, autre="x") for t, c, n, _, _ in bulletin()]
    (tmp_path / "b.json").write_text(json.dumps(api), encoding="utf-8")
    from_api = ingest.prepare_bulletin_payload(landing.read_bulletins(spark, str(tmp_path / "b.json")), AT)
    records = [("2025-07-01 06:00:00", n, c, "1", "2") for _, c, n, _, _ in bulletin()]
    write_archive(tmp_path / "a.csv.gz", [" Date ", "DEP_NOM", "num_dep", "niveau_j1", "niveau_j2"], records, ";")
    archives = landing.read_archives(spark, {2025: str(tmp_path / "a.csv.gz")})
    from_archives = ingest.prepare_archives(archives, AT)
    assert from_api.collect() == from_archives.collect()


def test_archives_of_several_years_and_delimiters(spark, tmp_path):
    for year, sep in ((2024, ","), (2025, "\t")):
        records = [(f"{year}-07-01T06:00:00Z", c, n, "1", "2") for _, c, n, _, _ in bulletin()]
        write_archive(tmp_path / f"{year}.gz", ["reference_time", "dep_code", "nom_dep", "niveau_j1", "niveau_j2"], records, sep)
    paths = {y: str(tmp_path / f"{y}.gz") for y in (2024, 2025)}
    assert ingest.prepare_archives(landing.read_archives(spark, paths), AT).count() == 192
    with pytest.raises(ContractError, match="in_year"):
        ingest.prepare_archives(landing.read_archives(spark, {2024: paths[2025]}), AT)


def collected(spark, body, codes=("59350",), backup=None, day=DAY):
    primary = payloads(spark, body)
    secondary = payloads(spark, backup) if backup is not None else primary.limit(0)
    return ingest.collect_weather(primary, secondary, manifest(spark, list(codes), day), AT)


def test_payloads_become_keyed_rows(spark):
    out = collected(spark, [daily(), daily(temperature_2m_mean=[7.5])], ["01034", "2A004"]).orderBy("code_insee")
    first, second = out.collect()
    assert out.columns == schemas.RAW_WEATHER.names
    assert (first["code_insee"], first["row_hash"], first["time"]) == ("01034", sha("2026-09-01|01034"), datetime(2026, 9, 1))
    assert (second["code_insee"], second["temperature_2m_mean"]) == ("2A004", 7.5)


def test_a_single_point_may_come_as_an_object(spark):
    assert collected(spark, daily()).count() == 1


@pytest.mark.parametrize(
    "body,rule",
    [
        ([daily("2026-09-02")], "other_day"),
        ([daily(temperature_2m_mean=...)], "variable_absent"),
        ([daily(time=["2026-09-01", "2026-09-02"])], "one_row_per_point"),
        ([], "point_without_answer"),
        ([daily(), daily()], "answer_without_point"),
    ],
)
def test_bad_payloads_are_refused(spark, body, rule):
    with pytest.raises(ContractError, match=rule):
        collected(spark, body)


def test_a_missing_value_replaces_the_whole_batch(spark):
    holes = [daily(precipitation_sum=[None]), daily(temperature_2m_mean=[3.0])]
    backup = [daily(precipitation_sum=[9.0]), daily(temperature_2m_mean=[4.0])]
    out = collected(spark, holes, ["a", "b"], backup)
    assert rows(out, "code_insee", "precipitation_sum", "temperature_2m_mean") == [("a", 9.0, 1.0), ("b", 1.0, 4.0)]
    optional = [daily(snowfall_sum=[None]), daily()]
    kept = collected(spark, optional, ["a", "b"], backup)
    assert rows(kept, "code_insee", "snowfall_sum") == [("a", None), ("b", 1.0)]


def test_weather_day_is_accepted_and_its_faults_refused(spark):
    reference = points(spark, ["a", "b"])
    good = collected(spark, [daily(), daily()], ["a", "b"])
    assert ingest.prepare_weather(good, reference, DAY).count() == 2
    cases = {
        "not_missing:temperature_2m_mean": collected(spark, [daily(temperature_2m_mean=[None]), daily()], ["a", "b"],
                                                     [daily(temperature_2m_mean=[None]), daily()]),
        "same_keys": collected(spark, [daily(), daily()], ["a", "z"]),
        "unique": good.unionByName(good),
        "row_count": good.where("code_insee = 'a'"),
        "not_null:insere_a": good.selectExpr(*[c if c != "insere_a" else "cast(null as timestamp) insere_a" for c in good.columns]),
        "finite": good.selectExpr(*[c if c != "rain_sum" else "double('-inf') rain_sum" for c in good.columns]),
        "key_matches": good.selectExpr(*[c if c != "row_hash" else "'x' row_hash" for c in good.columns]),
        "on_day": good.selectExpr(*[c if c != "time" else "time + interval 1 day time" for c in good.columns]),
    }
    for rule, bad in cases.items():
        with pytest.raises(ContractError, match=rule):
            ingest.prepare_weather(bad, reference, DAY)


def test_text_in_a_measure_fails_or_becomes_null(spark):
    df = spark.createDataFrame([("1.5",), ("x",)], "v string")
    assert rows(landing.coerce_double(df, ["v"], "null")) == sorted([(1.5,), (None,)], key=repr)
    with pytest.raises(Exception, match="Not a number"):
        landing.coerce_double(df, ["v"]).collect()


def test_landing_counts_what_it_writes(spark, tmp_path):
    path = str(tmp_path / landing.landing_name("meteo", DAY))
    assert landing.load_landing(spark.range(5), path, 5) == 5
    with pytest.raises(ContractError):
        landing.load_landing(spark.range(4), path, 5)
    assert spark.read.parquet(path).count() == 4


def test_point_seed(spark, tmp_path):
    (tmp_path / "seed.csv").write_text(
        ",".join(schemas.POINTS.names) + "\nBourg,46.2,5.2,ARA,Ain,01,s, 01034 ,true\n", encoding="utf-8"
    )
    from skyrisk.operators.quality import enforce, validate
    from skyrisk.sources.history import read_points

    seed = read_points(spark, str(tmp_path / "seed.csv"))
    assert rows(seed, "code_insee", "numero_departement", "centroide") == [("01034", "01", True)]
    enforce(validate(seed, ingest.point_rules(1)))
    with pytest.raises(ContractError, match="row_count"):
        enforce(validate(seed, ingest.point_rules()))


def test_a_lacking_batch_without_substitute_is_named(spark):
    primary = spark.createDataFrame([(1, "a", 1.0), (1, "b", None), (2, "c", 1.0), (3, "d", None)], "batch_id int, code_insee string, v double")
    secondary = spark.createDataFrame([(1, "a", 5.0), (2, "c", 9.0)], primary.schema)
    lost = landing.unanswered(primary, secondary, "batch_id", "code_insee", ["v"])
    assert rows(lost, "batch_id", "code_insee") == [(1, "b"), (3, "d")]
    whole = spark.createDataFrame([(1, "a", 5.0), (1, "b", 6.0), (3, "d", 7.0)], primary.schema)
    assert landing.unanswered(primary, whole, "batch_id", "code_insee", ["v"]).isEmpty()
    assert rows(landing.fallback_batch(primary, whole, "batch_id", ["v"])) == [(1, "a", 5.0), (1, "b", 6.0), (2, "c", 1.0), (3, "d", 7.0)]


def counted(spark, df):
    """The frame, and how many of its rows have been read."""
    seen = spark.sparkContext.accumulator(0)

    def run(parts):
        for part in parts:
            seen.add(len(part))
            yield part

    return df.mapInPandas(run, df.schema), seen


def test_bulletins_are_read_once_while_they_land(spark, tmp_path):
    raw, seen = counted(spark, raw_bulletins(spark, bulletin()))
    path = str(tmp_path / "landing" / "one")
    landed = ingest.land_bulletin_payload(raw, path, AT)
    assert seen.value == 96
    assert rows(landed) == rows(ingest.prepare_bulletin_payload(raw_bulletins(spark, bulletin()), AT))
    assert [p.name for p in (tmp_path / "landing").iterdir()] == ["one"]
    plan = landed._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan
    # A refused batch leaves what landed before.
    for bad, rule in ((bulletin(j1="7"), "whole_between:niveau_j1 .96"), (bulletin(codes=["01"] * 96), "unique"), ([], "not_empty")):
        raw, seen = counted(spark, raw_bulletins(spark, bad))
        with pytest.raises(ContractError, match=rule):
            ingest.land_bulletin_payload(raw, path, AT)
        assert seen.value == len(bad)
    assert [p.name for p in (tmp_path / "landing").iterdir()] == ["one"] and spark.read.parquet(path).count() == 96


def test_payloads_are_parsed_once_while_they_land(spark, tmp_path):
    holes = [daily(precipitation_sum=[None]), daily()]
    backup = [daily(precipitation_sum=[9.0]), daily(temperature_2m_mean=[4.0])]
    first, seen = counted(spark, payloads(spark, holes))
    second, again = counted(spark, payloads(spark, backup))
    path = str(tmp_path / "l" / "day")
    landed = ingest.land_weather(first, second, manifest(spark, ["a", "b"], DAY), points(spark, ["a", "b"]), DAY, path, AT)
    assert rows(landed, "code_insee", "precipitation_sum", "temperature_2m_mean") == [("a", 9.0, 1.0), ("b", 1.0, 4.0)]
    assert seen.value == 1 and again.value <= 2  # the names of its batches, then their payloads
    assert [p.name for p in (tmp_path / "l").iterdir()] == ["day"]
    with pytest.raises(ContractError, match="No substitute"):
        ingest.land_weather(first, second.limit(0), manifest(spark, ["a", "b"], DAY), points(spark, ["a", "b"]), DAY, path, AT)
    with pytest.raises(ContractError, match="other_day"):
        ingest.land_weather(payloads(spark, [daily("2026-09-02"), daily()]), second, manifest(spark, ["a", "b"], DAY), points(spark, ["a", "b"]), DAY, path, AT)
    assert [p.name for p in (tmp_path / "l").iterdir()] == ["day"]
