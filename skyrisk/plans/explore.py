"""Descriptive tables over the announced levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyrisk import schemas
from skyrisk.functions.scalars import level_name, round_even2
from skyrisk.operators import aggregates as A
from skyrisk.operators.reshape import pivot_pairs

LEVEL = "niveau_danger"
LABELS = list(schemas.HORIZONS)


def with_areas(danger: DataFrame, areas: DataFrame) -> DataFrame:
    """Levels with area names; unlike the published table, unknown areas are kept."""
    return danger.join(areas.select("numero_departement", "departement", "region"), "numero_departement", "left")


def _high():
    return F.col(LEVEL) >= 3


def _mean_level():
    return round_even2(F.avg(LEVEL)).alias("niveau_moyen")


def _high_share():
    return round_even2(A.share_where(_high())).alias("pct_danger_eleve")


def overview(df: DataFrame) -> DataFrame:
    return df.agg(
        A.count_rows().alias("lignes"),
        F.min("date_publication").alias("debut"),
        F.max("date_publication").alias("fin"),
        F.count_distinct("numero_departement").alias("departements"),
        F.array_join(F.array_sort(F.collect_set("echeance")), ",").alias("echeances"),
    )


def out_of_domain(df: DataFrame) -> DataFrame:
    """Levels outside 1..4; a null level is outside."""
    inside = F.coalesce(F.col(LEVEL).between(1, 4), F.lit(False))
    return df.agg(F.count_if(~inside).alias("niveaux_invalides"))


def incomplete_coverage(df: DataFrame) -> DataFrame:
    return A.coverage(df, ["reference_time", "echeance"], "numero_departement", "departements").orderBy(
        "reference_time", "echeance"
    )


def level_distribution(df: DataFrame) -> DataFrame:
    return A.distribution(df, LEVEL, schemas.LEVELS, schemas.LEVEL_NAMES)


def level_by_horizon(df: DataFrame) -> DataFrame:
    table = A.crosstab_pct(df, LEVEL, "echeance", schemas.LEVELS, LABELS)
    return table.select(LEVEL, level_name(LEVEL).alias("libelle"), *LABELS)


def month_profile(df: DataFrame) -> DataFrame:
    month = F.month("date_prevision").cast("long").alias("mois")
    return (
        df.dropna(subset=["date_prevision", "echeance"])
        .groupBy(month, "echeance")
        .agg(_mean_level(), _high_share())
        .orderBy("mois", "echeance")
    )


def area_profile(df: DataFrame) -> DataFrame:
    return (
        df.dropna(subset=["numero_departement", "departement"])
        .groupBy("numero_departement", "departement")
        .agg(
            A.count_rows().alias("observations"),
            _mean_level(),
            _high_share(),
            F.count_if(F.col(LEVEL) == 4).alias("nb_tres_eleve"),
        )
    )


def rank_areas(df: DataFrame, n: int = 15) -> DataFrame:
    """Areas most often at level 3 or 4; equal shares are ordered by code."""
    return area_profile(df).orderBy(F.col("pct_danger_eleve").desc(), "numero_departement").limit(n)


def rank_regions(df: DataFrame) -> DataFrame:
    return (
        df.dropna(subset=["region"])
        .groupBy("region")
        .agg(_high_share())
        .orderBy(F.col("pct_danger_eleve").desc(), "region")
    )


def rank_days(df: DataFrame, n: int = 15) -> DataFrame:
    """Target days on which danger is most widespread."""
    return (
        df.dropna(subset=["date_prevision", "echeance"])
        .groupBy("date_prevision", "echeance")
        .agg(
            F.count_if(_high()).alias("departements_niveau_3_ou_4"),
            F.count_if(F.col(LEVEL) == 4).alias("departements_niveau_4"),
            _mean_level(),
        )
        .orderBy(
            F.col("departements_niveau_3_ou_4").desc(),
            F.col("departements_niveau_4").desc(),
            "date_prevision",
            "echeance",
        )
        .limit(n)
    )


def horizon_pairs(df: DataFrame) -> DataFrame:
    """Both levels of each bulletin and area, and their direction."""
    wide = pivot_pairs(df, ["reference_time", "numero_departement"], "echeance", LEVEL, LABELS)
    first, second = F.col("J1"), F.col("J2")
    return wide.withColumn(
        "evolution",
        F.when(second > first, "Hausse").when(second < first, "Baisse").otherwise("Stable"),
    )


def horizon_evolution(df: DataFrame) -> DataFrame:
    """Share of each direction among the complete pairs."""
    names = ["Stable", "Hausse", "Baisse"]
    totals = horizon_pairs(df).agg(
        A.count_rows().alias("total"),
        *[F.count_if(F.col("evolution") == n).alias(n) for n in names],
    )
    rows = [F.struct(F.lit(n).alias("evolution"), F.col(n).alias("n")) for n in names]
    return (
        totals.select("total", F.inline(F.array(*rows)))
        .where("n > 0")
        .select("evolution", round_even2(F.col("n") / F.col("total") * 100.0).alias("pourcentage"))
        .orderBy(F.col("pourcentage").desc(), "evolution")
    )


def summary(df: DataFrame) -> DataFrame:
    """The headline facts in one row; ties go to the smallest value."""
    facts = df.agg(
        F.mode(LEVEL, deterministic=True).alias("niveau_dominant"),
        F.round(A.share_where(_high()), 1).alias("pct_danger_eleve"),
    )
    top = rank_areas(df, 1).select("departement", F.col("pct_danger_eleve").alias("pct_departement"))
    change = horizon_evolution(df).limit(1).select("evolution")
    return facts.select(
        level_name("niveau_dominant").alias("niveau_dominant"),
        "pct_danger_eleve",
        top.select("departement").scalar().alias("departement"),
        top.select("pct_departement").scalar().alias("pct_departement"),
        change.scalar().alias("evolution"),
    )


def area_options(df: DataFrame) -> DataFrame:
    """Choices for a selector: label and code."""
    return (
        df.select("numero_departement", "departement")
        .distinct()
        .select(F.concat("numero_departement", F.lit(" - "), "departement").alias("libelle"), "numero_departement")
        .orderBy("numero_departement")
    )


def filter_cases(df: DataFrame, target_day=None, area: str | None = None, horizon: str | None = None) -> DataFrame:
    for column, value in (("date_prevision", target_day), ("numero_departement", area), ("echeance", horizon)):
        if value is not None:
            df = df.where(F.col(column) == F.lit(value))
    return df
