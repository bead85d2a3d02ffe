"""DuckDB SQL for the checked queries, assembled from shared common table expressions."""

from __future__ import annotations

from checks.bindings import AREA_OF_NATION, GUESS, LEVEL_J1, LEVEL_J2, MEASURES
from skyrisk import schemas
from skyrisk.plans import marts

NAMES = schemas.WEATHER_NAMES
DIGITS = 9


def _list(items, sep=", ") -> str:
    return sep.join(items)


def rounded(columns, prefix: str = "") -> str:
    return _list(f"ROUND({prefix}{c}, {DIGITS}) AS {c}" for c in columns)


# Averages and sums: rounded on both sides, because summation order is free.
AREA_FLOATS = [
    "temperature_moyenne", "humidite_moyenne", "precipitations_totales", "precipitations_moyennes",
    "vitesse_vent_moyenne", "couverture_nuageuse_moyenne",
]
AREA_EXACT = [
    "temperature_minimale", "temperature_maximale", "rafale_vent_maximale", "deficit_pression_vapeur_maximal",
]
ROLLING_FLOATS = ["temperature_moyenne_7j", "humidite_moyenne_7j", "precipitations_7j", "precipitations_moyennes_7j"]
MODEL_FLOATS = [
    "temperature_moyenne", "humidite_moyenne", "precipitations_totales", "precipitations_moyennes", *ROLLING_FLOATS,
]

_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S') || '+00:00'"
_COMPLETE_AREA = " AND ".join(f"{c} IS NOT NULL" for c in marts.AREA_REQUIRED)
_COMPLETE_POINT = " AND ".join(f"{c} IS NOT NULL" for c in marts.POINT_REQUIRED)
_FRAME = (
    "(PARTITION BY numero_departement ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)"
)

# name -> (names it reads, body)
CTES: dict[str, tuple[list[str], str]] = {
    "points": (
        [],
        f"""SELECT s_name AS commune, s_acctbal AS latitude, CAST(s_suppkey AS DOUBLE) AS longitude,
            r_name AS region, n_name AS departement, {AREA_OF_NATION.format('n_nationkey', 'VARCHAR')} AS numero_departement,
            'service ' || CAST(r_regionkey AS VARCHAR) AS service, printf('%05d', s_suppkey) AS code_insee,
            s_acctbal >= 0 AS centroide
            FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "raw_weather": (
        [],
        f"""SELECT l_shipdate AS time, printf('%05d', l_suppkey) AS code_insee,
            sha256(strftime(l_shipdate, '%Y-%m-%d') || '|' || printf('%05d', l_suppkey) || '|' || CAST(l_orderkey AS VARCHAR)
                || '|' || CAST(l_linenumber AS VARCHAR) || '|' || CAST(l_partkey AS VARCHAR)) AS row_hash,
            TIMESTAMP '1970-01-01' + to_seconds(l_orderkey) AS insere_a,
            {_list(f'CAST({e} AS DOUBLE) AS {n}' for n, e in MEASURES.items())}
            FROM lineitem""",
    ),
    "weather": (
        ["raw_weather"],
        f"""SELECT row_hash, insere_a, code_insee, CAST(time AS DATE) AS date,
            CAST(ROUND(weather_code) AS BIGINT) AS code_meteo,
            {_list(f'{source} AS {name}' for source, name in NAMES.items() if name != 'code_meteo')}
            FROM raw_weather""",
    ),
    "observations": (
        ["weather", "points"],
        f"""SELECT row_hash, insere_a, date, code_insee, commune, numero_departement, departement, region,
            latitude, longitude, service, centroide, {_list(NAMES.values())}
            FROM weather JOIN points USING (code_insee)""",
    ),
    "area_day": (
        ["observations"],
        f"""SELECT date, numero_departement, MIN(departement) AS departement, MIN(region) AS region,
            COUNT(DISTINCT code_insee) AS nombre_points_meteo,
            BOOL_AND({_COMPLETE_POINT}) AS mesures_completes,
            AVG(temperature_moyenne) AS temperature_moyenne, MIN(temperature_minimale) AS temperature_minimale,
            MAX(temperature_maximale) AS temperature_maximale, AVG(humidite_moyenne) AS humidite_moyenne,
            SUM(precipitations_totales) AS precipitations_totales, AVG(precipitations_totales) AS precipitations_moyennes,
            AVG(vitesse_vent_moyenne) AS vitesse_vent_moyenne, MAX(rafale_vent_maximale) AS rafale_vent_maximale,
            AVG(couverture_nuageuse_moyenne) AS couverture_nuageuse_moyenne,
            MAX(deficit_pression_vapeur_maximal) AS deficit_pression_vapeur_maximal
            FROM observations GROUP BY ALL""",
    ),
    "areas": (["points"], "SELECT DISTINCT numero_departement, departement, region FROM points"),
    "raw_bulletins": (
        [],
        f"""SELECT reference_time, ' ' || code AS dep_code, nom_dep, niveau_j1, niveau_j2,
            sha256({_ISO.format('reference_time')} || '|' || code || '|' || CAST(o_orderkey AS VARCHAR)) AS row_hash,
            TIMESTAMP '1970-01-01' + to_seconds(o_orderkey // 100) AS insere_a, o_orderkey
            FROM (SELECT o_orderkey, o_orderdate + to_hours(CAST(6 * (o_orderkey % 2) AS INTEGER)) AS reference_time,
                {AREA_OF_NATION.format('c_nationkey', 'VARCHAR')} AS code, n_name || ' ' AS nom_dep,
                {LEVEL_J1} AS niveau_j1, {LEVEL_J2} AS niveau_j2
                FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)""",
    ),
    "bulletins": (
        ["raw_bulletins"],
        """SELECT DISTINCT ON (reference_time, dep_code) row_hash, insere_a, reference_time,
            CAST(reference_time AS DATE) AS date_publication, CAST(reference_time AS DATE) + 1 AS date_j1,
            CAST(reference_time AS DATE) + 2 AS date_j2, trim(dep_code) AS numero_departement,
            trim(nom_dep) AS departement, niveau_j1, niveau_j2
            FROM raw_bulletins ORDER BY reference_time, dep_code, insere_a DESC, row_hash DESC""",
    ),
    "danger": (
        ["bulletins"],
        """SELECT row_hash || '-J' || CAST(h AS VARCHAR) AS id_danger_incendie, reference_time, date_publication,
            date_publication + CAST(h AS INTEGER) AS date_prevision, numero_departement, 'J' || CAST(h AS VARCHAR) AS echeance,
            CASE h WHEN 1 THEN niveau_j1 ELSE niveau_j2 END AS niveau_danger, insere_a
            FROM bulletins, range(1, 3) AS r(h)""",
    ),
    "danger_weather": (
        ["danger", "areas", "area_day"],
        f"""SELECT d.id_danger_incendie, d.reference_time, d.date_publication, d.date_prevision, d.echeance,
            d.numero_departement, a.departement, a.region, d.niveau_danger, w.date AS date_meteo_utilisee,
            date_diff('day', w.date, d.date_publication) AS retard_meteo_jours, w.nombre_points_meteo,
            {_list(f'w.{c}' for c in AREA_FLOATS + AREA_EXACT if c != 'precipitations_moyennes')},
            w.date IS NOT NULL AS meteo_disponible
            FROM danger d JOIN areas a USING (numero_departement)
            ASOF LEFT JOIN area_day w
              ON d.numero_departement = w.numero_departement AND d.date_publication >= w.date""",
    ),
    "rolling": (
        ["area_day"],
        f"""SELECT *, AVG(temperature_moyenne) OVER w AS temperature_moyenne_7j,
            MAX(temperature_maximale) OVER w AS temperature_maximale_7j, AVG(humidite_moyenne) OVER w AS humidite_moyenne_7j,
            SUM(precipitations_totales) OVER w AS precipitations_7j,
            CASE WHEN COUNT(precipitations_moyennes) OVER w = 7 THEN SUM(precipitations_moyennes) OVER w END
                AS precipitations_moyennes_7j,
            MAX(rafale_vent_maximale) OVER w AS rafale_vent_maximale_7j,
            MAX(deficit_pression_vapeur_maximal) OVER w AS deficit_pression_vapeur_maximal_7j,
            CASE WHEN COUNT(precipitations_moyennes) OVER w = 7
                THEN CAST(SUM(CASE WHEN precipitations_moyennes = 0 THEN 1 ELSE 0 END) OVER w AS BIGINT) END AS jours_sans_pluie_7j,
            CAST(SUM(CASE WHEN mesures_completes AND {_COMPLETE_AREA} THEN 1 ELSE 0 END) OVER w AS BIGINT) AS nombre_jours_meteo_7j
            FROM area_day WINDOW w AS {_FRAME}""",
    ),
    "features": (
        ["rolling", "danger"],
        f"""SELECT CAST(date_publication AS VARCHAR) || '|' || p.numero_departement AS id_feature, date_publication,
            r.date AS meteo_date, p.numero_departement, departement, region, nombre_points_meteo,
            {_list(marts.SAME_DAY)}, {_list(marts.ROLLING)}, nombre_jours_meteo_7j,
            COALESCE(nombre_jours_meteo_7j = 7, FALSE) AS meteo_disponible
            FROM (SELECT DISTINCT date_publication, numero_departement FROM danger) p
            LEFT JOIN rolling r ON r.date = date_publication AND r.numero_departement = p.numero_departement""",
    ),
    "day_danger": (
        ["danger"],
        """SELECT DISTINCT ON (date_publication, numero_departement, echeance) * FROM danger
            ORDER BY date_publication, numero_departement, echeance, reference_time DESC, insere_a DESC,
                id_danger_incendie DESC""",
    ),
    "training": (
        ["day_danger", "features", "areas"],
        f"""SELECT CAST(d.date_publication AS VARCHAR) || '|' || d.numero_departement || '|' || echeance AS id_apprentissage,
            d.reference_time, d.date_publication, d.date_prevision, d.numero_departement, a.departement, a.region,
            d.echeance, CAST(substr(echeance, 2) AS BIGINT) AS horizon_jours, niveau_danger AS cible_niveau_danger,
            meteo_date, nombre_points_meteo, {_list('f.' + c for c in marts.SAME_DAY)},
            {_list('f.' + c for c in marts.ROLLING)}, meteo_disponible
            FROM day_danger d JOIN features f USING (date_publication, numero_departement)
            JOIN areas a ON a.numero_departement = d.numero_departement""",
    ),
    "explored": (
        ["danger", "areas"],
        "SELECT danger.*, departement, region FROM danger LEFT JOIN areas USING (numero_departement)",
    ),
    "guessed": (
        ["training"],
        f"""SELECT *, {GUESS} AS niveau_predit,
            CASE WHEN year(date_prevision) BETWEEN 1995 AND 1999 THEN 'train'
                WHEN year(date_prevision) = 2000 AND date_prevision <= DATE '2000-10-02' THEN 'test'
                ELSE 'hors_periode' END AS partie
            FROM training WHERE meteo_disponible
              AND {' AND '.join(f'{c} IS NOT NULL' for c in schemas.MODEL_FEATURES)}""",
    ),
    "bounds": (
        ["weather", "points", "bulletins"],
        """SELECT LEAST(a, c) AS date_min, GREATEST(b, d) AS date_max FROM
            (SELECT MIN(date) AS a, MAX(date) AS b FROM weather JOIN points USING (code_insee)),
            (SELECT MIN(date_j1) AS c, MAX(date_j2) AS d FROM bulletins)""",
    ),
    "calendar": (
        ["bounds"],
        "SELECT CAST(UNNEST(generate_series(date_min, date_max, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds",
    ),
    "regional": (
        [],
        """SELECT CAST(o_orderdate AS DATE) AS jour, 'R' || CAST(n_regionkey AS VARCHAR) AS code_insee,
            MAX(CASE WHEN o_totalprice > 30000 THEN o_totalprice END) AS prix
            FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""",
    ),
    "validity": (
        ["area_day"],
        """SELECT numero_departement, date, COALESCE(LEAD(date) OVER (PARTITION BY numero_departement ORDER BY date),
            DATE '9999-12-31') AS date_suivante FROM area_day""",
    ),
    "point_days": (
        ["raw_weather"],
        f"""SELECT code_insee, CAST(time AS DATE) AS jour,
            {_list(f'MAX({v}) AS {v}' for v in schemas.REQUIRED_VARIABLES)}
            FROM raw_weather GROUP BY 1, 2""",
    ),
}


def sql(needs: list[str], body: str) -> str:
    """``body`` after the common table expressions it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for parent in CTES[name][0]:
            visit(parent)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name][1]})" for name in order) + "\n" + body
