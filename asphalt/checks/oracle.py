"""The registered questions as SQL for DuckDB, stated independently of the Spark code."""

from __future__ import annotations

from itertools import combinations
from math import factorial

from asphalt.checks import parameters as P
from asphalt.checks.views import duckdb_clauses
from asphalt.schema import (
    DEPLOYABLE, FEATURES, INFRA, NUMERIC_CONTROLS, RAW_COLUMNS, WEATHER_NUMERIC, normal_name,
)

R, COS, SQRT3 = "6371007.2E0", "cos(radians(37.0E0))", "sqrt(3.0E0)"
T = P.STAND_IN

BUCKET = """CASE
  WHEN regexp_matches(w, 'snow|sleet|wintry|ice') THEN 'Snow'
  WHEN regexp_matches(w, 'rain|drizzle|shower|thunder') THEN 'Rain'
  WHEN regexp_matches(w, 'fog|mist|haze') THEN 'Fog'
  WHEN regexp_matches(w, 'cloud|overcast') THEN 'Cloud'
  WHEN regexp_matches(w, 'clear|fair') THEN 'Clear' ELSE 'Other' END"""


def cleaned(name: str, source: str, night: bool = True) -> str:
    flag = "COALESCE(CAST(sunrise_sunset = 'Night' AS INT), 0) AS is_night," if night else ""
    return f"""{name} AS (SELECT *, CAST(severity >= {T.severe_from} AS INT) AS grave,
      CAST(COALESCE(hour(start_time), 0) AS INT) AS hour, CAST(dayofweek(start_time) + 1 AS INT) AS dow,
      CAST(month(start_time) AS INT) AS month, CAST(year(start_time) AS INT) AS year, {flag}
      {BUCKET} AS weather_bucket
      FROM (SELECT *, lower(COALESCE(weather_condition, '')) AS w FROM {source})
      WHERE severity IS NOT NULL)"""


CLEAN_RAW = """kept AS (SELECT * EXCLUDE (""" + ", ".join(INFRA) + """), """ + ", ".join(
    f"COALESCE(CAST({e} AS INT), 0) AS {e}" for e in INFRA) + """ FROM raw_incidents
  WHERE severity IS NOT NULL AND start_lat IS NOT NULL AND start_lng IS NOT NULL)"""
CLEAN = f"{CLEAN_RAW},\n" + cleaned("acc", "kept")
TIMED = cleaned("timed", "incidents_ts", night=False)


def r6(expression: str, name: str | None = None, digits: int = 6) -> str:
    return f"ROUND({expression}, {digits}) + 0.0E0" + (f" AS {name}" if name else f" AS {expression}")


def hexed(name: str, source: str, resolution: int = 8, column: str = "cell") -> str:
    area = f"(0.7373E6 * pow(7.0E0, {8 - resolution}))"
    side = f"sqrt(2.0E0 * {area} / (3.0E0 * {SQRT3}))"
    return f"""{name} AS (
      SELECT * EXCLUDE (hx, hy, hq, hr, rq, rr, rt),
        '{resolution}:' || CAST(CAST(CASE WHEN abs(rq - hq) > abs(rr - hr) AND abs(rq - hq) > abs(rt + hq + hr)
          THEN -rr - rt ELSE rq END AS BIGINT) AS VARCHAR) || ':' ||
        CAST(CAST(CASE WHEN abs(rq - hq) > abs(rr - hr) AND abs(rq - hq) > abs(rt + hq + hr) THEN rr
          WHEN abs(rr - hr) > abs(rt + hq + hr) THEN -rq - rt ELSE rr END AS BIGINT) AS VARCHAR) AS {column}
      FROM (SELECT *, floor(hq + 0.5E0) AS rq, floor(hr + 0.5E0) AS rr, floor(-hq - hr + 0.5E0) AS rt
        FROM (SELECT *, ({SQRT3} / 3.0E0 * hx - hy / 3.0E0) / {side} AS hq, (2.0E0 / 3.0E0 * hy) / {side} AS hr
          FROM (SELECT *, {R} * radians(start_lng) * {COS} AS hx, {R} * sin(radians(start_lat)) / {COS} AS hy
            FROM {source}))))"""


def zones(name: str = "zones", source: str = "cells", keys: str = "") -> str:
    flags = ", ".join(
        f"CAST(SUM({e}) AS BIGINT) AS n_{e}, CAST(SUM(severity * {e}) AS BIGINT) AS charge_{e}" for e in INFRA)
    by = f"{keys + ', ' if keys else ''}cell"
    return f"""{name} AS (SELECT {by}, COUNT(*) AS n_accidents, AVG(severity) AS avg_severity,
      CAST(SUM(severity) AS BIGINT) AS charge, {flags} FROM {source} GROUP BY {by})"""


CELLS = hexed("cells", "acc")
ZONES = zones()


def walk(resolution: int = 8) -> str:
    """Road segments as pieces and ends, at the position that tells their cell."""
    side = f"sqrt(2.0E0 * 0.7373E6 * pow(7.0E0, {8 - resolution}) / (3.0E0 * {SQRT3}))"
    axes = ("q{0} - r{0}", "q{0} + 2 * r{0}", "-2 * q{0} - r{0}")
    cuts = ", ".join(
        f"[(k - ({a})) / (({b}) - ({a})) FOR k IN generate_series(CAST(floor(least({a}, {b})) AS BIGINT) + 1,"
        f" CAST(ceil(greatest({a}, {b})) AS BIGINT) - 1)]" for a, b in ((axis.format(0), axis.format(1)) for axis in axes))
    return f"""road_ends AS (SELECT *, COALESCE(end_lat, start_lat) AS to_lat, COALESCE(end_lng, start_lng) AS to_lng FROM road_segments),
road_plane AS (SELECT *, {R} * radians(start_lng) * {COS} AS x0, {R} * sin(radians(start_lat)) / {COS} AS y0,
  {R} * radians(to_lng) * {COS} AS x1, {R} * sin(radians(to_lat)) / {COS} AS y1 FROM road_ends),
road_axes AS (SELECT *, ({SQRT3} / 3.0E0 * x0 - y0 / 3.0E0) / {side} AS q0, (2.0E0 / 3.0E0 * y0) / {side} AS r0,
  ({SQRT3} / 3.0E0 * x1 - y1 / 3.0E0) / {side} AS q1, (2.0E0 / 3.0E0 * y1) / {side} AS r1 FROM road_plane),
road_cuts AS (SELECT segment_id, unnest(list_sort(flatten([[0.0E0, 1.0E0], {cuts}]))) AS high FROM road_axes),
road_shares AS (SELECT segment_id, LAG(high) OVER (PARTITION BY segment_id ORDER BY high) AS low, high FROM road_cuts),
road_parts AS (
  SELECT segment_id, low, high, FALSE AS is_end, FALSE AS last FROM road_shares WHERE high - low > 1E-9
  UNION ALL SELECT segment_id, 0, 0, TRUE, FALSE FROM road_segments UNION ALL SELECT segment_id, 1, 1, TRUE, TRUE FROM road_segments),
road_spots AS (SELECT p.is_end, CASE WHEN p.last THEN v ELSE u END AS node, (high - low) * length_m AS length_m,
  degrees(asin((y0 + (y1 - y0) * (low + high) / 2) * {COS} / {R})) AS start_lat,
  degrees((x0 + (x1 - x0) * (low + high) / 2) / ({R} * {COS})) AS start_lng
  FROM road_parts p JOIN road_plane s ON p.segment_id = s.segment_id)"""


ROADS = walk() + ",\n" + hexed("road_cells", "road_spots")
EXPOSURE = """roads AS (
  SELECT s.cell, s.street_km, COALESCE(i.n_intersections, 0) AS n_intersections
  FROM (SELECT cell, ROUND(SUM(length_m) / 1000, 6) AS street_km FROM road_cells GROUP BY cell) s
  LEFT JOIN (SELECT cell, COUNT(*) AS n_intersections FROM (
      SELECT cell, node FROM road_cells WHERE is_end GROUP BY cell, node HAVING COUNT(*) >= 2) GROUP BY cell) i ON s.cell = i.cell)"""
EXPOSED = """exposed AS (SELECT z.*, r.street_km, r.n_intersections,
  CASE WHEN r.street_km <> 0 THEN z.n_accidents / r.street_km END AS acc_per_km,
  CASE WHEN r.street_km <> 0 THEN z.charge / r.street_km END AS charge_per_km
  FROM {zones} z LEFT JOIN roads r ON z.cell = r.cell)"""
TYPED = """typed AS (SELECT *, CASE WHEN m IS NULL THEN 'n/d (pas d''exposition)' WHEN acc_per_km IS NULL THEN 'n/d (hors top OSM)'
  WHEN acc_per_km >= m THEN 'point noir concentré' ELSE 'réseau étendu (volume diffus)' END AS type_zone
  FROM exposed, (SELECT median(acc_per_km) AS m FROM exposed))"""


def z_score(**fixed: int) -> str:
    terms = [f"{fixed.get(c, c)} * {w!r}E0" for c, w in P.COEFFICIENTS.items()]
    return " + ".join([f"{P.INTERCEPT!r}E0", *terms])


def probability(**fixed: int) -> str:
    return f"1.0E0 / (1.0E0 + exp(-({z_score(**fixed)})))"


TEST = f"test AS (SELECT * FROM acc WHERE year >= {T.test_from})"
TRAIN = f"train AS (SELECT * FROM acc WHERE year < {T.test_from})"
SCORED = f"scored AS (SELECT ROUND({probability()}, 9) AS score, grave AS label FROM test)"
CURVE = """pts AS (SELECT score, SUM(label) AS pos, COUNT(*) AS n FROM scored GROUP BY score),
curve AS (SELECT score, pos, n, SUM(pos) OVER (ORDER BY score DESC) AS cp, SUM(n) OVER (ORDER BY score DESC) AS cn,
  SUM(pos) OVER () AS ap, SUM(n) OVER () AS an FROM pts)"""

DELTAS = "deltas AS (SELECT *, " + ", ".join(
    f"{probability(**{m: 1})} - {probability(**{m: 0})} AS d_{m}" for m in DEPLOYABLE) + " FROM test)"
PAIRS = [(h, m) for h in INFRA for m in DEPLOYABLE if h != m]
CONDITIONAL = "cond AS (" + " UNION ALL ".join(
    f"SELECT '{h}' AS hazard, '{m}' AS measure, COUNT(*) AS n,"
    f" CASE WHEN COUNT(*) >= {T.min_rows} THEN AVG(d_{m}) END AS delta FROM deltas WHERE {h} = 1" for h, m in PAIRS) + ")"
RAW_PAIRS = "raw_pairs AS (" + " UNION ALL ".join(
    f"SELECT '{h}' AS hazard, '{m}' AS measure, LEAST(COUNT(*) FILTER ({m} = 1), COUNT(*) FILTER ({m} = 0)) AS n,"
    f" CASE WHEN LEAST(COUNT(*) FILTER ({m} = 1), COUNT(*) FILTER ({m} = 0)) >= {T.min_rows} THEN"
    f" AVG(severity) FILTER ({m} = 1) - AVG(severity) FILTER ({m} = 0) END AS delta FROM acc WHERE {h} = 1"
    for h, m in PAIRS) + ")"


def lifted(name: str, source: str, weight: str) -> str:
    """Dominant hazard of the zones of ``source`` against all ``zones``."""
    prefix, total = {"severity": ("charge_", "charge"), "count": ("n_", "n_accidents")}[weight]
    long = " UNION ALL ".join(
        f"SELECT cell, {i} AS place, '{e}' AS element, CASE WHEN s.{e} > 0 THEN ({prefix}{e} / GREATEST({total}, 1))"
        f" / s.{e} ELSE 0.0E0 END AS lift FROM {source}, {name}_shares s" for i, e in enumerate(INFRA))
    shares = ", ".join(f"SUM({prefix}{e}) / GREATEST(SUM({total}), 1) AS {e}" for e in INFRA)
    return f"""{name}_shares AS (SELECT {shares} FROM zones), {name}_long AS ({long}),
    {name} AS (SELECT cell, lift, CASE WHEN lift >= {T.lift_min} THEN element ELSE 'diffus' END AS dominant FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY cell ORDER BY lift DESC, place) AS rn FROM {name}_long) WHERE rn = 1)"""


def presence(element: str) -> str:
    return f"(n_{element} / GREATEST(n_accidents, 1))"


EQUIPMENT = "COALESCE(NULLIF(concat_ws(', ', " + ", ".join(
    f"CASE WHEN {presence(e)} >= {T.presence_min} THEN '{e}' END" for e in INFRA) + "), ''), '—')"
LABELS = {
    "traffic_signal": "installer des feux", "crossing": "sécuriser passage piéton", "stop": "stop / cédez-le-passage",
    "traffic_calming": "modération de trafic (ralentisseurs)",
}
CASE_LABEL = "CASE measure " + " ".join(f"WHEN '{m}' THEN '{t}'" for m, t in LABELS.items()) + " END"


PLAN_TEXTS = {
    "diffuse": "investiguer facteur humain (vitesse / contrôle)", "equipped": "déjà équipé — revoir géométrie / abords",
    "railway": "sécuriser le passage à niveau (barrières/feux)", "measures": CASE_LABEL,
}
SCREEN_TEXTS = {
    "diffuse": "Investiguer facteur humain (vitesse/contrôles)", "equipped": "Déjà équipé - étude géométrie/abords",
    "railway": "Sécuriser le passage à niveau",
    "measures": "CASE measure WHEN 'traffic_signal' THEN 'Installer des feux' WHEN 'crossing' THEN 'Sécuriser un passage piéton'"
                " WHEN 'stop' THEN 'Poser stop / cédez-le-passage' WHEN 'traffic_calming' THEN"
                " 'Modération de trafic (ralentisseurs)' END",
}
NAMES = """names AS (SELECT * FROM (VALUES ('junction', 'carrefour'), ('crossing', 'passage piéton'), ('stop', 'stop'),
        ('traffic_signal', 'feux'), ('railway', 'passage à niveau'), ('station', 'station'), ('roundabout', 'rond-point'),
        ('bump', 'dos d''âne'), ('give_way', 'cédez-le-passage'), ('no_exit', 'impasse'),
        ('traffic_calming', 'modération trafic'), ('amenity', 'équipement public')) AS t(code, fr))"""
REASON = """CASE
      WHEN dominant = 'diffus' THEN 'aucun défaut d''infrastructure ne domine dans cette zone'
      WHEN measure IS NULL THEN 'aléa « ' || hn.fr || ' » mais les mesures efficaces sont déjà en place'
      ELSE 'aléa dominant « ' || hn.fr || ' » (×' || CAST(round_even(lift, 1) AS VARCHAR) || ' vs moyenne) ; « ' || mn.fr ||
        ' » absent alors qu''il réduit la gravité de ' || CAST(round_even(ABS(measure_delta) * 100, 1) AS VARCHAR) ||
        ' pts dans ce contexte' END"""
NAMED = "reco LEFT JOIN names hn ON hn.code = dominant LEFT JOIN names mn ON mn.code = measure"
YEARS = "(SELECT GREATEST(COUNT(DISTINCT (year, month)) / 12.0E0, 1E-9) FROM acc WHERE year IS NOT NULL)"


def recommended(source: str, lift: str, texts: dict[str, str] = PLAN_TEXTS) -> str:
    """Recommendation for the zones of ``source``, which has one row per cell."""
    present = "CASE c.measure " + " ".join(f"WHEN '{m}' THEN {presence(m)}" for m in DEPLOYABLE) + " END"
    order = "CASE c.measure " + " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(DEPLOYABLE)) + " END"
    return f"""picked AS (SELECT cell, measure, delta FROM (
        SELECT z.cell, c.measure, c.delta, ROW_NUMBER() OVER (PARTITION BY z.cell ORDER BY c.delta, {order}) AS rn
        FROM {source} z JOIN {lift} h ON z.cell = h.cell JOIN cond c ON c.hazard = h.dominant
        WHERE c.delta < 0 AND {present} < {T.presence_min}) WHERE rn = 1),
      reco AS (SELECT z.*, h.dominant, h.lift, p.measure, p.delta AS measure_delta, {EQUIPMENT} AS equip_present,
        CASE WHEN h.dominant = 'diffus' THEN '{texts["diffuse"]}'
          WHEN p.measure IS NULL THEN '{texts["equipped"]}'
          WHEN h.dominant = 'railway' THEN '{texts["railway"]}'
          ELSE {texts["measures"]} END AS amenagement,
        COALESCE(ABS(p.delta) * z.n_accidents, 0.0E0) AS impact_graves_evites
        FROM {source} z JOIN {lift} h ON z.cell = h.cell LEFT JOIN picked p ON z.cell = p.cell)"""


TOP = f"""top AS (SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY charge DESC, cell) AS INT) AS rank FROM zones
  ORDER BY charge DESC, cell LIMIT {T.top_zones})"""
PLAN_CHAIN = [
    CLEAN, CELLS, ZONES, TOP, ROADS, EXPOSURE, EXPOSED.format(zones="top"), TYPED, lifted("hazard", "zones", "severity"),
    TEST, DELTAS, CONDITIONAL, recommended("typed", "hazard"),
    """plan AS (SELECT rank, cell, n_accidents, charge, round_even(avg_severity, 3) AS avg_severity,
      round_even(street_km, 2) AS street_km, n_intersections, round_even(charge_per_km, 2) AS charge_per_km, type_zone,
      dominant, round_even(lift, 2) AS lift, equip_present, amenagement,
      round_even(impact_graves_evites, 1) AS impact_graves_evites FROM reco)""",
]
PLAN_VIEWS = ("raw_incidents", "road_segments")
BURDENS = f"""early AS (SELECT cell, SUM(severity) AS v FROM cells WHERE year BETWEEN {T.early[0]} AND {T.early[1]} GROUP BY cell),
late AS (SELECT cell, SUM(severity) AS v FROM cells WHERE year BETWEEN {T.late[0]} AND {T.late[1]} GROUP BY cell)"""


def with_clauses(select: str, *clauses: str, views: tuple[str, ...] = ("raw_incidents",)) -> str:
    return "WITH " + ",\n".join([*duckdb_clauses(*views), *clauses]) + "\n" + select


def on_clean(select: str, *clauses: str) -> str:
    return with_clauses(select, CLEAN, *clauses)


def on_zones(select: str, *clauses: str) -> str:
    return with_clauses(select, CLEAN, CELLS, ZONES, *clauses)


def on_scored(select: str) -> str:
    return with_clauses(select, CLEAN, TEST, SCORED, CURVE)


def on_plan(select: str) -> str:
    return with_clauses(select, *PLAN_CHAIN, views=PLAN_VIEWS)


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def avg_rank(value: str, partition: str = "") -> str:
    by = f"PARTITION BY {partition} " if partition else ""
    ties = f"PARTITION BY {partition + ', ' if partition else ''}{value}"
    return f"(RANK() OVER ({by}ORDER BY {value} DESC) + (COUNT(*) OVER ({ties}) - 1) / 2.0E0)"


RAW_NAMES = [normal_name(c) for c in RAW_COLUMNS]
RAW_PRESENT = with_clauses(
    union([f"SELECT '{c}' AS \"column\", COUNT({c}) AS n_present FROM raw_incidents" for c in RAW_NAMES]),
    views=("raw_incidents",))

def sweep_row(threshold: float) -> str:
    return f"""SELECT {threshold!r}E0 AS threshold, COUNT(*) FILTER (score < {threshold!r}E0 AND label = 0) AS tn,
      COUNT(*) FILTER (score >= {threshold!r}E0 AND label = 0) AS fp,
      COUNT(*) FILTER (score < {threshold!r}E0 AND label = 1) AS fn,
      COUNT(*) FILTER (score >= {threshold!r}E0 AND label = 1) AS tp FROM scored"""


def sweep(thresholds: list[float]) -> str:
    return f"""SELECT threshold, tn, fp, fn, tp, {r6('tp / GREATEST(tp + fn, 1)', 'recall')},
      {r6('tp / GREATEST(tp + fp, 1)', 'precision')}, {r6('2 * tp / GREATEST(2 * tp + fp + fn, 1)', 'f1')},
      {r6('(tp + fn) / GREATEST(tp + fn + tn + fp, 1)', 'base_rate')},
      {r6('(tp / GREATEST(tp + fp, 1)) / GREATEST((tp + fn) / GREATEST(tp + fn + tn + fp, 1), 1E-9)', 'lift')}
      FROM ({union([sweep_row(t) for t in thresholds])})"""


CUBE = """SELECT {state} AS state, {dim} FROM acc GROUP BY ALL"""


def cube(dimension: str, measures: str) -> str:
    return (f"SELECT state, {dimension}, {measures} FROM acc GROUP BY state, {dimension} UNION ALL "
            f"SELECT 'US', {dimension}, {measures} FROM acc GROUP BY {dimension}")


SHARE = f"COUNT(*) AS n, {r6('AVG(grave)', 'part_grave')}"
GRAVES = "COUNT(*) AS n, CAST(SUM(grave) AS BIGINT) AS graves"
AP = "SUM(pos / ap * cp / cn)"
AUC = "SUM((n - pos) * (cp - pos / 2.0E0)) / MAX(ap * (an - ap))"
EVENT = """CASE WHEN (m = 12 AND d >= 24) OR (m = 1 AND d <= 2) THEN 'Noël / Nouvel An'
  WHEN m = 11 AND d BETWEEN 22 AND 28 THEN 'Sem. Thanksgiving' WHEN m = 7 AND d BETWEEN 3 AND 5 THEN '4 Juillet'
  WHEN m = 5 AND d >= 25 THEN 'Memorial Day (approx.)' ELSE 'Période normale' END"""
EVENTS = f"""ev AS (SELECT *, {EVENT} AS event FROM (
  SELECT *, month(start_time) AS m, day(start_time) AS d FROM acc))"""
METHODS = f"""dl AS ({union([
    f"SELECT '{e}' AS element, ABS(AVG(severity) FILTER ({e} = 1) - AVG(severity) FILTER ({e} = 0)) AS value FROM acc"
    for e in INFRA])}),
  gc AS ({union([f"SELECT '{e}' AS element, ABS(AVG({probability(**{e: 1})} - {probability(**{e: 0})})) AS value FROM test"
                 for e in INFRA])}),
  pr AS ({union([f"SELECT '{e}' AS element, AVG({e}) AS value FROM acc" for e in INFRA])}),
  la AS ({union([f"SELECT '{e}' AS element, AVG(ABS(({e} - (SELECT AVG({e}) FROM train)) * {P.COEFFICIENTS[e]!r}E0)) AS value"
                 f" FROM test" for e in INFRA])}),
  vals AS (SELECT method, element, ROUND(value, 9) + 0.0E0 AS value FROM (
    SELECT 'raw' AS method, * FROM dl WHERE value IS NOT NULL UNION ALL SELECT 'adjusted', * FROM gc
    UNION ALL SELECT 'presence', * FROM pr UNION ALL SELECT 'attribution', * FROM la)),
  mranks AS (SELECT method, element, {avg_rank('value', 'method')} AS rank FROM vals)"""
METHOD_NAMES = ["raw", "adjusted", "presence", "attribution"]
METHOD_PAIRS = [(a, b) for i, a in enumerate(METHOD_NAMES) for b in METHOD_NAMES[i + 1:]]


def history(resolution: int) -> str:
    c = f"cell{resolution}"
    return f"""learnt{resolution} AS (SELECT {c}, SUM(grave) AS g, COUNT(*) AS n FROM train GROUP BY {c})"""


def history_columns(resolution: int) -> str:
    t, k = f"l{resolution}", f"{T.history_weight}E0"
    rate = f"COALESCE(({t}.g + (SELECT AVG(grave) FROM train) * {k}) / ({t}.n + {k}), (SELECT AVG(grave) FROM train))"
    return f"{r6(rate, f'zone_hist{resolution}')}, COALESCE({t}.n, 0) AS zone_hist{resolution}_n"


def outline() -> str:
    """Centre and outline points of the zones, straight from the projection."""
    area = "0.7373E6"
    side = f"sqrt(2.0E0 * {area} / (3.0E0 * {SQRT3}))"
    lat = f"degrees(asin(({{y}}) * {COS} / {R}))"
    lng = f"degrees(({{x}}) / ({R} * {COS}))"
    cx, cy = f"{SQRT3} * {side} * (q + r / 2.0E0)", f"1.5E0 * {side} * r"
    px = f"{cx} + {side} * cos(radians(60.0E0 * (corner % 6) + 30))"
    py = f"{cy} + {side} * sin(radians(60.0E0 * (corner % 6) + 30))"
    return f"""SELECT cell, charge, {r6(lat.format(y=cy), 'centre_lat')}, {r6(lng.format(x=cx), 'centre_lng')},
      CAST(corner AS INT) AS corner, {r6(lat.format(y=py), 'lat')}, {r6(lng.format(x=px), 'lng')}
      FROM (SELECT *, CAST(split_part(cell, ':', 2) AS BIGINT) AS q, CAST(split_part(cell, ':', 3) AS BIGINT) AS r
        FROM zones), range(7) t(corner)"""


def centre(column: str) -> str:
    side = f"sqrt(2.0E0 * 0.7373E6 / (3.0E0 * {SQRT3}))"
    q, r = "CAST(split_part(cell, ':', 2) AS BIGINT)", "CAST(split_part(cell, ':', 3) AS BIGINT)"
    if column == "lat":
        return f"degrees(asin((1.5E0 * {side} * {r}) * {COS} / {R}))"
    return f"degrees(({SQRT3} * {side} * ({q} + {r} / 2.0E0)) / ({R} * {COS}))"


def filled(column: str) -> str:
    return f"AVG(COALESCE({column}, (SELECT median({column}) FROM acc)))"


DRAW = "('0x' || substr(md5('42|' || id), 1, 8))::BIGINT"


def encoded_parts() -> list[str]:
    """Fills, scales and categories of the training rows, and the pooled category of each row."""
    parts = []
    for c in P.ENCODED:
        text = f"CAST({c} AS VARCHAR)"
        parts.append(f"mode_{c} AS (SELECT {text} AS v FROM train WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)")
        parts.append(f"size_{c} AS (SELECT COALESCE({text}, (SELECT v FROM mode_{c})) AS v, COUNT(*) AS n FROM train GROUP BY 1)")
    stats = ", ".join(
        f"AVG(COALESCE({c}, (SELECT median({c}) FROM train))) AS m_{c},"
        f" stddev_pop(COALESCE({c}, (SELECT median({c}) FROM train))) AS s_{c}, (SELECT median({c}) FROM train) AS f_{c}"
        for c in NUMERIC_CONTROLS)
    return [*parts, f"scales AS (SELECT {stats} FROM train)"]


ENCODED_PARTS = encoded_parts()
ENCODED_ROWS = "SELECT id, " + ", ".join([
    *[r6(f"(COALESCE({c}, f_{c}) - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END", c) for c in NUMERIC_CONTROLS],
    *[f"CASE WHEN z_{c}.n < {P.RARE_BELOW} THEN '_infrequent' ELSE z_{c}.v END AS {c}" for c in P.ENCODED],
]) + " FROM acc CROSS JOIN scales " + " ".join(
    f"LEFT JOIN size_{c} z_{c} ON z_{c}.v = COALESCE(CAST(acc.{c} AS VARCHAR), (SELECT v FROM mode_{c}))" for c in P.ENCODED
) + " WHERE year IS NOT NULL"

def _known(tree, features: frozenset) -> str:
    """Score of a tree that knows some features and averages the others out."""
    if not hasattr(tree, "feature"):
        return f"{tree.value!r}E0"
    left, right = _known(tree.left, features), _known(tree.right, features)
    if tree.feature not in features:
        return f"(({tree.left.cover!r}E0 * {left} + {tree.right.cover!r}E0 * {right}) / {tree.left.cover + tree.right.cover!r}E0)"
    condition = f"{tree.feature} <= {tree.at!r}" if tree.at is not None else f"{tree.feature} IN ({', '.join(map(repr, tree.categories))})"
    return f"CASE WHEN {condition} THEN {left} ELSE {right} END"


def tree_attribution(tree) -> str:
    """Shapley values by all subsets of the tree's features."""
    def names(node) -> set:
        return {node.feature} | names(node.left) | names(node.right) if hasattr(node, "feature") else set()

    used = sorted(names(tree))
    subsets = [frozenset(c) for k in range(len(used) + 1) for c in combinations(used, k)]
    number = {s: i for i, s in enumerate(subsets)}

    def value(feature: str) -> str:
        parts = []
        for s in subsets:
            if feature not in s:
                weight = factorial(len(s)) * factorial(len(used) - len(s) - 1) / factorial(len(used))
                parts.append(f"{weight!r}E0 * (f{number[s | {feature}]} - f{number[s]})")
        return " + ".join(parts)

    scores = "scores AS (SELECT " + ", ".join(f"{_known(tree, s)} AS f{i}" for s, i in number.items()) + " FROM test)"
    values = "parts AS (" + union([f"SELECT '{f}' AS feature, {value(f)} AS v FROM scores" for f in used]) + ")"
    return on_clean(
        f"SELECT feature, {r6('AVG(v)', 'mean_signed')}, {r6('AVG(ABS(v))', 'mean_abs')},"
        " CASE WHEN AVG(v) > 0 THEN 'aggravating' WHEN AVG(v) < 0 THEN 'protective' END AS direction FROM parts GROUP BY feature",
        TRAIN, TEST, scores, values)


def penalised_pair() -> str:
    """Penalised odds ratios of two flags: a fixed number of Newton steps, the 3 x 3 information inverted by its cofactors."""
    a, b = P.PENALISED
    cells = f"cells AS MATERIALIZED (SELECT {a}::DOUBLE AS a, {b}::DOUBLE AS b, COUNT(*)::DOUBLE AS n, SUM(grave)::DOUBLE AS y FROM train GROUP BY 1, 2)"
    steps = ["r0 AS MATERIALIZED (SELECT 0::DOUBLE AS b0, 0::DOUBLE AS b1, 0::DOUBLE AS b2, 0::DOUBLE AS v1, 0::DOUBLE AS v2)"]
    for i in range(P.PENALISED_ROUNDS):
        steps.append(f"""p{i} AS MATERIALIZED (SELECT *, n * p * (1 - p) AS w FROM (
  SELECT c.*, 1 / (1 + exp(-(b0 + b1 * a + b2 * b))) AS p FROM cells c, r{i}))""")
        steps.append(f"""m{i} AS MATERIALIZED (SELECT *,
  i00 * (i11 * i22 - i12 * i12) - i01 * (i01 * i22 - i12 * i02) + i02 * (i01 * i12 - i11 * i02) AS det FROM (
  SELECT SUM(w) AS i00, SUM(w * a) AS i01, SUM(w * b) AS i02, SUM(w * a * a) AS i11, SUM(w * a * b) AS i12, SUM(w * b * b) AS i22 FROM p{i}))""")
        steps.append(f"""v{i} AS MATERIALIZED (SELECT (i11 * i22 - i12 * i12) / det AS c00, (i02 * i12 - i01 * i22) / det AS c01, (i01 * i12 - i02 * i11) / det AS c02,
  (i00 * i22 - i02 * i02) / det AS c11, (i01 * i02 - i00 * i12) / det AS c12, (i00 * i11 - i01 * i01) / det AS c22 FROM m{i})""")
        steps.append(f"""u{i} AS MATERIALIZED (SELECT SUM(e) AS u0, SUM(e * a) AS u1, SUM(e * b) AS u2 FROM (
  SELECT a, b, y - n * p + w * (c00 + a * a * c11 + b * b * c22 + 2 * (a * c01 + b * c02 + a * b * c12)) * (0.5 - p) AS e FROM p{i}, v{i}))""")
        steps.append(f"""r{i + 1} AS MATERIALIZED (SELECT b0 + c00 * u0 + c01 * u1 + c02 * u2 AS b0, b1 + c01 * u0 + c11 * u1 + c12 * u2 AS b1,
  b2 + c02 * u0 + c12 * u1 + c22 * u2 AS b2, c11 AS v1, c22 AS v2 FROM r{i}, v{i}, u{i})""")
    last = f"r{P.PENALISED_ROUNDS}"
    return on_clean(union([
        f"SELECT '{name}' AS element, {r6(f'exp({x})', 'odds_ratio')}, {r6(f'exp({x} - 1.959964 * sqrt({v}))', 'lo')},"
        f" {r6(f'exp({x} + 1.959964 * sqrt({v}))', 'hi')} FROM {last}" for name, x, v in ((a, "b1", "v1"), (b, "b2", "v2"))]),
        TRAIN, cells, *steps)


ORACLE = {
    "scan_csv": RAW_PRESENT,
    "normalised_schema": RAW_PRESENT,
    "clean": with_clauses(
        f"SELECT id, severity, grave, hour, dow, month, year, is_night, weather_bucket, state, {r6('start_lat')},"
        f" {r6('start_lng')}, {r6('temperature_f')}, {', '.join(INFRA)} FROM cl",
        CLEAN_RAW, cleaned("cl", "kept"), views=("raw_incidents",)),
    "calendar_fields": with_clauses(
        "SELECT hour, dow, month, year, COUNT(*) AS n FROM timed GROUP BY ALL", TIMED, views=("incidents_ts",)),
    "keyword_bucket": with_clauses(
        "SELECT weather_condition, weather_bucket, COUNT(*) AS n FROM (SELECT weather_condition, weather_bucket FROM acc"
        " UNION ALL SELECT weather_condition, weather_bucket FROM timed) GROUP BY ALL",
        CLEAN, TIMED, views=("raw_incidents", "incidents_ts")),
    "event_window": on_clean(
        "SELECT CAST(m AS INT) AS month, CAST(d AS INT) AS day, event, COUNT(*) AS n FROM ev GROUP BY ALL", EVENTS),
    "territory": on_clean(
        f"SELECT state, year, COUNT(*) AS n, CAST(SUM(severity) AS BIGINT) AS charge FROM acc"
        f" WHERE state = '{P.STATE}' GROUP BY ALL"),
    "states": on_clean("SELECT DISTINCT state FROM acc WHERE state <> ''"),
    "temporal_split": on_clean(
        f"SELECT CASE WHEN year < {T.test_from} THEN 'train' ELSE 'test' END AS part, {GRAVES}, MIN(year) AS first_year,"
        f" MAX(year) AS last_year FROM acc WHERE year IS NOT NULL GROUP BY ALL"),
    "model_table": on_clean("SELECT " + ", ".join(
        r6(c) if c in WEATHER_NUMERIC else c for c in [*FEATURES, "grave", "year"]) + " FROM acc"),
    "target_rate": on_clean(f"SELECT {SHARE} FROM acc"),
    "missing_rate": with_clauses(
        "SELECT * FROM (" + union([
            f"SELECT '{c}' AS \"column\", {r6(f'100 * AVG(CAST({c} IS NULL AS INT))', 'pct_missing')} FROM raw_incidents"
            for c in RAW_NAMES]) + ") WHERE pct_missing > 0", views=("raw_incidents",)),
    "coverage": on_clean(
        f"SELECT state, n, {r6('100 * (SELECT SUM(n) FROM (SELECT n FROM s ORDER BY n DESC LIMIT 3)) / (SELECT SUM(n) FROM s)', 'leaders_pct')}"
        " FROM s ORDER BY n DESC, state LIMIT 15", "s AS (SELECT state, COUNT(*) AS n FROM acc GROUP BY state)"),
    "severity_dist": on_clean(
        f"SELECT severity, COUNT(*) AS n, {r6('100 * COUNT(*) / SUM(COUNT(*)) OVER ()', 'pct')} FROM acc GROUP BY severity"),
    "infra_delta": on_clean(
        f"SELECT element, {r6('sev_without')}, {r6('sev_with')}, {r6('sev_with - sev_without', 'delta')} FROM (" + union([
            f"SELECT '{e}' AS element, AVG(severity) FILTER ({e} = 0) AS sev_without,"
            f" AVG(severity) FILTER ({e} = 1) AS sev_with FROM acc" for e in INFRA])
        + ") WHERE sev_with - sev_without IS NOT NULL"),
    "flag_domain": on_clean(union([
        f"SELECT '{e}' AS element, MIN({e}) AS lo, MAX({e}) AS hi FROM acc" for e in INFRA])),
    "value_counts": on_clean("SELECT weather_bucket, COUNT(*) AS n FROM acc GROUP BY ALL"),
    "quand_hour": with_clauses(f"SELECT hour, {SHARE} FROM timed GROUP BY hour", TIMED, views=("incidents_ts",)),
    "quand_weather": with_clauses(
        f"SELECT weather_bucket, {SHARE} FROM timed GROUP BY weather_bucket", TIMED, views=("incidents_ts",)),
    "quand_event": on_clean(
        "SELECT event, COUNT(*) AS n, round_even(100 * AVG(grave), 1) AS part_grave, round_even(AVG(severity), 3) AS sev_moy"
        " FROM ev GROUP BY event", EVENTS),
    "quand_month": on_clean(cube("month", SHARE)),
    "quand_year": on_clean(cube("year", GRAVES)),
    "peak_hour": with_clauses(
        "SELECT hour AS peak_hour, round_even(100 * AVG(grave), 1) AS pct_max FROM timed GROUP BY hour"
        " ORDER BY AVG(grave) DESC, hour LIMIT 1", TIMED, views=("incidents_ts",)),
    "quand_fallback": with_clauses(
        "SELECT t.territory, CASE WHEN t.known THEN t.territory ELSE 'US' END AS source, q.month, q.n, q.part_grave"
        " FROM asked t JOIN q ON q.state = CASE WHEN t.known THEN t.territory ELSE 'US' END",
        CLEAN, TIMED, f"q AS ({cube('month', SHARE)})",
        "asked AS (SELECT state AS territory, state IN (SELECT state FROM q) AS known"
        " FROM (SELECT state FROM acc UNION SELECT state FROM timed))", views=("raw_incidents", "incidents_ts")),
    "hex_bin": on_clean(
        union([f"SELECT cell, COUNT(*) AS n, CAST(SUM(severity) AS BIGINT) AS charge FROM c{r} GROUP BY cell" for r in (8, 7, 5)]),
        *[hexed(f"c{r}", "acc", r) for r in (8, 7, 5)]),
    "zone_agg": with_clauses(
        f"SELECT * REPLACE (ROUND(avg_severity, 6) + 0.0E0 AS avg_severity) FROM zones", CLEAN, CELLS, zones(keys="state")),
    "zone_year": with_clauses(
        "SELECT state, cell, year, COUNT(*) AS n, CAST(SUM(severity) AS BIGINT) AS charge,"
        " CAST(SUM(grave) AS BIGINT) AS graves FROM cells GROUP BY ALL", CLEAN, CELLS),
    "zone_rank": on_zones(
        f"SELECT CAST(ROW_NUMBER() OVER (ORDER BY charge DESC, cell) AS INT) AS rank, cell, n_accidents,"
        f" {r6('avg_severity')}, charge FROM zones"),
    "flagship_zones": on_zones(
        f"SELECT * FROM (SELECT CAST(ROW_NUMBER() OVER o AS INT) AS rank, cell, n_accidents, {r6('avg_severity')}, charge,"
        f" {r6('SUM(charge) OVER o / (SELECT SUM(charge) FROM zones)', 'charge_share')} FROM zones"
        f" WINDOW o AS (ORDER BY charge DESC, cell)) WHERE rank <= {T.top_zones}"),
    "concentration": on_zones(
        f"SELECT CAST(ROW_NUMBER() OVER o AS INT) AS rank, cell, charge,"
        f" {r6('100 * ROW_NUMBER() OVER o / COUNT(*) OVER ()', 'zones_pct')},"
        f" {r6('SUM(charge) OVER o / SUM(charge) OVER ()', 'charge_share')} FROM zones"
        " WINDOW o AS (ORDER BY charge DESC, cell)"),
    "kpi": on_zones(
        f"SELECT CAST(SUM(n_accidents) AS BIGINT) AS accidents, COUNT(*) AS zones, CAST(SUM(charge) AS BIGINT) AS charge,"
        f" {r6('SUM(charge) / SUM(n_accidents)', 'avg_severity')} FROM zones"),
    "zone_extent": on_zones(
        f"SELECT {r6('MIN(lat)', 'south')}, {r6('MAX(lat)', 'north')}, {r6('MIN(lng)', 'west')}, {r6('MAX(lng)', 'east')},"
        f" {r6('(MIN(lat) + MAX(lat)) / 2', 'mid_lat')}, {r6('(MIN(lng) + MAX(lng)) / 2', 'mid_lng')} FROM"
        f" (SELECT {centre('lat')} AS lat, {centre('lng')} AS lng FROM top)", TOP),
    "zone_geojson": on_zones(outline()),
    "zone_size": with_clauses(
        f"SELECT cell, {r6('COALESCE(CASE WHEN hk > lk THEN (charge_per_km - lk) / (hk - lk) ELSE charge_per_km * 0 END, CASE WHEN hc > lc THEN (charge - lc) / (hc - lc) ELSE 0 END)', 'size')}"
        " FROM exposed, (SELECT MIN(charge_per_km) AS lk, MAX(charge_per_km) AS hk, MIN(charge) AS lc, MAX(charge) AS hc FROM exposed)",
        CLEAN, CELLS, ZONES, ROADS, EXPOSURE, EXPOSED.format(zones="zones"), views=PLAN_VIEWS),
    "road_exposure": with_clauses(
        f"SELECT cell, {r6('street_km')}, n_intersections FROM roads", ROADS, EXPOSURE, views=("road_segments",)),
    "zone_exposure": with_clauses(
        f"SELECT cell, n_accidents, charge, {r6('street_km')}, n_intersections, {r6('acc_per_km')}, {r6('charge_per_km')}"
        " FROM exposed", CLEAN, CELLS, ZONES, ROADS, EXPOSURE, EXPOSED.format(zones="zones"), views=PLAN_VIEWS),
    "zone_type": with_clauses(
        f"SELECT cell, {r6('acc_per_km')}, type_zone FROM typed",
        CLEAN, CELLS, ZONES, ROADS, EXPOSURE, EXPOSED.format(zones="zones"), TYPED, views=PLAN_VIEWS),
    "rank_movement": with_clauses(
        f"SELECT cell, {r6('a', 'rank_charge')}, {r6('b', 'rank_per_km')}, {r6('a - b', 'movement')} FROM"
        f" (SELECT cell, {avg_rank('charge')} AS a, {avg_rank('charge_per_km')} AS b FROM exposed WHERE street_km > 0)",
        CLEAN, CELLS, ZONES, ROADS, EXPOSURE, EXPOSED.format(zones="zones"), views=PLAN_VIEWS),
    "period_scores": with_clauses(
        f"SELECT e.cell, {r6('(e.v - (SELECT MIN(v) FROM early)) / (SELECT MAX(v) - MIN(v) FROM early)', 'early')},"
        f" {r6('(l.v - (SELECT MIN(v) FROM late)) / (SELECT MAX(v) - MIN(v) FROM late)', 'late')}"
        " FROM early e JOIN late l ON e.cell = l.cell", CLEAN, CELLS, BURDENS),
    "temporal_stability": with_clauses(
        f"SELECT n, {r6('rho')}, CASE WHEN rho IS NULL OR n <= 2 THEN NULL WHEN 1 - rho * rho <= 1E-12 THEN 0.0E0 ELSE"
        " ROUND((SELECT SUM(pow(cos(a + (i + 0.5E0) * (pi() / 2 - a) / 100000), n - 3)) * (pi() / 2 - a) FROM range(100000) t(i))"
        " / (SELECT SUM(pow(cos((i + 0.5E0) * pi() / 200000), n - 3)) * pi() / 2 FROM range(100000) t(i)), 6) + 0.0E0"
        " END AS p_value FROM (SELECT *, asin(LEAST(abs(rho), 1.0E0)) AS a"
        f" FROM (SELECT COUNT(*) AS n, corr(a, b) AS rho FROM (SELECT {avg_rank('ev')} AS a, {avg_rank('lv')} AS b"
        " FROM (SELECT e.v AS ev, l.v AS lv FROM early e JOIN late l ON e.cell = l.cell))))", CLEAN, CELLS, BURDENS),
    "top_kept": with_clauses(
        f"SELECT COUNT(*) AS early_top, COUNT(*) FILTER (l.v >= t) AS kept, {r6('MAX(t)', 'late_threshold')} FROM"
        f" (SELECT * FROM early ORDER BY v DESC, cell LIMIT {T.top_zones}) e LEFT JOIN late l ON e.cell = l.cell,"
        " (SELECT quantile_cont(v, 0.95) AS t FROM late)", CLEAN, CELLS, BURDENS),
    "backtest": with_clauses(
        f"SELECT CAST(g AS BIGINT) AS future_graves, z AS future_zones, CAST(c AS BIGINT) AS captured, {r6('c / g', 'share')},"
        f" {r6(f'{T.top_zones}.0E0 / GREATEST(z, 1)', 'weight')},"
        f" {r6(f'(c / g) / GREATEST({T.top_zones}.0E0 / GREATEST(z, 1), 1E-9)', 'ratio')} FROM"
        f" (SELECT SUM(grave) AS g, COUNT(DISTINCT cell) AS z FROM cells WHERE year >= {P.BACKTEST[1]}),"
        f" (SELECT SUM(grave) AS c FROM cells WHERE year >= {P.BACKTEST[1]} AND cell IN (SELECT cell FROM (SELECT cell,"
        f" SUM(severity) AS s FROM cells WHERE year <= {P.BACKTEST[0]} GROUP BY cell ORDER BY s DESC, cell LIMIT {T.top_zones})))",
        CLEAN, CELLS),
    "stratified_cap": on_clean(
        f"SELECT id, state FROM (SELECT id, state, ROW_NUMBER() OVER (PARTITION BY state ORDER BY {DRAW}, id) AS rn FROM acc)"
        f" WHERE rn <= {P.CAP_PER_STATE}"),
    "capped_sample": on_clean(
        f"SELECT id, state FROM acc, (SELECT COUNT(*) AS n FROM acc) WHERE n <= {P.CAP_ROWS}"
        f" OR {DRAW} < floor({P.CAP_ROWS}.0E0 / n * 4294967296)"),
    "encode_controls": on_clean(ENCODED_ROWS, TRAIN, *ENCODED_PARTS),
    "sinks": on_clean(
        "SELECT 'prepared' AS sink, (SELECT COUNT(*) FROM acc) AS n UNION ALL SELECT 'summary', (SELECT COUNT(*) FROM acc)"
        " UNION ALL SELECT 'csv', (SELECT COUNT(DISTINCT severity) FROM acc) UNION ALL SELECT 'sample', (SELECT"
        f" CAST(SUM(LEAST(n, {P.CAP_PER_STATE})) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM acc GROUP BY state))"),
    "fit_invariants": "SELECT unnest(['above the floor', 'junction raises severity', 'signals lower severity']) AS claim, 1 AS ok",
    "element_concordance": on_clean(
        f"SELECT element, {r6('delta')}, {r6('o', 'odds_ratio')}, CASE WHEN (o > 1) = (delta > 0) THEN '✓' ELSE '✗' END AS agrees FROM ("
        + union([
            f"SELECT '{e}' AS element, AVG({probability(**{e: 1})} - {probability(**{e: 0})}) AS delta,"
            f" {'NULL' if e in P.WITHOUT_ODDS else f'exp({P.COEFFICIENTS[e]!r}E0)'} AS o FROM test" for e in INFRA]) + ")", TEST),
    "impute_median": on_clean(union([
        f"SELECT '{c}' AS name, {r6(f'median({c})', 'value')}, {r6(filled(c), 'mean_after')} FROM acc" for c in WEATHER_NUMERIC])),
    "impute_mode": on_clean(union([
        f"SELECT '{c}' AS name, value, COUNT(*) AS \"rows\" FROM (SELECT COALESCE({c}, (SELECT {c} FROM acc WHERE {c} IS NOT NULL"
        f" GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1)) AS value FROM acc) GROUP BY value"
        for c in ("sunrise_sunset", "weather_condition")])),
    "standardise": on_clean("SELECT id, " + ", ".join(
        r6(f"({c} - m_{c}) / s_{c}", c) for c in WEATHER_NUMERIC)
        + " FROM acc, (SELECT " + ", ".join(
            f"AVG({c}) AS m_{c}, stddev_pop({c}) AS s_{c}"
            for c in WEATHER_NUMERIC) + " FROM acc)"),
    "rare_pooling": on_clean(
        f"SELECT CASE WHEN n < {P.RARE_BELOW} AND w IS NOT NULL THEN '_infrequent' ELSE w END AS weather_condition, CAST(SUM(n) AS BIGINT) AS n"
        " FROM (SELECT weather_condition AS w, COUNT(*) AS n FROM acc GROUP BY 1) GROUP BY 1"),
    "class_weights": on_clean(
        f"SELECT grave, COUNT(*) AS n, {r6('SUM(COUNT(*)) OVER () / (COUNT(*) OVER () * COUNT(*))', 'weight')}"
        " FROM train GROUP BY grave", TRAIN),
    "zone_history": with_clauses(
        f"SELECT id, {history_columns(7)}, {history_columns(5)} FROM (SELECT * FROM both_cells WHERE year IS NOT NULL) t"
        " LEFT JOIN learnt7 l7 ON t.cell7 = l7.cell7 LEFT JOIN learnt5 l5 ON t.cell5 = l5.cell5",
        CLEAN, hexed("c7", "acc", 7, "cell7"), hexed("both_cells", "c7", 5, "cell5"),
        f"train AS (SELECT * FROM both_cells WHERE year < {T.test_from})", history(7), history(5)),
    "avg_precision": on_scored(f"SELECT {r6(AP, 'pr_auc')} FROM curve"),
    "roc_auc": on_scored(f"SELECT {r6(AUC, 'roc_auc')} FROM curve"),
    "pr_curve": on_scored(
        f"SELECT {r6('score', 'threshold')}, {r6('cp / cn', 'precision')}, {r6('cp / ap', 'recall')} FROM curve"
        " UNION ALL SELECT NULL, 1.0E0, 0.0E0"),
    "gain_curve": on_scored(
        f"SELECT {r6('score')}, {r6('cn / an', 'targeted')}, {r6('cp / GREATEST(ap, 1)', 'captured')} FROM curve"),
    "gain_capture": on_scored(union([
        f"SELECT {x}E0 AS targeted, {r6('SUM(taken)', 'captured')}, {r6(f'SUM(taken) / {x}E0', 'versus_chance')} FROM"
        f" (SELECT pos * GREATEST(0, LEAST(n, floor(an * {x}E0) - (cn - n))) / n / ap AS taken FROM curve)" for x in (0.1, 0.2)])),
    "confusion": on_scored(sweep([P.THRESHOLD])),
    "threshold_sweep": on_scored(sweep(P.SWEEP)),
    "model_floor": on_clean(f"SELECT COUNT(*) AS n, {r6('AVG(grave)', 'pr_auc')}, 0.5E0 AS roc_auc FROM test", TEST),
    "reliability": on_scored(
        f"SELECT CAST(n AS BIGINT) AS n, {r6('base', 'baseline')}, {r6('p', 'pr_auc')}, {r6('p / base', 'ratio')},"
        f" CAST(p / base < 1.3 AS INT) AS low_signal FROM (SELECT MAX(an) AS n, MAX(ap) / MAX(an) AS base, {AP} AS p FROM curve)"),
    "gcomp_fixed": on_clean(union([
        f"SELECT '{e}' AS element, {r6(f'AVG({probability(**{e: 1})} - {probability(**{e: 0})})', 'delta')} FROM test"
        for e in INFRA]), TEST),
    "cond_effects": on_clean(f"SELECT hazard, measure, n, {r6('delta')} FROM cond", TEST, DELTAS, CONDITIONAL),
    "cond_delta_raw": on_clean(f"SELECT hazard, measure, n, {r6('delta')} FROM raw_pairs", RAW_PAIRS),
    "effect_concordance": on_clean(
        f"SELECT c.hazard, c.measure, {r6('c.delta', 'delta')}, {r6('r.delta', 'raw_delta')},"
        " CASE WHEN (c.delta < 0) = (r.delta < 0) THEN '✓' ELSE '—' END AS agrees FROM cond c"
        " LEFT JOIN raw_pairs r ON c.hazard = r.hazard AND c.measure = r.measure WHERE c.delta IS NOT NULL",
        TEST, DELTAS, CONDITIONAL, RAW_PAIRS),
    "linear_attribution": on_clean(
        f"SELECT feature, {r6('s', 'mean_signed')}, {r6('a', 'mean_abs')}, CASE WHEN s > 0 THEN 'aggravating'"
        " WHEN s < 0 THEN 'protective' END AS direction FROM (" + union([
            f"SELECT '{c}' AS feature, AVG(({c} - (SELECT AVG({c}) FROM train)) * {w!r}E0) AS s,"
            f" AVG(ABS(({c} - (SELECT AVG({c}) FROM train)) * {w!r}E0)) AS a FROM test" for c, w in P.COEFFICIENTS.items()])
        + ")", TRAIN, TEST),
    "fixed_tree_attribution": tree_attribution(P.TREE),
    "penalised_odds_pair": penalised_pair(),
    "method_ranks": on_clean(f"SELECT method, element, {r6('rank')} FROM mranks", TRAIN, TEST, METHODS),
    "rank_convergence": on_clean(union([
        f"SELECT '{a}' AS method_a, '{b}' AS method_b, {r6('corr(x.rank, y.rank)', 'rho')} FROM mranks x JOIN mranks y"
        f" ON x.element = y.element AND x.method = '{a}' AND y.method = '{b}'" for a, b in METHOD_PAIRS]),
        TRAIN, TEST, METHODS),
    "territory_share": on_zones(union([
        f"SELECT '{e}' AS element, {r6(f'SUM({p}{e}) / GREATEST(SUM({t}), 1)', 'share')}, '{w}' AS weight FROM zones"
        for w, p, t in (("severity", "charge_", "charge"), ("count", "n_", "n_accidents")) for e in INFRA])),
    "zone_lift": on_zones(
        f"SELECT cell, {r6('lift')}, dominant, 'severity' AS weight FROM hs UNION ALL"
        f" SELECT cell, {r6('lift')}, dominant, 'count' AS weight FROM hc",
        lifted("hs", "zones", "severity"), lifted("hc", "zones", "count")),
    "equip_present": on_zones(f"SELECT cell, {EQUIPMENT} AS equip_present FROM zones"),
    "recommend": on_zones(
        f"SELECT cell, dominant, measure, amenagement, {r6('impact_graves_evites')} FROM reco",
        lifted("hazard", "zones", "severity"), TEST, DELTAS, CONDITIONAL, recommended("zones", "hazard")),
    "priority_zones": on_plan("SELECT * FROM plan"),
    "plan_annual": on_plan(
        f"SELECT rank, cell, impact_graves_evites, round_even(impact_graves_evites / {YEARS}, 1) AS impact_par_an FROM plan"),
    "span_years": on_clean(
        f"SELECT {r6('GREATEST(COUNT(DISTINCT year * 100 + month) / 12.0E0, 1E-9)', 'years')} FROM acc WHERE year IS NOT NULL"),
    "plan_recap": on_plan(
        "SELECT amenagement, COUNT(*) AS zones, round_even(SUM(impact_graves_evites), 0) AS impact FROM plan GROUP BY amenagement"),
    "plan_reason": with_clauses(
        f"SELECT rank, cell, {REASON} AS reason FROM {NAMED}", *PLAN_CHAIN, NAMES, views=PLAN_VIEWS),
    "screen_plan": on_zones(
        "SELECT rang, cell, accidents, gravite_moy, alea_dominant, recommandation, justification, impact_graves_evites,"
        f" round_even(impact_graves_evites / {YEARS}, 1) AS impact_par_an FROM (SELECT rank AS rang, cell, n_accidents AS accidents,"
        " round_even(avg_severity, 2) AS gravite_moy, COALESCE(hn.fr, dominant) AS alea_dominant,"
        f" amenagement AS recommandation, {REASON} AS justification,"
        f" round_even(impact_graves_evites, 1) AS impact_graves_evites FROM {NAMED})",
        TOP, lifted("hazard", "zones", "count"), TEST, DELTAS, CONDITIONAL, recommended("top", "hazard", SCREEN_TEXTS), NAMES),
    "dq_checks": with_clauses(
        "SELECT 0 AS target_not_binary, (SELECT COUNT(*) FROM kept WHERE start_lat IS NULL OR start_lng IS NULL) AS no_position,"
        " (SELECT COUNT(*) FROM kept WHERE severity IS NULL) AS no_severity, "
        + ", ".join(f"(SELECT COUNT(*) FROM kept WHERE {e} NOT IN (0, 1) OR {e} IS NULL) AS bad_{e}" for e in INFRA)
        + ", 0 AS unusable_kept, 0 AS derived_missing, (SELECT COUNT(*) FROM raw_incidents WHERE severity IS NULL"
        " OR start_lat IS NULL OR start_lng IS NULL) AS raw_without_key", CLEAN_RAW, views=("raw_incidents",)),
    "leak_checks": on_clean(
        f"SELECT (SELECT COUNT(*) FROM train WHERE year >= {T.test_from}) AS train_rows_from_test_years,"
        f" (SELECT COUNT(*) FROM test WHERE year < {T.test_from}) AS test_rows_from_train_years, 0 AS target_in_features,"
        " 0 AS features_missing, 0 AS features_unexpected, (SELECT COUNT(*) FROM train) AS train_rows", TRAIN, TEST),
    "plan_checks": on_plan(
        "SELECT COUNT(*) - COUNT(DISTINCT rank) AS rank_repeated, COUNT(*) FILTER (rank < 1) AS rank_below_one,"
        " CASE WHEN MIN(rank) = 1 THEN 0 ELSE 1 END AS rank_not_from_one,"
        " COUNT(*) FILTER (avg_severity NOT BETWEEN 1 AND 4) AS severity_out_of_range,"
        " COUNT(*) FILTER (charge < n_accidents) AS charge_below_accidents,"
        " COUNT(*) FILTER (ABS(charge - n_accidents * avg_severity) > 0.01 * n_accidents + 5) AS charge_unlike_mean,"
        " COUNT(*) FILTER (impact_graves_evites < 0) AS impact_negative,"
        " COUNT(*) FILTER (NOT regexp_full_match(cell, '[0-9]+:-?[0-9]+:-?[0-9]+')) AS cell_invalid,"
        " CASE WHEN COUNT(DISTINCT amenagement) >= 3 THEN 0 ELSE 1 END AS actions_alike,"
        " (SELECT COUNT(*) FROM zones) AS zones FROM plan"),
}
