"""The same input tables as SQL, and the assembly of oracle statements."""

from __future__ import annotations

import re

ZONES = 500
FINE_ZONES = 2000


def _square(half: int) -> str:
    corners = [(-half, -half), (half, -half), (half, half), (-half, half), (-half, -half)]
    parts = " || ', ' || ".join(f"(x + {dx}) || ' ' || (y + {dy})" for dx, dy in corners)
    return f"'(' || {parts} || ')'"


def _zone_points(zones: int) -> str:
    return f"""
        SELECT zone, CAST(726000 + floor(sx / n * 0.4::DOUBLE) AS BIGINT) AS x,
            CAST(4350000 + floor(sy / n * 0.5::DOUBLE) AS BIGINT) AS y
        FROM (SELECT lpad(CAST(vec_id % {zones} AS VARCHAR), {len(str(zones - 1))}, '0') AS zone,
                CAST(SUM(CAST(floor(CAST(embedding[1] AS DOUBLE) * 1000000::DOUBLE) AS BIGINT)) AS DOUBLE) AS sx,
                CAST(SUM(CAST(floor(CAST(embedding[2] AS DOUBLE) * 1000000::DOUBLE) AS BIGINT)) AS DOUBLE) AS sy,
                COUNT(*) AS n
              FROM embeddings GROUP BY 1)"""


def _by_hour(legs: str) -> str:
    return f"""
        SELECT date, period, origin, destination, SUM(travels) AS travels, SUM(travels_km) AS travels_km
        FROM {legs} GROUP BY date, period, origin, destination"""


def _recoded(by_hour: str) -> str:
    return f"""
        SELECT date, CAST(period AS INTEGER) AS period, origin_id, destination_id,
            SUM(travels) AS travels, SUM(travels_km) AS travels_km
        FROM (SELECT date, period, origin_id, unnest(d_ids) AS destination_id, travels, travels_km
              FROM (SELECT date, period, unnest(o_ids) AS origin_id, d_ids, travels, travels_km
                    FROM {by_hour} JOIN recode_targets o(origin, o_ids) USING (origin)
                    JOIN recode_targets d(destination, d_ids) USING (destination)))
        GROUP BY date, period, origin_id, destination_id"""


def _all_dimensions(legs: str) -> str:
    return f"""
        SELECT date, period, origin, destination, distance, activity_origin, activity_destination,
            study_origin_posible, study_destination_posible, residence, rent, age, gender,
            SUM(travels) AS travels, SUM(travels_km) AS travels_km
        FROM {legs} GROUP BY ALL"""


def measured(od: str) -> str:
    """The pairs of ``od`` with both zones' facts and their distance; only pairs that occur are measured."""
    return f"""
        SELECT origin_id, destination_id, actual_trips, sqrt((b.x - a.x) ** 2 + (b.y - a.y) ** 2) AS metres,
            a.people AS people, b.euros AS euros
        FROM {od}, zone_facts a, zone_facts b
        WHERE a.distrito_id = origin_id AND b.distrito_id = destination_id AND origin_id <> destination_id"""


def gravity(pairs: str, digits: int | None = None) -> str:
    """People and euros over the squared distance, of at least 500 metres; rounded for comparing."""
    shown = (lambda x: f"round({x}, {digits})") if digits else str
    return f"""
        SELECT origin_id, destination_id, actual_trips, {shown("far")} AS dist_meters, people AS "P_i", euros AS "E_j",
            {shown("people * euros / (far * far)")} AS gravity_raw
        FROM (SELECT *, CASE WHEN metres < 500 THEN 500 ELSE metres END AS far FROM {pairs})"""


TABLES: dict[str, str] = {
    "legs": f"""
        SELECT CAST(l_shipdate AS DATE) AS date,
            lpad(CAST(l_orderkey % 24 AS VARCHAR), 2, '0') AS period,
            lpad(CAST(l_partkey % {ZONES} AS VARCHAR), 3, '0') AS origin,
            lpad(CAST(l_suppkey % {ZONES} AS VARCHAR), 3, '0') AS destination,
            CASE WHEN l_extendedprice < 20000 THEN '0.5-2' WHEN l_extendedprice < 40000 THEN '2-10'
                 WHEN l_extendedprice < 60000 THEN '10-50' ELSE '>50' END AS distance,
            l_returnflag AS activity_origin, l_linestatus AS activity_destination,
            CASE WHEN l_discount >= 0.05 THEN 'si' ELSE 'no' END AS study_origin_posible,
            CASE WHEN l_linenumber > 3 THEN 'si' ELSE 'no' END AS study_destination_posible,
            lpad(CAST(l_suppkey % 25 AS VARCHAR), 2, '0') AS residence,
            CASE WHEN l_linenumber <= 2 THEN '<10' WHEN l_linenumber <= 5 THEN '10-15' ELSE '>15' END AS rent,
            CASE WHEN l_tax < 0.02 THEN '0-25' WHEN l_tax < 0.04 THEN '25-45'
                 WHEN l_tax < 0.06 THEN '45-65' ELSE '65-100' END AS age,
            CASE WHEN l_tax >= 0.08 THEN NULL WHEN l_orderkey % 2 = 0 THEN 'hombre' ELSE 'mujer' END AS gender,
            l_quantity AS travels, l_extendedprice AS travels_km
        FROM lineitem""",
    # legs of 16 neighbouring orders share day, hour, zones and most dimensions, so that groups hold many rows
    "busy_legs": f"""
        SELECT DATE '1995-01-01' + CAST(l_orderkey // 16 * 37 % 2557 AS INT) AS date,
            lpad(CAST(l_orderkey // 16 % 24 AS VARCHAR), 2, '0') AS period,
            lpad(CAST(l_orderkey // 16 % {ZONES} AS VARCHAR), 3, '0') AS origin,
            lpad(CAST((l_orderkey // 16 + l_orderkey // 16 // {ZONES} + 1) % {ZONES} AS VARCHAR), 3, '0') AS destination,
            if(l_orderkey // 16 % 5 < 3, '2-10', '10-50') AS distance,
            l_returnflag AS activity_origin, l_linestatus AS activity_destination,
            if(l_orderkey // 16 % 5 < 2, 'si', 'no') AS study_origin_posible,
            if(l_orderkey // 16 % 7 < 3, 'si', 'no') AS study_destination_posible,
            lpad(CAST(l_orderkey // 16 % 25 AS VARCHAR), 2, '0') AS residence,
            if(l_orderkey // 16 % 2 = 0, '<10', '>15') AS rent, if(l_orderkey // 16 % 3 = 0, '25-45', '45-65') AS age,
            if(l_orderkey // 16 % 4 = 0, NULL, 'mujer') AS gender, l_quantity AS travels, l_extendedprice AS travels_km
        FROM lineitem""",
    "bronze_trips": _all_dimensions("legs"),
    "busy_bronze": _all_dimensions("busy_legs"),
    "relation": f"""
        SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS seccion_ine,
            'D' || lpad(CAST(CASE WHEN c_custkey % 97 = 0 THEN (c_custkey + 1) % {ZONES}
                             ELSE c_custkey % {ZONES} END AS VARCHAR), 3, '0') AS distrito_ine,
            CASE WHEN c_custkey % 101 = 50 THEN NULL ELSE lpad(CAST(c_nationkey AS VARCHAR), 5, '0') END AS municipio_ine,
            lpad(CAST(c_custkey % {ZONES} AS VARCHAR), 3, '0') AS distrito_mitma,
            'M' || CAST(c_nationkey AS VARCHAR) AS municipio_mitma,
            CASE WHEN c_acctbal < 0 THEN NULL WHEN c_mktsegment = 'FURNITURE' THEN 'NA'
                 ELSE 'G' || CAST(c_nationkey % 5 AS VARCHAR) END AS gau_mitma
        FROM customer""",
    "silver_relation": """
        SELECT * FROM relation
        WHERE seccion_ine IS NOT NULL AND distrito_ine IS NOT NULL AND municipio_ine IS NOT NULL
            AND distrito_mitma IS NOT NULL AND municipio_mitma IS NOT NULL""",
    "district_map": "SELECT DISTINCT distrito_mitma, distrito_ine FROM silver_relation",
    "zone_points": _zone_points(ZONES),
    "vector_points": """
        SELECT vec_id, CAST(726000 + floor(floor(CAST(embedding[1] AS DOUBLE) * 1000000::DOUBLE) * 0.4::DOUBLE) AS BIGINT) AS x,
            CAST(4350000 + floor(floor(CAST(embedding[2] AS DOUBLE) * 1000000::DOUBLE) * 0.5::DOUBLE) AS BIGINT) AS y
        FROM embeddings""",
    "fine_zones": f"""
        SELECT zone AS distrito_id, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y
        FROM ({_zone_points(FINE_ZONES)})""",
    "outlines": f"""
        SELECT zone, 'POLYGON (' || {_square(900)} || ', ' || {_square(300)} || ')' AS geom FROM zone_points""",
    "geometries": """
        SELECT distrito_ine AS distrito_id, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, geom AS geometria
        FROM zone_points JOIN outlines USING (zone) JOIN district_map ON zone = distrito_mitma""",
    "own_zones": "SELECT zone AS distrito_id, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM zone_points",
    "distances": """
        SELECT low.distrito_id AS origin_id, high.distrito_id AS destination_id,
            sqrt((high.x - low.x) * (high.x - low.x) + (high.y - low.y) * (high.y - low.y)) AS distance_meters
        FROM geometries low JOIN geometries high ON low.distrito_id <> high.distrito_id""",
    "section_years": """
        SELECT seccion, year, COUNT(*) * 100 AS people, SUM(cents) // (100 * COUNT(*)) AS income
        FROM (SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS seccion, year(o_orderdate) AS year,
                CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
        GROUP BY seccion, year""",
    "section_targets": """
        SELECT seccion_ine AS seccion, list(DISTINCT distrito_ine) AS codes FROM silver_relation GROUP BY seccion_ine""",
    # whole-number sums: people come in hundreds and incomes in euros
    "demographics": """
        SELECT distrito_id, year, CAST(euros AS DOUBLE) AS renta_total_euros,
            round(CAST(euros AS DOUBLE) / people, 2) AS renta_media_euros, CAST(people AS INTEGER) AS poblacion
        FROM (SELECT distrito_id, year, SUM(people) AS people, SUM(people * income) AS euros
              FROM (SELECT unnest(codes) AS distrito_id, year, people, income
                    FROM section_years JOIN section_targets USING (seccion))
              GROUP BY distrito_id, year)""",
    "documents_flat": """
        SELECT seccion, year, right(seccion, 1) AS last, year || '-01-01T00:00:00.000+01:00' AS fecha,
            CASE WHEN year = 1997 AND right(seccion, 1) = '3' THEN '.' ELSE CAST(income AS VARCHAR) END AS valor
        FROM section_years""",
    # every code with the list of its targets; a trip is repeated for each pair of targets
    "recode_targets": "SELECT distrito_mitma AS code, list(distrito_ine) AS ids FROM district_map GROUP BY distrito_mitma",
    "legs_by_hour": _by_hour("legs"),
    "busy_by_hour": _by_hour("busy_legs"),
    "weekly_legs": "SELECT * REPLACE (CAST(date_trunc('week', date) AS DATE) AS date) FROM legs",
    "weekly_bronze": _all_dimensions("weekly_legs"),
    "later_legs": """
        SELECT * REPLACE (travels + if((date - DATE '1995-01-02') // 7 % 9 = 0, 1, 0) AS travels)
        FROM weekly_legs WHERE (date - DATE '1995-01-02') // 7 % 17 <> 3""",
    "later_by_hour": _by_hour("later_legs"),
    "later_silver": _recoded("later_by_hour"),
    "silver_trips": _recoded("legs_by_hour"),
    "busy_silver": _recoded("busy_by_hour"),
    "od": "SELECT origin_id, destination_id, SUM(travels) AS actual_trips FROM silver_trips GROUP BY 1, 2",
    # all that is known of a zone in 1996, one row per zone geometry
    "zone_facts": """
        SELECT distrito_id, x, y, CAST(poblacion AS DOUBLE) AS people, renta_total_euros AS euros
        FROM geometries JOIN demographics USING (distrito_id) WHERE year = 1996""",
    "measured_od": measured("od"),
    "gravity": gravity("measured_od"),
    # the rank of a value is the number of smaller ones, from a running total of counts; NULL is the largest
    "efficiency": """
        SELECT *, CASE WHEN gravity_raw > 0 THEN actual_trips / gravity_raw END AS per_pull FROM gravity""",
    "efficiency_counts": "SELECT per_pull, COUNT(*) AS n FROM efficiency GROUP BY per_pull",
    "efficiency_ranks": """
        SELECT per_pull, SUM(n) OVER (ORDER BY per_pull NULLS LAST) - n AS smaller, SUM(n) OVER () - 1 AS others
        FROM efficiency_counts""",
    "trimmed": """
        SELECT efficiency.* FROM efficiency JOIN efficiency_ranks r ON efficiency.per_pull IS NOT DISTINCT FROM r.per_pull
        WHERE 20 * smaller >= others AND 20 * smaller <= 19 * others""",
    "gaps": """
        SELECT origin_id, destination_id, actual_trips, CAST(dist_meters AS INTEGER) AS distance_meters,
            CAST(expected AS INTEGER) AS potential_demand,
            CASE WHEN expected > 0 THEN round(actual_trips / expected, 4) END AS gap_ratio
        FROM (SELECT *, gravity_raw * (SUM(actual_trips) OVER () / fsum(gravity_raw) OVER ()) AS expected FROM trimmed)""",
    "activity": """
        SELECT event_id, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour,
            CAST(value AS DECIMAL(18, 2)) AS value FROM events""",
    "feed": """
        SELECT CASE WHEN o_orderstatus = 'P' AND o_orderkey % 10 = 1 THEN 'nombres_distritos.csv'
                    WHEN o_orderkey % 25 = 7 THEN 'zonificacion_distritos.zip'
                    ELSE strftime(o_orderdate, '%Y%m%d') || '_Viajes_'
                      || CASE o_orderkey % 3 WHEN 0 THEN 'distritos' WHEN 1 THEN 'GAU' ELSE 'municipios' END
                      || '.csv.gz' END AS title,
            'https://files.example.org/' || CASE WHEN o_orderkey % 5 = 0 THEN 'otros' ELSE 'estudios_basicos' END
                || '/' || CAST(o_orderkey AS VARCHAR) AS link,
            o_orderkey AS pos, CAST(o_orderdate AS DATE) AS day,
            CASE o_orderkey % 3 WHEN 0 THEN 'distritos' WHEN 1 THEN 'gau' ELSE 'municipios' END AS level
        FROM orders""",
    "trip_feed": """
        SELECT link AS url, 'bronze_mitma_viajes_' || level AS "table", day, pos FROM feed
        WHERE contains(title, '_Viajes_') AND contains(link, 'estudios_basicos')""",
    "holiday_list": """
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders
        WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000""",
    "order_days": """
        SELECT CAST(unnest(generate_series(CAST(MIN(o_orderdate) AS TIMESTAMP), CAST(MAX(o_orderdate) AS TIMESTAMP),
            INTERVAL 1 DAY)) AS DATE) AS day FROM orders""",
    "calendar": """
        SELECT day AS fecha, CASE WHEN h.date IS NULL THEN 0 ELSE 1 END AS es_festivo,
            CASE WHEN isodow(day) > 5 THEN 1 ELSE 0 END AS es_fin_de_semana
        FROM order_days LEFT JOIN holiday_list h ON day = h.date""",
    "daily_shares": """
        SELECT date, hour, hour_trips / NULLIF(day_total, 0) AS share FROM (
            SELECT date, period AS hour, SUM(travels) AS hour_trips,
                SUM(SUM(travels)) OVER (PARTITION BY date) AS day_total
            FROM silver_trips GROUP BY 1, 2)""",
    "daily_profile": "SELECT date, "
    + ", ".join(f'COALESCE(SUM(share) FILTER (hour = {h}), 0.0) AS "{h}"' for h in range(24))
    + " FROM daily_shares GROUP BY date",
}


def statement(body: str, **extra: str) -> str:
    """``body`` preceded by the tables it needs, directly or through others.

    ``extra`` adds tables of its own; they may use the shared ones.
    """
    known = {**TABLES, **extra}
    needed: set[str] = set()
    queue = [body]
    while queue:
        words = set(re.findall(r"\w+", queue.pop()))
        for name in words & known.keys() - needed:
            needed.add(name)
            queue.append(known[name])
    tables = ",\n".join(f"{name} AS ({known[name]})" for name in known if name in needed)
    recursive = "RECURSIVE " if "UNION ALL" in tables else ""
    return f"WITH {recursive}{tables}\n{body}" if tables else body
