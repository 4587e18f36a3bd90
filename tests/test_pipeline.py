"""From files to the gap report, through written tables."""

from __future__ import annotations

import json
from datetime import date

from conftest import rows

from corridor import schemas
from corridor.operators import loads
from corridor.plans import bronze, gold, silver
from corridor.schemas import RAW_TRIPS
from corridor.sources import delimited

STAMP = "2023-01-01T00:00:00.000+01:00"
ZONES = {"01": (700000, 4300000), "02": (703000, 4304000), "03": (710000, 4300000), "04": (0, 0)}


def types(df):
    return [(field.name, field.dataType) for field in df.schema]


def documents(value, names):
    meta = [{"T3_Variable": "Secciones", "Codigo": "", "Nombre": "s"}]
    meta += [{"T3_Variable": "v", "Codigo": "", "Nombre": name} for name in names]
    return [
        {"MetaData": [dict(meta[0], Codigo=f"s{zone}"), *meta[1:]], "Data": [{"Fecha": STAMP, "Valor": value}]}
        for zone in ZONES
    ]


def test_from_files_to_the_report(spark, database, tmp_path):
    line = "{day}|{hour:02d}|{a}|{b}|2-10|casa|trabajo|si|no|01|>15|25-45|mujer|{n}|{n}.5"
    lines = [
        line.format(day=day, hour=hour, a=a, b=b, n=1 + int(a) * int(b))
        for day in ("20230508", "20230509") for hour in range(24) for a in ZONES for b in ZONES
    ]
    (tmp_path / "trips.csv").write_text("\n".join(["|".join(RAW_TRIPS.fieldNames()), *lines, "short|row"]))
    (tmp_path / "relation.csv").write_text(
        "seccion_ine|distrito_ine|municipio_ine|distrito_mitma|municipio_mitma|gau_mitma\n"
        + "".join(f"s{z}|D{z}|m|{z}|m|\n" for z in ZONES)
    )
    (tmp_path / "points.csv").write_text("ID|geom\n" + "".join(f"{z}|POINT ({x} {y})\n" for z, (x, y) in ZONES.items()))
    (tmp_path / "areas.csv").write_text("ID|geom\n" + "".join(f"{z}|POLYGON ((0 0, 1 0, 1 1, 0 0))\n" for z in ZONES))
    (tmp_path / "income.json").write_text(json.dumps(documents(20.0, ["x", "Renta neta media por persona"])))
    (tmp_path / "people.json").write_text(json.dumps(documents(100.0, ["16 y más años", "Total", "Total", "Total"])))
    (tmp_path / "days.csv").write_text("fecha,es_festivo,es_fin_de_semana\n2023-05-08,1,0\n")

    table = f"{database}.bronze_trips"
    bronze.create_trips(spark, table)
    raw = delimited.read_lenient(spark, str(tmp_path / "trips.csv"), RAW_TRIPS)
    landed = bronze.load_trips(raw, table, ["2023-05-08", "2023-05-09"])
    assert landed.count() == 2 * 24 * 16

    relation = silver.relation(bronze.dimension(spark, "bronze_relacion_ine", str(tmp_path / "relation.csv")))
    mapping = silver.district_map(relation)
    trips = loads.replace_table(silver.trips(landed, mapping), f"{database}.silver_trips", ["date"])
    trips = trips.select(*schemas.SILVER_TRIPS.fieldNames())
    assert types(trips) == types(spark.createDataFrame([], schemas.SILVER_TRIPS))
    places = silver.geometries(
        bronze.centroids(spark, str(tmp_path / "points.csv")), bronze.outlines(spark, str(tmp_path / "areas.csv")), mapping
    )
    people = silver.demographics(
        bronze.population(spark, str(tmp_path / "people.json")), bronze.income(spark, str(tmp_path / "income.json")), relation
    )
    assert types(people) == types(spark.createDataFrame([], schemas.SILVER_DEMOGRAPHICS))
    assert rows(people)[0] == ("D01", 2023, 2000.0, 20.0, 100)
    distances = silver.distances(places)
    assert types(distances) == types(spark.createDataFrame([], schemas.SILVER_DISTANCES))
    assert distances.count() == 12

    inside = gold.trips_in_region(trips, places)
    assert inside.count() == 2 * 24 * 9  # zone 04 lies outside
    od = inside.groupBy("origin_id", "destination_id").agg({"travels": "sum"})
    features = gold.gravity_features(od.toDF("origin_id", "destination_id", "actual_trips"), people, 2023, distances)
    assert features.count() == 6
    report = gold.worst_first(gold.infrastructure_gaps(features)).collect()
    assert 0 < len(report) < 6
    assert [r["gap_ratio"] for r in report] == sorted(r["gap_ratio"] for r in report)

    profile = gold.daily_profile(inside)
    assert types(profile) == types(spark.createDataFrame([], schemas.DAILY_PROFILE))
    assert all(abs(sum(row[1:]) - 1) < 1e-12 for row in profile.collect())

    calendar = silver.calendar(bronze.calendar(spark, str(tmp_path / "days.csv")))
    assert types(calendar) == types(spark.createDataFrame([], schemas.SILVER_CALENDAR))
    assert rows(calendar) == [(date(2023, 5, 8), True, False)]
