from __future__ import annotations

import gzip
import json
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from corridor.operators.aggregates import by_all_dimensions
from corridor.plans import bronze
from corridor.schemas import CALENDAR, RAW_TRIPS, RELATION, strings
from corridor.sources import calendar, delimited, feed, geometry, series

HEADER = "|".join(RAW_TRIPS.fieldNames())


def trip(fecha="20230508", periodo="01", origen="01001", destino="01002", sexo="mujer", viajes="1.5", km="10"):
    return "|".join(
        [fecha, periodo, origen, destino, "2-10", "casa", "trabajo", "si", "no", "01", ">15", "25-45", sexo, viajes, km]
    )


def write(path, text, zipped=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    opener = gzip.open if zipped else open
    with opener(path, "wt", encoding="utf-8") as handle:
        handle.write(text)
    return str(path)


def test_malformed_rows_drop_whatever_is_read(spark, tmp_path):
    path = write(tmp_path / "a.csv.gz", "\n".join([HEADER, trip(), "20230508|01", trip() + "|x", trip(viajes="2")]), True)
    table = delimited.read_lenient(spark, path, RAW_TRIPS)
    assert table.count() == 2
    assert rows(table.select("viajes")) == [("1.5",), ("2",)]
    assert table.first()["origen"] == "01001"


def test_landing_sums_filters_and_keeps_null_dimensions(spark, tmp_path):
    lines = [HEADER, trip(), trip(viajes="2.5"), trip(fecha="20230509"), trip(sexo=""), trip(periodo="1")]
    raw = delimited.read_lenient(spark, write(tmp_path / "a.csv", "\n".join(lines)), RAW_TRIPS)
    day = by_all_dimensions(raw, "2023-05-08").select("date", "period", "gender", "travels")
    assert rows(day) == [
        (date(2023, 5, 8), "01", None, 1.5),
        (date(2023, 5, 8), "01", "mujer", 4.0),
        (date(2023, 5, 8), "1", "mujer", 1.5),
    ]


def test_bad_date_fails_unless_lenient(spark, tmp_path):
    path = write(tmp_path / "a.csv", "\n".join([HEADER, trip(), trip(fecha="20230132")]))
    raw = delimited.read_lenient(spark, path, RAW_TRIPS)
    with pytest.raises(Exception, match="20230132"):
        by_all_dimensions(raw).collect()
    assert by_all_dimensions(raw, lenient=True).count() == 1


def test_landing_table_replaces_days(spark, database, tmp_path):
    table = f"{database}.trips"
    bronze.create_trips(spark, table)
    path = write(tmp_path / "a.csv", "\n".join([HEADER, trip(), trip(fecha="20230509")]))
    raw = delimited.read_lenient(spark, path, RAW_TRIPS)
    for _ in range(2):
        loaded = bronze.load_trips(raw, table, ["2023-05-08", "2023-05-09", "2023-05-10"])
    assert loaded.count() == 2
    assert bronze.create_trips(spark, table).count() == 2


def test_delimiter_comes_from_the_first_line(spark, tmp_path):
    write(tmp_path / "d" / "semi.csv", "a;b\n1|2|3|4;x\n")
    write(tmp_path / "d" / "pipe.csv.gz", "a|b\n1|2\n", True)
    write(tmp_path / "d" / "tie.csv", "a;b|c\n")
    found = {row["file"].split("/")[-1]: row["delimiter"] for row in delimited.delimiters(spark, str(tmp_path / "d")).collect()}
    assert found == {"semi.csv": ";", "pipe.csv.gz": "|", "tie.csv": ";"}


def test_files_of_both_delimiters_and_by_pattern(spark, tmp_path):
    write(tmp_path / "d" / "20230106_x.csv", "a;b\n01;2\n")
    write(tmp_path / "d" / "20230107_x.csv", 'a|b\n"q|4\n')
    write(tmp_path / "d" / "20240101_x.csv", "a;b\n9;9\n")
    table = delimited.read_detected(spark, str(tmp_path / "d"), strings("a", "b"), glob="*2023*.csv")
    assert rows(table) == [('"q', "4", "|"), ("01", "2", ";")]


def test_files_in_folders_with_special_characters(spark, tmp_path):
    write(tmp_path / "a b [1] %20" / "x y.csv", "a;b\n01;2\n")
    table = delimited.read_detected(spark, str(tmp_path / "a b \\[1\\] %20"), strings("a", "b"))
    assert rows(table) == [("01", "2", ";")]


def test_dimension_file_keeps_zeros_and_cuts_columns(spark, tmp_path):
    path = write(tmp_path / "r.csv", "|".join([*RELATION.fieldNames(), "more"]) + "\n01|02|03|04|05|NA|x\n01|02|03|04|05||x\n")
    table = delimited.read_dimension(spark, path, ["seccion_ine", "gau_mitma"])
    assert rows(table) == [("01", None), ("01", "NA")]


@pytest.mark.parametrize(
    ("table", "text", "want"),
    [
        ("bronze_poblacion_distritos", "ID|population|note\n01|500|x\n02||\n", [("01", "500"), ("02", None)]),
        ("bronze_poblacion_gaus", "population|ID\n7|G1\n", [("G1", "7")]),
        ("bronze_provincias", "province_id|province\n08|Barcelona\n", [("08", "Barcelona")]),
    ],
)
def test_people_and_provinces(spark, tmp_path, table, text, want):
    assert rows(bronze.dimension(spark, table, write(tmp_path / "d.csv", text))) == want


META = [
    {"T3_Variable": "Secciones", "Codigo": "0101", "Nombre": "s"},
    {"T3_Variable": "x", "Codigo": "", "Nombre": "y"},
    {"T3_Variable": "x", "Codigo": "", "Nombre": "Renta neta media por persona"},
]


def test_nested_series(spark, tmp_path):
    stamp = "2023-01-01T00:00:00.000+01:00"
    other = [dict(META[0], T3_Variable="Municipios"), *META[1:]]
    documents = [
        {"MetaData": META, "Data": [{"Fecha": stamp, "Valor": 12.5}, {"Fecha": stamp, "Valor": "."}]},
        {"MetaData": META, "Data": []},
        {"MetaData": [], "Data": [{"Fecha": stamp, "Valor": 1}]},
        {"MetaData": META[:2], "Data": [{"Fecha": stamp, "Valor": 1}]},
        {"MetaData": other, "Data": [{"Fecha": stamp, "Valor": 1}]},
        {"MetaData": META, "Data": [{"Fecha": stamp, "Valor": None}]},
    ]
    path = write(tmp_path / "s.json.gz", json.dumps(documents, indent=2), True)
    found = series.extract_series(series.read_documents(spark, path), series.INCOME_SERIES)
    assert rows(found) == [("0101", stamp, None), ("0101", stamp, None), ("0101", stamp, 12.5)]
    assert series.with_meta(series.read_documents(spark, path), series.POPULATION_SERIES).count() == 0


FEED = """<rss><channel>
<item><title>20230508_Viajes_distritos.csv.gz</title><link>https://x/estudios_basicos/first</link></item>
<item><title>20230508_Viajes_distritos.csv.gz</title><link>https://x/estudios_basicos/second</link></item>
<item><title>20230509_Viajes_distritos.csv.gz</title><link>https://x/otros/9</link></item>
<item><title>20230510_Viajes_municipios.csv.gz</title><link>https://x/estudios_basicos/10</link></item>
<item><title>nombres_distritos.csv</title><link>https://x/names</link></item>
<item><title>zonificacion_distritos.zip</title><link>https://x/zones</link></item>
<item><title>news</title><link>https://x/news</link></item>
</channel></rss>"""


def test_feed(spark, tmp_path):
    items = feed.read_feed(spark, write(tmp_path / "feed.xml", FEED))
    trips = feed.trip_files(items, {"bronze_mitma_viajes_distritos": "Viajes_distritos"})
    days = feed.first_file_per_day(trips, "2023-05-08", "2023-05-10")
    assert rows(days.select("day", "url")) == [(date(2023, 5, 8), "https://x/estudios_basicos/first")]
    assert rows(feed.dimension_files(items)) == [("https://x/names", "bronze_distritos_nombres")]
    assert feed.trip_files(items).count() == 3


def test_calendar(spark):
    holidays = spark.createDataFrame([(date(2023, 5, 1),), (date(2023, 5, 1),)], "date date")
    found = calendar.calendar(calendar.days(spark, "2023-05-01", "2023-05-08"), holidays)
    assert [f.dataType for f in found.schema] == [f.dataType for f in CALENDAR]
    flags = {row[0].day: (row[1], row[2]) for row in found.collect()}
    assert flags[1] == (1, 0) and flags[6] == (0, 1) and flags[7] == (0, 1) and flags[8] == (0, 0)
    assert sorted(r[0].day for r in calendar.special_days(found).collect()) == [1, 6, 7]


def test_load_audit(spark):
    days = calendar.days(spark, "2023-01-01", "2023-01-04")
    landed = spark.createDataFrame(
        [("gau", date(2023, 1, 1)), ("gau", date(2023, 1, 1)), ("gau", date(2023, 1, 3)), ("other", date(2023, 1, 2))],
        "level string, day date",
    )
    assert rows(calendar.load_audit(days, ["gau", "distritos"], landed)) == [
        ("distritos", 4, 0, 4, "2023-01-01,2023-01-02,2023-01-03,2023-01-04"),
        ("gau", 4, 2, 2, "2023-01-02,2023-01-04"),
    ]


def test_zone_tables(spark, tmp_path):
    path = write(tmp_path / "z.csv", "ID|geom\n01|POINT (10.5 -2)\n02|point(1 2)\n")
    zones = geometry.read_zone_table(spark, path)
    assert rows(geometry.centroids(zones).select("distrito_id", "centroide.x", "centroide.y")) == [
        ("01", 10.5, -2.0),
        ("02", 1.0, 2.0),
    ]
    assert geometry.outlines(zones).filter(F.col("geometria").startswith("POINT")).count() == 1
