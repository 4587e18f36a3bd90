"""Fixed schemas of the landed, conformed and product tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _table(*columns: tuple[str, object]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns])


def strings(*names: str) -> StructType:
    return _table(*((name, StringType()) for name in names))


# Field names of the daily trip files and the names they get on landing.
TRIP_FIELDS = {
    "fecha": "date",
    "periodo": "period",
    "origen": "origin",
    "destino": "destination",
    "distancia": "distance",
    "actividad_origen": "activity_origin",
    "actividad_destino": "activity_destination",
    "estudio_origen_posible": "study_origin_posible",
    "estudio_destino_posible": "study_destination_posible",
    "residencia": "residence",
    "renta": "rent",
    "edad": "age",
    "sexo": "gender",
    "viajes": "travels",
    "viajes_km": "travels_km",
}
TRIP_MEASURES = ["travels", "travels_km"]
TRIP_DIMENSIONS = [name for name in TRIP_FIELDS.values() if name not in TRIP_MEASURES]

RAW_TRIPS = strings(*TRIP_FIELDS)
BRONZE_TRIPS = _table(
    ("date", DateType()),
    *((name, StringType()) for name in TRIP_DIMENSIONS[1:]),
    *((name, DoubleType()) for name in TRIP_MEASURES),
)

ZONE_NAMES = strings("ID", "name")
ZONE_PEOPLE = strings("ID", "population")
PROVINCES = strings("province_id", "province")
RELATION = strings(
    "seccion_ine", "distrito_ine", "municipio_ine", "distrito_mitma", "municipio_mitma", "gau_mitma"
)
CALENDAR = _table(
    ("fecha", DateType()), ("es_festivo", IntegerType()), ("es_fin_de_semana", IntegerType())
)
ZONE_WKT = strings("ID", "geom")
FEED_ITEM = _table(("title", StringType()), ("link", StringType()), ("pos", LongType()))

SERIES_DOCUMENT = _table(
    ("MetaData", ArrayType(strings("T3_Variable", "Codigo", "Nombre"))),
    ("Data", ArrayType(strings("Fecha", "Valor"))),
)
SERIES = _table(("codigo", StringType()), ("fecha", StringType()), ("valor", DoubleType()))

SILVER_CALENDAR = _table(
    ("date", DateType()), ("is_holiday", BooleanType()), ("is_weekend", BooleanType())
)
SILVER_TRIPS = _table(
    ("date", DateType()),
    ("period", IntegerType()),
    ("origin_id", StringType()),
    ("destination_id", StringType()),
    ("travels", DoubleType()),
    ("travels_km", DoubleType()),
)
SILVER_DEMOGRAPHICS = _table(
    ("distrito_id", StringType()),
    ("year", IntegerType()),
    ("renta_total_euros", DoubleType()),
    ("renta_media_euros", DoubleType()),
    ("poblacion", IntegerType()),
)
SILVER_DISTANCES = _table(
    ("origin_id", StringType()), ("destination_id", StringType()), ("distance_meters", DoubleType())
)
PARTIAL_TRIPS = _table(
    ("origin_id", StringType()), ("destination_id", StringType()), ("partial_trips", LongType())
)
HOUR_COLUMNS = [str(hour) for hour in range(24)]
DAILY_PROFILE = _table(("date", DateType()), *((hour, DoubleType()) for hour in HOUR_COLUMNS))
DATE_PATTERNS = _table(("date", DateType()), ("pattern_type", IntegerType()))
