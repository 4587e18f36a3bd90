from __future__ import annotations

import re
from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from corridor.operators import aggregates, loads
from corridor.plans import bronze, refresh, silver
from corridor.schemas import RAW_TRIPS
from corridor.session import settle

TRIPS = "date date, period string, origin string, destination string, travels double, travels_km double, note string"
DAY = date(2024, 1, 1)


def landed(spark, days):
    """days: {offset: [travels of one trip each]}"""
    data = [(DAY + timedelta(d), "07", "a", "b", float(v), v * 10.0, "n") for d, found in days.items() for v in found]
    return spark.createDataFrame(data, TRIPS)


@pytest.fixture
def mapping(spark):
    return spark.createDataFrame([("a", "A"), ("b", "B")], "distrito_mitma string, distrito_ine string")


def offsets(days):
    return [(date.fromisoformat(day) - DAY).days for day in days]


def test_only_changed_days_are_loaded(spark, database, mapping):
    table, ledger = f"{database}.silver", f"{database}.ledger"

    def load(days, codes=mapping):
        return offsets(refresh.refresh_trips(landed(spark, days), codes, table, ledger))

    first = {0: [1], 1: [2, 2], 2: [3], 3: [4]}
    assert load(first) == [0, 1, 2, 3]
    assert load(first) == []
    # a changed number, a repeated row more, a day gone, a day come
    second = {0: [1], 1: [2, 2, 2], 2: [5], 4: [6]}
    assert load(second) == [1, 2, 3, 4]
    want = silver.trips(landed(spark, second), mapping)
    assert rows(spark.table(table).select(*want.columns)) == rows(want)
    # columns that are not conformed change nothing; the codes do
    noted = landed(spark, second).withColumn("note", F.lit("other"))
    assert refresh.refresh_trips(noted, mapping, table, ledger) == []
    other = spark.createDataFrame([("a", "A"), ("b", "C")], mapping.schema)
    assert load(second, other) == [0, 1, 2, 4]
    assert {r["destination_id"] for r in spark.table(table).collect()} == {"C"}
    assert load({}) == [0, 1, 2, 4] and spark.table(table).count() == 0


def test_a_load_that_fails_is_done_again(spark, database, mapping, monkeypatch):
    table, ledger = f"{database}.silver", f"{database}.ledger"
    days = {0: [1], 1: [2]}
    refresh.refresh_trips(landed(spark, days), mapping, table, ledger)
    days[1] = [9]

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(loads, "replace_table", broken)
    with pytest.raises(RuntimeError, match="lost"):
        refresh.refresh_trips(landed(spark, days), mapping, table, ledger)
    monkeypatch.undo()
    assert offsets(refresh.refresh_trips(landed(spark, days), mapping, table, ledger)) == [1]
    assert rows(spark.table(table).select("travels")) == [(1.0,), (9.0,)]


def test_partials_equal_a_full_recomputation(spark, database, mapping):
    table, ledger, partials = (f"{database}.{name}" for name in ("silver", "ledger", "partials"))
    start, end = "2024-01-01", "2024-01-28"

    def refreshed(days):
        changed = refresh.refresh_trips(landed(spark, days), mapping, table, ledger)
        weeks = refresh.refresh_partials(spark.table(table), changed, partials, start, end)
        whole = aggregates.weekly_partials(silver.trips(landed(spark, days), mapping), start, end)
        assert rows(spark.table(partials).select(*whole.columns)) == rows(whole)
        return weeks

    days = {0: [1], 6: [2], 7: [3], 15: [4], 40: [5]}
    assert refreshed(days) == [0, 1, 2]
    assert refreshed(days) == []
    assert refreshed({**days, 8: [7], 41: [1]}) == [1]
    # the only day of a week goes, a late row comes to another
    late = {0: [1, 1], 6: [2], 7: [3], 8: [7], 40: [5], 41: [1]}
    assert refreshed(late) == [0, 2]


def test_a_load_shuffles_landed_rows_once(spark, database, mapping, monkeypatch):
    written = []
    overwrite = loads._overwrite_partitions

    def seen(df, table):
        written.append(df._jdf.queryExecution().executedPlan().toString())
        overwrite(df, table)

    monkeypatch.setattr(loads, "_overwrite_partitions", seen)
    codes = settle(mapping, "codes")
    refresh.refresh_trips(landed(spark, {0: [1], 1: [2, 2]}), codes, f"{database}.silver", f"{database}.ledger")
    assert len(written) == 1 and len(re.findall(r"(?<!Broadcast)Exchange ", written[0])) == 1
    assert rows(spark.table(f"{database}.silver").select("travels")) == [(1.0,), (4.0,)]


def test_trips_by_day_are_the_trips_in_few_files(spark, database):
    # codes with two targets, and one without any whose hour cannot be read
    codes = settle(
        spark.createDataFrame([("a", "A"), ("a", "B"), ("b", "B"), ("c", "B")], "distrito_mitma string, distrito_ine string"),
        "codes",
    )
    raw = spark.range(6000).selectExpr(
        "CASE WHEN id % 50 = 0 THEN NULL ELSE date_add(DATE '2024-01-01', CAST(id % 10 AS INT)) END AS date",
        "CASE WHEN id % 5 = 4 THEN 'night' WHEN id % 40 = 1 THEN NULL WHEN id % 2 = 0 THEN '01' ELSE CAST(id % 24 AS STRING) END AS period",
        "CASE WHEN id % 5 = 4 THEN 'z' ELSE substr('abc', CAST(id % 3 AS INT) + 1, 1) END AS origin",
        "substr('cab', CAST(id % 7 % 3 AS INT) + 1, 1) AS destination",
        "CAST(id AS DOUBLE) AS travels", "CASE WHEN id % 11 = 0 THEN NULL ELSE 1.5D END AS travels_km",
    )
    found = silver.trips_by_day(raw, codes, 3)
    assert rows(found) == rows(silver.trips(raw, codes))
    table, ledger = f"{database}.silver", f"{database}.ledger"
    refresh.refresh_trips(raw, codes, table, ledger)
    want = silver.trips(raw.filter("date IS NOT NULL"), codes)
    assert rows(spark.table(table).select(*want.columns)) == rows(want)
    # four tasks cut ten days at three places
    assert spark.table(table).select(F.input_file_name()).distinct().count() <= 13


def test_fingerprints_do_not_depend_on_order_but_on_repeats(spark):
    one = landed(spark, {0: [1, 2, 3], 1: [4, 4]})
    again = landed(spark, {1: [4, 4], 0: [3, 1, 2]}).repartition(4)
    assert rows(refresh.day_fingerprints(one)) == rows(refresh.day_fingerprints(again))
    thrice = landed(spark, {0: [1, 2, 3], 1: [4, 4, 4, 4]})
    assert refresh.changed_days(refresh.day_fingerprints(thrice), refresh.day_fingerprints(one)) == [str(DAY + timedelta(1))]
    assert refresh.day_fingerprints(one.limit(0)).count() == 0


def test_only_requested_files_are_read(spark, database, tmp_path):
    header = "|".join(RAW_TRIPS.fieldNames())
    values = {"fecha": "20240101", "viajes": "2.5", "viajes_km": "7"}

    def file(name, *dates):
        lines = ["|".join({**dict.fromkeys(RAW_TRIPS.fieldNames(), "1"), **values, "fecha": day}.values()) for day in dates]
        (tmp_path / name).write_text("\n".join([header, *lines]))
        return str(tmp_path / name)

    good, late, bad = file("a.csv", "20240101", "20240101"), file("b.csv", "20240102"), file("c.csv", "not a date")
    manifest = spark.createDataFrame(
        [(good, DAY), (good, DAY), (late, date(2024, 1, 2)), (bad, date(2024, 1, 3)), (str(tmp_path / "gone.csv"), date(2024, 1, 4))],
        "url string, day date",
    )
    table = f"{database}.trips"
    bronze.create_trips(spark, table)
    assert rows(bronze.load_requested(spark, manifest, table, ["2024-01-01"]).select("travels")) == [(5.0,)]
    # a day that was not published is left alone, and so are the other days
    bronze.load_requested(spark, manifest, table, ["2024-01-02", "2024-01-09"])
    assert rows(spark.table(table).select("travels")) == [(2.5,), (5.0,)]
    assert bronze.load_requested(spark, manifest, table, ["2024-02-01"]).count() == 2
    with pytest.raises(Exception):  # noqa: B017
        bronze.load_requested(spark, manifest, table, ["2024-01-03"])
    assert spark.table(table).count() == 2
