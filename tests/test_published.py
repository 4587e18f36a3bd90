"""The stream over flat names: completeness, late parts, reruns, parts published anew."""

from __future__ import annotations

import gzip
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from corridor.operators import loads
from corridor.streaming import published

PARTS = ("Viajes_distritos", "Viajes_GAU")


@pytest.fixture
def arrivals(spark, database, tmp_path):
    """A landing folder, and a call that takes in what is there."""
    table, ledger, landing = f"{database}.t", f"{database}.ledger", tmp_path / "landing"
    loads.create_if_absent(spark.createDataFrame([], "v int, date date"), table, ["date"])

    def land(name, *values, folder="2024-01"):
        (landing / folder).mkdir(parents=True, exist_ok=True)
        text = "\n".join(["v", *map(str, values)]).encode()
        (landing / folder / name).write_bytes(gzip.compress(text) if name.endswith("gz") else text)

    def run(files_per_batch=1, checkpoint="checkpoint"):
        published.ingest_published(
            spark, f"{landing}/*", spark.table(table).drop("date").schema, table, ledger,
            str(tmp_path / checkpoint), PARTS, files_per_batch=files_per_batch, header=True,
        )
        return [(v, d.day) for v, d in rows(spark.table(table))]

    return land, run, table, ledger


def test_days_load_when_complete(spark, arrivals, monkeypatch):
    land, run, table, ledger = arrivals
    replaced = []
    replace_days = published.replace_days

    def counted(df, name, days, column):
        replaced.append(sorted(days))
        return replace_days(df, name, days, column)

    monkeypatch.setattr(published, "replace_days", counted)
    land("20240101_Viajes_distritos.csv.gz", 1, 2)
    land("20240101_Viajes_GAU.csv", 3)
    land("20240102_Viajes_distritos.csv.gz", 4)
    land("20240103_Viajes_municipios.csv", 99)
    land("20249999_Viajes_GAU.csv", 98)
    land("notes.txt", 97)
    assert run() == [(1, 1), (2, 1), (3, 1)]
    # one load of the day, though its files came in two micro-batches
    assert replaced == [["2024-01-01"]]
    assert rows(published.missing_parts(spark.table(ledger), PARTS)) == [
        (date(2024, 1, 2), "Viajes_GAU"), (date(2024, 1, 3), "Viajes_GAU"), (date(2024, 1, 3), "Viajes_distritos"),
    ]
    assert run() == [(1, 1), (2, 1), (3, 1)] and len(replaced) == 1
    land("20240102_Viajes_GAU.csv", 5, folder="late")
    assert run() == [(1, 1), (2, 1), (3, 1), (4, 2), (5, 2)]
    assert replaced[1:] == [["2024-01-02"]]


def test_part_published_anew_replaces_the_old_one(arrivals):
    land, run, *_ = arrivals
    land("20240101_Viajes_distritos.csv", 1, 2)
    land("20240101_Viajes_GAU.csv", 3)
    assert run(files_per_batch=10) == [(1, 1), (2, 1), (3, 1)]
    land("20240101_Viajes_GAU.csv", 7, folder="again")
    assert run(files_per_batch=10) == [(1, 1), (2, 1), (7, 1)]


def test_another_checkpoint_sees_all_files_again(spark, arrivals):
    land, run, table, ledger = arrivals
    land("20240101_Viajes_distritos.csv", 1)
    land("20240101_Viajes_GAU.csv", 3)
    first = run(files_per_batch=10)
    assert run(files_per_batch=10, checkpoint="other") == first
    assert published.current_files(spark.table(ledger)).count() == 2
    assert spark.table(ledger).agg(F.countDistinct("batch")).first()[0] == 2
