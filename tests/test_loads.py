from __future__ import annotations

from datetime import date

import pytest
from conftest import rows

from corridor.operators import loads, setops
from corridor.session import new_path
from corridor.streaming.daily import ingest_days


def table_of(spark, data, schema="k string, v int"):
    return spark.createDataFrame(data, schema)


def test_upsert_updates_inserts_and_repeats(spark):
    target = table_of(spark, [("a", 1), ("b", 2)])
    source = table_of(spark, [("b", 20), ("c", 30)])
    once = loads.upsert(target, source, ["k"])
    assert rows(once) == [("a", 1), ("b", 20), ("c", 30)]
    assert rows(loads.upsert(once, source, ["k"])) == rows(once)


def test_upsert_null_key_is_added_every_time(spark):
    target = table_of(spark, [("a", 1), (None, 2)])
    source = table_of(spark, [(None, 3)])
    assert rows(loads.upsert(target, source, ["k"])) == [(None, 2), (None, 3), ("a", 1)]
    assert rows(loads.upsert(target, source, ["k"], null_safe=True)) == [(None, 3), ("a", 1)]


def test_upsert_duplicate_source_keys(spark):
    target = table_of(spark, [("a", 1)])
    with pytest.raises(Exception, match="two source rows"):
        loads.upsert(target, table_of(spark, [("a", 2), ("a", 3)]), ["k"]).collect()
    assert rows(loads.upsert(target, table_of(spark, [("b", 2), ("b", 3)]), ["k"])) == [("a", 1), ("b", 2), ("b", 3)]


def test_upsert_keeps_duplicate_target_rows(spark):
    target = table_of(spark, [("a", 1), ("a", 2)])
    assert rows(loads.upsert(target, table_of(spark, [("a", 9)]), ["k"])) == [("a", 9), ("a", 9)]


def test_upsert_update_to_null(spark):
    target = table_of(spark, [("a", 1)])
    assert rows(loads.upsert(target, table_of(spark, [("a", None)]), ["k"])) == [("a", None)]


def test_upsert_two_keys_by_columns_in_any_order(spark):
    target = spark.createDataFrame([("s", "2022", 1.0), ("s", "2023", 2.0)], "codigo string, fecha string, valor double")
    source = spark.createDataFrame([(5.0, "2023", "s"), (6.0, "2024", "s")], "valor double, fecha string, codigo string")
    assert rows(loads.upsert(target, source, ["codigo", "fecha"])) == [
        ("s", "2022", 1.0),
        ("s", "2023", 5.0),
        ("s", "2024", 6.0),
    ]


def test_swap_table(spark, database):
    table = f"{database}.t"
    loads.replace_table(table_of(spark, [("a", 1)]), table)
    loads.swap_table(loads.upsert(spark.table(table), table_of(spark, [("a", 2)]), ["k"]), table)
    assert rows(spark.table(table)) == [("a", 2)]


def test_a_failed_replacement_leaves_the_old_table(spark, database):
    table = f"{database}.kept"
    loads.replace_table(table_of(spark, [("a", 1)]), table)
    bad = table_of(spark, [("b", 2)]).selectExpr("k", "CAST(raise_error('broken') AS INT) AS v")
    with pytest.raises(Exception, match="broken"):
        loads.replace_table(bad, table)
    assert rows(spark.table(table)) == [("a", 1)]


def test_days_of_an_unpartitioned_table(spark, database):
    table, one, two = f"{database}.plain", date(2024, 1, 1), date(2024, 1, 2)
    loads.replace_table(spark.createDataFrame([(1, one), (2, two), (3, None)], "id int, date date"), table)
    again = spark.createDataFrame([(9, one)], "id int, date date")
    assert rows(loads.replace_days(again, table, [one])) == [(2, two), (3, None), (9, one)]


def test_merge_then_replace_a_day_keeps_the_other_days(spark, database):
    table, one, two = f"{database}.days", date(2024, 1, 1), date(2024, 1, 2)
    schema = "id int, v int, date date"
    loads.replace_table(spark.createDataFrame([(1, 1, one), (2, 2, two)], schema), table, ["date"])
    loads.swap_table(loads.upsert(spark.table(table), spark.createDataFrame([(1, 5, one)], schema), ["id", "date"]), table)
    assert loads.partition_columns(spark, table) == ["date"]
    loads.upsert_into(table, spark.createDataFrame([(1, 6, one), (3, 3, one)], schema), ["id", "date"])
    assert rows(spark.table(table)) == [(1, 6, one), (2, 2, two), (3, 3, one)]
    assert rows(loads.replace_days(spark.createDataFrame([(7, 7, one)], schema), table, [one])) == [(2, 2, two), (7, 7, one)]


def test_a_double_match_fails_whatever_is_selected(spark):
    merged = loads.upsert(table_of(spark, [("a", 1)]), table_of(spark, [("a", 2), ("a", 3)]), ["k"])
    for use in (lambda: merged.count(), lambda: merged.select("k").collect()):
        with pytest.raises(Exception, match="two source rows"):
            use()
    keys = table_of(spark, [("a",)], "k string")
    with pytest.raises(Exception, match="two source rows"):
        loads.upsert(keys, table_of(spark, [("a",), ("a",)], "k string"), ["k"]).collect()


def test_except_treats_nulls_as_equal_and_folds_duplicates(spark):
    source = table_of(spark, [("a", 1), ("a", 1), (None, None), (None, 5)])
    target = table_of(spark, [(None, None), ("z", 0), ("z", 0)])
    assert rows(setops.except_distinct(source, target)) == [(None, 5), ("a", 1)]
    assert rows(loads.insert_only_new(target, source)) == [(None, None), (None, 5), ("a", 1), ("z", 0), ("z", 0)]


DAYS = "v int, date date"


def test_replace_days_clears_a_day_that_came_out_empty(spark, database):
    table = f"{database}.d"
    one, two, three = date(2023, 1, 1), date(2023, 1, 2), date(2023, 1, 3)
    loads.replace_table(table_of(spark, [(1, one), (2, one), (3, two), (4, three)], DAYS), table, ["date"])
    fewer = table_of(spark, [(9, one), (8, three)], DAYS)
    for _ in range(2):
        found = loads.replace_days(fewer, table, [one, two])
        assert rows(found) == [(4, three), (9, one)]
    assert rows(loads.replace_days(fewer.limit(0), table, [one])) == [(4, three)]


def test_create_if_absent_and_empty_clone(spark, database):
    table = f"{database}.t"
    data = table_of(spark, [("a", 1)])
    assert loads.create_if_absent(loads.empty_like(data), table).count() == 0
    assert loads.create_if_absent(data, table).count() == 0
    assert spark.table(table).schema == data.schema


def test_append_by_position_and_by_name(spark, database):
    table = f"{database}.t"
    loads.replace_table(spark.createDataFrame([("a", "b")], "x string, y string"), table)
    other = spark.createDataFrame([("1", "2")], "y string, x string")
    loads.append_by_position(other, table)
    assert rows(loads.append_by_name(other, table)) == [("1", "2"), ("2", "1"), ("a", "b")]
    with pytest.raises(ValueError, match="columns differ"):
        loads.append_by_name(other.withColumnRenamed("x", "z"), table)


def test_skip_already_loaded(spark):
    manifest = spark.createDataFrame([("u1",), ("u2",)], "url string")
    assert rows(loads.not_yet_loaded(manifest, manifest.filter("url = 'u1'"), ["url"])) == [("u2",)]


def test_stream_replaces_whole_days_across_batches(spark, database, tmp_path):
    table, landing = f"{database}.s", tmp_path / "landing"
    schema = table_of(spark, [], "v int, date date").schema
    loads.create_if_absent(spark.createDataFrame([], schema), table, ["date"])

    def land(day, name, text):
        folder = landing / f"date={day}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text)

    def run():
        ingest_days(
            spark, str(landing), schema, table, str(tmp_path / "checkpoint"), files_per_batch=1, header=True
        )
        return rows(spark.table(table))

    land("2023-01-01", "a.csv", "v\n1\n2\n")
    land("2023-01-01", "b.csv", "v\n3\n")
    land("2023-01-02", "a.csv", "v\n4\n")
    first = run()
    assert [v for v, _ in first] == [1, 2, 3, 4]
    assert run() == first
    land("2023-01-02", "late.csv", "v\n5\n")
    assert [v for v, _ in run()] == [1, 2, 3, 4, 5]


def test_clustered_write_splits_a_busy_day(spark):
    busy = spark.range(10_000).selectExpr("DATE'2023-01-01' AS date", "CAST(id AS STRING) AS origin_id")
    path = new_path(spark, "clustered")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    loads.clustered(busy, "date", "origin_id").write.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(spark.read.parquet(path).inputFiles()) == 4
    assert spark.read.parquet(path).count() == 10_000


PLAIN = {
    "sql": "CREATE TABLE {} (v INT, date DATE) USING parquet PARTITIONED BY (date)",
    "static": "CREATE TABLE {} (v INT, date DATE) USING parquet OPTIONS (partitionOverwriteMode 'static') PARTITIONED BY (date)",
    "unpartitioned": "CREATE TABLE {} (v INT, date DATE) USING parquet",
    "coarser": "CREATE TABLE {} (v INT, date DATE, year INT) USING parquet PARTITIONED BY (year)",
}


@pytest.fixture(params=sorted(PLAIN))
def plain_table(spark, database, request):
    """Three days in a table that plain SQL created, partitioned in one way or another."""
    table = f"{database}.t_{request.param}"
    spark.sql(PLAIN[request.param].format(table))
    days = [(1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, date(2024, 1, 2)), (4, date(2025, 1, 3))]
    held = spark.createDataFrame(days, "v int, date date")
    if request.param == "coarser":
        held = held.selectExpr("v", "date", "year(date) AS year")
    held.write.insertInto(table)
    return table


def like(spark, table, data):
    return spark.createDataFrame(data, "v int, date date").selectExpr("v", "date", "year(date) AS year").select(*spark.table(table).columns)


def test_replacing_a_day_keeps_the_others_in_any_table(spark, plain_table):
    loads.replace_days(like(spark, plain_table, [(9, date(2024, 1, 2))]), plain_table, ["2024-01-02"])
    want = [(1, date(2024, 1, 1)), (4, date(2025, 1, 3)), (9, date(2024, 1, 2))]
    assert rows(spark.table(plain_table).select("v", "date")) == want
    loads.replace_days(like(spark, plain_table, []), plain_table, ["2024-01-01"])
    assert rows(spark.table(plain_table).select("v", "date")) == want[1:]


def test_merging_into_a_day_keeps_the_others_in_any_table(spark, plain_table):
    source = like(spark, plain_table, [(2, date(2024, 1, 2)), (5, date(2024, 1, 2)), (6, date(2026, 1, 1))])
    for _ in range(2):
        loads.upsert_into(plain_table, source, ["v", "date"])
        got = rows(spark.table(plain_table).select("v"))
        assert got == [(1,), (2,), (3,), (4,), (5,), (6,)]


def test_the_session_keeps_its_own_overwrite_mode(spark, database):
    table = f"{database}.modes"
    spark.sql(PLAIN["sql"].format(table))
    before = spark.conf.get(loads.OVERWRITE_MODE)
    failing = like(spark, table, [(1, date(2024, 1, 1))]).selectExpr("CAST(raise_error('no') AS INT) AS v", "date")
    with pytest.raises(Exception, match="no"):
        loads.replace_days(failing, table, ["2024-01-01"])
    assert spark.conf.get(loads.OVERWRITE_MODE) == before


def test_a_failed_replacement_leaves_the_old_partitioned_table(spark, database, monkeypatch):
    table = f"{database}.kept"
    spark.sql(PLAIN["sql"].format(table))
    spark.sql(f"INSERT INTO {table} VALUES (1, DATE'2024-01-01'), (2, DATE'2024-01-02')")
    bad = spark.table(table).selectExpr("CAST(raise_error('broken') AS INT) AS v", "date")
    for replace in (lambda: loads.replace_table(bad, table, ["date"]), lambda: loads.swap_table(bad, table)):
        with pytest.raises(Exception, match="broken"):
            replace()
        assert rows(spark.table(table).select("v")) == [(1,), (2,)]

    # the rows are computed, but the last copy fails half way, under the same columns and under others
    half = "CAST(CASE WHEN date > DATE'2024-01-06' THEN raise_error('half') ELSE v END AS INT) AS v"
    overwrite, writer, calls = loads._overwrite_partitions, loads._writer, []

    def first_fails(df, partition_by):
        calls.append(partition_by)
        return writer(df.selectExpr(half, *(c for c in df.columns if c != "v")) if len(calls) == 1 else df, partition_by)

    monkeypatch.setattr(loads, "_overwrite_partitions", lambda df, name: overwrite(df.selectExpr(half, "date"), name))
    monkeypatch.setattr(loads, "_writer", first_fails)
    new = like(spark, table, [(6, date(2024, 1, 6)), (7, date(2024, 1, 7))])
    for changed in (new, new.withColumn("w", new["v"])):
        with pytest.raises(Exception, match="half"):
            loads.replace_table(changed, table, ["date"])
        assert rows(spark.table(table).select("v")) == [(1,), (2,)]
    assert len(calls) == 2
    monkeypatch.undo()
    assert rows(spark.table(table).select("v")) == [(1,), (2,)]
    loads.replace_days(like(spark, table, [(8, date(2024, 1, 2))]), table, ["2024-01-02"])
    assert rows(spark.table(table).select("v")) == [(1,), (8,)]


def test_a_replaced_table_takes_days_and_drops_them(spark, database):
    table = f"{database}.twice"
    for v in (1, 2):
        loads.replace_table(like_rows(spark, v), table, ["date"])
    loads.replace_days(like_rows(spark, 5), table, ["2024-01-01"])
    loads.replace_days(like_rows(spark, 6).limit(0), table, ["2024-01-02"])
    assert rows(spark.table(table)) == [(5, date(2024, 1, 1))]


def like_rows(spark, v):
    return spark.createDataFrame([(v, date(2024, 1, 1)), (v, date(2024, 1, 2))], "v int, date date")


def test_partitions_that_are_no_more_go_with_a_replacement(spark, database):
    table = f"{database}.named"
    first = spark.createDataFrame([(1, "a'b"), (2, None), (3, "c/d=e"), (4, "f")], "v int, k string")
    loads.replace_table(first, table, ["k"])
    loads.replace_table(first.filter("v = 4").withColumn("v", first["v"] * 10), table, ["k"])
    assert rows(spark.table(table)) == [(40, "f")]
    loads.replace_table(first.filter("v IN (2, 3)"), table, ["k"])
    assert rows(spark.table(table)) == [(2, None), (3, "c/d=e")]
    loads.replace_table(spark.createDataFrame([(1, "x", 2.0)], "v int, k string, w double"), table, ["k"])
    assert spark.table(table).select("v", "k", "w").collect() == [(1, "x", 2.0)]
    loads.replace_table(spark.createDataFrame([(1, 2)], "v int, w int"), table)
    assert rows(spark.table(table)) == [(1, 2)] and loads.partition_columns(spark, table) == []
