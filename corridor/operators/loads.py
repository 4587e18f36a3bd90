"""Writing tables so that a rerun changes nothing."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corridor.operators.setops import except_distinct
from corridor.session import settle

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def replace_table(df: DataFrame, table: str, partition_by: list[str] | None = None) -> DataFrame:
    """Create the table from ``df``, replacing one that exists.

    The new rows are computed beside the old table first; if that or what follows fails, the old rows stay.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        _writer(df, partition_by).saveAsTable(table)
        return spark.table(table)
    return _publish(df, table, partition_by)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    """The columns a table is partitioned by, in order."""
    return [column.name for column in spark.catalog.listColumns(table) if column.isPartition]


def _publish(df: DataFrame, table: str, partition_by: list[str] | None) -> DataFrame:
    """Compute ``df`` in full beside the table, then let it take the table's place.

    A failure at any point leaves the old table's rows. Without partitions the new table takes the old
    one's name. Partitioned tables are not renamed, since a catalog may go on naming partition folders
    from before: partitions are overwritten by one job, which takes effect as a whole, and those that
    are no more are dropped after it. A table whose columns or partitions change is written anew and,
    should that fail, again from a copy of its rows.
    """
    spark = df.sparkSession
    held = partition_columns(spark, table)
    if not held and not partition_by:
        return _take_name(df, table)
    staged = settle(df, "published")
    old = spark.table(table)
    same = [(f.name, f.dataType) for f in old.schema] == [(f.name, f.dataType) for f in staged.schema]
    plain = all(old.schema[name].dataType.simpleString() in ("date", "int", "bigint", "string") for name in held)
    if same and plain and held == partition_by and _own_partitions(spark, table) == held:
        _overwrite_partitions(staged, table)
        _drop_partitions_without_rows(staged, table, held)
        return spark.table(table)
    copy = settle(old, "kept")
    try:
        _writer(staged, partition_by).mode("overwrite").saveAsTable(table)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        _writer(copy, held).mode("overwrite").saveAsTable(table)
        raise
    return spark.table(table)


def _take_name(df: DataFrame, table: str) -> DataFrame:
    """Write ``df`` as an unpartitioned table beside the old one, which it then replaces by renaming."""
    spark = df.sparkSession
    mark = uuid4().hex
    new, old = f"{table}_new_{mark}", f"{table}_old_{mark}"
    _writer(df, None).saveAsTable(new)
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    except Exception:
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        raise
    spark.sql(f"DROP TABLE {old}")
    return spark.table(table)


def _literal(value: str) -> str:
    """A partition's value in SQL."""
    if value == NO_VALUE:
        return "NULL"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _drop_partitions_without_rows(rows: DataFrame, table: str, columns: list[str]) -> None:
    """Drop the table's partitions that ``rows`` has no rows for; both lists are as long as the partitions."""
    spark = rows.sparkSession
    values = rows.select(*(F.coalesce(F.col(c).cast("string"), F.lit(NO_VALUE)) for c in columns)).distinct().collect()
    filled = {tuple(row) for row in values}
    for (shown,) in spark.sql(f"SHOW PARTITIONS {table}").collect():
        parts = [unquote(part.split("=", 1)[1]) for part in shown.split("/")]
        # an empty text is stored as no value
        if tuple(parts) in filled or (NO_VALUE in parts and any("" in row for row in filled)):
            continue
        spec = ", ".join(f"{c}={_literal(v)}" for c, v in zip(columns, parts, strict=True))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def create_if_absent(df: DataFrame, table: str, partition_by: list[str] | None = None) -> DataFrame:
    """Create the table from ``df``; leave one that exists alone."""
    _writer(df, partition_by).mode("ignore").saveAsTable(table)
    return df.sparkSession.table(table)


def _writer(df: DataFrame, partition_by: list[str] | None):
    writer = df.write.format("parquet")
    return writer.partitionBy(*partition_by) if partition_by else writer


def _overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions that ``df`` has rows for, and no others.

    Which partitions an overwrite empties is the session's setting unless the table names its own:
    the setting is made for this write, however the table was created.
    """
    spark = df.sparkSession
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        df.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def _own_partitions(spark: SparkSession, table: str) -> list[str]:
    """The partition columns of a table whose partitions can be overwritten one by one.

    A table declared with the static mode empties all partitions whatever the session says.
    """
    shown = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("lower(data_type) LIKE '%partitionoverwritemode=static%'")
    return [] if shown.limit(1).collect() else partition_columns(spark, table)


def swap_table(df: DataFrame, table: str) -> DataFrame:
    """Replace a table by a result that reads that same table; its partitioning stays."""
    return _publish(df, table, partition_columns(df.sparkSession, table))


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return df.limit(0)


def append_by_position(df: DataFrame, table: str) -> DataFrame:
    """Insert columns in order, whatever their names."""
    df.write.mode("append").insertInto(table)
    return df.sparkSession.table(table)


def append_by_name(df: DataFrame, table: str) -> DataFrame:
    """Insert columns by name; a missing or extra column fails."""
    target = df.sparkSession.table(table)
    if set(df.columns) != set(target.columns):
        raise ValueError(f"columns differ from {table}: {sorted(set(df.columns) ^ set(target.columns))}")
    return append_by_position(df.select(*target.columns), table)


def replace_days(
    df: DataFrame, table: str, days: Iterable[object], column: str = "date", placed: bool = False
) -> DataFrame:
    """Replace the given days of a table; see ``replace_partitions``."""
    return replace_partitions(df, table, [str(day) for day in days], column, placed)


def replace_partitions(
    df: DataFrame, table: str, values: Iterable[object], column: str, placed: bool = False
) -> DataFrame:
    """Replace the rows of the given values of one column, such as days.

    In a table partitioned by ``column`` alone, whoever created it, one job rewrites the partitions
    of every value that has rows, clustered so that a value is a few files, and notes which those
    were. A value without rows ends up empty too: its partition is dropped. Any other table is
    written anew with its other values kept. Rows that already lie in ranges of ``column`` are
    ``placed``: they are sorted, but not shuffled again.
    """
    spark = df.sparkSession
    wanted = sorted({str(value) for value in values})
    target = spark.table(table)
    kind = target.schema[column].dataType
    asked = F.col(column).isin([F.lit(value).cast(kind) for value in wanted])
    rows = df.filter(asked).select(*target.columns)
    if _own_partitions(spark, table) != [column]:
        others = target.filter(~F.coalesce(asked, F.lit(False)))
        return swap_table(others.unionByName(rows), table)
    order = [column, *(c for c in rows.columns if c != column)]
    rows = rows.sortWithinPartitions(*order) if placed else clustered(rows, *order)
    seen = Observation()
    # a set of at most as many values as were asked for
    _overwrite_partitions(rows.observe(seen, F.collect_set(F.col(column).cast("string")).alias("found")), table)
    emptied = sorted(set(wanted) - set(seen.get["found"]))
    if emptied:
        parts = ", ".join(f"PARTITION ({column}={_literal(value)})" for value in emptied)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
    return spark.table(table)


def clustered(df: DataFrame, *columns: str) -> DataFrame:
    """Range-partition and sort by the columns, so files hold narrow key ranges.

    A busy day is cut by the later columns instead of landing in one task.
    """
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """The target after a keyed merge: matched rows take the source's other
    columns, unmatched source rows are added.

    A NULL key matches nothing unless ``null_safe``, so it is added every time.
    A target row matched by two source rows fails the job.
    """
    values = [name for name in target.columns if name not in keys]
    per_key = source.groupBy(*keys).agg(
        F.count("*").alias("_matches"), *(F.any_value(name).alias(f"_new_{name}") for name in values)
    )
    hit = F.col("s._matches").isNotNull()
    twice = F.raise_error(F.lit(f"two source rows match one target row on {keys}")).cast("boolean")
    # a filter of its own: no choice of columns, nor a count, leaves it out
    once = F.when(F.col("s._matches") > 1, twice).otherwise(F.lit(True))

    def fresh(name: str) -> Column:
        return F.when(hit, F.col(f"s._new_{name}")).otherwise(F.col(f"t.{name}")).alias(name)

    # rows with a NULL key cannot match: they pass around the join and its shuffle
    matchable = target if null_safe else target.filter(_no_null(keys))
    updated = (
        matchable.alias("t")
        .join(per_key.alias("s"), _same("t", "s", keys, null_safe), "left")
        .filter(once)
        .select(*(F.col(f"t.{name}") if name in keys else fresh(name) for name in target.columns))
    )
    candidates = source if null_safe else source.filter(_no_null(keys))
    known = target.select(*keys).distinct()
    added = candidates.alias("s").join(known.alias("t"), _same("t", "s", keys, null_safe), "left_anti")
    merged = updated.unionByName(added.select(*target.columns))
    if null_safe:
        return merged
    for loose in (target, source.select(*target.columns)):
        merged = merged.unionByName(loose.filter(~_no_null(keys)))
    return merged


def upsert_into(table: str, source: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """Merge ``source`` into the table.

    If the table is partitioned by one of the keys, only the partitions the source has rows for
    are read, merged and rewritten; else the merged table takes the old one's place.
    """
    spark = source.sparkSession
    target = spark.table(table)
    parts = _own_partitions(spark, table)
    if len(parts) != 1 or parts[0] not in keys:
        return swap_table(upsert(target, source, keys, null_safe), table)
    # as many values as partitions are written
    touched = [row[0] for row in source.select(parts[0]).distinct().collect()]
    if None in touched:
        return swap_table(upsert(target, source, keys, null_safe), table)
    held = target.filter(F.col(parts[0]).isin(touched))
    merged = settle(upsert(held, source, keys, null_safe), "merged")
    spread = clustered(merged, parts[0], *(k for k in keys if k != parts[0]))
    _overwrite_partitions(spread.select(*target.columns), table)
    return spark.table(table)


def _no_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])


def _same(left: str, right: str, keys: list[str], null_safe: bool) -> Column:
    pairs = [(F.col(f"{left}.{key}"), F.col(f"{right}.{key}")) for key in keys]
    tests = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    return reduce(lambda a, b: a & b, tests)


def insert_only_new(target: DataFrame, source: DataFrame) -> DataFrame:
    """The target plus every distinct source row it does not hold."""
    return target.unionByName(except_distinct(source.select(*target.columns), target))


def with_provenance(df: DataFrame) -> DataFrame:
    """Add the file each row came from and the time of loading."""
    return df.withColumn("source_url", F.col("_metadata.file_path")).withColumn(
        "ingestion_ts", F.current_timestamp()
    )


def write_day_tree(df: DataFrame, path: str, column: str = "date") -> None:
    """Parquet under year=/month=/day= folders."""
    parts = {"year": F.year(column), "month": F.month(column), "day": F.dayofmonth(column)}
    tree = df.withColumns(parts)
    # ranges over (day, row hash) keep a busy day from being written by one task
    spread = tree.withColumn("_spread", F.xxhash64(*df.columns)).repartitionByRange(column, "_spread")
    spread.drop("_spread").write.mode("overwrite").partitionBy(*parts).parquet(path)


def not_yet_loaded(manifest: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    """The manifest entries whose key the ledger of loaded files lacks."""
    return manifest.join(ledger.select(*keys).distinct(), keys, "left_anti")
