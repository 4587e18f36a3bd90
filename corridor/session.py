"""Session defaults and the shared folder where intermediate tables live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_fallback: list[str] = []


def local_session(app: str, cpus: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is used only for a local master without that setting.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if not _local_fallback:
        _local_fallback.append(tempfile.mkdtemp(prefix="corridor-"))
    return _local_fallback[0]


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has written to yet.

    All paths of one application share a folder named after it, so that they
    can be removed together once its results are no longer read.
    """
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/corridor/{application}/{uuid.uuid4().hex}/{name}"


def new_database(spark: SparkSession) -> str:
    """A fresh database whose managed tables live in the shared folder."""
    name = f"corridor_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_path(spark, 'db')}'")
    return name


def settle(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Everything downstream then reads a table: its lineage is cut, a lost
    executor re-reads files, and Spark knows its true size, so the automatic
    broadcast threshold decides about broadcasting from a measured value.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
