"""Session settings for local runs, and the shared folder used by jobs that cut lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def local_session(cores: str = "8", name: str = "campaignry") -> SparkSession:
    """A session for tests and the bench. On a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # call-site capture per column
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is missing, a folder below the warehouse takes its place in a session of one process; on a
    cluster that folder might lie on the driver's machine alone, so the job stops.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for written tables below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, each finished query gives its shuffle files back at once, not when the driver next collects garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder and read back.

    They survive the loss of any executor, later readers load only the columns they use, and Spark
    knows their size when it picks a join. The shuffle files behind them go.
    """
    path = scratch_path(df.sparkSession, "cut")
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(spark: SparkSession, path: str) -> None:
    """Gives back a table written below the shared folder, once nothing reads it any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def local_frame(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A short driver-side list as a local relation, whose size Spark knows when it picks a join."""
    schema = StructType.fromDDL(ddl)
    fields = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    table = pa.table([pa.array(c, type=f.type) for c, f in zip(columns, fields)], schema=fields)
    return spark.createDataFrame(table, schema)
