"""Session settings and lineage cutting."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def build_session(app: str = "sitelode", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the jobs in this package are written for."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Small shuffles keep enough partitions for work that is heavy per row; big ones are unaffected.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.checkpoint.compress", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    session = builder.getOrCreate()
    ship_package(session)
    return session


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application.

    The jobs that run Python need it wherever their tasks run; Spark distributes the archive.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        str(Path(tempfile.mkdtemp(prefix="sitelode-")) / package.name), "zip", package.parent, package.name
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach for checkpoints and scratch tables.

    It is whatever ``spark.checkpoint.dir`` names. Only a local master, where
    every task sees the driver's disk, falls back to a temporary folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="sitelode-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for one written table."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store_columns(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back by column, so readers take only what they need."""
    place = scratch_path(df.sparkSession, name)
    df.write.parquet(place)
    return df.sparkSession.read.parquet(place)


def store_clustered(df: DataFrame, keys: str | list[str], location: str, buckets: int | None = None) -> DataFrame:
    """Write ``df`` in buckets of ``keys``, ordered inside them, and read it back; joins on just these then leave it where it lies.

    Where ``df`` is already placed by the keys nothing is shuffled. There is one bucket per shuffle partition unless told
    otherwise, and one file per bucket and task that holds some of it.
    """
    spark = df.sparkSession
    keys = [keys] if isinstance(keys, str) else keys
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"clustered_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{location}/rows").saveAsTable(name)
    # Written last: a table without its layout was not finished.
    spark.createDataFrame([(",".join(keys), buckets)], "keys string, buckets int").write.parquet(f"{location}/layout")
    return spark.table(name)


def read_clustered(spark: SparkSession, location: str) -> DataFrame:
    """A table that :func:`store_clustered` wrote, also in another session."""
    keys, buckets = spark.read.parquet(f"{location}/layout").first()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{location}/rows").schema)
    name = f"clustered_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{location}/rows'"
    )
    return spark.table(name)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so later steps neither recompute it nor lose it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
