"""Reading captures and writing results."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CRAWL_REQUESTS, RESPONSES
from ..session import cut_lineage

def read_table(spark: SparkSession, location: str) -> DataFrame:
    """A parquet table as it is stored; ``spark.sql.files.*`` sets the width of the scan."""
    return spark.read.parquet(location)


def read_responses(spark: SparkSession, location: str, format: str = "parquet") -> DataFrame:
    """Captured responses as a batch table, with a declared schema."""
    return spark.read.schema(RESPONSES).format(format).load(location)


def read_requests(spark: SparkSession, location: str, format: str = "json") -> DataFrame:
    return spark.read.schema(CRAWL_REQUESTS).format(format).load(location)


def stream_responses(spark: SparkSession, location: str, format: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """The same captures as a stream of arriving files."""
    return (
        spark.readStream.schema(RESPONSES).format(format).option("maxFilesPerTrigger", files_per_batch).load(location)
    )


def _committed(spark: SparkSession, location: str) -> dict[int, str | None]:
    """The folder that holds each bucket now, by the last commit that named it; null for a bucket without rows.

    One row per bucket comes to the driver, and there are as many as the table was given.
    """
    try:
        commits = spark.read.parquet(f"{location}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r.bucket: r.last.version for r in commits.groupBy("bucket").agg(F.max(F.struct("number", "version")).alias("last")).collect()}


def read_stored(spark: SparkSession, location: str) -> DataFrame:
    """What the commits of a stored table name, and nothing of a write that was not committed."""
    held = {bucket: version for bucket, version in _committed(spark, location).items() if version}
    paths = [f"{location}/versions/{version}/bucket={bucket}" for bucket, version in held.items()]
    if not paths:
        return spark.createDataFrame([], spark.read.parquet(f"{location}/commits").select("columns").first()[0])
    return spark.read.parquet(*paths)


def _replace_crawls(rows: DataFrame, location: str, crawls: DataFrame | None, buckets: int) -> None:
    """Write ``rows`` over what the table holds of ``crawls``, all of theirs if not given; other crawls stay.

    The table has a folder for each bucket of crawls, not for each crawl. Buckets that get rows or
    lose some are written anew into a version of their own, and one small file then names the version of each; it appears at once.
    A write that dies before that leaves the table as it was, and a rerun gives the same rows. One job writes a
    table at a time. Rebalancing splits a hot crawl by size.
    """
    spark = rows.sparkSession
    bucket = F.pmod(F.xxhash64("crawl_id"), F.lit(buckets)).cast("int").alias("bucket")
    placed = rows.withColumn("bucket", bucket)
    replaced = cut_lineage((rows if crawls is None else crawls).select("crawl_id", bucket).distinct())
    touched = {r.bucket for r in replaced.select("bucket").distinct().collect()}
    held = _committed(spark, location)
    old = [f"{location}/versions/{held[b]}/bucket={b}" for b in touched if held.get(b)]
    if old:
        stays = spark.read.schema(rows.schema).parquet(*old).join(replaced.select("crawl_id"), "crawl_id", "left_anti")
        placed = placed.unionByName(stays.withColumn("bucket", bucket))
    version = uuid.uuid4().hex
    place = f"{location}/versions/{version}"
    placed.hint("rebalance", "bucket").sortWithinPartitions("bucket", "crawl_id").write.partitionBy("bucket").parquet(place)
    written = {r.bucket for r in spark.read.schema(placed.schema).parquet(place).select("bucket").distinct().collect()}
    folders = {b: version if b in written else None for b in touched}
    if folders or not held:
        _commit(spark, location, folders or {-1: None}, rows.schema.simpleString())


def _commit(spark: SparkSession, location: str, folders: dict[int, str | None], columns: str) -> None:
    """Make the versions of some buckets count, by one file."""
    try:
        number = spark.read.parquet(f"{location}/commits").agg(F.max("number")).first()[0] + 1
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        number = 0
    rows = [(number, b, v, columns) for b, v in folders.items()]
    spark.createDataFrame(rows, "number bigint, bucket int, version string, columns string").coalesce(1).write.mode("append").parquet(f"{location}/commits")


def write_pages(pages: DataFrame, location: str, crawls: DataFrame | None = None, buckets: int = 256) -> None:
    """Page table by bucket of crawls; pages that the table holds of the same crawls are replaced.

    Give ``crawls`` (``crawl_id``) to replace also those that have no page any more.
    """
    columns = ("crawl_id", "page_no", "source_url", "title", "description", "content")
    _replace_crawls(pages.select(*columns), location, crawls, buckets)


def write_progress(progress: DataFrame, location: str, crawls: DataFrame | None = None, buckets: int = 256) -> None:
    """Messages or summaries by bucket of crawls; those of the same crawls are replaced."""
    _replace_crawls(progress, location, crawls, buckets)
