"""Writing results. Connection data always comes from the caller."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

JDBC_REQUIRED = ("url", "dbtable")

# Whether Spark removes the shuffle files of a query once the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Tables staged in each ``released_after`` that is open, the innermost last.
_staging: list[list[DataFrame]] = []


def jdbc_options(**options: str) -> dict[str, str]:
    """Checked options for the JDBC writer."""
    missing = [name for name in JDBC_REQUIRED if not options.get(name)]
    if missing:
        raise ValueError(f"JDBC options missing: {', '.join(missing)}")
    return {name: str(value) for name, value in options.items() if value is not None}


def write_jdbc(df: DataFrame, mode: str = "append", **options: str) -> None:
    """Append to, or overwrite, a database table."""
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be 'append' or 'overwrite'")
    df.write.format("jdbc").mode(mode).options(**jdbc_options(**options)).save()


def write_partitions(
    df: DataFrame,
    path: str,
    files: int | None = None,
    by: str = "time",
    compression: str = "gzip",
    mode: str = "overwrite",
) -> None:
    """Write Parquet partitioned by date. Overwriting replaces only the dates written.

    ``files`` sets over how many files each date is spread, by a hash of the row: a date
    holding most of the rows does not end up in one task, and no task writes every date.
    """
    rows = df
    if files is not None:
        spot = F.pmod(F.xxhash64(*[c for c in df.columns if c != by]), F.lit(files))
        rows = df.repartition(F.col(by), spot)
    with shuffles_removed(df.sparkSession):
        (
            rows.write.mode(mode)
            .option("compression", compression)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(by)
            .parquet(path)
        )


def has_partition(spark: SparkSession, path: str, day, by: str = "time") -> bool:
    """Whether a table partitioned by date has a folder for the date."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{by}={day}")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def write_bucketed(
    df: DataFrame, name: str, path: str, buckets: int, keys: list[str], by: str = "time"
) -> DataFrame:
    """Write a catalog table partitioned by date and, within a date, bucketed and sorted by keys.
    Windows, groups and joins by the keys (and more columns) then start without a shuffle. Rows
    are dealt to the buckets once, so a date has one file per bucket."""
    (
        df.repartition(buckets, *keys)
        .write.format("parquet")
        .option("path", path)
        .mode("overwrite")
        .partitionBy(by)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def write_checked(df: DataFrame, path: str, reason: str = "reject_reason") -> tuple[DataFrame, DataFrame, dict]:
    """Write rows once, those with a reason to reject them apart from the others, and read both
    parts back: accepted rows, rejected rows, and how many rows were read, accepted and rejected
    (counted while they were written)."""
    seen = Observation()
    counted = df.observe(
        seen,
        F.count(F.lit(1)).alias("read"),
        F.count_if(F.col(reason).isNull()).alias("accepted"),
        F.count_if(F.col(reason).isNotNull()).alias("rejected"),
    )
    rejected = F.col(reason).isNotNull().alias("is_rejected")
    counted.select("*", rejected).write.partitionBy("is_rejected").parquet(path)
    back = df.sparkSession.read.schema(
        df.schema.add("is_rejected", "boolean")
    ).parquet(path)
    parts = [back.where(F.col("is_rejected") == flag).drop("is_rejected") for flag in (False, True)]
    return parts[0], parts[1], seen.get


def write_report(df: DataFrame, path: str) -> None:
    """Write a report table as one CSV file with a header. For results that are small by
    nature, such as one row per probe or city."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``. Only a session whose
    executors run on the driver's machine may leave it unset, and then uses its warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_footfall"
    return folder.rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """The same rows, written once to the shared folder and read back.

    For a result that a plan uses several times. Unlike a cache it outlives executors, and
    unlike a checkpoint its readers still prune columns and know its size. The files stay
    until ``release``, or until the folder is cleared.
    """
    path = f"{shared_folder(df.sparkSession)}/footfall-{uuid4().hex}"
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.staged_at = path
    if _staging:
        _staging[-1].append(back)
    return back


@contextmanager
def released_after() -> Iterator[None]:
    """Tables staged inside are removed at the end, for work whose outcome is written by then."""
    _staging.append([])
    try:
        yield
    finally:
        release(*_staging.pop())


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each table written inside are removed when it is written. Otherwise
    they stay until the driver's memory is next cleaned up, and those of all steps of a job add up
    on the executors' disks."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def release(*tables: DataFrame) -> None:
    """Remove the files of staged tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
