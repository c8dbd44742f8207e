"""What several operators of this subpackage share."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def shuffle_parts(spark: SparkSession) -> int:
    """Partitions of a shuffle in this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a session whose executors run on the driver's
    machine may leave it unset, and then uses its warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return folder.rstrip("/")


class Scratch:
    """Tables written to the shared folder between the steps of one operator.

    A written table survives lost executors, and a step that reads it sees the same rows however
    often it runs. ``drop`` removes the ones that no later step and no result reads.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/llm-{uuid4().hex}"
        self.paths: dict[int, str] = {}

    def write(self, df: DataFrame) -> DataFrame:
        """The rows of ``df``, written once and read back."""
        path = f"{self.root}/{len(self.paths)}"
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = path
        self._alive = [*getattr(self, "_alive", []), back]  # ids stay unique
        return back

    def write_buckets(self, df: DataFrame, buckets: int, by: str) -> DataFrame:
        """The rows of ``df``, written once in ``buckets`` files' worth of buckets by the hash of a
        column and read back. Joins and groups by that column over as many partitions do not
        shuffle them again. The catalog knows the table only while it is written."""
        path, name = f"{self.root}/{len(self.paths)}", f"bucketed_{uuid4().hex}"
        writer = df.write.format("parquet").option("path", path).bucketBy(buckets, by)
        writer.saveAsTable(name)
        back = self.spark.table(name)
        back.schema  # resolved now: the files stay when the name goes
        self.spark.sql(f"DROP TABLE {name}")
        self.paths[id(back)] = path
        self._alive = [*getattr(self, "_alive", []), back]
        return back

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables that nothing reads any more."""
        for df in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths[id(df)])
            conf = self.spark._jsc.hadoopConfiguration()
            path.getFileSystem(conf).delete(path, True)


def semi_join_listed(
    rows: DataFrame, keys: DataFrame, on: str, most: int = 500_000
) -> DataFrame:
    """Rows whose ``on`` is among ``keys`` (distinct long values, already written to a table).

    Up to ``most`` keys, counted from the written table's footers, are broadcast (8 bytes each);
    a longer list is joined by a shuffle.
    """
    listed = F.broadcast(keys) if keys.count() <= most else keys
    return rows.join(listed, on, "left_semi")


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A hash of a row's identifier and whole text, by which steps know the row."""
    return F.xxhash64(F.col(f"`{id_col}`"), whole_text(f"`{text_col}`"))


def without_keys(docs: DataFrame, gone: DataFrame, most: int = 500_000) -> DataFrame:
    """Rows of ``docs`` whose ``row_key`` is not in ``gone`` (key, already written to a table).

    Up to ``most`` keys, counted from the written table's footers, are broadcast (8 bytes each);
    a longer list is joined by a shuffle. The row is nested meanwhile, so no column can clash.
    """
    listed = F.broadcast(gone) if gone.count() <= most else gone
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key().alias("key")
    )
    return keyed.join(listed, "key", "left_anti").select("row.*")
