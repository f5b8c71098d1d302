"""Helpers that the corpus operators share: scratch tables, input selection, small constants."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: ASCII white space: space and U+0009 to U+000D. Everything else belongs to a word.
WS_CLASS = r"[\x20\x09-\x0D]"
WS_RUN = WS_CLASS + "+"


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``; one of our own only where that is unset and
    the master is local."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="linkspan-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    if jvm is None:
        return
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Tables written to the shared folder. They cut lineage and survive lost executors. Owners drop tables
    that they have done with (``drop``, ``keep``); the rest, on which results still rest, goes at exit."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self._at_exit)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        schema = df.schema
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            delete_path(self.spark, f"{self.root}/{name}")

    def keep(self, *names: str) -> None:
        """Drops all tables but those named."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for status in fs.listStatus(root):
            if status.getPath().getName() not in names:
                fs.delete(status.getPath(), True)

    def _at_exit(self) -> None:
        try:
            delete_path(self.spark, self.root)
        except Exception:  # the session may be gone at exit
            pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(taken: list[str], name: str = "__text") -> str:
    """A column name that isn't taken; case doesn't count."""
    lower = {c.lower() for c in taken}
    while name in lower:
        name += "_"
    return name


def words(text: Column) -> Column:
    """Words of a text: the maximal runs of anything but ASCII white space; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WS_RUN), "")


def smallest(rows: DataFrame, group: str, by: str, most: int) -> DataFrame:
    """Of each ``group`` the ``most`` rows of smallest unsigned hash of ``by``, whose values differ within a group.

    No group is gathered in one task: counts by the leading bits of the hash tell the bits where the group's last row
    lies, and only rows with just these bits are ranked."""
    hashed = rows.withColumn("__hash", F.xxhash64(by)).withColumn("__top", F.shiftrightunsigned(F.col("__hash"), 56))
    counts = hashed.groupBy(F.col(group).alias("__group"), F.col("__top").alias("__at")).agg(F.count(F.lit(1)).alias("__m"))
    before = W.partitionBy("__group").orderBy("__at").rowsBetween(W.unboundedPreceding, -1)  # 256 rows of a group at most
    counts = counts.withColumn("__before", F.coalesce(F.sum("__m").over(before), F.lit(0)))
    last = counts.where(F.col("__before") < most).groupBy("__group").agg(F.max(F.struct("__at", "__before")).alias("__last"))
    near = hashed.join(last, F.col(group) == F.col("__group")).where(F.col("__top") <= F.col("__last.__at"))
    inside = near.where(F.col("__top") < F.col("__last.__at")).select(*rows.columns)
    order = W.partitionBy("__group").orderBy("__hash", by)
    edge = near.where(F.col("__top") == F.col("__last.__at")).withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= most - F.col("__last.__before"))
    return inside.unionByName(edge.select(*rows.columns))
