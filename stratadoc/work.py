"""Intermediate tables in the folder that the driver and all executors share: written, read again, deleted."""

from __future__ import annotations

import atexit
import posixpath
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master, whose driver is its executor, may go
    without: then a temporary folder is made and set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        local = tempfile.mkdtemp(prefix="stratadoc-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        folder = "file://" + local
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    return posixpath.join(work_dir(spark), f"stratadoc-{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written to the shared folder: its lineage is cut, and a lost executor loses none of it."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stratadoc_path = path
    return out


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` written like ``written``, dealt by key over as many buckets as a shuffle has partitions: joins on the key
    then shuffle the other side alone."""
    spark = df.sparkSession
    path, table = fresh_dir(spark, name), f"stratadoc_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, key).write.format("parquet").bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(table)
    out = spark.table(table)
    out._stratadoc_path, out._stratadoc_table = path, table
    return out


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``written`` and ``bucketed`` that nothing still to run reads."""
    for t in tables:
        if hasattr(t, "_stratadoc_table"):
            t.sparkSession.sql(f"DROP TABLE IF EXISTS {t._stratadoc_table}")
        remove(t.sparkSession, t._stratadoc_path)
