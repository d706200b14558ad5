"""The folder that driver and executors share, and tables in it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_work: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset, a temporary one in local mode, and an error on a cluster, whose executors couldn't see it."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="ladderlake-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{_work[-1] if _work else shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet to the shared folder and reread: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that written() made and nothing reads any more."""
    for df in tables:
        delete(df.sparkSession, df._written_to)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[str]:
    """What is written inside goes to a folder that is deleted at the end; results that read it have to be written elsewhere by then."""
    folder = f"{shared_dir(spark)}/work-{uuid.uuid4().hex}"
    _work.append(folder)
    try:
        yield folder
    finally:
        _work.pop()
        delete(spark, folder)


def filesystem(uri: str):
    """(pyarrow file system, path in it) of a folder's URI; works in executors too."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(uri)
