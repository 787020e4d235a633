"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Characters that separate words everywhere in this subpackage (space and \t \n \v \f \r).
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only in local mode where the session names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="retailflow-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


#: Tables in the shared folder, in the order in which they were begun.
_begun: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _begun.append(path)
    return path


def written(df: DataFrame, name: str, codec: str = "snappy") -> tuple[DataFrame, str]:
    """df as a table in the shared folder, and its path: lost executors do not lose it, and it can be read in parts."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """df, computed once and kept as a table of the shared folder."""
    return written(df, name)[0]


def tables_begun() -> list[str]:
    """Paths of the tables that are not discarded yet."""
    return [*_begun]


def discard(spark: SparkSession, *paths: str) -> None:
    """Removes tables of the shared folder that nothing reads any more."""
    for path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        if path in _begun:
            _begun.remove(path)


def begun() -> int:
    """A mark for discard_since."""
    return len(_begun)


def discard_since(spark: SparkSession, mark: int, *keep: str) -> None:
    """Removes the tables begun since the mark, but for those to keep: for when the result they made is written."""
    discard(spark, *[p for p in _begun[mark:] if p not in keep])
