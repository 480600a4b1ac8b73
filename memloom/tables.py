"""Tables in the folder that the driver and all executors share, and names that are free."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share (spark.checkpoint.dir).

    A folder of our own is set only where the session has none and all of it is
    one process, as in tests; a cluster without the setting is an error, since
    its machines don't see each other's folders.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None:
        known = spark.sparkContext.getCheckpointDir()
        if known is None:
            master = spark.sparkContext.master
            if master != "local" and not master.startswith("local["):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="memloom-"))
            known = spark.sparkContext.getCheckpointDir()
        path = known
    return path.rstrip("/")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """df as a table in the shared folder: later reads survive lost executors."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, name: str) -> None:
    """Deletes a file or folder of any file system that Spark reaches."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Deletes the files of tables that `written` made and nothing reads any more."""
    for df in tables:
        for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
            delete(df.sparkSession, name)


def free_name(name: str, *frames: DataFrame) -> str:
    """name, or name with as many underscores as it takes to be none of the frames' columns."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name
