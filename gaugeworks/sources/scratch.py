"""Written intermediate tables in the shared folder the cluster names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    ``spark.checkpoint.dir`` of the session, else the folder given to
    ``setCheckpointDir``.  Only a local master, where driver and executors are
    one process, may go without: there it is a folder of the warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("intermediate tables need a shared folder: set spark.checkpoint.dir")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{scratch_folder(spark)}/gaugeworks/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once and read it back: later steps neither recompute it nor depend on executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the files of a table made by ``written`` that no plan reads any more."""
    spark = df.sparkSession
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        if "/gaugeworks/" not in folder:
            raise ValueError(f"not an intermediate table: {folder}")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
