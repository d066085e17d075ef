"""Tables kept between jobs in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or where that is unset and Spark runs in one process, as in tests, a local folder."""
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not where:
        where = sc.getCheckpointDir()
    if not where:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="tickweave-")
        sc.setCheckpointDir(where)
    return where


#: Rows of a file where a table's number of rows is known.
FILE_ROWS = 1_000_000


def materialize(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back.

    What follows starts from these files, so a lost executor costs only the tasks that it ran. rows: about
    how many df has, if that is known; it then has no more files than they need.
    """
    if rows is not None:
        df = df.coalesce(rows // FILE_ROWS + 1)
    path = f"{shared_dir(df.sparkSession)}/tickweave-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
