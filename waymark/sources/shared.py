"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings while a table is written. A table that is broadcast passes through the driver, and loops write many:
#: only small ones are, by their compressed size, so that the driver's share does not grow with the input. The driver
#: keeps the printed plan of a thousand queries, so those of written steps are cut.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "64k", "spark.sql.maxPlanStringLength": "8k"}


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]):
    """The session with other settings, put back at the end."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset and all tasks run here, as in tests, below a folder of this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "local")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="waymark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/waymark-{uuid.uuid4().hex}"


def materialize(df: DataFrame, by: str | None = None, broadcast: bool = True) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives a lost executor.

    Spark deletes the shuffle files of the write as soon as it is over, and joins
    in it broadcast nothing large unless told to. by: a column whose values get
    folders of their own, which can be discarded alone. broadcast: whether small
    tables are; in a long loop whose tables are small at first even these add up.
    """
    spark = df.sparkSession
    path = shared_dir(spark)
    with _set(spark, _WRITING if broadcast else _WRITING | {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(by) if by else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path).select(df.columns)
    out.waymark_path = path
    return out


def is_empty(df: DataFrame) -> bool:
    """Whether a query of written tables has no row, with joins that broadcast no more than those of a written step."""
    with _set(df.sparkSession, _WRITING):
        return df.isEmpty()


def discard(df: DataFrame, folder: str = "") -> None:
    """Delete a table of materialize(), or a folder of it, that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{df.waymark_path}/{folder}".rstrip("/"))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of pages, or of what pages are made of, that one task takes.
PAGES = 5_000


def dealt(df: DataFrame, *by: str, like: DataFrame | None = None, rows: int = PAGES) -> DataFrame:
    """df dealt by its key over a task for each so many rows. like: a table of as many rows, if it is easier to count.

    For work that is long, or wide, for each row of a small table: by bytes alone
    its rows would be put together in one task.
    """
    n = (df if like is None else like).count()
    return df.repartition(max(1, -(-n // rows)), *by)
