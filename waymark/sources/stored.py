"""Stored node and edge tables: a folder for each source, rows of a key in one bucket.

A write replaces the folders of the sources it brings and no others, so resetting
one source leaves the files of the rest as they are. Rows lie in buckets by key,
the same in all tables of one layout, so keyed joins of stored tables need no
shuffle of the stored side.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators.records import same_key, upsert
from waymark.sources.shared import discard, materialize, shared_dir

_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


class StoredTable:
    """A table partitioned by source and bucketed by its key, under a name of the session's catalogue and a path of its own."""

    def __init__(self, spark: SparkSession, name: str, key: tuple[str, ...], source: str = "source", buckets: int = 8, path: str | None = None) -> None:
        if not re.fullmatch(r"\w+", name):
            raise ValueError(f"{name} is no table name")
        self.spark, self.name, self.key, self.source, self.buckets = spark, name, key, source, buckets
        self.path = path or shared_dir(spark)

    def create(self, rows: DataFrame) -> StoredTable:
        """Write the rows as the whole table. Rows of a bucket are brought together first, so each has one file in each source."""
        dealt = rows.repartition(self.buckets, *self.key)
        dealt.write.mode("overwrite").partitionBy(self.source).bucketBy(self.buckets, *self.key).sortBy(*self.key).option("path", self.path).saveAsTable(self.name)
        return self

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def _replace(self, rows: DataFrame) -> None:
        """Write rows over the folders of the sources they have; other folders stay. Rows that come from the table must have been written elsewhere before."""
        dealt = rows.select(self.rows().columns).repartition(self.buckets, *self.key)
        before = self.spark.conf.get(_OVERWRITE)
        self.spark.conf.set(_OVERWRITE, "dynamic")
        try:
            dealt.write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(_OVERWRITE, before)

    def reset(self, source: str) -> None:
        """Delete one source's rows: its folder alone goes."""
        here = [r.partition for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()]  # a row for each source
        if f"{self.source}={source}" in here:
            self.spark.sql(f"ALTER TABLE {self.name} DROP PARTITION ({self.source} = '{source.replace(chr(39), chr(39) * 2)}')")
            fs_path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{self.source}={source}")
            fs_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(fs_path, True)

    def upsert(self, rows: DataFrame) -> None:
        """Refresh and add rows within the sources that they have: given values replace, nulls keep what is there. Only those folders are read and written."""
        new = materialize(rows)
        touched = new.select(self.source).distinct()
        held = self.rows().join(F.broadcast(touched), self.source, "left_semi")  # a row for each source
        merged = materialize(upsert(held, new, self.source, *self.key))
        self._replace(merged)
        discard(merged)
        discard(new)

    def present(self, rows: DataFrame) -> DataFrame:
        """The rows whose key is there already; the stored side is read in its buckets. Absent parts of a key are values too: such rows, few, are joined apart."""
        held = self.rows().select(*(F.col(k).alias(f"_h_{k}") for k in self.key))
        lacks = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in self.key))
        held_lacks = reduce(lambda a, b: a | b, (F.col(f"_h_{k}").isNull() for k in self.key))
        solid = rows.where(~lacks).repartition(self.buckets, *self.key)
        equal = reduce(lambda a, b: a & b, (solid[k] == held[f"_h_{k}"] for k in self.key))
        loose, held_loose = rows.where(lacks), held.where(held_lacks)
        return solid.join(held.hint("merge"), equal, "left_semi").union(loose.join(held_loose, same_key(loose, held_loose, self.key, "_h_"), "left_semi"))
