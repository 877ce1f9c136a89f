"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.sources.shared import discard, materialize, shared_dir  # noqa: F401  the operators take them from here

#: Rows and bytes of an Arrow batch handed to a Python worker, about: texts can be long, so bytes count.
BATCH_ROWS, BATCH_BYTES = 20_000, "4m"

#: Texts of white space, ASCII and Latin letters only, and the letters and digits among those characters.
PLAIN = "[\t-\r -~\u00a1-\u017f]*"
LETTERS, DIGITS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"

#: Stands for a null document id inside joins: such rows sort after every real id.
NULL_ID = (1 << 63) - 1


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of Python stages planned from now on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, lengthened where the table already has a column of that name."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty), did (null id: last) and th, which tells rows of one id apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("did"),
        F.xxhash64(text).alias("th"),
        text.alias("text"),
    )


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without nulls, and its offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def batches_of(columns: dict[str, np.ndarray | list], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if len(next(iter(columns.values()))):
        yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
