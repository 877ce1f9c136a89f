"""Samples of a growing count, each at least a gap of time after the one before, and the rates between them.

The first row is a sample; the next is the first row at least a gap later, and so
on; the last row closes the curve. Which rows are samples depends on all before,
but only through one value: the last sample. So time is cut into ranges; a task
finds, for every row that could be the first sample of its range, where the chain
of samples leaves the range. These jumps are doubled and followed from the start,
which gives each range its first sample, and the ranges list their samples.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.sources.shared import discard, materialize

#: Distinct times of a range, about.
RANGE = 1 << 16


def _exits(gap: int, width: int):
    schema = pa.schema([("t", pa.int64()), ("leaves", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        t, own = table.column("t").to_numpy(), table.column("own").to_numpy()
        here, ahead = np.sort(t[own]), np.sort(t[~own])
        if not len(here):
            return schema.empty_table()
        beyond = table.column("beyond").combine_chunks().drop_null()
        beyond = beyond[0].as_py() if len(beyond) else -1
        after = np.searchsorted(here, here + gap)
        far = np.searchsorted(ahead, here + gap)
        leaves = np.where(far < len(ahead), np.append(ahead, 0)[np.minimum(far, len(ahead))], beyond)
        for i in range(len(here) - 1, -1, -1):
            if after[i] < len(here):
                leaves[i] = leaves[after[i]]
        start = here[0] - here[0] % width
        first = (here < start + gap) | (np.arange(len(here)) == 0) | (np.arange(len(here)) == np.searchsorted(here, start + gap))
        return pa.table({"t": here[first], "leaves": pa.array(leaves[first], mask=leaves[first] < 0)}, schema=schema)

    return run


def _listed(gap: int):
    schema = pa.schema([("range", pa.int64()), ("t", pa.int64()), ("upto", pa.int64()), ("place", pa.int64()), ("last", pa.bool_())])

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("t").to_numpy())
        t, upto = table.column("t").to_numpy()[order], np.cumsum(table.column("k").to_numpy()[order])
        at = int(np.searchsorted(t, table.column("entry")[0].as_py()))
        found = []
        while at < len(t):
            found.append(at)
            at = int(np.searchsorted(t, t[at] + gap))
        n = len(found)
        return pa.table({"range": table.column("range").slice(0, 1).to_pylist() * n, "t": t[found], "upto": upto[found], "place": np.arange(n), "last": np.arange(n) == n - 1}, schema=schema)

    return run


def gap_samples(df: DataFrame, ts: Column, gap_seconds: int, size: int = RANGE) -> DataFrame:
    """at (timestamp), total (rows so far) and rate (rows a second since the sample before; null for the first and where no time passed). Rows without a time don't count."""
    gap = gap_seconds * 1_000_000
    times = materialize(df.select(F.unix_micros(ts).alias("us")).where("us is not null").groupBy("us").agg(F.count("*").alias("k")))
    lo, hi, n, rows = times.agg(F.min("us"), F.max("us"), F.count("*"), F.sum("k")).first()
    if lo is None:
        return df.select(F.lit(None).cast("timestamp").alias("at"), F.lit(0).cast("long").alias("total"), F.lit(0.0).alias("rate")).limit(0)
    width = max(2 * gap, -(-(hi - lo + 1) * size // n))
    t = times.select((F.col("us") - lo).alias("t"), "k").withColumn("range", F.floor(F.col("t") / width))
    near = F.pmod("t", F.lit(width)) < gap
    ranges = t.groupBy("range").agg(F.min("t").alias("first"), F.min(F.when(~near, F.col("t"))).alias("after"), F.sum("k").alias("k"))
    order = Window.orderBy("range")  # a row for each range
    lead = lambda c, k=1: F.lead(c, k).over(order)
    beyond = F.when(lead("range") == F.col("range") + 1, F.coalesce(lead("after"), lead("first", 2))).otherwise(lead("first"))
    about = materialize(ranges.select("range", beyond.alias("beyond"), (F.sum("k").over(order) - F.col("k")).alias("base")))
    own = t.join(about, "range").select("range", "t", "beyond", F.lit(True).alias("own"))
    ahead = t.where(near & (F.col("range") > 0)).select(F.col("range") - 1, "t", F.lit(None).cast("long"), F.lit(False))
    jumps = materialize(own.union(ahead).groupBy("range").applyInArrow(_exits(gap, width), "t long, leaves long").where("leaves is not null"))
    entries = materialize(df.sparkSession.createDataFrame([(0,)], "t long"))
    while not jumps.isEmpty():
        entries = materialize(entries.union(entries.join(jumps, "t").select(F.col("leaves").alias("t"))).distinct())
        twice = jumps.join(jumps.select(F.col("t").alias("leaves"), F.col("leaves").alias("further")), "leaves").select("t", F.col("further").alias("leaves"))
        jumps, old = materialize(twice), jumps
        discard(old)
    start = entries.groupBy(F.floor(F.col("t") / width).alias("range")).agg(F.min("t").alias("entry"))
    found = t.join(start, "range").groupBy("range").applyInArrow(_listed(gap), "range long, t long, upto long, place long, last boolean")
    found = materialize(found.join(about, "range").select("range", "t", "place", "last", (F.col("base") + F.col("upto")).alias("total")))
    closing = hi - lo
    if found.where(F.col("t") == closing).isEmpty():
        end = found.agg(F.max("range").alias("range")).select((F.col("range") + 1).alias("range"), F.lit(closing).alias("t"), F.lit(0).cast("long").alias("place"), F.lit(True).alias("last"), F.lit(rows).cast("long").alias("total"))
        found = found.union(end)
    # the sample before: in the same range, or the last of the range before that has one
    ends = found.where("last").select("range", F.struct("t", "total").alias("end"))
    before = ends.select("range", F.lag("end").over(order).alias("end"))  # a row for each range
    here = F.lag(F.struct("t", "total")).over(Window.partitionBy("range").orderBy("place"))
    out = found.join(before, "range").withColumn("prev", F.coalesce(here, "end"))
    passed = F.nullif(F.col("t") - F.col("prev.t"), F.lit(0)) / 1e6
    return out.select(F.timestamp_micros(F.col("t") + lo).alias("at"), "total", ((F.col("total") - F.col("prev.total")) / passed).alias("rate"))
