"""Streaming jobs (R1 to R4), each run to the end of the events table as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.operators import records as rec
from waymark.plans.registry import query
from waymark.sources.shared import materialize, shared_dir
from waymark.streaming import jobs


def _arrive(t, parts: int = 4):
    """The events as files that arrive one after the other, in time order."""
    path = shared_dir(t.spark)
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    dealt = materialize(events.repartitionByRange(parts, "ts").withColumn("part", F.spark_partition_id()))
    for k in range(parts):
        dealt.where(F.col("part") == k).drop("part").coalesce(1).write.mode("append").parquet(path)
    return jobs.file_stream(t.spark, path, events.schema), shared_dir(t.spark)


_HALF = "FROM (SELECT event_type, ntile(8) OVER (ORDER BY event_id) AS f FROM events) WHERE f <= 4 GROUP BY event_type"


@query("R1_resumable_census", f"""SELECT event_type, count(*) AS n, 8 AS files_read, 8 AS files_planned, 8 AS population, TRUE AS planned, TRUE AS complete FROM events GROUP BY event_type
  UNION ALL SELECT concat('half: ', event_type), count(*), 4, 8, 8, FALSE, FALSE {_HALF} UNION ALL SELECT concat('short: ', event_type), count(*), 4, 4, 8, TRUE, FALSE {_HALF}""")
def r1(t):
    """A census of eight files in two runs: after four files it is not complete, and the second run goes on from there. A plan of four of the eight is done and still not complete."""
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    parts = rec.ranked(events, "event_id")
    n = events.count()
    # the first n % 8 files have a row more, as ntile deals them
    big, more = n // 8 + 1, n % 8
    file = F.when(F.col("rank") < big * more, F.floor(F.col("rank") / big)).otherwise(more + F.floor((F.col("rank") - big * more) / max(1, n // 8)))
    parts = materialize(parts.withColumn("file", file))
    path, place = shared_dir(t.spark), shared_dir(t.spark)

    def arrive(lo: int, hi: int) -> None:
        for f in range(lo, hi):
            parts.where(F.col("file") == f).drop("rank", "file").coalesce(1).write.option("maxRecordsPerFile", 0).parquet(f"{path}/{f}")

    def run(name: str, plan: int) -> DataFrame:
        stream = jobs.file_stream(t.spark, f"{path}/*", events.schema)
        jobs.resumable_census(stream, f"{place}/{name}", f"{place}/{name}-checkpoint", plan)
        return jobs.census_totals(t.spark, f"{place}/{name}", plan, 8)

    arrive(0, 4)
    half, short = (materialize(run(name, plan).withColumn("event_type", F.concat(F.lit(f"{label}: "), "event_type"))) for name, plan, label in (("out", 8, "half"), ("short", 4, "short")))
    arrive(4, 8)
    return run("out", 8).union(half).union(short)


@query("R2_idempotent_inserts", "SELECT count(*) + 1 AS n, count(DISTINCT event_id) AS ids, 1 AS null_keys FROM events")
def r2(t):
    """The events and a row without a key, in two runs; then all of it arrives again, and a third run creates nothing."""
    path, place = shared_dir(t.spark), shared_dir(t.spark)
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    every = events.union(events.orderBy("event_id").limit(1).withColumn("event_id", F.lit(None).cast("long")).select(events.columns))

    def arrive_and_run(rows: DataFrame) -> None:
        rows.repartition(2).write.mode("append").parquet(path)
        jobs.insert_stream(jobs.file_stream(t.spark, path, events.schema), f"{place}/out", f"{place}/checkpoint", "event_id")

    arrive_and_run(every.where("event_id % 2 = 0"))
    arrive_and_run(every.where("event_id is null or event_id % 2 <> 0"))
    arrive_and_run(every)
    held = t.spark.read.schema(events.schema).parquet(f"{place}/out")
    return held.agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"), F.count_if(F.col("event_id").isNull()).cast("int").alias("null_keys"))


@query("R3_progress", """WITH m AS (SELECT date_trunc('minute', ts) AS start, count(*) AS n, round(sum(value), 6) AS value FROM events GROUP BY 1) SELECT start, n, value FROM m""")
def r3(t):
    """Rows of each minute, from the partial results of the batches."""
    stream, place = _arrive(t)
    jobs.progress_to_end(stream, f"{place}/out", f"{place}/checkpoint", "1 minute")
    return jobs.progress_totals(t.spark, f"{place}/out").select("start", "n", F.round("value", 6).alias("value"))


@query("R4_run_tally", "SELECT event_type, count(*) AS runs, max(value) AS longest, round_even(median(value), 1) AS median FROM events GROUP BY event_type")
def r4(t):
    """Runs by type as they arrive: durations are counted by value and batch, so that the median of all is exact."""
    stream, place = _arrive(t)
    jobs.durations_to_end(stream, f"{place}/out", f"{place}/checkpoint")
    return jobs.tally_totals(t.spark, f"{place}/out")
