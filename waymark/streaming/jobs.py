"""Structured Streaming forms of the census, load, progress and tally jobs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators.records import Refused, middle_values


def file_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def census(stream: DataFrame) -> DataFrame:
    """Totals by type over what has been read so far."""
    return stream.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))


def run_to_end(df: DataFrame, path: str, checkpoint: str, mode: str) -> None:
    """Read everything there is, write the result and stop; a later run goes on from the checkpoint."""
    def keep(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(path)

    df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()


def committed(stream: DataFrame, path: str, checkpoint: str, partial) -> None:
    """Run to the end and keep a partial result of each batch under its number: a batch that is replayed replaces its own, nothing else is written again."""
    def keep(batch: DataFrame, epoch: int) -> None:
        partial(batch).write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()


def resumable_census(stream: DataFrame, path: str, checkpoint: str, plan: int) -> None:
    """Keep the counts by type and file of what arrives, for `census_totals`; a later run goes on from the checkpoint.

    A checkpoint made under another plan is refused: two plans are two populations.
    """
    spark = stream.sparkSession
    about = f"{checkpoint}-plan"
    try:
        known = spark.read.schema("plan int").parquet(about).first()
    except AnalysisException:
        known = None
    if known is None:
        spark.createDataFrame([(plan,)], "plan int").write.parquet(about)
    elif known.plan != plan:
        raise Refused(f"the checkpoint covers a plan of {known.plan} files, this run {plan}: start again rather than blend them")
    committed(stream.withColumn("file", F.input_file_name()), path, checkpoint, lambda b: b.groupBy("event_type", "file").agg(F.count("*").alias("n")))


def census_totals(spark: SparkSession, path: str, plan: int, population: int) -> DataFrame:
    """event_type and n over the files read so far, with how many those are, of the plan and of the population.

    planned: whether the plan is done. complete: whether the whole population has
    been read; a plan that is shorter never makes it complete.
    """
    counts = spark.read.schema("event_type string, file string, n long, batch long").parquet(path)
    read = counts.agg(F.count_distinct("file").cast("int").alias("files_read"))  # one row
    out = counts.groupBy("event_type").agg(F.sum("n").alias("n")).crossJoin(F.broadcast(read))
    return out.select("event_type", "n", "files_read", F.lit(plan).alias("files_planned"), F.lit(population).alias("population"), (F.col("files_read") >= plan).alias("planned"), (F.col("files_read") >= population).alias("complete"))


def insert_stream(stream: DataFrame, path: str, checkpoint: str, *key: str) -> None:
    """Append the first row of each key to a table that this job alone writes; a null in a key is a value.

    Keys that have come are state of the stream, held by key, so no batch reads
    the table; a batch that is replayed replaces its own rows.
    """
    committed(stream.dropDuplicates(list(key)), path, checkpoint, lambda b: b)


def progress(stream: DataFrame, every: str = "60 seconds", late: str = "10 minutes") -> DataFrame:
    """Rows and running value in fixed windows; rows later than the watermark are dropped."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", every)).agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("window.start").alias("start"), "n", "value")


def progress_to_end(stream: DataFrame, path: str, checkpoint: str, every: str = "60 seconds") -> None:
    """Rows and value by window of each batch, in one pass, for `progress_totals`: late rows add to their window, and no window stays open."""
    committed(stream, path, checkpoint, lambda b: b.groupBy(F.window("ts", every)).agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("window.start").alias("start"), "n", "value"))


def progress_totals(spark: SparkSession, path: str) -> DataFrame:
    kept = spark.read.schema("start timestamp, n long, value double, batch long").parquet(path)
    return kept.groupBy("start").agg(F.sum("n").alias("n"), F.sum("value").alias("value"))


def durations_to_end(stream: DataFrame, path: str, checkpoint: str) -> None:
    """How often each duration came, by type, of each batch, for `tally_totals`."""
    committed(stream, path, checkpoint, lambda b: b.groupBy("event_type", "value").agg(F.count("*").alias("n")))


def tally_totals(spark: SparkSession, path: str) -> DataFrame:
    """Runs, longest and the exact median (1 dp) by type over all batches."""
    kept = spark.read.schema("event_type string, value double, n long, batch long").parquet(path)
    runs = kept.groupBy("event_type").agg(F.sum("n").alias("runs"), F.max("value").alias("longest"))
    mid = middle_values(kept, "value", "event_type", times="n").select("event_type", F.bround((F.col("lower") + F.col("upper")) / 2, 1).alias("median"))
    return runs.join(mid.withColumnRenamed("event_type", "type"), F.col("event_type").eqNullSafe(F.col("type")), "left").select("event_type", "runs", "longest", "median")
