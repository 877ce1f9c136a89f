"""Keyed writes, reconciliation and refusals over tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.sources.shared import materialize


class Refused(ValueError):
    """A load or measurement that must not go on."""


# ---- writes


def same_key(a: DataFrame, b: DataFrame, key: tuple[str, ...], prefix: str) -> Column:
    """Equal keys, nulls being equal to each other; b's columns carry a prefix."""
    return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[f"{prefix}{k}"]) for k in key))


def prefixed(df: DataFrame, prefix: str, *columns: str) -> DataFrame:
    return df.select(*(F.col(c).alias(f"{prefix}{c}") for c in columns))


def upsert(old: DataFrame, new: DataFrame, *key: str) -> DataFrame:
    """Rows of old refreshed by new: given values replace, nulls keep what is there, absent rows are added. A null in a key is a value like others."""
    rest = [c for c in old.columns if c not in key]
    renamed = prefixed(new, "_n_", *key, *(c for c in rest if c in new.columns))
    joined = old.join(renamed, same_key(old, renamed, key, "_n_"), "full_outer")
    return joined.select(*(F.coalesce(k, f"_n_{k}").alias(k) for k in key), *(F.coalesce(F.col(f"_n_{c}"), F.col(c)).alias(c) if f"_n_{c}" in joined.columns else F.col(c) for c in rest))


def insert_absent(existing: DataFrame, new: DataFrame, *key: str) -> DataFrame:
    """The rows of new to append: one for each key that is not there yet. A key with all columns makes properties part of identity; an absent one is a value too."""
    once, held = new.dropDuplicates(list(key)), prefixed(existing, "_h_", *key)
    return once.join(held, same_key(once, held, key, "_h_"), "left_anti")


def write_counts(existing: DataFrame, new: DataFrame, kind: str, *key: str) -> DataFrame:
    """kind, looked_up, created, already_present of an insert."""
    keys = new.select(*key).distinct()
    held = prefixed(existing, "_h_", *key).distinct().withColumn("_there", F.lit(1))
    there = keys.join(held, same_key(keys, held, key, "_h_"), "left")
    return there.agg(F.count("*").alias("looked_up"), F.count_if(F.col("_there").isNull()).alias("created"), F.count("_there").alias("already_present")).select(F.lit(kind).alias("kind"), "*")


def reset_scope(table: DataFrame, column: str, value: str) -> DataFrame:
    """The table without the rows of one source; rows without a source stay."""
    return table.where(F.coalesce(F.col(column) != value, F.lit(True)))


def first_wins(df: DataFrame, order: str, *key: str) -> DataFrame:
    """The first row of each key in source order, ties by the other columns: a grouped minimum, so keys of many rows shrink before they move."""
    rest = [order, *(c for c in df.columns if c not in key and c != order)]
    first = df.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_r"))
    return first.select(*key, *(F.col(f"_r.{c}").alias(c) for c in rest)).select(*df.columns)


def append_metrics(metrics: DataFrame, path: str, stamp: str) -> None:
    """Append figures with the run's stamp, which figures cannot set."""
    metrics.drop("stamp").withColumn("stamp", F.lit(stamp)).write.mode("append").parquet(path)


def went_empty(before: DataFrame, now: DataFrame, *key: str, value: str = "value") -> DataFrame:
    """Keys that had a figure above zero and now have none."""
    return before.where(F.col(value) > 0).select(*key).join(now.where(F.col(value) > 0).select(*key), list(key), "left_anti")


def replace_record(before: DataFrame, now: DataFrame, path: str, *key: str, value: str = "value") -> None:
    """Write the new record unless something found before has gone empty."""
    lost = went_empty(before, now, *key, value=value).limit(5).collect()
    if lost:
        raise Refused(f"found before and empty now: {[tuple(r) for r in lost]}")
    now.write.mode("overwrite").parquet(path)


# ---- measures of a table


def digest(df: DataFrame):
    """A row's digest over its columns in name order."""
    return F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)


def slice_integrity(df: DataFrame, reported: int) -> DataFrame:
    """rows, rows_unique and what is wrong: empty, count, repeated, or null."""
    c = df.agg(F.count("*").alias("rows"), F.count_distinct(digest(df)).alias("rows_unique"))
    return c.withColumn("problem", F.when(F.col("rows") == 0, "empty").when(F.col("rows") != reported, "count").when(F.col("rows_unique") != F.col("rows"), "repeated"))


def key_fitness(df: DataFrame, *columns: str) -> DataFrame:
    """For each column as a key: present, absent, distinct, collides, shared values, usable."""
    long = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns))).alias("x")).select("x.*")
    counts = long.groupBy("field", "value").agg(F.count("*").alias("n"))
    real = F.col("value").isNotNull()
    out = counts.groupBy("field").agg(
        F.coalesce(F.sum(F.when(real, F.col("n"))), F.lit(0)).alias("present"), F.coalesce(F.sum(F.when(~real, F.col("n"))), F.lit(0)).alias("absent"),
        F.count("value").alias("distinct_values"), F.count_if(real & (F.col("n") > 1)).alias("shared_values"))
    return out.withColumn("collides", F.col("present") - F.col("distinct_values")).withColumn("usable", (F.col("absent") == 0) & (F.col("collides") == 0))


def key_collisions(df: DataFrame, key: list[str], extra: str, amount: str) -> DataFrame:
    """What a key without `extra` loses: keys with and without it, merged groups, groups whose merge loses an amount, and the amount lost."""
    six = df.groupBy(*key, extra).agg(F.sum(amount).alias("a"))
    five = six.groupBy(*key).agg(F.count("*").alias("n"), F.count_if(F.col("a") > 0).alias("positive"), (F.sum("a") - F.max("a")).alias("lost"))
    return five.agg(F.sum("n").alias("long_keys"), F.count("*").alias("short_keys"), F.count_if(F.col("n") > 1).alias("merged"), F.count_if(F.col("positive") > 1).alias("losing"), F.sum("lost").alias("amount_lost"))


def spread(df: DataFrame, *key: str) -> DataFrame:
    """rows_per_key, n_keys: how many keys have how many rows."""
    return df.groupBy(*key).agg(F.count("*").alias("rows_per_key")).groupBy("rows_per_key").agg(F.count("*").alias("n_keys"))


def reconcile(expected: DataFrame, held: DataFrame, key: str = "kind") -> DataFrame:
    """kind, expected, held, gap and verdict (surplus, shortfall or agrees) of two (kind, n) tables."""
    both = expected.select(key, F.col("n").alias("expected")).join(held.select(key, F.col("n").alias("held")), key, "full_outer").fillna(0, ["expected", "held"])
    gap = F.col("held") - F.col("expected")
    return both.withColumn("gap", gap).withColumn("verdict", F.when(gap > 0, "surplus").when(gap < 0, "shortfall").otherwise("agrees"))


def read_back(before: DataFrame, created: DataFrame, held: DataFrame, key: str = "kind") -> DataFrame:
    """Rows held against those before plus those created."""
    n = lambda d, name: d.select(key, F.col("n").alias(name))
    all3 = n(before, "before").join(n(created, "created"), key, "full_outer").join(n(held, "held"), key, "full_outer").fillna(0)
    return all3.withColumn("gap", F.col("held") - F.col("before") - F.col("created"))


def present_counts(df: DataFrame, *columns: str) -> DataFrame:
    """field, present: values of each column."""
    return df.agg(*(F.count(c).alias(c) for c in columns)).unpivot([], list(columns), "field", "present")


def invalid_counts(df: DataFrame, **tests) -> DataFrame:
    """field, invalid: rows that fail the test of each field (a Column that is true for valid values)."""
    return df.agg(*(F.count_if(~F.coalesce(t, F.lit(False))).alias(f) for f, t in tests.items())).unpivot([], list(tests), "field", "invalid")


def refuse_invalid(df: DataFrame, **tests) -> None:
    """Refuse before the first write if any written field has a value that can't be written."""
    bad = [(r.field, r.invalid) for r in invalid_counts(df, **tests).where("invalid > 0").collect()]
    if bad:
        raise Refused(f"values that can't be written: {bad}")


def keyed_otherwise(table: DataFrame, new: DataFrame, key: str, sample: int = 25) -> DataFrame:
    """One row, rekeyed: the table has rows and none of the sampled new keys."""
    ids = new.select(key).orderBy(key).limit(sample)
    there = table.join(F.broadcast(ids), key, "left_semi").agg(F.count("*").alias("hits"))  # at most `sample` ids
    return table.agg(F.count("*").alias("rows")).crossJoin(there).select(((F.col("rows") > 0) & (F.col("hits") == 0)).alias("rekeyed"))


def refuse_empty(df: DataFrame, what: str) -> DataFrame:
    """The table, unless it is empty: nothing can be measured against nothing."""
    if df.isEmpty():
        raise Refused(f"{what} is empty")
    return df


def drifted(changed: int, total: int) -> bool:
    """Markup drift that must stop a load: more than ten pages and more than a tenth of them."""
    return changed > 10 and changed * 10 > total


def code_overlap(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """both, only_left, only_right over distinct codes."""
    a, b = (d.select(column).distinct().withColumn(n, F.lit(1)) for d, n in ((left, "a"), (right, "b")))
    return a.join(b, column, "full_outer").agg(F.count_if(F.expr("a = 1 and b = 1")).alias("both"), F.count_if(F.col("b").isNull()).alias("only_left"), F.count_if(F.col("a").isNull()).alias("only_right"))


def carry_forward(df: DataFrame, value, order: str, *by: str) -> DataFrame:
    """As-of: the last value that is not null at or before each row in its group, as `carried`."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("carried", F.last(value, ignorenulls=True).over(w))


def carry_over_ranges(df: DataFrame, value, order: str, size: int = 100_000) -> DataFrame:
    """As `carry_forward` over one sequence of whole numbers: last values go over ranges of `size` first, then within each, so no task holds all rows."""
    rows = df.withColumns({"_value": value, "_range": F.floor(F.col(order) / size)})
    last = rows.where("_value is not null").groupBy("_range").agg(F.max_by("_value", order).alias("_last"))
    ranges = rows.select("_range").distinct().join(last, "_range", "left")  # a row for each range
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = ranges.select("_range", F.last("_last", ignorenulls=True).over(before).alias("_base"))
    here = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(base, "_range").withColumn("carried", F.coalesce(F.last("_value", ignorenulls=True).over(here), "_base"))
    return out.select(*df.columns, "carried")


def ranked(df: DataFrame, *order: str) -> DataFrame:
    """Adds rank, from 0 in the given order: within ranges that are sorted apart, behind the rows of the ranges before."""
    ranges = materialize(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    counts = ranges.groupBy("_range").agg(F.count("*").alias("n"))  # a row for each range
    base = counts.select("_range", (F.sum("n").over(Window.orderBy("_range")) - F.col("n")).alias("_base"))
    here = Window.partitionBy("_range").orderBy(*order)
    return ranges.join(base, "_range").select(*df.columns, (F.col("_base") + F.row_number().over(here) - 1).alias("rank"))


def middle_values(df: DataFrame, value: str, *by: str, few: int = 4096, times: str | None = None) -> DataFrame:
    """by, n, lower and upper: the two middle values of each group, equal if n is odd. Nulls don't count. times: a column with how often each row counts.

    A KLL sketch of each group gives values below and above the middle for
    certain, as the counts of what lies below and between them tell; only values
    between are sorted, each once with its count. Bounds that don't hold the
    middle, or hold more than `few` values, are sought again between the old ones,
    so no outlier and no common value makes a group large.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("v")).agg((F.sum(times) if times else F.count("*")).alias("k"))
    values = materialize(counted)
    keys = list(by) or ["_all"]
    values = values if by else values.withColumn("_all", F.lit(0))
    total = values.groupBy(*keys).agg(F.sum("k").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.lit(0).cast("long").alias("below"))
    open_, found = materialize(total), None
    for _ in range(200):
        # what is still between the bounds, and how much lies below it; n and below count rows
        inside = on_keys(values, open_, keys).where("v >= lo and v <= hi")
        size = inside.groupBy(*keys).agg(F.count("*").alias("size"))
        near = materialize(open_.join(size, keys))
        small = near.where(F.col("size") <= few).select(*keys, "n", "lo", "hi", "below")
        own = on_keys(values, small, keys).where("v >= lo and v <= hi")
        upto = F.sum("k").over(Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, -1))  # at most `few` rows of a group
        placed = own.withColumn("base", F.col("below") + F.coalesce(upto, F.lit(0)))
        is_lower, is_upper = (F.expr(f"base <= {r} and {r} < base + k") for r in ("(n - 1) div 2", "n div 2"))
        done = placed.groupBy(*keys).agg(F.first("n").alias("n"), F.max(F.when(is_lower, F.col("v"))).alias("lower"), F.max(F.when(is_upper, F.col("v"))).alias("upper"))
        found = materialize(done) if found is None else found.unionByName(materialize(done))
        wide = near.where(F.col("size") > few).select(*keys, "n", "lo", "hi", "below")
        if wide.isEmpty():
            return found.select(*by, "n", "lower", "upper")
        # the distinct values in between, in sixteenths by a sketch; the sixteenths that hold the middle stay
        rows = on_keys(values, wide, keys).where("v >= lo and v <= hi")
        cuts = rows.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col("v").cast("double")).alias("s")).select(*keys, F.array(*(F.kll_sketch_get_quantile_double("s", F.lit(i / 16)) for i in range(1, 16))).alias("cuts"))
        part = F.size(F.filter("cuts", lambda c: c < F.col("v")))
        parts = on_keys(rows.drop("cuts"), cuts, keys).groupBy(*keys, "n", "below", part.alias("part")).agg(F.sum("k").alias("k"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        w = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # at most 16 rows of a group
        parts = parts.withColumn("base", F.col("below") + F.coalesce(F.sum("k").over(w), F.lit(0)))
        kept = parts.where(is_lower | is_upper).groupBy(*keys, "n").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("base").alias("below"))
        open_ = materialize(kept)
    raise RuntimeError("middle values were not found")


def on_keys(rows: DataFrame, per_key: DataFrame, keys: list[str]) -> DataFrame:
    """rows with the columns of a table of one row for each key; null keys are keys too."""
    p = per_key.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    return rows.join(p, same_key(rows, p, tuple(keys), "_k_")).drop(*(f"_k_{k}" for k in keys))


def census(spark: SparkSession, tables: dict[str, DataFrame | None], code: str) -> DataFrame:
    """name, rows, has_<code> and status of tables: read, empty, or missing (None) with null rows."""
    out = spark.createDataFrame([(n, None, None, "missing") for n, df in tables.items() if df is None], f"name string, rows long, has_{code} boolean, status string")
    for name, df in tables.items():
        if df is not None:
            own = df.agg(F.count("*").alias("rows"))
            out = out.union(own.select(F.lit(name), "rows", F.lit(any(code in c for c in df.columns)), F.when(F.col("rows") == 0, "empty").otherwise("read")))
    return out


def answers_emptily(answer: DataFrame) -> DataFrame:
    """One row, empty: the answer has no rows, or a single one whose values are all null or zero."""
    blank = F.lit(True)
    for c in answer.columns:
        blank = blank & (F.col(c).isNull() | F.coalesce(F.col(c).cast("string").isin("0", "0.0"), F.lit(False)))
    n = answer.agg(F.count("*").alias("n"), F.coalesce(F.bool_and(blank), F.lit(True)).alias("blank"))
    return n.select(((F.col("n") == 0) | ((F.col("n") == 1) & F.col("blank"))).alias("empty"))


def fold_rows(rows: DataFrame) -> DataFrame:
    """Pathway rows (pathway_id, course_id, section, credits, pos) to one edge for each pair.

    Sections are the distinct ones that are not empty, as first seen, joined by " | ".
    """
    real = rows.where(F.coalesce(F.col("section"), F.lit("")) != "")
    firsts = real.groupBy("pathway_id", "course_id", "section").agg(F.min("pos").alias("at"))
    named = firsts.groupBy("pathway_id", "course_id").agg(F.sort_array(F.collect_list(F.struct("at", "section"))).alias("s"))
    named = named.select("pathway_id", "course_id", F.array_join(F.col("s.section"), " | ").alias("section"), F.size("s").alias("sections"))
    folded = rows.groupBy("pathway_id", "course_id").agg(F.count("*").alias("n_rows"), F.min_by("credits", "pos").alias("credits"), F.count_distinct("credits").alias("n_credits"))
    joined = folded.join(named, ["pathway_id", "course_id"], "left")
    return joined.select("pathway_id", "course_id", "section", F.coalesce("sections", F.lit(0)).alias("sections"), "n_rows", "credits", (F.col("n_credits") > 1).alias("conflict"))


