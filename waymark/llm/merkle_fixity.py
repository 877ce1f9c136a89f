"""WARC fixity audit with Merkle trees over ordered offset ranges.

Records of a replica are laid out in archive files of a fixed range of page ids,
in order of id and, among rows of one id, of hash; so each has an offset. A leaf
is a distinct record with its length and number of copies. Leaves of one id are
folded by the first digits of their hashes, then by id, so that an id of very
many rows is no large group; each next level hashes a range of FANOUT
neighbours as (offset within the range, length, hash) of each. Offsets start at
zero in each range, so a lost record changes the nodes above it and no others.
Replicas are compared from the root: only children of nodes that differ are read
on, so an audit of sound replicas ends at the root, and a damaged record costs
its path. All hashes are built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

FANOUT = 16
#: Page ids of an archive file; a power of FANOUT.
FILE_IDS = 4096
#: Hash digits by which the records of one id are folded first.
DIGITS = 4

#: Names a node: rows without an id are a tree of their own.
_SLOT = ["no_id", "slot"]


def warc_record(url: str = "url", html: str = "html") -> Column:
    """The bytes of a response record; null parts are empty."""
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(F.col(url), F.lit("")), F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary"))


def leaves(pages: DataFrame) -> DataFrame:
    """no_id, slot (the page id, or 0 without one), digits, hash, length and n (copies) of each distinct record."""
    record = warc_record()
    rows = pages.select(
        F.col("page_id").isNull().alias("no_id"), F.coalesce(F.col("page_id").cast("long"), F.lit(0)).alias("slot"),
        F.sha2(record, 256).alias("hash"), F.octet_length(record).cast("long").alias("length"))
    return rows.groupBy(*_SLOT, F.substring("hash", 1, DIGITS).alias("digits"), "hash", "length").agg(F.count("*").alias("n"))


def tree(records: DataFrame, levels: int) -> DataFrame:
    """Nodes (level, no_id, slot, size, hash); level 0 has a node for each id, and slot is the id without its last `level` digits to the base FANOUT."""
    bins = records.groupBy(*_SLOT, "digits").agg(F.sort_array(F.collect_list(F.struct("hash", "length", "n"))).alias("own"), F.sum(F.col("length") * F.col("n")).alias("size"))
    bins = bins.select(*_SLOT, "digits", "size", F.sha2(F.expr("array_join(transform(own, x -> concat(x.hash, '+', x.length, '*', x.n)), '|')"), 256).alias("hash"))
    slots = bins.groupBy(*_SLOT).agg(F.sort_array(F.collect_list(F.struct("digits", "size", "hash"))).alias("own"), F.sum("size").alias("size"))  # at most FANOUT ** DIGITS
    slots = slots.select(F.lit(0).alias("level"), *_SLOT, "size", F.sha2(F.expr("array_join(transform(own, x -> concat(x.hash, '+', x.size)), '|')"), 256).alias("hash"))
    level = nodes = materialize(slots)
    ranged = "array_join(transform(own, (x, i) -> concat(x.slot, '@', aggregate(slice(own, 1, i), 0L, (a, y) -> a + y.size), '+', x.size, ':', x.hash)), '|')"
    for k in range(1, levels + 1):
        up = level.groupBy("no_id", F.expr(f"cast(floor(slot / {FANOUT}) as bigint)").alias("up")).agg(F.sort_array(F.collect_list(F.struct("slot", "size", "hash"))).alias("own"), F.sum("size").alias("size"))
        level = materialize(up.select(F.lit(k).alias("level"), "no_id", F.col("up").alias("slot"), "size", F.sha2(F.expr(ranged), 256).alias("hash")))
        nodes = nodes.unionByName(level)
    return nodes


def root(nodes: DataFrame, levels: int) -> str:
    """One hash over the top nodes: those of ids from zero on, of negative ids and of rows without one."""
    top = nodes.where(F.col("level") == levels).select(F.struct("no_id", "slot", "size", "hash").alias("x"))
    return top.agg(F.sha2(F.to_json(F.sort_array(F.collect_list("x"))), 256)).first()[0]


def descend(left: DataFrame, right: DataFrame, levels: int) -> DataFrame:
    """Ids (no_id, slot) whose nodes differ, found from the top through mismatching nodes only."""
    suspects = None
    for level in range(levels, -1, -1):
        a, b = (t.where(F.col("level") == level).select(*_SLOT, F.struct("size", "hash").alias(h)) for t, h in ((left, "a"), (right, "b")))
        if suspects is not None:
            up = F.expr(f"cast(floor(slot / {FANOUT}) as bigint)")
            a, b = (t.withColumn("up", up).join(suspects, ["no_id", "up"], "left_semi").drop("up") for t in (a, b))
        apart = materialize(a.join(b, _SLOT, "full_outer").where("not (a <=> b)").select(*_SLOT))
        suspects = apart.select("no_id", F.col("slot").alias("up"))
    return apart


def _with_running_sums(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Adds <column>_before: sums over the records of the id that come earlier by hash. Summed by hash digits first, so no id is one window."""
    bins = rows.groupBy(*_SLOT, "digits").agg(*(F.sum(c).alias(c) for c in columns))
    earlier = Window.partitionBy(*_SLOT).orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)
    base = bins.select(*_SLOT, "digits", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_base") for c in columns))
    own = Window.partitionBy(*_SLOT, "digits").orderBy("hash", "length").rowsBetween(Window.unboundedPreceding, -1)
    out = rows.join(base, [*_SLOT, "digits"])
    return out.select(*rows.columns, *((F.col(f"{c}_base") + F.coalesce(F.sum(c).over(own), F.lit(0))).alias(f"{c}_before") for c in columns))


def _slot_offsets(nodes: DataFrame, bad: DataFrame, name: str) -> DataFrame:
    """Where the records of an id start in their archive file, for the files of bad ids."""
    file = F.expr(f"cast(floor(slot / {FILE_IDS}) as bigint)")
    ids = nodes.where("level = 0").withColumn("file", file).join(bad.select("no_id", file.alias("file")).distinct(), ["no_id", "file"], "left_semi")
    before = Window.partitionBy("no_id", "file").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)  # at most FILE_IDS ids
    return ids.select(*_SLOT, F.coalesce(F.sum("size").over(before), F.lit(0)).alias(name))


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """Records that two replicas of (page_id, url, html) don't share.

    Columns: page_id, copy (place among the rows of the id), file, offset and
    length in the left replica (right for records that only it has), problem:
    changed, missing (from the right) or added. Rows of one id are compared as
    a multiset of records: equal ones are paired first, what is left over on
    both sides is `changed`, in order of hash. Null ids are an id of their own
    in a file of their own (null), apart from every number. Null url or html
    count as empty; records of any length are hashed whole. Empty replicas of
    both sides give no rows; other columns are ignored.
    """
    a, b = materialize(leaves(left)), materialize(leaves(right))
    highest = a.select("slot").union(b.select("slot")).agg(F.max(F.abs("slot"))).first()[0] or 0
    levels = 1
    while FANOUT**levels <= highest + 1:
        levels += 1
    x, y = tree(a, levels), tree(b, levels)
    sound = root(x, levels) == root(y, levels)
    bad = (x.where("false") if sound else descend(x, y, levels)).select(*_SLOT)
    own, key = [*_SLOT, "digits", "hash", "length"], F.coalesce("nl", F.lit(0)) - F.coalesce("nr", F.lit(0))
    both = a.join(bad, _SLOT, "left_semi").withColumnRenamed("n", "nl").join(b.join(bad, _SLOT, "left_semi").withColumnRenamed("n", "nr"), own, "full_outer")
    both = both.select(*own, F.coalesce("nl", F.lit(0)).alias("nl"), F.coalesce("nr", F.lit(0)).alias("nr"), F.greatest(key, F.lit(0)).alias("lost"), F.greatest(-key, F.lit(0)).alias("more"))
    both = both.withColumns({"sl": F.col("nl") * F.col("length"), "sr": F.col("nr") * F.col("length")})
    total = both.groupBy(*_SLOT).agg(F.sum("lost").alias("all_lost"), F.sum("more").alias("all_more"))
    found = _with_running_sums(both, ["nl", "nr", "sl", "sr", "lost", "more"]).where("lost + more > 0").join(total, _SLOT)
    found = found.join(_slot_offsets(x, bad, "at_l"), _SLOT, "left").join(_slot_offsets(y, bad, "at_r"), _SLOT, "left")
    each = found.withColumn("j", F.explode(F.expr("sequence(0L, lost + more - 1)")))  # one row for each surplus copy, the last of its record
    gone, rank = F.col("lost") > 0, F.col("j") + F.when(F.col("lost") > 0, F.col("lost_before")).otherwise(F.col("more_before"))
    each = each.withColumn("problem", F.when(gone & (rank < F.col("all_more")), "changed").when(gone, "missing").when(rank >= F.col("all_lost"), "added")).where("problem is not null")
    k = F.when(gone, F.col("nl") - F.col("lost")).otherwise(F.col("nr") - F.col("more")) + F.col("j")
    return each.select(
        F.when(~F.col("no_id"), F.col("slot")).alias("page_id"), (F.when(gone, F.col("nl_before")).otherwise(F.col("nr_before")) + k).alias("copy"),
        F.when(~F.col("no_id"), F.expr(f"cast(floor(slot / {FILE_IDS}) as bigint)")).alias("file"),
        (F.when(gone, F.col("at_l") + F.col("sl_before")).otherwise(F.col("at_r") + F.col("sr_before")) + k * F.col("length")).alias("offset"), "length", "problem")


def damaged(pages: DataFrame) -> DataFrame:
    """A replica with known damage, by rule: every 997th page altered and every 1499th lost."""
    html = F.when(F.col("page_id") % 997 == 0, F.concat(F.coalesce("html", F.lit("")), F.lit("!"))).otherwise(F.col("html"))
    return pages.withColumn("html", html).where(F.coalesce(F.col("page_id") % 1499 != 1, F.lit(True)))
