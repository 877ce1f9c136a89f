r"""Benchmark decontamination by spaced-seed hashing, with built-in SQL functions only.

A seed is the hash of the tokens at the positions that a fixed mask keeps, so a
substituted token at an ignored position does not change it. Seeds of documents
and benchmark items are joined on their hash (the mask's number is hashed too),
hits are counted for each diagonal (place in the text minus place in the item),
and diagonals with enough of them are compared token by token: each stretch
around their hits is judged by itself, extended both ways as far as its share
of equal tokens allows.

The masks lose nothing: dynamic programming over all patterns of equal and other
tokens shows that 12 equal tokens or more that are 70 % of their stretch hold at
least MIN_HITS seeds of the two masks, both of which ignore positions. Diagonals
with fewer, nearly all chance hits, need no comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NULL_ID, discard, free_names, materialize

#: Kept positions of each mask: every stretch with MIN_EQUAL and MIN_SHARE holds one of them.
SEEDS = ("1101", "10011")
#: Equal tokens that an overlap needs, and their least share of the stretch. A shorter item must be there whole.
MIN_EQUAL = 12
MIN_SHARE = 0.7
#: Seeds that every overlap holds, at least (the least over all patterns of equal and other tokens).
MIN_HITS = 4
#: The mask of items that are shorter than the others; used only where there are such items, and for them alone.
SHORT = "111"
#: Tokens of an item, at least: one or two words are no evidence of a benchmark.
MIN_ITEM = 3
#: Most benchmark seeds (two longs and an int each) that are broadcast; beyond it the join shuffles.
BROADCAST_SEEDS = 500_000
#: Most keys of texts (two longs each) that are broadcast, so that the texts stay where they are; beyond it they shuffle once.
BROADCAST_KEYS = 500_000


def _tokens(text: str) -> Column:
    return F.expr(rf"filter(split(lower(coalesce({text}, '')), '[^\\p{{L}}\\p{{N}}]+'), x -> x <> '')")


def _row_keys() -> tuple[Column, Column]:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), F.xxhash64(F.coalesce("text", F.lit("")))


def _keys(rows: DataFrame, *key: str) -> DataFrame:
    """The distinct keys of rows, written, with a hint to broadcast them if they are few."""
    keys = materialize(rows.select(*key).distinct())
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def _seeds(k: int, mask: str) -> str:
    args = ", ".join(f"_h[i + {at}]" for at, bit in enumerate(mask) if bit == "1")
    last = len(mask) - 1
    return f"case when size(_h) > {last} then transform(sequence(0, size(_h) - {last + 1}), i -> xxhash64({k}, {args})) else array() end"


def seeds(rows: DataFrame, masks: tuple[str, ...] = SEEDS) -> DataFrame:
    """rows with tokens `_w`: one row for each mask and place, as h and pos, beside the other columns.

    Tokens are hashed once; the seeds of all masks are one array, so that a text is read and split once.
    """
    keep = [c for c in rows.columns if c != "_w"]
    # the array holds the seeds of one mask after the other: where each mask's begin
    starts = ["0"]
    for mask in masks[:-1]:
        starts.append(f"{starts[-1]} + greatest(size(_h) - {len(mask) - 1}, 0)")
    every = rows.withColumn("_h", F.expr("transform(_w, x -> xxhash64(x))")).selectExpr(*keep, f"array({', '.join(starts)}) as _s", f"posexplode(concat({', '.join(_seeds(k, m) for k, m in enumerate(masks))})) as (_at, h)")
    place = "_at"
    for k in range(1, len(masks)):
        place = f"if(_at >= _s[{k}], _at - _s[{k}], {place})"
    return every.selectExpr(*keep, "h", f"{place} as pos")


def passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every stretch of a document and an item with MIN_EQUAL equal tokens at MIN_SHARE, without insertions.

    Columns: doc_id, rid (tells rows of one id apart), item_id, start_word and
    item_word (tokens from 0), n_words, n_equal, share. For each end, the stretch
    that holds enough equal tokens with the most above its share; of those with
    one start, the longest. Items of MIN_ITEM to MIN_EQUAL - 1 tokens are found
    where they stand whole and unchanged; shorter ones never.

    Null and empty texts have no tokens; texts of any length are used whole.
    Rows that repeat doc_id and text give their stretches once. Items are told
    apart by item_id and tokens; null item_ids and doc_ids are kept. Empty tables
    give no rows; other columns of both tables are ignored.
    """
    did, rid = _row_keys()
    text = docs.select(did.alias("did"), rid.alias("rid"), "text")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), _tokens("text").alias("_i")).distinct()
    items = items.where(F.size("_i") >= MIN_ITEM).withColumns({"iid": F.xxhash64(F.coalesce("item_id", F.lit(NULL_ID)), "_i"), "need": F.least(F.lit(MIN_EQUAL), F.size("_i"))})
    items = materialize(items)
    least = min(map(len, SEEDS))
    whole = " + ".join(f"greatest(size(_i) - {len(m) - 1}, 0)" for m in SEEDS)  # seeds of an item that stands whole
    long = items.where(F.size("_i") >= least).select("iid", F.expr(f"least({MIN_HITS}, {whole})").alias("hits"), F.col("_i").alias("_w"))
    known, masks = seeds(long), SEEDS
    brief = items.where(F.size("_i") < least)
    if not brief.isEmpty():
        masks = (*SEEDS, SHORT)
        known = known.unionByName(seeds(brief.select("iid", F.lit(1).alias("hits"), F.col("_i").alias("_w")), masks))
    known = materialize(known.withColumnRenamed("pos", "item_pos"))
    if known.count() <= BROADCAST_SEEDS:
        known = F.broadcast(known)
    hits = seeds(text.select("did", "rid", _tokens("text").alias("_w")), masks).join(known, "h")
    shift = (F.col("pos") - F.col("item_pos")).alias("shift")
    found = hits.groupBy("did", "rid", "iid", shift).agg(F.count("*").alias("n"), F.max("hits").alias("hits")).where("n >= hits").select("did", "rid", "iid", "shift")
    found = materialize(found)
    # Only texts with a diagonal to compare are read and split again.
    again = materialize(text.join(_keys(found, "did", "rid"), ["did", "rid"], "left_semi").dropDuplicates(["did", "rid"]))
    both = found.join(again.select("did", "rid", _tokens("text").alias("_w")), ["did", "rid"]).join(items, "iid")
    equal = F.expr("transform(sequence(greatest(0, -shift), least(size(_i), size(_w) - shift) - 1), k -> get(_w, k + shift) = _i[k])")
    key = ["did", "rid", "iid", "shift"]
    both = both.select(*key, "item_id", "need", F.expr("greatest(0, -shift)").alias("from"), equal.alias("eq")).withColumn("n", F.size(F.filter("eq", lambda x: x)).cast("long"))
    both = materialize(both.where("n >= need"))
    discard(again)
    short = both.where(F.col("need") < MIN_EQUAL).selectExpr(*key, "item_id", "0 as lo", "need as hi", "n", "`from`")
    # One row for each place between tokens; the row at place k holds what is counted before it.
    rows = both.where(F.col("need") == MIN_EQUAL).selectExpr(*key, "item_id", "`from`", "posexplode(concat(array(false), eq)) as (at, same)")
    so_far = Window.partitionBy(*key).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("at") == 0, 0).otherwise(F.when(F.col("same"), 10).otherwise(0) - int(10 * MIN_SHARE))
    rows = rows.withColumns({"score": F.sum(step).over(so_far), "n": F.sum(F.col("same").cast("long")).over(so_far)})
    enough = Window.partitionBy(*key).orderBy("n").rangeBetween(Window.unboundedPreceding, -MIN_EQUAL)
    ends = rows.withColumn("lo", F.min(F.struct("score", "at", "n")).over(enough)).where("same and score >= lo.score")
    ends = ends.groupBy(*key, "item_id", "from", "lo").agg(F.max(F.struct("at", "n")).alias("hi"))
    long = ends.selectExpr(*key, "item_id", "lo.at as lo", "hi.at as hi", "hi.n - lo.n as n", "`from`")
    out = long.unionByName(short).select(
        F.nullif("did", F.lit(NULL_ID)).alias("doc_id"), "rid", "item_id", F.expr("cast(`from` + lo + shift as bigint)").alias("start_word"),
        F.expr("cast(`from` + lo as bigint)").alias("item_word"), F.expr("cast(hi - lo as bigint)").alias("n_words"), F.col("n").alias("n_equal"))
    return out.withColumn("share", F.col("n_equal") / F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of documents without a passage of an item, with all their columns, whatever their names.

    Rows that repeat doc_id and text share the decision. Null and empty texts,
    null ids, long texts and empty tables are as in `passages`.
    """
    d, r = free_names(docs, "did", "rid")
    bad = _keys(passages(docs, benchmark).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias(d), F.col("rid").alias(r)), d, r)
    did, rid = _row_keys()
    return docs.withColumns({d: did, r: rid}).join(bad, [d, r], "left_anti").select(*docs.columns)
