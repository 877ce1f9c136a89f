"""Near copies: SimHash trees first, then exact Jaccard similarity of word shingles.

Two texts are linked when the Jaccard similarity of their sets of five-word
shingles is 0.8 or more. Each set has a SimHash fingerprint; equal fingerprints,
and those that the vantage-point trees bring together, are compared exactly, and
what is similar is linked. That finds copies and closest pairs. A pair at 0.8
differs by up to a quarter of the bits, where no tree can prune, so the others
come from prefix filtering: under any one order of all shingles, similar sets
share one of their first n - ceil(0.8 n) + 1 shingles. The order is by frequency
over all texts, as a table of 2^22 counters tells it (a shingle counts with those
that share its counter), then by hash, so that common passages come last. Within
a shared shingle all texts are first paired with two of them; only shingles whose
texts are still in several components then pair the rest. There a pair is formed at the first shingle that
it shares, if its sizes, the places of that shingle and the parities of both sets
leave room for enough more. No link is missed: the counters only order shingles,
the bounds are those of the sets, and every comparison is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, discard, free_names, materialize, small_batches
from .components import connected_components
from .simhash_vptree import hamming_links, majority

SHINGLE = 5
SEED = 42
#: Counters of the order of shingles (a power of two; the table sent to tasks has a byte for each), and how many of them are summed together.
COUNTERS, SPAN = 1 << 22, 1 << 12
#: Tasks whose counters are summed in one group.
FAN = 128
#: Longs of a set's parities, and shared shingles before its own that a row of a shingle names.
WORDS, BEFORE = 8, 16


#: Whether two sets of na and nb can be similar if their prefixes share c. Of the set whose prefix ends first in the
#: common order, all that is shared up to there is in both prefixes, and beyond it stand only ceil(0.8 n) - 1 shingles.
_ENOUGH = "9L * (c + greatest((4 * na + 4) div 5, (4 * nb + 4) div 5) - 1) >= 4L * (na + nb) and 5L * least(na, nb) >= 4L * greatest(na, nb)"

#: Whether two sets can be similar if the first shingle that they share is the i-th of each (from 0): all that they share
#: is there or later, and all parities that differ stand for a shingle of only one of them.
_ROOM = "5L * least(na, nb) >= 4L * greatest(na, nb) and 9L * least(na - ia, nb - ib) >= 4L * (na + nb)"
_PARITY = "9L * (" + " + ".join(f"bit_count(pa[{k}] ^ pb[{k}])" for k in range(WORDS)) + ") <= na + nb"


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; one of all its words if they are fewer than SHINGLE."""
    words = text.lower().split()
    flat, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        return np.array([digest(flat, SEED)] if words else [], np.uint64).view(np.int64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    found = [digest(flat[a:b], SEED) for a, b in zip(starts[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist())]
    return np.unique(np.array(found, np.uint64).view(np.int64))


def parities(own: np.ndarray) -> list[int]:
    """WORDS longs of bits, each telling whether an odd number of the shingles have its number."""
    odd = np.bincount((own >> 32) & (64 * WORDS - 1), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64).tolist()


def node(*more: Column, text: str = "text") -> Column:
    """A hash of a text, seeded by what stands before it; null texts and texts without words are one."""
    own = F.coalesce(F.col(text), F.lit(""))
    return F.xxhash64(*more, F.when(own.rlike(r"\S"), own).otherwise(""))


def with_nodes(docs: DataFrame, name: str) -> DataFrame:
    """docs with a column that names each row's text: its hash or, where another text has that hash, a second one.

    Two texts have one name only if both hashes are equal. Texts that share a hash
    are found by one grouped count; there are next to none, so their table is tiny
    at any size (about one row at 5e9 texts) and its join is left to the planner.
    """
    h, second, clash = free_names(docs, "text_hash", "second_hash", "clash")
    both = docs.select(node().alias(h), node(F.lit(1)).alias(second))
    shared = both.groupBy(h).agg(F.min(second).alias("lo"), F.max(second).alias("hi")).where("lo <> hi")
    shared = materialize(shared.select(h, F.lit(True).alias(clash)))
    named = docs.withColumn(h, node()).join(shared, h, "left")
    return named.withColumn(name, F.when(F.col(clash), node(F.lit(1))).otherwise(F.col(h))).drop(h, clash)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counters of the shingles of this task's texts, a row for each span that has any."""
    total = np.zeros(COUNTERS, np.uint32)
    for batch in batches:
        for x in batch.column("text"):
            np.add.at(total, shingles(x.as_py().encode()) & (COUNTERS - 1), 1)
    spans = total.reshape(-1, SPAN)
    some = np.flatnonzero(spans.any(1))
    for at in range(0, len(some), 64):
        own = some[at : at + 64]
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int64)), pa.array([TaskContext.get().partitionId() // FAN] * len(own), pa.int64()), pa.array([spans[k].tobytes() for k in own], pa.binary())], names=["span", "fan", "counts"])


def _summed(table: pa.Table) -> pa.Table:
    rows = [np.frombuffer(x.as_py(), np.uint32) for x in table.column("counts")]
    total = np.minimum(np.sum(rows, 0, dtype=np.uint64), 0xFFFFFFFF).astype(np.uint32)
    return pa.table({"span": table.column("span")[:1], "fan": pa.array([table.column("fan")[0].as_py() // FAN], pa.int64()), "counts": pa.array([total.tobytes()], pa.binary())})


def frequencies(texts: DataFrame) -> np.ndarray:
    """A byte for each counter, which grows with the logarithm of its count: the order of shingles. Of fixed size, however many texts there are."""
    small_batches(texts.sparkSession)
    schema, out = "span long, fan long, counts binary", np.zeros((COUNTERS // SPAN, SPAN), np.uint8)
    found = texts.select("text").mapInArrow(_counted, schema)
    for _ in range(3):  # FAN ** 3 tasks, about
        found = found.groupBy("span", "fan").applyInArrow(_summed, schema)
    found = found.groupBy("span").applyInArrow(_summed, schema)
    for r in found.mapInArrow(_as_bytes, "span long, counts binary").toLocalIterator():
        out[r.span] = np.frombuffer(r.counts, np.uint8)
    return out.ravel()


def _as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        steps = [np.minimum(255, np.rint(10 * np.log2(1.0 + np.frombuffer(x.as_py(), np.uint32)))).astype(np.uint8).tobytes() for x in batch.column("counts")]
        yield pa.RecordBatch.from_arrays([batch.column("span"), pa.array(steps, pa.binary())], names=["span", "counts"])


def prefixes(texts: DataFrame, order: Broadcast) -> DataFrame:
    """texts (node, text): key, node, n (size of the set) and i (place) for each shingle of a set's prefix, and a row with n = 0, the set's fingerprint as key and its parities."""
    small_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, nodes, odd = [], [], [], []
            for x_node, x in zip(batch.column("node").to_pylist(), batch.column("text")):
                own = shingles(x.as_py().encode())
                n = len(own)
                if n:
                    own = own[np.lexsort((own, order.value[own & (COUNTERS - 1)]))]
                    keys += [own[: n - (4 * n + 4) // 5 + 1], np.array([majority(own.view(np.uint64))], np.uint64).view(np.int64)]
                    sizes += [n, 0]
                    nodes += [x_node] * 2
                    odd += [None] * (len(keys[-2])) + [parities(own)]
            count = [len(k) for k in keys]
            if sum(count):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.repeat(np.array(nodes, np.int64), count)), pa.array(np.repeat(np.array(sizes, np.int32), count)),
                     pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in count])), pa.array(odd, pa.list_(pa.int64()))],
                    names=["key", "node", "n", "i", "odd"])

    return texts.mapInArrow(run, "key long, node long, n int, i int, odd array<long>")


def _similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sets have similarity 0.8 or more. Texts meet in the join, since sets of hashes are larger and don't compress."""
    small_batches(texts.sparkSession)
    of = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    once = materialize(texts.join(of, "node", "left_semi").groupBy("node").agg(F.min("text").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for batch in batches:
            keep = []
            for a, x, y in zip(batch.column("a").to_pylist(), batch.column("x"), batch.column("y")):
                if a != last:
                    last, own = a, shingles(x.as_py().encode())
                other = shingles(y.as_py().encode())
                shared = len(np.intersect1d(own, other, assume_unique=True))
                keep.append(9 * shared >= 4 * (len(own) + len(other)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(once.select(F.col("node").alias("b"), F.col("text").alias("y")), "b").join(once.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
    found = materialize(both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"))
    discard(once)
    return found


def near_copy_components(texts: DataFrame) -> DataFrame:
    """texts (node, text): node and root, which names its component, for nodes that have a link to another."""
    order = texts.sparkSession.sparkContext.broadcast(frequencies(texts))
    every = materialize(prefixes(texts, order).distinct())  # copies of a text are one node from here on
    prints = materialize(every.where("n = 0").select("node", F.col("key").alias("fp"), "odd"))
    roots = connected_components(_similar(_fingerprint_pairs(prints.select("node", "fp")), texts))
    rows = every.where("n > 0").select("key", "node", "n", "i")
    ends = materialize(rows.groupBy("key").agg(F.min(F.struct("node", "n")).alias("lo"), F.max(F.struct("node", "n")).alias("hi")).where("lo.node <> hi.node"))
    members = materialize(rows.join(ends.select("key"), "key", "left_semi"))
    discard(every)
    hubs = F.explode(F.array("lo", "hi"))
    tried = materialize(_apart(_with_hubs(members, ends.select("key", hubs.alias("hub"))), roots))
    discard(ends)
    roots = _joined(roots, _similar(tried, texts))
    named = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = named.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key")
    rest = materialize(named.join(several, "key", "left_semi").select("key", "node", "n", "i", "root"))
    discard(members)
    more = _similar(materialize(_first_met(rest, prints).distinct().join(tried, ["a", "b"], "left_anti")), texts)
    found = materialize(_joined(roots, more))
    discard(rest)
    discard(prints)
    order.destroy()
    return found


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, root) of those of roots and links (a, b) between their nodes or others."""
    return connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links))


def _first_met(rest: DataFrame, prints: DataFrame) -> DataFrame:
    """rest (key, node, n, i, root), prints (node, odd): pairs (a, b), a < b, of different roots that can be similar.

    A pair is formed where both have a key for the first time. A row names only
    the last BEFORE keys before its own, so some pairs are formed again later;
    none is left out, as what they name they share.
    """
    own = rest.groupBy("node").agg(F.first("n").alias("n"), F.first("root").alias("root"), F.sort_array(F.collect_list(F.struct("i", "key"))).alias("own"))  # at most the text's prefix
    own = own.join(prints.select("node", "odd"), "node").select("*", F.posexplode("own").alias("at", "it"))
    own = own.select("it.key", "it.i", "node", "n", "root", "odd", F.slice(F.col("own.key"), F.greatest(F.lit(1), F.col("at") + 1 - BEFORE), F.least(F.lit(BEFORE), F.col("at"))).alias("before"))
    own = materialize(own)
    a, b = (own.select("key", *(F.col(c).alias(f"{short}{x}") for c, short in (("node", ""), ("n", "n"), ("i", "i"), ("root", "r"), ("odd", "p"), ("before", "f")))) for x in "ab")
    return a.join(b, "key").where(f"a < b and ra <> rb and {_ROOM} and {_PARITY} and not arrays_overlap(fa, fb)").select("a", "b")


def _with_hubs(members: DataFrame, hubs: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of the texts of a shingle (key, node, n) and its hubs (key, hub) whose prefixes share enough."""
    a, b = F.least("node", "hub.node"), F.greatest("node", "hub.node")
    na, nb = F.when(F.col("node") < F.col("hub.node"), F.col("n")).otherwise(F.col("hub.n")), F.when(F.col("node") < F.col("hub.node"), F.col("hub.n")).otherwise(F.col("n"))
    both = members.join(hubs, "key").where("node <> hub.node").select("key", a.alias("a"), b.alias("b"), na.alias("na"), nb.alias("nb")).distinct()
    return both.groupBy("a", "b").agg(F.count("*").alias("c"), F.first("na").alias("na"), F.first("nb").alias("nb")).where(_ENOUGH).select("a", "b")


def _fingerprint_pairs(prints: DataFrame) -> DataFrame:
    """prints (node, fp): pairs (a, b) of nodes with one fingerprint, or with fingerprints that the trees link."""
    least = materialize(prints.groupBy("fp").agg(F.min("node").alias("least")))
    same = prints.join(least, "fp").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    near = hamming_links(least.select("fp"))
    near = near.join(least.toDF("a", "na"), "a").join(least.toDF("b", "nb"), "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))
    return materialize(same.union(near).distinct())


def _apart(pairs: DataFrame, components: DataFrame) -> DataFrame:
    """Pairs (a, b) that aren't in one component already."""
    ra, rb = (components.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in "ab")
    return pairs.join(ra, "a", "left").join(rb, "b", "left").where("not coalesce(ra = rb, false)").select("a", "b")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies: that of least doc_id (nulls last) and text hash, with all its columns, whatever their names.

    Rows that repeat both doc_id and text are one group's, and the least of them by
    their other columns stays. Null texts and texts without words are copies of
    each other; texts of any length are compared whole; an empty table stays empty.
    """
    d, n, t, many = free_names(docs, "did", "node", "th", "n_rows")
    tagged = with_nodes(docs, n).withColumns({d: F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), t: F.xxhash64(F.lit(2), F.coalesce("text", F.lit("")))})
    linked = near_copy_components(tagged.select(F.col(n).alias("node"), F.coalesce("text", F.lit("")).alias("text")))
    ids = materialize(tagged.groupBy(n, d, t).agg(F.count("*").alias(many)))
    least = ids.groupBy(n).agg(F.min(F.struct(d, t, many)).alias("one"))
    named = least.join(linked.select(F.col("node").alias(n), F.col("root").alias("component")), n, "left").groupBy(F.coalesce("component", n).alias("component")).agg(F.min("one").alias("one"))
    kept = materialize(named.select("one.*"))
    once = tagged.join(kept, [d, t])
    single = once.where(F.col(many) == 1).select(*docs.columns)
    again = once.where(F.col(many) > 1).groupBy(d, t).agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return single.union(again)
