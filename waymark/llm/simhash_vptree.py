"""SimHash near-dedup: exact Hamming links through vantage-point trees.

Equal fingerprints are one node from the start. A vantage-point tree, fitted on
a bounded sample, cuts the distinct fingerprints into shards: at each step those
within the vantage point's radius go left and the others right, and those left
of the boundary by less than the link distance also visit the right side. By
the triangle inequality every linked pair then meets in a shard. Shards that
are overfull get trees of their own, until none is. A shard is
searched outwards from one fingerprint at a time and emits one edge for each
fingerprint it reaches, so copies never become all their pairs; the edges keep
the shard's components, and the global ones follow from grouped minima.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, materialize, small_batches
from .components import connected_components

SHINGLE = 3
SEED = 42
LINK_BITS = 2
#: Fingerprints that the tree is fitted on, at most; every fingerprint is then placed in it.
SAMPLE = 1 << 14
#: Fingerprints wanted in a shard.
SHARD = 1024
#: Fingerprints in a shard beyond which it is cut again by a tree fitted on about REFIT of its own.
OVERFULL, REFIT = 1 << 17, 1 << 11
#: Times that shards are cut again, at most; those still overfull then are cut inside their task.
REFITS = 4
#: Fewest sampled fingerprints that a step of the tree is fitted on.
LEAST = 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text; zero if it has no words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        h = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    else:
        flat = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        digest = xxhash.xxh64_intdigest
        h = np.array([digest(flat[a:b], SEED) for a, b in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist())], np.uint64)
    return majority(h)


def majority(h: np.ndarray) -> int:
    """The fingerprint of 64-bit hashes: bits that are set in over half of them."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 15):
        part = h[at : at + (1 << 15)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(h), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a long), one row for each row; null text is empty."""
    small_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_py().encode()) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.array(found, np.uint64).view(np.int64))], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, fp long")


def fit_tree(sample: np.ndarray, depth: int) -> list[tuple[int, int] | None]:
    """Vantage point and radius of each inner node in heap order; None where a side is searched whole.

    Of a few candidates the one that leaves the fewest fingerprints near its
    boundary is the vantage point, with the radius that halves the sample.
    """
    nodes: list[tuple[int, int] | None] = [None] * ((1 << depth) - 1)
    parts = {0: sample}
    for i in range(len(nodes)):
        own = parts.pop(i, sample[:0])
        if len(own) < LEAST:
            continue
        best = None
        for at in np.linspace(0, len(own) - 1, 12).astype(int):
            d = np.bitwise_count(own ^ own[at]).astype(int)
            mid = int(np.median(d))
            for radius in (mid - 1, mid):
                left = (d <= radius).mean()
                near = ((d <= radius) & (d > radius - LINK_BITS)).mean()
                if 0.2 <= left <= 0.8 and (best is None or near + abs(left - 0.5) < best[0]):
                    best = (near + abs(left - 0.5), int(own[at]), radius, d)
        if best is None:
            continue
        _, point, radius, d = best
        nodes[i] = (point, radius)
        parts[2 * i + 1], parts[2 * i + 2] = own[d <= radius], own[d > radius]
    return nodes


def place(fps: np.ndarray, nodes: list[tuple[int, int] | None], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of a fingerprint and a shard, for all shards it lives in or visits."""
    at, shard = [], []
    todo = [(0, np.arange(len(fps)))]
    while todo:
        i, own = todo.pop()
        if not len(own):
            continue
        if i >= len(nodes) or nodes[i] is None:
            at.append(own)
            shard.append(np.full(len(own), i))
            continue
        point, radius = nodes[i]
        d = np.bitwise_count(fps[own] ^ np.uint64(point)).astype(int)
        todo += [(2 * i + 1, own[d <= radius]), (2 * i + 2, own[d > radius - bits])]
    return (np.concatenate(at), np.concatenate(shard)) if at else (np.zeros(0, int), np.zeros(0, int))


def spread(fps: np.ndarray, bits: int) -> Iterator[tuple[int, int]]:
    """(root, fingerprint) for every distinct fingerprint that is linked to another: a spanning star of each component."""
    rest = fps
    while len(rest):
        root, rest = rest[0], rest[1:]
        front = np.array([root], np.uint64)
        while len(front) and len(rest):
            step = max(1, (1 << 22) // len(rest))
            hit = np.zeros(len(rest), bool)
            for lo in range(0, len(front), step):
                hit |= (np.bitwise_count(rest[None, :] ^ front[lo : lo + step, None]) <= bits).any(axis=0)
            front, rest = rest[hit], rest[~hit]
            for x in front.tolist():
                yield int(root), x


def search_shard(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Edges of a shard; one far larger than wanted is cut by its own tree first."""
    if len(fps) > 4 * SHARD:
        depth = int(np.ceil(np.log2(len(fps) / SHARD)))
        nodes = fit_tree(fps[:: max(1, len(fps) // SAMPLE)], min(depth, 12))
        if nodes[0] is not None:
            at, shard = place(fps, nodes, bits)
            order = np.argsort(shard, kind="stable")
            cuts = np.flatnonzero(np.diff(shard[order])) + 1
            return [e for part in np.split(at[order], cuts) for e in spread(fps[part], bits)]
    return list(spread(fps, bits))


def _refit(shards: DataFrame, bits: int) -> DataFrame:
    """Shards (shard, fp) with overfull ones cut by trees of their own."""
    for _ in range(REFITS):
        sizes = shards.groupBy("shard").count().where(F.col("count") > OVERFULL)
        some = shards.join(F.broadcast(sizes), "shard").where(F.pmod(F.xxhash64("fp", F.lit(9)), F.greatest(F.lit(1), F.expr(f"count div {REFIT}"))) == 0)  # a row for each shard of the last tree

        def fit(pdf: pd.DataFrame) -> pd.DataFrame:
            n = int(pdf["count"].iloc[0])
            depth = int(np.clip(np.ceil(np.log2(n / SHARD)), 1, np.log2(REFIT / LEAST)))
            nodes = fit_tree(np.sort(pdf["fp"].to_numpy().view(np.uint64)), depth)
            return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "nodes": [json.dumps(nodes)]})

        trees = {r.shard: [x and tuple(x) for x in json.loads(r.nodes)] for r in some.groupBy("shard").applyInPandas(fit, "shard long, nodes string").collect()}
        trees = {k: v for k, v in trees.items() if v[0] is not None}
        if not trees:
            break

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                shard, fps = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                for k in np.unique(shard):
                    own = fps[shard == k].view(np.uint64)
                    if k not in trees:
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), k)), pa.array(own.view(np.int64))], names=["shard", "fp"])
                        continue
                    at, sub = place(own, trees[k], bits)
                    yield pa.RecordBatch.from_arrays([pa.array((k + 1) << 12 | sub), pa.array(own[at].view(np.int64))], names=["shard", "fp"])

        shards = materialize(shards.mapInArrow(deal, "shard long, fp long"))
    return shards


def hamming_links(fps: DataFrame, bits: int = LINK_BITS) -> DataFrame:
    """fps (fp long, distinct): pairs (a, b) that span the components of fingerprints at `bits` or fewer differing bits."""
    spark = fps.sparkSession
    n = fps.count()
    want = min(SAMPLE, n)
    taken = fps.orderBy(F.xxhash64("fp", F.lit(7)), "fp").limit(want).collect() if want else []
    sample = np.array([r.fp for r in taken], np.int64).view(np.uint64)
    depth = int(np.clip(np.ceil(np.log2(max(n, 1) / SHARD)), 0, np.log2(SAMPLE / LEAST)))
    nodes = fit_tree(sample, depth)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at, shard = place(own, nodes, bits)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int64)), pa.array(own[at].view(np.int64))], names=["shard", "fp"])

    def edges(pdf: pd.DataFrame) -> pd.DataFrame:
        own = np.sort(pdf["fp"].to_numpy().view(np.uint64))
        found = np.array(search_shard(own, bits), np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    shards = fps.mapInArrow(deal, "shard long, fp long")
    if n > OVERFULL:
        shards = _refit(materialize(shards), bits)
    return shards.groupBy("shard").applyInPandas(edges, "a long, b long")


def hamming_components(fps: DataFrame, bits: int = LINK_BITS) -> DataFrame:
    """fps (fp long, distinct): returns (fp, root) for fingerprints with a link; root names the component."""
    return connected_components(hamming_links(fps, bits)).select(F.col("node").alias("fp"), "root")


def simhash_near_dedup(docs: DataFrame, bits: int = LINK_BITS) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id (the least doc_id that is reachable) for every row.

    Null texts and texts without words have fingerprint zero and link like any
    other; texts of any length are hashed whole. Repeated rows each get their
    row. Null ids keep a row; a component of null ids only has component_id null.
    An empty table gives no rows; other columns are ignored.
    """
    own = materialize(fingerprints(docs))
    distinct = materialize(own.groupBy("fp").agg(F.min(F.coalesce("doc_id", F.lit(NULL_ID))).alias("least")))
    linked = hamming_components(distinct.select("fp"), bits)
    named = distinct.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = named.join(least, "root").select("fp", F.nullif("component_id", F.lit(NULL_ID)).alias("component_id"))
    return own.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
