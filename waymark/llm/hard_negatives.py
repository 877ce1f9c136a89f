"""Hard negatives by rotated one-bit codes with stored alignments and certain score intervals.

Vectors are whole numbers; they are rotated by a fixed orthogonal matrix. A code
is the signs b of a rotated vector r; stored beside it are its alignment
<r, b> / <b, b> and the length of what is left, r - alignment * b, which is
orthogonal to b. Further codes hold the signs of that rest in the same way: one
code alone leaves intervals of 0.6 times both lengths, four leave 0.13.
A query's rotated components are rounded to bit planes, so <b, query> is a sum
of popcounts, wrong by at most the 1-norm of the rounding. By Cauchy-Schwarz the
rest adds at most its length times the length of the query's part orthogonal to
the last b. So each score lies in an interval for certain; only rows whose interval can
matter are scored, in integers.

Rows are packed in blocks of a table. Queries come in groups of bounded size,
which are broadcast; a pass over the blocks takes one group, and each task keeps
only the best rows of each query.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, small_batches

#: Rows of a block, queries of a block, query blocks that are broadcast together, queries compared at once.
BLOCK, QUERIES, GROUP, AT_ONCE = 4096, 1024, 16, 128
#: Codes of a vector, and bits of a query's rounded components.
CODES, PLANES = 4, 6
#: Pairs scored at once, and the share of pairs below which they are listed one by one.
PAIRS, SPARSE = 1 << 11, 0.08
#: Greatest length of a vector: then a hundred times a score fits a long.
LONGEST = float(1 << 27)
POSITIVES, NEGATIVES = 5, 3
#: The band of a negative's score, in hundredths of the positive's.
LOW, HIGH = 50, 95
SEED = 12


@functools.cache
def rotation(size: int) -> np.ndarray:
    """A fixed orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def _words(bits: np.ndarray) -> np.ndarray:
    """Bits of each row, 64 to a word."""
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


class Rows:
    """Vectors, by label, with their codes: for each code its words and alignment, the length of the rest and of what the codes so far add up to."""

    def __init__(self, uid, ids, labels, vectors) -> None:
        order = np.argsort(labels, kind="stable")
        uid, ids, labels, vectors = uid[order], ids[order], labels[order], vectors[order]
        self.uid, self.ids, self.labels, self.vectors = uid, ids, labels, vectors
        self.norm = np.sqrt((vectors.astype(float) ** 2).sum(1))
        turned = left = vectors @ rotation(vectors.shape[1]).T
        self.codes, self.alignment, self.rest, self.near = [], [], [], []
        for _ in range(CODES):
            bits = left >= 0
            signs = np.where(bits, 1.0, -1.0)
            along = (left * signs).sum(1) / left.shape[1]
            left = left - along[:, None] * signs
            self.codes.append(_words(bits))
            self.alignment.append(along)
            self.rest.append(np.sqrt((left**2).sum(1)))
            self.near.append(np.sqrt(((turned - left) ** 2).sum(1)))

    def packed(self) -> dict[str, bytes]:
        out = {"uid": self.uid, "ids": self.ids, "labels": self.labels, "vectors": self.vectors.astype("<i4"), "norm": self.norm}
        out |= {"codes": np.array(self.codes), "alignment": np.array(self.alignment), "rest": np.array(self.rest), "near": np.array(self.near)}
        return {k: v.tobytes() for k, v in out.items()}

    @classmethod
    def unpacked(cls, b: dict) -> Rows:
        own = cls.__new__(cls)
        own.uid, own.ids, own.labels = (np.frombuffer(b[k], "<i8") for k in ("uid", "ids", "labels"))
        n = len(own.uid)
        own.vectors = np.frombuffer(b["vectors"], "<i4").reshape(n, -1)
        own.norm = np.frombuffer(b["norm"])
        own.codes = np.frombuffer(b["codes"], "<u8").reshape(CODES, n, -1)
        own.alignment, own.rest, own.near = (np.frombuffer(b[k]).reshape(CODES, n) for k in ("alignment", "rest", "near"))
        return own


class Queries:
    """Rotated queries as bit planes: component j is base + step * (its bits in the planes), wrong by `off` in sum and by `error` in length at most."""

    def __init__(self, uid, ids, labels, vectors) -> None:
        self.uid, self.ids, self.labels, self.vectors = uid, ids, labels, vectors
        self.norm = np.sqrt((vectors.astype(float) ** 2).sum(1))
        x = vectors @ rotation(vectors.shape[1]).T
        top = (1 << PLANES) - 1
        self.base = x.min(1)
        self.step = np.maximum((x.max(1) - self.base) / top, 1e-12)
        steps = np.clip(np.rint((x - self.base[:, None]) / self.step[:, None]), 0, top).astype(np.uint8)
        near = self.base[:, None] + self.step[:, None] * steps
        self.sum, self.off, self.error = near.sum(1), np.abs(x - near).sum(1) * (1 + 1e-9), np.sqrt(((x - near) ** 2).sum(1)) * (1 + 1e-9)
        self.planes = [_words((steps >> p & 1).astype(bool)) for p in range(PLANES)]
        self.size = x.shape[1]


def along(q: Queries, rows: Rows, i, j, code: int) -> np.ndarray:
    """<b, rounded query> of q[i] with rows[j], which broadcast against each other."""
    words = rows.codes[code][j]
    count = 0
    for p, plane in enumerate(q.planes):
        own = plane[i]
        for w in range(words.shape[-1]):
            count = count + np.left_shift(np.bitwise_count(own[..., w] & words[..., w]), p, dtype=np.int32)
    ones = np.bitwise_count(words).sum(-1, dtype=np.int32)
    return (2 * q.base[i] * ones - q.sum[i]) + 2 * q.step[i] * count


def half_width(q: Queries, rows: Rows, i, j, code: int, dot: np.ndarray) -> np.ndarray:
    """How far a score can be from the sum of the first codes' shares: the rest against the query's part across the last code, and the rounding."""
    sure = np.maximum(np.abs(dot) - q.off[i], 0)
    across = np.sqrt(np.maximum(q.norm[i] ** 2 - sure**2 / q.size, 0))
    return rows.rest[code][j] * across + rows.near[code][j] * q.error[i] + 1e-9 * q.norm[i] * rows.norm[j] + 1e-6


def intervals(q: Queries, rows: Rows, i, j, codes: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest scores from the first `codes` codes."""
    total = 0.0
    for c in range(codes):
        dot = along(q, rows, i, j, c)
        total = total + rows.alignment[c][j] * dot
    wide = half_width(q, rows, i, j, codes - 1, dot)
    return total - wide, total + wide


def scores(q: Queries, rows: Rows, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of pairs."""
    out = np.zeros(len(i), np.int64)
    for at in range(0, len(i), PAIRS):
        s = slice(at, at + PAIRS)
        out[s] = np.einsum("ij,ij->i", q.vectors[i[s]], rows.vectors[j[s]], dtype=np.int64)
    return out


def _best(key: np.ndarray, score: np.ndarray, ids: np.ndarray, uid: np.ndarray, most: int) -> np.ndarray:
    """Places of the first `most` of each key: higher scores, then smaller ids."""
    order = np.lexsort((uid, ids, -score, key))
    k = key[order]
    start = np.maximum.accumulate(np.where(np.r_[True, k[1:] != k[:-1]], np.arange(len(k)), 0)) if len(k) else np.zeros(0, np.int64)
    return order[np.arange(len(k)) - start < most]


class Search:
    """The best rows of the queries of one block, over row blocks one after the other.

    low and high, of one row for each query: the ranges in which scores count,
    each with its own best. same: whether rows of the query's label count, or the others.
    """

    def __init__(self, q: Queries, low: np.ndarray, high: np.ndarray, same: bool, most: int) -> None:
        self.q, self.low, self.high, self.same, self.most = q, low, high, same, most
        self.floor = low.copy()
        self.held = [np.zeros(0, np.int64)] * 4
        self.seen = np.zeros(2, np.int64)  # pairs that count, and those that were scored

    def add(self, rows: Rows) -> None:
        everyone, q = np.arange(len(self.q.uid)), self.q
        groups = [(everyone, 0, len(rows.uid))]
        if self.same:  # queries of a label against its rows, which lie together
            labels = np.intersect1d(q.labels, rows.labels)
            groups = [(np.flatnonzero(q.labels == n), *np.searchsorted(rows.labels, [n, n + 1])) for n in labels]
        for who, first, last in groups:
            for at in range(0, len(who), AT_ONCE):
                self._add(rows, who[at : at + AT_ONCE], np.arange(first, last))

    def _fits(self, i, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Intervals that a range of their queries q[i] can still use."""
        some = np.zeros(low.shape, bool)
        for k in range(self.low.shape[1]):
            some |= (high >= self.floor[i, k]) & (low <= self.high[i, k])
        return some

    def _add(self, rows: Rows, who: np.ndarray, j: np.ndarray) -> None:
        q = self.q
        i, j = who[:, None], j[None, :]
        live = ((q.labels[i] == rows.labels[j]) == self.same) & (q.uid[i] != rows.uid[j])
        self.seen[0] += live.sum()
        total = 0.0
        for c in range(CODES):
            dot = along(q, rows, i, j, c)
            total = total + rows.alignment[c][j] * dot
            wide = half_width(q, rows, i, j, c, dot)
            live = live & self._fits(i, total - wide, total + wide)
            if live.ndim == 2 and (c == CODES - 1 or live.mean() < SPARSE):
                a, b = np.nonzero(live)
                i, j, total, live = who[a], j[0, b], total[a, b], np.ones(len(a), bool)
            elif live.ndim == 1:
                i, j, total, live = i[live], j[live], total[live], live[live]
        self.seen[1] += len(i)
        score = scores(q, rows, i, j)
        n = self.low.shape[1]
        fits = (score[:, None] >= self.floor[i]) & (score[:, None] <= self.high[i])
        pair, k = np.nonzero(fits)
        new = (i[pair] * n + k, score[pair], rows.ids[j[pair]], rows.uid[j[pair]])
        mine = (self.held[0] // n >= who[0]) & (self.held[0] // n <= who[-1])
        key, score, ids, uid = (np.concatenate([h[mine], x]) for h, x in zip(self.held, new))
        best = _best(key, score, ids, uid, self.most)
        self.held = [np.concatenate([h[~mine], x[best]]) for h, x in zip(self.held, (key, score, ids, uid))]
        full, count = np.unique(key[best], return_counts=True)
        least = np.full(n * len(q.uid), np.iinfo(np.int64).max)
        np.minimum.at(least, key[best], score[best])
        full = full[count == self.most]
        self.floor.reshape(-1)[full] = np.maximum(self.floor.reshape(-1)[full], least[full])


_BLOCKS = ("uid", "ids", "labels", "vectors", "norm", "codes", "alignment", "rest", "near")


def _blocks(size: int):
    """Packed blocks of the rows; uid: the task and the row's number in it."""
    schema = pa.schema([(n, pa.binary()) for n in _BLOCKS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                lists = part.column("v")
                n, flat, ends = len(lists), lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
                full = np.zeros((n, size))
                full[np.arange(size)[None, :] < ends[:, None]] = np.floor(256 * flat)
                fits = np.sqrt((full**2).sum(1)) <= LONGEST
                own = Rows(first + np.arange(n)[fits], part.column("id").to_numpy()[fits], part.column("label").to_numpy()[fits], full[fits].astype(np.int64))
                first += n
                if len(own.uid):
                    yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in own.packed().values()], schema=schema)

    return run


def _anchors(every: int):
    schema = pa.schema([("uid", pa.int64()), ("id", pa.int64()), ("label", pa.int64()), ("vector", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                rows = Rows.unpacked(b)
                at = np.flatnonzero(rows.ids % every == 0)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(rows.uid[at]), pa.array(rows.ids[at]), pa.array(rows.labels[at]), pa.array([rows.vectors[k].tobytes() for k in at], pa.binary())], schema=schema)

    return run


_QUERY = ("q_uid", "q_ids", "q_labels", "q_vectors", "q_low", "q_high")


def _packed_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Query blocks, each with the number of its task."""
    part = TaskContext.get().partitionId()
    schema = pa.schema([("part", pa.int64())] + [(n, pa.binary()) for n in _QUERY])
    for batch in batches:
        for at in range(0, batch.num_rows, QUERIES):
            b = batch.slice(at, QUERIES)
            vectors = b"".join(b.column("vector").to_pylist())
            bands = [np.array(b.column(n).to_pylist(), "<i8").tobytes() for n in ("low", "high")]
            out = [part, *(b.column(n).to_numpy().tobytes() for n in ("uid", "id", "label")), vectors, *bands]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(out, schema)], schema=schema)


_FOUND = "uid long, anchor_id long, k long, score long, id long, row long"


def _searched(same: bool, most: int):
    """Pairs of a row block and a query block: the best rows of each query in this task."""
    schema = pa.schema([(n.split()[0], pa.int64()) for n in _FOUND.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, Search] = {}
        for batch in batches:
            for b in batch.to_pylist():
                name = b["q_uid"]
                if name not in held:
                    uid, ids, labels = (np.frombuffer(b[k], "<i8") for k in ("q_uid", "q_ids", "q_labels"))
                    q = Queries(uid, ids, labels, np.frombuffer(b["q_vectors"], "<i4").reshape(len(uid), -1))
                    low, high = (np.frombuffer(b[k], "<i8").reshape(len(uid), -1) for k in ("q_low", "q_high"))
                    held[name] = Search(q, low, high, same, most)
                held[name].add(Rows.unpacked(b))
        for s in held.values():
            key, score, ids, uid = s.held
            n = s.low.shape[1]
            if len(key):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (s.q.uid[key // n], s.q.ids[key // n], key % n, score, ids, uid)], schema=schema)

    return run


def _search(blocks: DataFrame, anchors: DataFrame, n: int, same: bool, most: int) -> DataFrame:
    """The first `most` rows of each anchor (uid, id, label, vector, low, high) and band, by pass over the blocks for each group of anchors."""
    parts = max(1, -(-n // QUERIES))
    packed = materialize(anchors.repartition(parts).mapInArrow(_packed_queries, "part long, " + ", ".join(f"{c} binary" for c in _QUERY)))
    found = None
    for first in range(0, parts, GROUP):
        group = packed.where(F.col("part").between(first, first + GROUP - 1)).drop("part")
        # queries in blocks against all rows: GROUP * QUERIES of them at once, about
        own = materialize(blocks.crossJoin(F.broadcast(group)).mapInArrow(_searched(same, most), _FOUND))
        found = own if found is None else found.unionByName(own)
    place = F.row_number().over(Window.partitionBy("uid", "k").orderBy(F.desc("score"), "id", "row"))
    best = materialize(found.withColumn("rank", place).where(F.col("rank") <= most))
    discard(packed)
    return best


def hard_negatives(table: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of the embeddings (vec_id, embedding, label).

    Rows with a null id, label, vector or component, or one that is not finite,
    take no part, nor do vectors longer than 2^27 in units of 1/256, whose scores
    would not fit. Shorter vectors are filled with zeros; an empty one scores 0.
    Labels of ids divisible by 7 move on by one, modulo ten. A repeated row is
    another row of equal score: it can be a positive of its twin, and each gets
    results of its own. Other columns are ignored; an empty table has no result.
    """
    spark = table.sparkSession
    small_batches(spark)
    real = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    label = F.col("label").cast("long")
    ids = F.col("vec_id").cast("long")
    rows = table.where(ids.isNotNull() & label.isNotNull() & F.col("embedding").isNotNull() & real).select(
        ids.alias("id"), F.when(ids % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    n, queries, longest = rows.agg(F.count("*"), F.count_if(F.col("id") % every == 0), F.max(F.size("v"))).first()
    size = max(64, -(-(longest or 0) // 64) * 64)
    parts = max(-(-n // (4 * BLOCK)), min(spark.sparkContext.defaultParallelism, -(-n // 1024)), 1)
    blocks = materialize(rows.repartition(parts).mapInArrow(_blocks(size), ", ".join(f"{c} binary" for c in _BLOCKS)))
    anchors = materialize(blocks.mapInArrow(_anchors(every), "uid long, id long, label long, vector binary"))
    ends = 1 << 60
    open_band = anchors.withColumns({"low": F.array(F.lit(-ends)), "high": F.array(F.lit(ends))})
    close = _search(blocks, open_band, queries, True, positives).select("uid", "anchor_id", F.col("rank").alias("k"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    # bands in whole numbers: low% of the positive's score, rounded up, to high% of it, rounded down; without a positive an empty one
    listed = close.groupBy("uid").agg(F.map_from_entries(F.collect_list(F.struct(F.col("k").cast("int"), "positive_score"))).alias("p"))
    each = F.sequence(F.lit(1), F.lit(positives))
    hundredth = lambda x: F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100))  # noqa: E731  rounded down
    bands = anchors.join(listed, "uid").select("*", F.transform(each, lambda k: F.col("p")[k]).alias("s")).select(
        "uid", "id", "label", "vector",
        F.transform("s", lambda s: F.coalesce(-hundredth(-low * s), F.lit(ends))).alias("low"),
        F.transform("s", lambda s: F.coalesce(hundredth(high * s), F.lit(-ends))).alias("high"))
    far = _search(blocks, bands, queries, False, negatives).withColumn("k", F.col("k") + 1)
    both = far.join(close.drop("anchor_id"), ["uid", "k"])
    return both.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
