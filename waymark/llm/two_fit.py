"""Best-two-fit packing of token ids into sequences of at most `limit` tokens.

A sequence is filled greedily, the longest piece that fits first; then its
smallest piece makes way for two unpacked ones that fill the room more tightly,
as long as that helps. What is packed are lengths, of which there are `limit`
at most: the plan is made from how many pieces have each length, and a filling
is repeated as long as its lengths last, so the plan is small however many
pieces there are. Pieces then take their places in Spark by their number among
those of the same length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, small_batches
from .rans_tokens import END_ID, encoder, larger

LIMIT = 1024

_PIECES = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int64()), ("at", pa.int64())]
_PIECES_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, at long"


def cuts(n: int, limit: int) -> list[int]:
    """Lengths of the pieces of n tokens: all are full but the first."""
    first = n % limit or min(n, limit)
    return [first] + [limit] * ((n - first) // limit)


def _pieces(path: str, end: int, limit: int, with_ids: bool):
    """Pieces of each text; part and at: the task, and the piece's number among those of its length there."""
    schema = pa.schema(_PIECES + [("ids", pa.binary())] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, seen = encoder(path), TaskContext.get().partitionId(), [0] * (limit + 1)
        for batch in larger(batches):
            rows = []
            for doc, found in zip(batch.column("doc_id").to_pylist(), own.encode_all(batch.column("text"))):
                ids = np.append(found, np.uint32(end)).astype("<u4").tobytes()
                start = 0
                for k, n in enumerate(cuts(len(ids) // 4, limit)):
                    data = ids[4 * start : 4 * (start + n)]
                    rows.append((doc, k, start, n, zlib.crc32(data), part, seen[n], data)[: len(schema)])
                    seen[n] += 1
                    start += n
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


class _Stock:
    """How many pieces of each length are left, with a bit for each length that has any."""

    def __init__(self, counts: np.ndarray) -> None:
        self.left = [int(c) for c in counts]
        self.bits = sum(1 << n for n, c in enumerate(self.left) if c)

    def longest(self, most: int) -> int:
        """The greatest length of at most `most` that is left, or 0."""
        return max(0, (self.bits & ((2 << most) - 1)).bit_length() - 1)

    def take(self, n: int, k: int = 1) -> None:
        self.left[n] -= k
        self.bits = self.bits | 1 << n if self.left[n] else self.bits & ~(1 << n)

    def two(self, room: int) -> tuple[int, int]:
        """Two pieces that are left, of the greatest sum within room; (0, 0) without any. Of equal sums the one of the most equal lengths, so that short pieces stay for other gaps."""
        best = (0, 0)
        b = self.longest(room // 2)
        while b:
            self.take(b)
            a = self.longest(room - b)
            self.take(b, -1)
            if a and a + b > sum(best):
                best = (max(a, b), min(a, b))
                if a + b == room:
                    break
            b = self.longest(b - 1)
        return best


def filled(stock: _Stock, limit: int, swap: int = 1) -> list[int]:
    """The lengths of one sequence, taken out of stock, longest first. swap: the place of the first piece that may make way; 0: any."""
    out, gap = [], limit
    while n := stock.longest(gap):
        stock.take(n)
        out.append(n)
        gap -= n
    while gap and len(out) > swap:
        least = out[-1]
        a, b = stock.two(gap + least)
        if a + b <= least:
            break
        stock.take(least, -1)
        stock.take(a)
        stock.take(b)
        out = sorted(out[:-1] + [a, b], reverse=True)
        gap += least - a - b
    return out


def plan(counts: np.ndarray, limit: int, swap: int = 1) -> list[tuple[list[int], int]]:
    """(lengths, times): what the sequences hold, for counts[n] pieces of n tokens. Each filling is repeated until a length of it runs short."""
    stock, out = _Stock(counts), []
    while stock.bits:
        lengths = filled(stock, limit, swap)
        need = Counter(lengths)
        more = min(stock.left[n] // k for n, k in need.items())
        for n, k in need.items():
            stock.take(n, k * more)
        out.append((lengths, 1 + more))
    return out


def best_plan(counts: np.ndarray, limit: int) -> list[tuple[list[int], int]]:
    """The plan of fewest sequences of those in which the longest piece stays or may make way too."""
    return min((plan(counts, limit, swap) for swap in (1, 0)), key=lambda made: sum(times for _, times in made))


class Places:
    """Sequence and offset of the k-th piece of a length, from a plan."""

    def __init__(self, made: list[tuple[list[int], int]]) -> None:
        used: Counter[int] = Counter()
        rows, offsets, sequence = [], [], 0
        for lengths, times in made:
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            for n in dict.fromkeys(lengths):
                own = [int(s) for s, m in zip(starts, lengths) if m == n]
                rows.append((n, used[n], sequence, len(own), len(offsets)))
                offsets += own
                used[n] += len(own) * times
            sequence += times
        self.sequences = sequence
        rows.sort()
        self.key = np.array([n << 48 | first for n, first, *_ in rows], np.int64)
        self.first, self.sequence, self.each, self.at = (np.array(c, np.int64) for c in list(zip(*rows))[1:]) if rows else [np.zeros(0, np.int64)] * 4
        self.offset = np.array(offsets, np.int64)

    def of(self, length: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.searchsorted(self.key, length << 48 | k, "right") - 1
        beyond = k - self.first[row]
        return self.sequence[row] + beyond // self.each[row], self.offset[self.at[row] + beyond % self.each[row]]


def _placed(places: Places, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                k = batch.column("base").to_numpy() + batch.column("at").to_numpy()
                sequence, offset = places.of(batch.column("length").to_numpy(), k)
                found = {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
                yield pa.RecordBatch.from_arrays([found[f.name] if f.name in found else batch.column(f.name) for f in schema], schema=schema)

    return run


def pack(docs: DataFrame, path: str, limit: int = LIMIT, end: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of each piece of each text; ids (little-endian, 32 bits), if asked for.

    A document is the ids of its text and `end`; one of over `limit` tokens is
    cut into full pieces and a first one with the rest. Null texts are empty (one
    token), null ids are kept, repeated rows are packed each, texts of any length
    are encoded whole, an empty table gives no rows, other columns are ignored.
    Which of the pieces of a length takes which of its places is not defined.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    pieces = materialize(texts.mapInArrow(_pieces(path, end, limit, with_ids), _PIECES_SQL + ", ids binary" * with_ids))
    held = materialize(pieces.groupBy("part", "length").agg(F.count("*").alias("n")))
    counts = np.zeros(limit + 1, np.int64)
    for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row for each length, `limit` at most
        counts[r.length] = r.n
    places = Places(best_plan(counts, limit))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")  # a row for each task
    numbered = pieces.join(held.select("part", "length", before.alias("base")), ["part", "length"])
    schema = pa.schema([*_PIECES[:5], ("sequence_id", pa.int64()), ("offset", pa.int64())] + [("ids", pa.binary())] * with_ids)
    return numbered.mapInArrow(_placed(places, schema), _PIECES_SQL.replace("part long, at long", "sequence_id long, offset long") + ", ids binary" * with_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids (little-endian, 32 bits) and doc_ids of pack(with_ids=True), whole sequences of bounded length."""
    own = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("p"))
    return own.select("sequence_id", "n_tokens", F.aggregate("p", F.lit(b""), lambda x, p: F.concat(x, p.ids)).alias("ids"), F.col("p.doc_id").alias("doc_ids"))
