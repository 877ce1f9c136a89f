"""Exact substring dedup by sparse distributed prefix doubling.

A position is named ("ranked") by the bytes that start there. Round one ranks
sampled positions by ANCHOR bytes, Spark sorts the (rank, position) pairs, and
ranks that occur once leave. The sample is content-defined: each window of
`threshold` bytes picks the ANCHOR-byte string of least hash in it, so equal
windows pick equal positions wherever they stand and no repeat is missed. All
windows that share a pick travel as one span. Spans whose whole bytes are equal
are settled in that sort. Where a rank repeats with different bytes around it,
the offset grows: round two ranks the pick together with the bytes up to the
nearer half of a window on either side, one of which equal windows must share,
and spans whose longer ranks are unique leave. Round three doubles once more:
each window of what is left is ranked by the pair (rank of its first half, rank
of the half at the offset), which covers the threshold, and a last sort settles
those windows one by one.

Ranks are 64-bit names of byte strings, always used in pairs from two
independent hash functions, rather than ordinals, so no global count is needed.

Each row of (rank, span, document) is sent once, a document's text once.
A frequent string is a frequent rank: before the shuffle, tasks combine their
rows, so that of one string only those of the task's smallest document travel by
rank; the others are copies already and are dealt out at random. What is left of
a frequent rank is streamed through a sort and never collected.

Strings are compared by pairs of independent 64-bit names, never byte by byte:
two different strings count as equal with a chance of about 2**-128.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, keyed, materialize, small_batches, text_bytes

THRESHOLD = 50
ANCHOR = 20
#: Window starts handled at once; bounds the worker's memory for texts of any length.
CHUNK = 1 << 19

#: Rows combined at once in a task.
COMBINE = 1 << 20

#: known: a copy for sure, with a random rank. n holds the number of windows in its low 15 bits, then whether its rank reaches to the left, and the place of the pick, from start, above.
_SPAN = pa.schema([("a", pa.int64()), ("s", pa.int64()), ("did", pa.int64()), ("th", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("known", pa.bool_())])
_FLAG = pa.schema([("kind", pa.int8()), ("did", pa.int64()), ("th", pa.int64()), ("start", pa.int32()), ("n", pa.int32())])


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class _Names:
    """Names of byte strings of any length at any place, from one polynomial sum over the bytes."""

    def __init__(self, seed: int) -> None:
        self.table = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(seed | 1)) | np.uint64(1)
        self.base = int(_mix(np.array([seed], np.uint64))[0]) | 5
        self.powers = self.inverse = np.ones(1, np.uint64)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.cumprod(out)

    def load(self, data: np.ndarray) -> None:
        n = len(data) + 1
        if len(self.powers) < n:
            self.powers, self.inverse = (self._powers(x, n) for x in (self.base, pow(self.base, -1, 1 << 64)))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.table[data] * self.powers[: n - 1])])

    def every(self, length: int) -> np.ndarray:
        """The names of the strings of this length at every place."""
        n = max(0, len(self.sums) - length)
        return _mix((self.sums[length : length + n] - self.sums[:n]) * self.inverse[:n])

    def at(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return _mix((self.sums[start + length] - self.sums[start]) * self.inverse[start] + np.asarray(length, np.uint64))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """For each place the index of the first least value of the next `width` places."""
    n, span = len(values), 1
    v, at = values, np.arange(n, dtype=np.int32)
    while span < width:
        step = min(span, width - span)
        keep = v[:-step] <= v[step:]
        v, at = np.where(keep, v[:-step], v[step:]), np.where(keep, at[:-step], at[step:])
        span += step
    return at


def _pieces(ends: np.ndarray, threshold: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of whole documents up to CHUNK bytes; longer documents in overlapping pieces."""
    lo, total = 0, int(ends[-1])
    while lo < total:
        hi = int(ends[np.searchsorted(ends, lo + CHUNK, "right") - 1])
        if hi <= lo:
            hi = min(lo + CHUNK, int(ends[np.searchsorted(ends, lo, "right")]))
            yield lo, hi
            lo = hi if hi in ends else hi - threshold + 1
        else:
            yield lo, hi
            lo = hi


class _Combined:
    """Gathers a task's rows; of one string (a, s), rows of other documents than the smallest become known copies."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.rows = 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.rows += len(columns[0])

    def flush(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        """The rows gathered, if there are so many."""
        if self.rows < least:
            return
        columns = [np.concatenate(c) for c in zip(*self.parts)]
        self.parts, self.rows = [], 0
        a, s, did, th, start, n = columns
        order = np.lexsort((did, s, a))
        head = np.ones(len(a), bool)
        head[1:] = (a[order[1:]] != a[order[:-1]]) | (s[order[1:]] != s[order[:-1]])
        known = np.empty(len(a), bool)
        known[order] = did[order] > did[order[np.flatnonzero(head)]][np.cumsum(head) - 1]
        # rows stay in the order of the documents, which is written smaller than that of the ranks
        anywhere = _mix(did.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + start.astype(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((np.where(known, anywhere, a), s, did, th, start, n, known), _SPAN)], schema=_SPAN)


def _spans(threshold: int, anchor: int):
    """Documents to spans: for each sampled position its rank, the name of its span, and where the span is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, rows = _Names(0xA5A5F00D), _Names(0x0DDBA11), _Combined()
        for batch in batches:
            data, ends = text_bytes(batch.column("text"))
            did, th = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("did", "th"))
            for lo, hi in _pieces(ends, threshold):
                if hi - lo < threshold:
                    continue
                part = data[lo:hi]
                i, j = np.searchsorted(ends, lo, "right") - 1, np.searchsorted(ends, hi, "left")
                cuts = np.clip(ends[i : j + 1], lo, hi) - lo
                owner = np.repeat(np.arange(i, j, dtype=np.int32), np.diff(cuts))
                first.load(part)
                second.load(part)
                ranks = first.every(anchor)
                pick = _least(ranks, threshold - anchor + 1)
                starts = np.flatnonzero(owner[: hi - lo - threshold + 1] == owner[threshold - 1 :])
                if not len(starts):
                    continue
                pick = pick[starts]
                at = np.flatnonzero(np.concatenate([[True], pick[1:] != pick[:-1]]))
                n = np.diff(np.append(at, len(starts)))
                start, pick = starts[at], pick[at]
                doc = owner[start]
                rows.add(ranks[pick].view(np.int64), second.at(start, n - 1 + threshold).view(np.int64), did[doc], th[doc], start + lo - ends[doc], n | (pick - start) << 16)
                yield from rows.flush(COMBINE)
        yield from rows.flush()

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by a, s, did. kind 0: spans whose bytes an earlier document holds. kind 1: spans whose rank also has other bytes around it."""
    last_a = last_s = first = None
    runs, held = 0, None  # span names seen of the last rank; its rows while there is only one name
    for batch in batches:
        a, s, did, th, start, n, known = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(7))
        if known.any():
            at = np.flatnonzero(known)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((np.zeros(len(at), np.int8), did[at], th[at], start[at], n[at]), _FLAG)], schema=_FLAG)
            a, s, did, th, start, n = (x[~known] for x in (a, s, did, th, start, n))
        m = len(a)
        if not m:
            continue
        new_a, new_s = np.ones(m, bool), np.ones(m, bool)
        new_a[1:] = a[1:] != a[:-1]
        new_s[1:] = new_a[1:] | (s[1:] != s[:-1])
        new_a[0] = last_a is None or a[0] != last_a
        new_s[0] = new_a[0] or s[0] != last_s
        heads = np.flatnonzero(new_s)
        run = np.cumsum(new_s) - 1
        least = np.where(run >= 0, did[heads[np.maximum(run, 0)]] if len(heads) else 0, first if first is not None else 0)
        copy = did > least
        if new_a[0]:
            runs, held = 0, None
        group = np.cumsum(new_a) - (1 if new_a[0] else 0)
        seen = np.bincount(group[heads], minlength=group[-1] + 1) if len(heads) else np.zeros(group[-1] + 1, int)
        seen[0] += runs
        mixed = ~copy & (seen[group] > 1)
        out = [np.flatnonzero(copy), np.flatnonzero(mixed)]
        if held is not None and seen[0] > 1:
            yield held
            held = None
        last = group == group[-1]
        if seen[-1] == 1:
            keep = np.flatnonzero(last & ~copy)
            add = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((np.ones(len(keep), np.int8), did[keep], th[keep], start[keep], n[keep]), _FLAG)], schema=_FLAG)
            held = add if held is None or group[-1] > 0 else pa.Table.from_batches([held, add]).combine_chunks().to_batches()[0] if len(keep) else held
        else:
            held = None
        last_a, last_s, first, runs = a[-1], s[-1], least[-1], int(seen[-1])
        at = np.concatenate(out)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((np.repeat([0, 1], [len(out[0]), len(out[1])]).astype(np.int8), did[at], th[at], start[at], n[at]), _FLAG)], schema=_FLAG)


def _over_spans(threshold: int, name):
    """Documents with lists of spans to named rows; name(first, second, starts, windows, left, pick) works on CHUNK bytes at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, rows = _Names(0xC0FFEE11), _Names(0x5EED1E55), _Combined()
        for batch in batches:
            data, ends = text_bytes(batch.column("text"))
            did, th = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("did", "th"))
            doc, start, n = _flat(batch.column("spans"))
            place = np.unique(np.stack([ends[doc] + start, n, doc]), axis=1)  # repeated rows repeat their spans
            at = 0
            while at < place.shape[1]:
                low = int(place[0, at])
                to = max(at + 1, int(np.searchsorted(place[0], low + CHUNK)))
                where, n, doc = place[:, at:to]
                at = to
                part = data[low : int((where + (n & 0x7FFF)).max()) + threshold - 1]
                first.load(part)
                second.load(part)
                a, s, i, new_start, new_n = name(first, second, where - low, n & 0x7FFF, n >> 15 & 1, n >> 16)
                if len(a):
                    own = doc[i]
                    rows.add(a.view(np.int64), s.view(np.int64), did[own], th[own], new_start + low - ends[own], new_n)
                    yield from rows.flush(COMBINE)
        yield from rows.flush()

    return run


def _flat(spans: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and n of each entry of a column of span lists; null lists are empty."""
    sizes = np.nan_to_num(spans.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = spans.flatten()
    return np.repeat(np.arange(len(spans)), sizes), flat.field(0).to_numpy(zero_copy_only=False).astype(np.int64), flat.field(1).to_numpy(zero_copy_only=False).astype(np.int64)


def _longer(threshold: int, anchor: int):
    """Spans named by the pick and the bytes before it, and by the pick and the bytes after it."""
    half = (threshold - anchor + 1) // 2

    def name(first: _Names, second: _Names, start: np.ndarray, n: np.ndarray, left: np.ndarray, off: np.ndarray):
        pick, whole = start + off, second.at(start, n - 1 + threshold)
        i, j = np.flatnonzero(off >= half), np.flatnonzero(off + anchor + half <= n - 1 + threshold)
        a = np.concatenate([first.at(pick[i] - half, anchor + half), ~first.at(pick[j], anchor + half)])
        k = np.concatenate([i, j])
        side = np.repeat([1, 0], [len(i), len(j)]) << 15
        return a, whole[k], k, start[k], n[k] | side | off[k] << 16

    return name


def _doubled(threshold: int, anchor: int):
    """Windows of spans, named by the ranks of their two halves: those that hold the longer rank that the span shares."""
    half, reach = threshold // 2, (threshold - anchor + 1) // 2

    def name(first: _Names, second: _Names, start: np.ndarray, n: np.ndarray, left: np.ndarray, off: np.ndarray):
        lo = np.where(left == 1, 0, np.maximum(0, off + anchor + reach - threshold))
        hi = np.where(left == 1, np.minimum(n, off - reach + 1), n)
        size = np.maximum(0, hi - lo)
        k = np.repeat(np.arange(len(n)), size)
        at = (start + lo)[k] + np.arange(size.sum()) - (np.cumsum(size) - size)[k]
        at, keep = np.unique(at, return_index=True)
        a = first.at(at, half) ^ (first.at(at + half, threshold - half) * np.uint64(3))
        s = second.at(at, half) + (second.at(at + half, threshold - half) * np.uint64(5))
        return a, s, k[keep], at, np.ones(len(at), np.int64)

    return name


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _cut(threshold: int, with_text: bool):
    fields = _OUT if with_text else pa.schema(list(_OUT)[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = text_bytes(batch.column("text"))
            rows = []
            owner, start, n = _flat(batch.column("spans"))
            off = np.searchsorted(owner, np.arange(len(batch) + 1))
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                text = data[ends[i] : ends[i + 1]]
                lo, hi = start[off[i] : off[i + 1]], n[off[i] : off[i + 1]] & 0x7FFF
                runs = 0
                if len(lo):
                    mark = np.zeros(len(text) + 1, np.int32)
                    np.add.at(mark, lo, 1)
                    np.add.at(mark, lo + hi - 1 + threshold, -1)
                    gone = np.cumsum(mark[:-1]) > 0
                    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    kept = text[~gone].tobytes()
                else:
                    kept = text.tobytes()
                rows.append((doc, len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*rows), fields)], schema=fields)

    return run


def suffix_array_dedup(docs: DataFrame, threshold: int = THRESHOLD, anchor: int = ANCHOR, with_text: bool = False) -> DataFrame:
    """Remove bytes covered by a string of `threshold` bytes that also starts in a document of smaller id.

    Null text counts as empty and a null doc_id as larger than every id. Rows
    that repeat a doc_id are one document to the rule and each gets a row.
    Other columns are ignored. with_text adds the bytes that stay as `kept`.
    """
    if not 2 <= anchor <= threshold < 1 << 15:
        raise ValueError("anchor must be between 2 and threshold, which is below 32768")
    small_batches(docs.sparkSession)
    rows = keyed(docs)
    kinds = "a long, s long, did long, th long, start int, n int, known boolean"
    flag = "kind byte, did long, th long, start int, n int"
    spans = rows.select("did", "th", "text").mapInArrow(_spans(threshold, anchor), kinds)
    settled = materialize(spans.repartition("a").sortWithinPartitions("a", "s", "did").mapInArrow(_settle, flag))

    place = F.struct("start", "n")

    def again(mixed: DataFrame, name) -> DataFrame:
        lists = mixed.where("kind = 1").groupBy("did", "th").agg(F.collect_list(place).alias("spans"))
        named = rows.join(lists, ["did", "th"]).select("did", "th", "text", "spans").mapInArrow(_over_spans(threshold, name), kinds)
        return named.repartition("a").sortWithinPartitions("a", "s", "did").mapInArrow(_settle, flag)

    longer = materialize(again(settled, _longer(threshold, anchor)))
    windows = materialize(again(longer, _doubled(threshold, anchor)))
    discard(longer)
    gone = settled.unionByName(windows).where("kind = 0").groupBy("did", "th").agg(F.collect_list(place).alias("spans"))
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return rows.join(gone, ["did", "th"], "left").select("doc_id", "text", "spans").mapInArrow(_cut(threshold, with_text), out)
