"""Token ids in an entropy-coded file: static range asymmetric numeral systems.

Token counts over all documents give one frequency table, which every block
shares. A block is a run of the id stream, dealt round robin over LANES coder
states that advance together, so coding and decoding are array operations. It
is decoded without any other block; each of its segments starts from a stored
checkpoint (states and place in the words) and has its own checksum, so a
segment can be decoded alone too. The file is a folder with a table of blocks,
in the order of the id stream, and the frequency table; nothing else is needed
to read it. Blocks also list the documents in them, by their numbers of ids.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import DIGITS, LETTERS, NULL_ID, PLAIN, materialize, shared_dir, small_batches, text_bytes

END_ID = 2
#: States of a block, steps of them in a segment, and segments in a block.
LANES, STEPS, SEGMENTS = 1024, 128, 2
#: Bits of the sum of all frequencies.
SCALE = 20
LOW = np.uint64(1 << 31)
#: Bytes of the batches whose distinct pieces are merged at once, and pieces whose ids are gathered at once.
GROUP, SPAN = 8 << 20, 1 << 18

_PLAIN = re.compile(PLAIN).fullmatch
#: Kinds of bytes. A character of two bytes has the kind of its letter, digit or symbol in both; OTHER is in no plain text.
OTHER, SPACE, LETTER, DIGIT, SYMBOL, LEAD = range(6)


def _kind(c: str) -> int:
    if not _PLAIN(c):
        return OTHER
    return SPACE if c in "\t\n\v\f\r " else LETTER if re.match(f"[{LETTERS}]", c) else DIGIT if re.match(f"[{DIGITS}]", c) else SYMBOL


_BYTES = np.array([LEAD if 0xC2 <= b <= 0xC5 else _kind(chr(b)) if b < 0x80 else OTHER for b in range(256)], np.uint8)
_PAIRS = np.array([_kind(chr(c)) for c in range(0x80, 0x180)], np.uint8)  # characters of lead bytes C2 to C5


def _kinds(data: np.ndarray) -> np.ndarray:
    """The kind of each byte of UTF-8 texts."""
    out = _BYTES[data]
    lead = out == LEAD
    if lead.any():
        follow = np.append(data[1:], np.uint8(0))[lead]
        kind = np.where((follow & 0xC0) == 0x80, _PAIRS[((data[lead] - 0xC2) << 6) + (follow & 0x3F)], OTHER)
        out[lead] = kind
        second = lead[:-1]
        out[1:][second] = kind[: second.sum()]
    return out


def _piece_starts(data: np.ndarray, kinds: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the pieces of plain texts begin: `'s|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?[^\\sLN]+|\\s+(?!\\S)|\\s+`. starts: first bytes of the texts.

    A run of one kind is a piece, but takes a blank before it along; what else is
    white space before other characters leaves its last one by itself.
    """
    n = len(data)
    first = np.zeros(n + 1, bool)
    first[starts] = True
    first[n] = True
    run = first.copy()
    run[1:n] |= kinds[1:] != kinds[:-1]
    out = run[:n].copy()
    out[1:] &= (data[:-1] != 32) | first[1:n]
    out[:-1] |= (kinds[:-1] == SPACE) & run[1:n] & ~first[1:n]
    at = np.flatnonzero((data == 39) & out & run[:n])  # apostrophes with no symbol and no blank before them
    at = at[~first[at + 1]]
    one, two = data[at + 1], np.where(first[at + 2], 0, data[np.minimum(at + 2, n - 1)])
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    out[at[short | long] + 1] = False
    ends = np.concatenate([at[short] + 2, at[long] + 3])
    out[ends[ends < n]] = True
    return np.flatnonzero(out)


def _places(data: bytes, part: bytes) -> Iterator[int]:
    at = data.find(part)
    while at >= 0:
        yield at
        at = data.find(part, at + 1)


def _parted(words: pa.Array) -> str:
    """The words, each with a zero character after it."""
    data, offsets = text_bytes(words)
    out, own = np.zeros(len(data) + len(words), np.uint8), np.ones(len(data) + len(words), bool)
    own[offsets[1:] + np.arange(len(words))] = False
    out[own] = data
    return out.tobytes().decode()


def _ranks(tokenizer: Tokenizer) -> dict[bytes, int]:
    """The byte strings of a byte-level vocabulary, whose ids are its merge ranks."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    special = tokenizer.get_added_tokens_decoder()
    return {bytes(letter[c] for c in piece): i for piece, i in tokenizer.get_vocab().items() if i not in special}


class Encoder:
    """Ids of texts as the tokenizer gives them.

    Plain texts are split into the tokenizer's pieces, a batch of texts at once;
    each distinct piece of a batch is merged once, by tiktoken over the
    tokenizer's own ranks. Other texts, and those with special tokens, go through
    the tokenizer whole.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = _ranks(self.tokenizer)
        self.end = ranks[b"\0"]  # no plain text has this byte: it parts pieces
        self.merge = tiktoken.Encoding("own", pat_str=r"\x00|[^\x00]+", mergeable_ranks=ranks, special_tokens={}).encode_to_numpy

    def _merged(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces that begin at starts, and how many each has."""
        cut = np.append(starts, len(data))
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cut), pa.py_buffer(data)]).dictionary_encode()
        own = self.merge(_parted(words.dictionary))
        end, which = np.flatnonzero(own == self.end), words.indices.to_numpy()
        begin = np.append(0, end[:-1] + 1)[: len(end)]
        n = (end - begin).astype(np.int32)[which]
        ids = [np.zeros(0, np.uint32)]
        for at in range(0, len(n), SPAN):
            some = n[at : at + SPAN]
            ids.append(own[np.repeat(begin[which[at : at + SPAN]] - np.cumsum(some) + some, some) + np.arange(some.sum())])
        return np.concatenate(ids), n

    def encode_all(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text of a column without nulls."""
        data, offsets = text_bytes(column)
        kinds, size = _kinds(data), np.diff(offsets)
        plain, whole = np.ones(len(size), bool), data.tobytes()
        plain[size > 0] = ~np.logical_or.reduceat(kinds == OTHER, offsets[:-1][size > 0]) if len(data) else True
        for s in self.special:
            plain[np.searchsorted(offsets, list(_places(whole, s)), "right") - 1] = False
        if not plain.all():
            keep = np.repeat(plain, size)
            data, kinds = np.ascontiguousarray(data[keep]), kinds[keep]
        edges = np.concatenate([[0], np.cumsum(size[plain])])
        starts = _piece_starts(data, kinds, edges) if len(data) else np.zeros(0, np.int64)
        ids, counts = self._merged(data, starts)
        cut = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, edges)]
        own = iter(zip(cut[:-1].tolist(), cut[1:].tolist()))
        out = []
        for i, p in enumerate(plain.tolist()):
            if p:
                a, b = next(own)
                out.append(ids[a:b])
            else:
                out.append(np.array(self.tokenizer.encode(column[i].as_py(), add_special_tokens=False).ids, np.uint32))
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all(pa.array([text], pa.large_string()))[0]


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder for each worker."""
    return Encoder(path)


def larger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in groups of GROUP bytes or a little more."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= GROUP:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**SCALE, one at least for each id that occurs."""
    total = max(1, int(counts.sum()))
    out = np.where(counts > 0, np.maximum(1, counts.astype(object) * (1 << SCALE) // total), 0).astype(np.int64)
    if out.sum():
        spare = (1 << SCALE) - int(out.sum())
        order = np.argsort(-out, kind="stable")
        at = 0
        while spare:  # to or from the most frequent
            i = order[at % len(order)]
            step = spare if spare > 0 else -min(-spare, int(out[i]) - 1)
            out[i] += step
            spare -= step
            at += 1
    return out


class Table:
    """Start, size and symbol of each slot, from frequencies that sum to 2**SCALE."""

    def __init__(self, scaled: np.ndarray) -> None:
        self.size = scaled.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(scaled)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(scaled), dtype=np.uint32), scaled)

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, int]]]:
        """Words in reading order, and (states, first word) of each segment."""
        steps = -(-len(ids) // LANES)
        grid = np.full(steps * LANES, ids[-1], np.uint32)
        grid[: len(ids)] = ids
        grid = grid.reshape(steps, LANES)
        x = np.full(LANES, LOW, np.uint64)
        words, points, written = [], [], 0
        scale, shift = np.uint64(SCALE), np.uint64(32)
        for t in range(steps - 1, -1, -1):
            f = self.size[grid[t]]
            full = x >= ((LOW >> scale) << shift) * f
            words.append((x[full] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            written += len(words[-1])
            x[full] >>= shift
            x = ((x // f) << scale) + x % f + self.start[grid[t]]
            if t % STEPS == 0:
                points.append((x.copy(), written))
        flat = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
        return flat, [(s, written - w) for s, w in points[::-1]]

    def decode(self, words: np.ndarray, states: np.ndarray, at: int, n: int) -> np.ndarray:
        """n ids from a checkpoint on."""
        x, out = states.copy(), []
        scale, mask, shift = np.uint64(SCALE), np.uint64((1 << SCALE) - 1), np.uint64(32)
        words = words.astype(np.uint64)
        for _ in range(-(-n // LANES)):
            slot = x & mask
            s = self.symbol[slot]
            out.append(s)
            x = self.size[s] * (x >> scale) + slot - self.start[s]
            low = x < LOW
            k = int(low.sum())
            x[low] = (x[low] << shift) | words[at : at + k]
            at += k
        return np.concatenate(out)[:n]


_IDS = pa.schema([("doc_id", pa.int64()), ("did", pa.int64()), ("th", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])


def _tokens(path: str, end: int):
    import zstandard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, pack = encoder(path), zstandard.ZstdCompressor(1)
        for batch in larger(batches):
            found = [np.append(x, np.uint32(end)) for x in own.encode_all(batch.column("text"))]
            data = [pack.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 4).T).tobytes()) for x in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("did"), batch.column("th"), pa.array([len(x) for x in found], pa.int64()), pa.array(data, pa.binary())], schema=_IDS)

    return run


def _unpacked(data: bytes) -> np.ndarray:
    import zstandard

    return np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1, np.int64)
    for batch in batches:
        own = np.bincount(np.concatenate([_unpacked(data) for data in batch.column("ids").to_pylist()] or [np.zeros(0, np.uint32)]))
        if len(own) > len(total):
            own[: len(total)] += total
            total = own
        else:
            total[: len(own)] += own
    ids = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])


#: part and block: the order of blocks; first: ids of the part before it. docs: the documents in it, with how many of their ids are here.
_BLOCK_SQL = "part int, block int, first long, n int, words binary, states binary, points array<int>, checks array<long>, docs array<struct<doc_id:long,row:long,n:int>>"


def _write(table: Table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, first, row = TaskContext.get().partitionId(), 0, 0, 0
        room = LANES * STEPS * SEGMENTS
        schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n", pa.int32()), ("words", pa.binary()), ("states", pa.binary()), ("points", pa.list_(pa.int32())), ("checks", pa.list_(pa.int64())), ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("row", pa.int64()), ("n", pa.int32())])))])
        held, docs, size = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal block, first, held, docs, size
            ids = np.concatenate(held)
            words, points = table.encode(ids)
            step = LANES * STEPS
            checks = [zlib.crc32(ids[i : i + step].astype("<u4").tobytes()) for i in range(0, len(ids), step)]
            out = (part, block, first, len(ids), words.astype("<u4").tobytes(), np.concatenate([p[0] for p in points]).astype("<u8").tobytes(), [p[1] for p in points], checks, docs)
            block, first, held, docs, size = block + 1, first + len(ids), [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(out, schema)], schema=schema)

        for batch in batches:
            for doc, data in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                ids = _unpacked(data)
                at = 0
                while at < len(ids):
                    take = min(room - size, len(ids) - at)
                    held.append(ids[at : at + take])
                    docs.append({"doc_id": doc, "row": part << 40 | row, "n": take})
                    at, size = at + take, size + take
                    if size == room:
                        yield flush()
                row += 1
        if size:
            yield flush()

    return run


def _read(table: Table):
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("crc", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                ids = decode_block(table, b)
                rows, at = [], 0
                for d in b["docs"]:
                    own = ids[at : at + d["n"]]
                    rows.append((d["doc_id"], d["row"], b["base"] + b["first"] + at, len(own), zlib.crc32(own.astype("<u4").tobytes())))
                    at += len(own)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def decode_block(table: Table, block: dict) -> np.ndarray:
    """Ids of a block, segment by segment from its checkpoints; a wrong checksum is an error."""
    words, states = np.frombuffer(block["words"], "<u4"), np.frombuffer(block["states"], "<u8").reshape(-1, LANES)
    step, out = LANES * STEPS, []
    for k, (at, check) in enumerate(zip(block["points"], block["checks"])):
        ids = table.decode(words, states[k].astype(np.uint64), at, min(step, block["n"] - k * step))
        if zlib.crc32(ids.astype("<u4").tobytes()) != check:
            raise ValueError(f"block {block['part']}/{block['block']}, segment {k}: checksum")
        out.append(ids)
    return np.concatenate(out)


_POLY = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2) modulo the checksum's."""
    out = 0
    while a:
        if a & 0x80000000:
            out ^= b
        a = (a << 1) & 0xFFFFFFFF
        b = (b >> 1) ^ (_POLY if b & 1 else 0)
    return out


def crc_joined(parts: list[tuple[int, int]]) -> int:
    """crc32 of a concatenation from (crc32, bytes) of its parts."""
    total = 0
    for crc, n in parts:
        power, square, k = 0x80000000, 0x00800000, n
        while k:
            if k & 1:
                power = _times(power, square)
            square, k = _times(square, square), k >> 1
        total = _times(power, total) ^ crc
    return total


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole documents from the pieces of their ids, in order of place."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for batch in batches:
        rows = []
        for doc, pieces in zip(batch.column("doc_id").to_pylist(), batch.column("pieces").to_pylist()):
            crc = crc_joined([(p["crc"], 4 * p["n"]) for p in pieces]) if len(pieces) > 1 else pieces[0]["crc"]
            rows.append((doc, pieces[0]["at"], sum(p["n"] for p in pieces), crc))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def write_tokens(docs: DataFrame, path: str, end: int = END_ID) -> str:
    """Write the ids of all texts, in ascending doc_id order with `end` after each, to a new folder, and return it.

    Ties of doc_id are ordered by text hash; null ids come last; null texts are
    empty; texts of any length are encoded whole; repeated rows are written each;
    an empty table gives a file without blocks; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("did"), F.xxhash64(text).alias("th"), text.alias("text"))
    tokens = materialize(rows.mapInArrow(_tokens(path, end), "doc_id long, did long, th long, n long, ids binary"))
    counted = tokens.select("ids").mapInArrow(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()  # a row for each id of the vocabulary
    counts = np.zeros(max((r.id for r in counted), default=0) + 1, np.int64)
    for r in counted:
        counts[r.id] = r.n
    sizes = scaled(counts)
    place = shared_dir(spark)
    spark.createDataFrame([(int(i), int(sizes[i])) for i in np.flatnonzero(sizes)], "id long, size long").coalesce(1).write.parquet(f"{place}/frequencies")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = tokens.repartitionByRange(parts, "did", "th").sortWithinPartitions("did", "th").select("doc_id", "ids").mapInArrow(_write(Table(sizes)), _BLOCK_SQL)
    blocks.write.option("compression", "none").parquet(f"{place}/blocks")
    return place


def read_table(spark: SparkSession, place: str) -> Table:
    """The frequency table of a file: a row for each id of the vocabulary that occurs."""
    rows = spark.read.parquet(f"{place}/frequencies").collect()
    sizes = np.zeros(max((r.id for r in rows), default=0) + 1, np.int64)
    for r in rows:
        sizes[r.id] = r.size
    if sizes.sum() not in (0, 1 << SCALE):
        raise ValueError(f"{place}: the frequencies don't sum to {1 << SCALE}")
    return Table(sizes)


def read_tokens(spark: SparkSession, place: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the file alone."""
    table, blocks = read_table(spark, place), spark.read.parquet(f"{place}/blocks")
    totals = blocks.groupBy("part").agg(F.sum("n").alias("n"))  # a row for each part of the file
    base = totals.select("part", (F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("base"))
    small_batches(spark)
    pieces = blocks.join(F.broadcast(base), "part").mapInArrow(_read(table), "doc_id long, row long, at long, n long, crc long")
    whole = pieces.groupBy("row").agg(F.min("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("at", "n", "crc"))).alias("pieces"))  # pieces of one text
    return whole.select("doc_id", "pieces").mapInArrow(_joined, "doc_id long, start long, n_tokens long, ids_crc32 long")


def rans_round_trip(docs: DataFrame, path: str, end: int = END_ID) -> DataFrame:
    """Write all documents' ids to a file and read doc_id, start, n_tokens and ids_crc32 back from it; rows are taken as in `write_tokens`."""
    return read_tokens(docs.sparkSession, write_tokens(docs, path, end))
