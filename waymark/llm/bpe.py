"""BPE encoding and decoding through a table of distinct words.

Texts are split into words once, in blocks of documents: a block keeps each
document as numbers of the block's own distinct words. Those words, dealt by
their hash into buckets, make the distinct-word table, where each word is
encoded once. A bucket's words join back to every block that holds them, and a
block's words to the places of its documents. For decoding, the distinct ids of
each block join the id-to-piece table, whose size the vocabulary fixes. Words
travel packed, one row for each block and bucket, since a row for each word
would outweigh the text.

A block is bounded by BLOCK_BYTES. Words join back by bucket and range of
blocks; there are as many ranges as keep a group's lists about as large as one
block, so no task grows with the number of blocks. A word that is in every text
is one entry for each block.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from .common import DIGITS, LETTERS, PLAIN, discard, materialize, small_batches

#: Bytes of text in a block, at most, but for a single text that is longer.
BLOCK_BYTES = 32 << 20
#: Rows of the id-to-piece table, at most: it is broadcast, and a block holds its pieces.
MAX_VOCABULARY = 1_000_000
#: Buckets of the distinct-word table, at least and at most; between, one for each shuffle partition.
FEWEST, MOST = 16, 4096

#: Texts of these characters are split here; others by the tokenizer's own normalizer and splitter.
_PLAIN = re.compile(PLAIN).fullmatch
_FIND = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^\t-\r {LETTERS}{DIGITS}]+").findall


class WordSplitter:
    """Words of a text as the tokenizer splits it; special tokens are words of their own."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def words(self, text: str) -> list[str]:
        if self.cut and "<|" in text:
            return [w for part in self.cut.split(text) for w in ([part] if part in self.special else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if _PLAIN(text):
            return _FIND(text.lower())
        normal = self.tokenizer.normalizer.normalize_str(text)
        return [normal[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def encode(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        return [t.id for part, _ in self.bytes.pre_tokenize_str(word) for t in self.tokenizer.model.tokenize(part)]


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(3).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _pack_numbers(x: np.ndarray) -> bytes:
    return _pack(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpack_numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(_unpack(data), np.uint8).reshape(4, -1).T).view("<u4").ravel()


#: bucket -1: documents of the block (ids, sizes and word numbers) and the bucket of each word number; others: the block's words in a bucket, by number.
_BLOCK = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("data", pa.binary()), ("deal", pa.binary())])
_BLOCK_SQL = "block long, bucket int, ids array<long>, sizes array<int>, data binary, deal binary"


def _split(path: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = WordSplitter(path)
        part, made = TaskContext.get().partitionId(), 0
        number: dict[str, int] = {}
        ids, places, size = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal number, ids, places, size, made
            words, flat = list(number), np.concatenate(places)
            # frequent words get small numbers, which pack smaller
            order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
            renumber = np.empty(len(words), np.int64)
            renumber[order] = np.arange(len(words))
            bucket = np.fromiter((zlib.crc32(words[i].encode()) % buckets for i in order.tolist()), np.int64, len(words))
            rows = [(-1, ids, [len(p) for p in places], _pack_numbers(renumber[flat]), _pack_numbers(bucket))]
            by_bucket = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[by_bucket])) + 1
            for own in np.split(by_bucket, cuts) if len(words) else []:
                rows.append((int(bucket[own[0]]), [], [], _pack(" ".join(words[i] for i in order[own].tolist()).encode()), None))
            out = pa.RecordBatch.from_arrays([pa.array([part << 24 | made] * len(rows), pa.int64()), *(pa.array(list(c), f.type) for c, f in zip(zip(*rows), list(_BLOCK)[1:]))], schema=_BLOCK)
            number, ids, places, size, made = {}, [], [], 0, made + 1
            return out

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py()
                words = splitter.words(text)
                places.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)))
                ids.append(doc)
                size += len(text)
                if size >= BLOCK_BYTES:
                    yield flush()
        if ids:
            yield flush()

    return run


_WORDS = pa.schema([("range", pa.int32()), ("bucket", pa.int32()), ("word", pa.string())])


def _unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed words to a row each; words seen just before in the task are left out early."""
    seen: dict[tuple[int, int], set] = {}
    for batch in batches:
        for part, bucket, data in zip(*(batch.column(c).to_pylist() for c in ("range", "bucket", "data"))):
            words = _unpack(data).decode().split(" ")
            known = seen.setdefault((part, bucket), set())
            new = [w for w in words if w not in known]
            if sum(map(len, seen.values())) < 1_000_000:
                known.update(new)
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(new), pa.int32()), pa.array([bucket] * len(new), pa.int32()), pa.array(new, pa.string())], schema=_WORDS)


def _encode(path: str):
    schema = pa.schema([("bucket", pa.int32()), ("word", pa.string()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = WordSplitter(path)
        for batch in batches:
            found = [splitter.encode(w) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("bucket"), batch.column("word"), pa.array(found, schema.field("ids").type)], schema=schema)

    return run


_CODED = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("data", pa.binary())])


def _join_back(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """A bucket's words (right) to each block's list of them (left): their ids, in the list's order."""
    coded = dict(zip(right.column("word").to_pylist(), right.column("ids").to_pylist(), strict=True))
    out = []
    for data in left.column("data").to_pylist():
        out.append(_pack("\n".join([" ".join(map(str, coded[w])) for w in _unpack(data).decode().split(" ")]).encode()))
    return pa.table([left.column("block"), left.column("bucket"), pa.array(out, pa.binary())], schema=_CODED)


_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("ids", pa.string()), ("decoded", pa.string())])


def _distinct_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """block and id of every id that a block's words have in a bucket."""
    for batch in batches:
        for block, data in zip(batch.column("block").to_pylist(), batch.column("data").to_pylist()):
            ids = pa.array({int(x) for x in _unpack(data).split()}, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(ids), pa.int64()), ids], names=["block", "id"])


#: Stands for the bucket of a block's pieces.
_PIECES = -2


def _rebuild(with_text: bool):
    fields = _OUT if with_text else pa.schema(list(_OUT)[:4])

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        """A block's documents (left) from the codes of its words and the pieces of its ids (right)."""
        deal = _unpack_numbers(left.column("deal")[0].as_py())
        ids_text, piece = np.empty(len(deal), object), {}
        for bucket, data in zip(right.column("bucket").to_pylist(), right.column("data").to_pylist()):
            if bucket == _PIECES:
                piece = dict(x.split(" ", 1) for x in data.decode().split("\n"))
            else:
                ids_text[deal == bucket] = _unpack(data).decode().split("\n")
        ids_text = ids_text.tolist()
        pieces = [" ".join([piece[i] for i in x.split(" ")]) for x in ids_text]
        count = np.fromiter((x.count(" ") + 1 for x in ids_text), np.int64, len(ids_text))
        rows = []
        for docs, sizes, data in zip(*(left.column(c).to_pylist() for c in ("ids", "sizes", "data"))):
            places, at = _unpack_numbers(data), 0
            for doc, n in zip(docs, sizes):
                own = places[at : at + n]
                at += n
                listed = own.tolist()
                a, b = " ".join(map(ids_text.__getitem__, listed)), " ".join(map(pieces.__getitem__, listed))
                row = (doc, int(count[own].sum()), hashlib.sha256(a.encode()).hexdigest(), hashlib.sha256(b.encode()).hexdigest(), a, b)
                rows.append(row[: len(fields)])
        return pa.table([pa.array(list(c), f.type) for c, f in zip(zip(*rows), fields)], schema=fields) if rows else fields.empty_table()

    return run


def bpe_round_trip(docs: DataFrame, path: str, buckets: int | None = None, with_text: bool = False) -> DataFrame:
    """Token count and digests of the ids and of the decoded text for every row.

    path: a tokenizer file with the split pattern of WordSplitter. Null texts
    are empty and have no tokens; texts of any length are encoded whole. Null ids
    stay null. Repeated rows each get their row; an empty table gives none; other
    columns are ignored. with_text adds the ids (decimal, joined by spaces) and decoded.
    """
    spark = docs.sparkSession
    small_batches(spark)
    buckets = buckets or min(MOST, max(FEWEST, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    split = rows.mapInArrow(_split(path, buckets), _BLOCK_SQL)
    blocks = materialize(split.withColumn("listed", F.col("bucket") >= 0), by="listed")

    ranges = max(1, -(-blocks.where("not listed").count() // buckets))
    lists = blocks.where("listed").select("block", "bucket", "data", F.pmod(F.xxhash64("block"), F.lit(ranges)).cast("int").alias("range"))
    wanted = lists.select("range", "bucket", "data").mapInArrow(_unfold, "range int, bucket int, word string").distinct()
    if ranges > 1:
        wanted = materialize(wanted)
    words = wanted.select("bucket", "word")
    coded = (words.distinct() if ranges > 1 else words).mapInArrow(_encode(path), "bucket int, word string, ids array<int>")
    vocabulary = Tokenizer.from_file(path).get_vocab()
    if len(vocabulary) > MAX_VOCABULARY:
        raise ValueError("the vocabulary is too large for a task")
    pieces = spark.createDataFrame(pa.table({"id": pa.array(list(vocabulary.values()), pa.int32()), "piece": pa.array(list(vocabulary), pa.string())}))
    table = materialize(coded)
    every = wanted.join(table, ["bucket", "word"]) if ranges > 1 else table.withColumn("range", F.lit(0))  # a word goes to the ranges that hold it
    back = lists.groupBy("bucket", "range").cogroup(every.groupBy("bucket", "range")).applyInArrow(_join_back, "block long, bucket int, data binary")
    back = materialize(back)
    discard(table)
    if ranges > 1:
        discard(wanted)
    discard(blocks, "listed=true")
    own = back.select("block", "data").mapInArrow(_distinct_ids, "block long, id int").distinct().join(F.broadcast(pieces), "id")  # at most MAX_VOCABULARY rows
    decoded = own.groupBy("block").agg(F.array_join(F.collect_list(F.concat("id", F.lit(" "), "piece")), "\n").cast("binary").alias("data"))
    back = back.unionByName(decoded.withColumn("bucket", F.lit(_PIECES)))

    places = blocks.where("not listed").select("block", "ids", "sizes", "data", "deal")
    out = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids string, decoded string" * with_text
    return places.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_rebuild(with_text), out)
