import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from waymark.llm import rans_tokens as m
from waymark.llm.bpe import bpe_round_trip

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def texts():
    rnd = random.Random(8)
    alphabet = list("ab Z\t\n'sté İΣς9²ºµ½日本ñÑ\u0085 \x1c .,!?|%😀ﬁⅣ") + ["'ll", "'d", "<|endoftext|>", "\r\n", "The ", " word"]
    out = [None, "", " ", "<|startoftext|>x<|endoftext|>", "a" * 3000, " ".join(f"w{i % 97}" for i in range(9000))]
    return out + ["".join(rnd.choices(alphabet, k=rnd.randint(0, 60))) for _ in range(150)]


def test_bpe_equals_the_library(spark, monkeypatch):
    from waymark.llm import bpe

    rows = [(i // 2 * 3, t, "clash") for i, t in enumerate(texts())] + [(None, "null id", "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    t = Tokenizer.from_file(WORD)
    want = []
    for d, text, _ in rows:
        e = t.encode(text or "", add_special_tokens=False)
        back = t.decode(e.ids, skip_special_tokens=False)
        want.append((d, len(e.ids), hashlib.sha256(" ".join(map(str, e.ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    for size, buckets in ((bpe.BLOCK_BYTES, None), (500, None), (500, 2)):  # the last with many ranges of blocks
        monkeypatch.setattr(bpe, "BLOCK_BYTES", size)
        got = [tuple(r) for r in bpe_round_trip(docs, WORD, buckets).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert bpe_round_trip(docs.limit(0), WORD).count() == 0
    full = bpe_round_trip(docs, WORD, with_text=True).where("doc_id = 9").first()
    assert hashlib.sha256(full.ids.encode()).hexdigest() == full.ids_sha256


def test_rans_round_trip_equals_the_library(spark):
    rows = [(500 - i // 2 * 3, t) for i, t in enumerate(texts())] + [(None, "null id"), (100000, "the " * 140000)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, ids string, start int").repartition(3)
    t = Tokenizer.from_file(BYTE)
    got = m.rans_round_trip(docs, BYTE).collect()
    want = {}
    for d, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        want.setdefault(d, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    known = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert known[:-1] == sorted(known[:-1]) and known[-1] is None
    assert m.rans_round_trip(docs.limit(0), BYTE).count() == 0


def test_segments_decode_alone_and_checksums_catch_damage(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * 1600) for i in range(600)], "doc_id long, text string")
    place = m.write_tokens(docs, BYTE)
    table, blocks = m.read_table(spark, place), spark.read.parquet(f"{place}/blocks")
    block = max((r.asDict(recursive=True) for r in blocks.collect()), key=lambda b: b["n"])
    whole = m.decode_block(table, block)
    assert len(block["points"]) == 2
    words, states = np.frombuffer(block["words"], "<u4"), np.frombuffer(block["states"], "<u8").reshape(-1, m.LANES)
    step = m.LANES * m.STEPS
    tail = table.decode(words, states[1].astype(np.uint64), block["points"][1], block["n"] - step)
    assert (tail == whole[step:]).all()
    bad = bytearray(block["words"])
    bad[10] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        m.decode_block(table, block | {"words": bytes(bad)})


def test_pieces_equal_the_library_on_the_tables():
    """Texts that are split and merged piece by piece, against the tokenizers library on whole texts."""
    import pyarrow.parquet as pq

    own = m.Encoder(BYTE)
    texts = [x or "" for x in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()]
    assert sum(m._PLAIN(x) is not None for x in texts) > len(texts) // 2
    for text, want in zip(texts, own.tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert own.encode(text).tolist() == want.ids


def test_a_batch_of_texts_is_split_and_merged_at_once():
    """Pieces of whole batches equal the library's, on texts made of what is hard to split; the merge is called once for a batch."""
    rnd = random.Random(5)
    parts = [*"'stmdrvel  \t\n\r!?1²¾ªµºéĀſ×÷¡", "'ll", "'ve", "'re", "'LL", " '", "''", "  ", "\n ", " \n", "word", "日", "\u00a0", "\u0085", "\x1c", "\x00", "ƀ", "😀", "<|endoftext|>", "<|endof", "text|>"]
    plain = [x for x in parts if m._PLAIN(x) and "|" not in x]
    texts = ["".join(rnd.choices(plain if i % 4 else parts, k=rnd.randint(0, 12))) for i in range(20_000)] + ["", "'", "it's", "'s's", "a'", " ", "x" * 9000, "<|endof", "text|>", ""]
    own, calls = m.Encoder(BYTE), []
    merge = own.merge
    own.merge = lambda text: calls.append(len(text)) or merge(text)
    want = [x.ids for x in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for kind in (pa.string(), pa.large_string()):
        assert [x.tolist() for x in own.encode_all(pa.array(texts, kind))] == want
    assert [x.tolist() for x in own.encode_all(pa.array(texts).slice(11, 5000))] == want[11:5011]
    assert len(calls) == 3 and own.encode_all(pa.array([], pa.string())) == []
    assert calls[0] < sum(map(len, texts)) / 2  # repeated pieces are merged once


def test_batches_are_grouped_whole(monkeypatch):
    monkeypatch.setattr(m, "GROUP", 1000)
    batches = [pa.RecordBatch.from_arrays([pa.array(range(k, k + 7)), pa.array(["y" * 30] * 7)], names=["doc_id", "text"]) for k in range(0, 70, 7)]
    got = list(m.larger(iter(batches)))
    assert 1 < len(got) < 10 and [i for b in got for i in b.column("doc_id").to_pylist()] == list(range(70))


def test_a_file_with_other_frequencies_is_refused(spark):
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    place = m.write_tokens(docs, BYTE)
    stored = spark.read.parquet(f"{place}/frequencies").collect()
    assert sum(r["size"] for r in stored) == 1 << m.SCALE and {r.id for r in stored} == {*Tokenizer.from_file(BYTE).encode("one two").ids, 2}
    spark.createDataFrame([(1, 5)], "id long, size long").write.mode("overwrite").parquet(f"{place}/frequencies")
    with pytest.raises(ValueError, match="frequencies"):
        m.read_tokens(spark, place)
