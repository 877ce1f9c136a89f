"""License scans: phrase places, and an exact set-similarity join with license templates.

A text block is a window of consecutive words, one at every offset, SLACK times
as long as the template it is compared with. A block matches if it holds
THRESHOLD of the template's distinct words, among them those that name it.
Words are ordered by how many documents of the corpus hold them, rarest first,
so a matching block must hold one of the template's first words (prefix filter).
Around those words the scan cuts regions: all blocks that hold one lie in one of
them, and of a region only words of templates travel. Regions meet templates in
a join on the prefix words; a pair stays if the region has enough distinct words
(length filter) and if, after the first word they share, both ordered sets still
hold enough words (positional filter). What passes is counted window by window.
Templates are a parameter of a stated bound.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NULL_ID, materialize, small_batches
from .license_texts import TEMPLATES

THRESHOLD = 0.8
#: Words of a block for each word of the template.
SLACK = 1.25
#: Words of all templates together, at most: bounds the counts, the prefix rows and what tasks hold.
MAX_WORDS = 200_000

#: Phrases whose places are counted, and their labels.
PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def _frequencies(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """Documents that hold each word of the templates: at most MAX_WORDS counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                seen.update(vocabulary.intersection(words_of(text.as_py().encode())))
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    rows = docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {r.word.encode(): r.n for r in rows}


class Template:
    """Distinct words in frequency order, the least number of them a block must hold, words that tell it from templates with the same share, and the block's length."""

    def __init__(self, label: str, must: str, text: str, threshold: float) -> None:
        words = words_of(text.encode())
        self.label, self.must, self.words = label, frozenset(words_of(must.encode())), set(words)
        self.need = math.ceil(threshold * len(self.words) - 1e-9)
        self.window = math.ceil(SLACK * len(words))
        self.order: list[bytes] = []

    def prefix(self) -> list[bytes]:
        return self.order[: len(self.order) - self.need + 1]

    def held(self, words: list[tuple[int, bytes]]) -> tuple[int, bool]:
        """Most distinct words of the template in any window, and whether one such window has its telling words; words: (place, word) in order."""
        own = [(i, w) for i, w in words if w in self.words]
        count: Counter = Counter()
        best, lo, tells = 0, 0, False
        for i, w in own:
            count[w] += 1
            while own[lo][0] <= i - self.window:
                gone = own[lo][1]
                count[gone] -= 1
                if not count[gone]:
                    del count[gone]
                lo += 1
            if len(count) >= best:
                tells = (tells and len(count) == best) or self.must <= count.keys()
                best = len(count)
        return best, tells


_REGION = pa.struct([("at", pa.list_(pa.int32())), ("words", pa.list_(pa.string()))])
_SCANNED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())), ("regions", pa.list_(_REGION))])
_SCANNED_SQL = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, regions array<struct<at:array<int>,words:array<string>>>"


def _scan(vocabulary: set[bytes], reach: dict[bytes, int]):
    """reach: for each prefix word the longest block of a template that has it in its prefix."""
    phrases = [(label, p.encode().split()) for label, p in PHRASES.items()]

    def regions(words: list[bytes]) -> list[dict]:
        spans: list[list[int]] = []
        for i, w in enumerate(words):
            far = reach.get(w)
            if far is None:
                continue
            lo, hi = max(0, i - far + 1), i + far
            while spans and spans[-1][1] >= lo:
                last = spans.pop()
                lo, hi = min(lo, last[0]), max(hi, last[1])
            spans.append([lo, hi])
        out = []
        for lo, hi in spans:
            own = [(i, words[i]) for i in range(lo, min(hi, len(words))) if words[i] in vocabulary]
            out.append({"at": [i for i, _ in own], "words": [w.decode() for _, w in own]})
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                low = text.as_py().encode().lower()
                words = _WORD.findall(low)
                places, labels = [], set()
                for label, p in phrases:
                    if p[-1] in low and p[0] in low:
                        found = [i for i, w in enumerate(words) if w == p[0] and words[i : i + len(p)] == p]
                        places += found
                        if found:
                            labels.add(label)
                near = [] if reach.keys().isdisjoint(words) else regions(words)
                out.append((doc, len(words), len(places), min(places, default=None), max(places, default=None), sorted(labels), near))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), _SCANNED)], schema=_SCANNED)

    return run


def candidates(regions: DataFrame, templates: list[Template], rank: dict[bytes, int]) -> DataFrame:
    """Pairs (row, region, template) that pass the prefix, length and positional filters.

    regions: row, region, words. A pair shares no word rarer than the first that
    it shares; from there on each ordered set holds so many words at most.
    """
    spark = regions.sparkSession
    ranks = [(w.decode(), r) for w, r in rank.items()]
    wanted = [(w.decode(), k, i, t.need, len(t.order)) for k, t in enumerate(templates) for i, w in enumerate(t.prefix())]
    word_rank = spark.createDataFrame(ranks, "word string, rank int")
    prefix = spark.createDataFrame(wanted, "word string, template int, at int, need int, size int")
    each = regions.select("row", "region", F.explode(F.array_distinct("words")).alias("word")).join(F.broadcast(word_rank), "word")  # at most MAX_WORDS rows
    own = each.groupBy("row", "region").agg(F.array_sort(F.collect_list(F.struct("rank", "word"))).alias("own"))  # distinct words of templates
    placed = own.select("row", "region", F.size("own").alias("n"), F.posexplode("own").alias("pos", "x")).select("row", "region", "n", "pos", F.col("x.word").alias("word"))
    hits = placed.join(F.broadcast(prefix), "word").where("n >= need")  # at most MAX_WORDS rows
    first = hits.groupBy("row", "region", "template").agg(F.min(F.struct("at", "pos", "n", "need", "size")).alias("x"))
    return first.where("1 + least(x.size - x.at - 1, x.n - x.pos - 1) >= x.need").select("row", "region", "template")


def license_join(docs: DataFrame, templates: list[tuple[str, str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Word count, phrase places and labels for every row of documents.

    labels holds the phrases' labels and those of every template that a block
    meets; score is the largest share of a template that a matching block holds,
    1 with a phrase, else 0. templates: (label, telling words, text); of templates of
    which a text's blocks hold the same share at best, only those whose telling
    words are there too, if there are such.

    Null and empty texts have no words; texts of any length are used whole. Null
    ids stay null. Repeated rows each get their row; an empty table gives none;
    other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    made = [Template(*t, threshold) for t in (TEMPLATES if templates is None else templates)]
    made = [t for t in made if t.words]
    if sum(len(t.words) for t in made) > MAX_WORDS:
        raise ValueError(f"templates have more than {MAX_WORDS} words")
    vocabulary = set().union(*(t.words for t in made))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    seen = _frequencies(rows, vocabulary)
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (seen.get(w, 0), w)))}
    reach: dict[bytes, int] = {}
    for t in made:
        t.order = sorted(t.words, key=rank.get)
        for w in t.prefix():
            reach[w] = max(reach.get(w, 0), t.window)
    scanned = materialize(rows.mapInArrow(_scan(vocabulary, reach), _SCANNED_SQL).withColumn("row", F.monotonically_increasing_id()))
    regions = scanned.select("row", F.posexplode("regions").alias("region", "r")).select("row", "region", F.col("r.at").alias("at"), F.col("r.words").alias("words"))
    pairs = candidates(regions, made, rank).groupBy("row", "region").agg(F.collect_list("template").alias("templates"))  # one entry for each template

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("row", pa.int64()), ("label", pa.string()), ("share", pa.float64()), ("tells", pa.bool_())])
        for batch in batches:
            out = []
            for b in batch.to_pylist():
                words = list(zip(b["at"], (w.encode() for w in b["words"])))
                for k in b["templates"]:
                    held, tells = made[k].held(words)
                    if held >= made[k].need:
                        out.append((b["row"], made[k].label, held / len(made[k].words), tells))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], schema.field(i).type) for i in range(4)], schema=schema)

    good = regions.join(pairs, ["row", "region"]).select("row", "at", "words", "templates").mapInArrow(count, "row long, label string, share double, tells boolean")
    best = good.groupBy("row", "label").agg(F.max(F.struct("share", "tells")).alias("x")).select("row", "label", "x.*")
    # of templates with one share, those whose words tell
    good = best.withColumn("told", F.max("tells").over(Window.partitionBy("row", "share"))).where("tells or not told")  # a row for each template
    labels = good.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    joined = scanned.drop("regions").join(labels, "row", "left")
    every = F.array_sort(F.array_distinct(F.concat("base_labels", F.coalesce("more", F.array().cast("array<string>")))))
    return joined.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
