"""Personal data: fixed patterns, and bootstrapped contextual extraction.

Fixed patterns find the seeds. Every other run of characters with four digits or
more is a mention (digit groups with one space between them are one run); the
nearest words around a mention, one or two on a side, and one word beside the
shape of the mention are its contexts. Contexts and the distinct
identifiers in them form a graph, on which Spark scores both sides in turn: a
context is trusted by the share of its identifiers that are known, an unknown
identifier by the trusted contexts it stands in, and what is trusted joins the
known ones of the next round, until a round finds nothing.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, free_names, materialize, small_batches

KINDS = ("email", "ip", "card", "phone")
FOUND = "id"
#: Rounds after which the bootstrap fails rather than stop early; each must find something, so they follow the longest chain of discoveries.
MAX_ROUNDS = 100
#: Known identifiers that a trusted context holds at least, and their least share.
MIN_KNOWN, MIN_SHARE = 3, 0.8
#: Trusted contexts that a new identifier stands in at least, and its least score.
MIN_CONTEXTS, MIN_SCORE = 2, 0.9

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # a match starts where its digits do
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_TOKEN = re.compile(r"\S+")
_GROUP = re.compile(r"[0-9.()/+-]+").fullmatch
_WORD = re.compile(r"[^\W\d_]+")
_ALNUM = re.compile(r"[^\W_]+")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind, then start."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m.group().split(".")))]
        for m in _CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m.group()) if m.end() - m.start() < 64 else ""
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


def shape(what: str) -> str:
    """What an identifier looks like: runs of digits and of mixed letters and digits by their lengths, letters as a, all else as it stands."""
    return _ALNUM.sub(lambda m: f"d{len(m[0])}" if m[0].isdigit() else "a" if m[0].isalpha() else f"x{len(m[0])}", what)


class _Around:
    """Words of a text, found once, to look up the nearest ones before and after a place.

    The patterns of a place: one word or two before it, one or two after it, one on
    each side, and one word beside the shape of what stands there.
    """

    def __init__(self, text: str) -> None:
        self.text = text
        found = [m.span() for m in _WORD.finditer(text)]
        self.starts, self.ends = [a for a, _ in found], [b for _, b in found]

    def contexts(self, start: int, end: int) -> list[str]:
        i, j = bisect_right(self.ends, start) - 1, bisect_left(self.starts, end)
        before, after, what = self._word(i), self._word(j), shape(self.text[start:end])
        wide = [f"{self._word(i - 1)} {before} _"] * (i >= 0) + [f"_ {after} {self._word(j + 1)}"] * (j < len(self.starts))
        return [f"{before} _", f"_ {after}", f"{before} _ {after}", *wide, f"{before} _{what}", f"_{what} {after}"]

    def _word(self, k: int) -> str:
        if 0 <= k < len(self.starts):
            return self.text[self.starts[k] : self.ends[k]].lower()
        return "^" if k < 0 else "$"


def mentions(text: str, base: list[tuple[str, int, int]]) -> list[dict]:
    """Seeds and other identifier-like runs with their contexts."""
    if not base and not _DIGIT.search(text):
        return []
    taken = sorted((a, b) for _, a, b in base)
    runs, k, group = [], 0, -2  # group: where the run ended if it is one of digit groups
    for m in _TOKEN.finditer(text):
        start, end = m.span()
        if not _DIGIT.search(text, start, end):
            continue
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if k < len(taken) and taken[k][0] < end:
            continue
        plain = _GROUP(text, start, end)
        if plain and group == start - 1 and text[group] == " ":
            runs[-1][1] = end
        else:
            runs.append([start, end])
        group = end if plain else -2
    places = []
    for start, end in runs:
        if sum(text.count(c, start, end) for c in "0123456789") < 4:
            continue
        while not (text[start].isalnum() or text[start] == "+"):
            start += 1
        while not text[end - 1].isalnum():
            end -= 1
        places.append((start, end))
    if not base and not places:
        return []
    around = _Around(text)
    found = [(a, b, True) for _, a, b in base] + [(a, b, False) for a, b in places]
    return [{"what": text[a:b].lower(), "seed": seed, "start": a, "end": b, "contexts": around.contexts(a, b)} for a, b, seed in found]


_SCAN_SQL = "doc_id long, did long, th long, base array<struct<kind:string,start:int,end:int>>, mentions array<struct<what:string,seed:boolean,start:int,end:int,contexts:array<string>>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_MENT = pa.struct([("what", pa.string()), ("seed", pa.bool_()), ("start", pa.int32()), ("end", pa.int32()), ("contexts", pa.list_(pa.string()))])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("did", pa.int64()), ("th", pa.int64()), ("base", pa.list_(_SPAN)), ("mentions", pa.list_(_MENT))])
    for batch in batches:
        base, found = [], []
        for text in batch.column("text"):
            text = text.as_py()
            own = base_spans(text)
            base.append([{"kind": k, "start": a, "end": b} for k, a, b in own])
            found.append(mentions(text, own))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("did"), batch.column("th"), pa.array(base, schema.field("base").type), pa.array(found, schema.field("mentions").type)], schema=schema)


def discover(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """Identifiers (what) beyond the seeds that trusted contexts point at, to the last round that finds any. edges: distinct (context, what)."""
    known = seeds.select("what", F.lit(True).alias("seed"))
    for _ in range(MAX_ROUNDS):
        flagged = edges.join(known.select("what", F.lit(1).alias("known")), "what", "left")
        contexts = flagged.groupBy("context").agg(F.sum(F.coalesce("known", F.lit(0))).alias("k"), F.count("*").alias("n"))
        trusted = contexts.where((F.col("k") >= MIN_KNOWN) & (F.col("k") >= MIN_SHARE * F.col("n"))).select("context", (F.col("k") / (F.col("n") + 1)).alias("share"))
        scored = flagged.where("known is null").join(trusted, "context").groupBy("what").agg(F.count("*").alias("n"), (1 - F.exp(F.sum(F.log(1 - F.col("share"))))).alias("score"))
        new = materialize(scored.where((F.col("n") >= MIN_CONTEXTS) & (F.col("score") >= MIN_SCORE)).select("what", F.lit(False).alias("seed")))
        if new.isEmpty():
            return known.where("not seed").select("what")
        known = known.union(new)
    raise RuntimeError(f"identifiers are still found after {MAX_ROUNDS} rounds")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, did, th (row keys), base and spans (arrays of kind, start, end in code points) for every row.

    Null texts are empty; texts and words of any length are used whole. Spans are
    ordered by kind as listed, found ones last, then start. Repeated rows each get
    their row; an empty table gives none; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("did"), F.xxhash64(text).alias("th"), text.alias("text"))
    scanned = materialize(rows.mapInArrow(_scan, _SCAN_SQL).withColumn("row", F.monotonically_increasing_id()))
    each = scanned.select("row", F.inline("mentions"))
    edges = materialize(each.select(F.explode("contexts").alias("context"), "what").distinct())
    seeds = materialize(each.where("seed").select("what").distinct())
    new = discover(edges, seeds)
    more = each.where("not seed").join(new, "what", "left_semi").groupBy("row").agg(F.sort_array(F.collect_list(F.struct(F.lit(FOUND).alias("kind"), "start", "end"))).alias("more"))
    joined = scanned.join(more, "row", "left")
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return joined.select("doc_id", "did", "th", "base", F.concat("base", F.coalesce("more", none)).alias("spans"))


def _listed(column: str):
    return F.expr(f"array_join(transform({column}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')")


def personal_data_report(docs: DataFrame) -> DataFrame:
    """Counts of the fixed patterns, their digest, and all spans as text, for every row."""
    found = personal_data(docs)
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """documents with each span replaced by its kind in angle brackets and n_chars renewed; overlapping spans become one.

    All columns stay, whatever their names. Null texts stay null; rows that
    repeat doc_id and text share their spans; an empty table stays empty.
    """
    d, t, found = free_names(docs, "did", "th", "found_spans")
    keys = docs.withColumns({d: F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), t: F.xxhash64(F.coalesce("text", F.lit("")))})
    spans = personal_data(docs).where("size(spans) > 0").select(F.col("did").alias(d), F.col("th").alias(t), F.col("spans").alias(found)).dropDuplicates([d, t])

    names, kinds = docs.columns, docs.schema
    at_text, at_size = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def cut(text: str, spans: list[dict]) -> str:
        out, at = [], 0
        for s in sorted(spans, key=lambda x: (x["start"], -x["end"])):
            if s["start"] >= at:
                out += [text[at : s["start"]], f"<{s['kind'].upper()}>"]
            at = max(at, s["end"])
        return "".join(out) + text[at:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(at_text).to_pylist(), batch.column(len(names)).to_pylist()
            texts = [cut(x, s) if s else x for x, s in zip(texts, spans)]
            columns = [batch.column(i) for i in range(len(names))]
            columns[at_text] = pa.array(texts, pa.string())
            if at_size is not None:
                sizes = [len(x) if s else n for x, s, n in zip(texts, spans, columns[at_size].to_pylist())]
                columns[at_size] = pa.array(sizes, columns[at_size].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    small_batches(docs.sparkSession)
    return keys.join(spans, [d, t], "left").select(*names, found).mapInArrow(run, kinds)
