"""Repair of conversations at least cost, by parallel Viterbi with rank convergence.

A conversation's rows are cut into chunks of bounded size, wherever a task's
share ends. Costs run backwards over the rows as a vector of four: what it takes
to bring the rest to a legal end from the start, after a system row, after a
user row, after an assistant row. Each chunk starts from a speculative vector.
In fix-up passes a chunk takes the vector that the next chunk has come to; it is
run again only if that differs from the one it used by more than a constant, and
only until its own vectors differ from the old ones by a constant. When no chunk
changes, costs are exact up to constants, which add up. Edits are then traced
forwards, the least letter that keeps the cost first: each chunk from all four
states, the outcomes are stitched, and each chunk again from its true state.

Conversations that lie in one chunk, nearly all, are settled where they are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, small_batches

#: Rows and characters of a chunk, rows between vectors that a chunk keeps, and rows times chunks that run together.
ROWS, CHARS, MARK, TOGETHER = 4096, 1 << 20, 64, 1 << 19

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
#: States: start, after a system row, after a user row, after an assistant row. Where an inserted or re-roled row leads from each.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = np.array([USER, USER, ASSISTANT, USER])
#: Where a row of initial s, u, a or another leads from each state; 4: nowhere.
LEADS = np.array([[1, 4, 4, 4], [2, 2, 4, 2], [4, 4, 3, 4], [4, 4, 4, 4]])
#: Cost of a legal end from each state.
END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)
NEVER = np.int64(1) << 60
TRUNCATED, FORCED = 4, 8
_SPACE = "\t\n\x0b\x0c\r "
_ROLE = {USER: "user", ASSISTANT: "assistant"}


def damage(table: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies: rows dropped, emptied, stripped of ends, repeated or given to the user, by crc32 of `conv_id:turn` modulo 20. Nulls are one space."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = table.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(F.encode(key, "utf-8")) % 20).alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return rows.where("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


# ---- one chunk: symbols, costs, edits


def digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()


class Chunk:
    """Rows as symbols: initial, TRUNCATED added, or FORCED for rows that must go; `copies` of each; `row`: the row of each symbol."""

    def __init__(self, turns: list, roles: list[str], texts: list[str], copies: list[int], seen: set[bytes] | None = None) -> None:
        self.roles, self.texts = roles, texts
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        symbols, self.row, counts, known, before = [], [], [], set(), None
        for k, (role, text, n) in enumerate(zip(roles, texts, copies)):
            body, initial = text.strip(_SPACE), role[:1]
            if before is not None:
                self.illegal += before + initial not in ("su", "ua", "au")
            self.illegal += n - 1
            before = initial
            if not body:
                self.blank += n
                self._add(symbols, counts, k, FORCED, n)
                continue
            if (role, text) in known or seen and digest(role, text) in seen:
                self.duplicate += n
                self._add(symbols, counts, k, FORCED, n)
                continue
            known.add((role, text))
            cut = body[-1] not in ".!?"
            self.truncated += cut
            self._add(symbols, counts, k, max("sua".find(initial), 0) + TRUNCATED * cut if initial and initial in "sua" else 3 + TRUNCATED * cut, 1)
            if n > 1:
                self.duplicate += n - 1
                self._add(symbols, counts, k, FORCED, n - 1)
        self.symbols, self.copies = np.array(symbols, np.uint8), np.array(counts, np.int64)
        real = [t for t in turns if t is not None]
        self.first_turn, self.last_turn, self.turns = (real[0], real[-1], len(set(real))) if real else (None, None, 0)
        self.first_initial, self.last_initial = roles[0][:1], roles[-1][:1]

    def _add(self, symbols: list, counts: list, row: int, symbol: int, n: int) -> None:
        symbols.append(symbol)
        counts.append(n)
        self.row.append(row)


def step(after: np.ndarray, symbol: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """Costs before a row, and before what may be inserted in front of it, from those after it: a row of four for each chunk."""
    forced, cut = symbol == FORCED, np.where(symbol & TRUNCATED, CUT_OFF, 0)[:, None]
    go = after + DELETE * copies[:, None]
    padded = np.concatenate([after, np.full((len(after), 1), NEVER)], 1)
    keep = KEEP + cut + np.take_along_axis(padded, LEADS[np.where(forced, 3, symbol & 3)], 1)
    best = np.where(forced[:, None], go, np.minimum(np.minimum(go, keep), REROLE + cut + after[:, NEXT]))
    user = np.minimum(best[:, USER], INSERT + best[:, ASSISTANT])
    return np.stack([np.minimum(best[:, START], INSERT + user), np.minimum(best[:, SYSTEM], INSERT + user), user, np.minimum(best[:, ASSISTANT], INSERT + best[:, USER])], 1)


def batches_by_length(lengths: list[int]) -> Iterator[np.ndarray]:
    """Places of the chunks, longest first, in groups that run together."""
    order = np.argsort(-np.array(lengths, np.int64), kind="stable")
    at = 0
    while at < len(order):
        n = max(1, TOGETHER // max(1, lengths[order[at]]))
        yield order[at : at + n]
        at += n


class Run:
    """Costs of several chunks, the longest first. costs[r, c] are those of chunk c with r rows to go."""

    def __init__(self, chunks: list[tuple[np.ndarray, np.ndarray]], ends: np.ndarray) -> None:
        self.n = np.array([len(s) for s, _ in chunks])
        longest = int(self.n[0])
        self.symbols, self.copies = np.zeros((len(chunks), longest), np.uint8), np.zeros((len(chunks), longest), np.int64)
        for c, (s, k) in enumerate(chunks):  # from the end
            self.symbols[c, : len(s)], self.copies[c, : len(s)] = s[::-1], k[::-1]
        self.costs = np.zeros((longest + 1, len(chunks), 4), np.int64)
        self.costs[0] = ends
        for r in range(longest):
            live = int(np.searchsorted(-self.n, -r, "left"))
            self.costs[r + 1, :live] = step(self.costs[r, :live], self.symbols[:live, r], self.copies[:live, r])

    def starts(self) -> np.ndarray:
        return self.costs[self.n, np.arange(len(self.n))]

    def traced(self, entry: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """letters [chunk, row], inserted before each row [chunk, row + 1; the place behind the rows too, for chunks that are last], and the state at the end."""
        state, chunks = entry.copy(), np.arange(len(self.n))
        letters, inserted = np.zeros(self.symbols.shape, "S1"), np.zeros((len(self.n), self.symbols.shape[1] + 1), np.int8)
        for k in range(self.symbols.shape[1]):
            todo = chunks[self.n > k]
            while len(todo):
                left, x = self.n[todo] - k, state[todo]
                symbol, now, then = self.symbols[todo, left - 1], self.costs[left, todo, x], left - 1
                cut = np.where(symbol & TRUNCATED, CUT_OFF, 0)
                go = DELETE * self.copies[todo, left - 1] + self.costs[then, todo, x] == now
                add = ~go & (INSERT + self.costs[left, todo, NEXT[x]] == now)
                to = np.where(symbol == FORCED, 4, LEADS[np.where(symbol == FORCED, 3, symbol & 3), x])
                keep = ~go & ~add & (to < 4) & (KEEP + cut + self.costs[then, todo, np.minimum(to, 3)] == now)
                other = ~go & ~add & ~keep
                inserted[todo[add], k] += 1
                letters[todo[go], k], letters[todo[keep], k], letters[todo[other], k] = b"D", b"K", b"R"
                state[todo] = np.where(keep, to, np.where(add | other, NEXT[x], x))
                todo = todo[add]
        open_ends = chunks[last]
        while len(open_ends := open_ends[END[state[open_ends]] > 0]):
            inserted[open_ends, self.n[open_ends]] += 1
            state[open_ends] = NEXT[state[open_ends]]
        return letters, inserted, state


def edited(chunk: Chunk, entry: int, letters: np.ndarray, inserted: np.ndarray) -> tuple[str, list[tuple[str, str]]]:
    """Edits as letters and the repaired (role, text) rows of a chunk."""
    audit, rows, state = [], [], entry
    for k in range(len(chunk.symbols) + 1):
        for _ in range(inserted[k]):
            state = int(NEXT[state])
            audit.append("I")
            rows.append((_ROLE[state], ""))
        if k == len(chunk.symbols):
            break
        letter, row = letters[k].decode(), chunk.row[k]
        audit.append(letter * int(chunk.copies[k]))
        if letter == "K":
            state = int(LEADS[chunk.symbols[k] & 3, state])
            rows.append((chunk.roles[row], chunk.texts[row]))
        elif letter == "R":
            state = int(NEXT[state])
            rows.append((_ROLE[state], chunk.texts[row]))
    return "".join(audit), rows


# ---- chunks and pieces as tables


_CHUNK = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("whole", pa.bool_()), ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("copies", pa.list_(pa.int64()))])
_CHUNK_SQL = "conv_id long, place long, whole boolean, turns array<long>, roles array<string>, texts array<string>, copies array<long>"

_PIECE = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
                    ("first_initial", pa.string()), ("last_initial", pa.string()), ("cost", pa.int64()), ("edits", pa.string()), ("rows", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])
_PIECE_SQL = "conv_id long, place long, first_turn long, last_turn long, turns long, blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, cost long, edits string, rows array<struct<role:string,text:string>>"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _chunked(most_rows: int, most_chars: int):
    """Sorted rows to chunks. whole: the conversation surely lies in this chunk alone. place: the task and the number of the chunk in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, first, conv, held, chars, cut = TaskContext.get().partitionId() << 32, True, None, [], 0, False
        out, size = [], 0

        def close(whole: bool) -> None:
            nonlocal place, held, chars, size
            out.append((conv, place, whole, *(list(c) for c in zip(*held))))
            place, held, size, chars = place + 1, [], size + chars, 0

        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text", "copies"))):
                if held and row[0] != conv:
                    close(not first and not cut)
                    first = cut = False
                elif held and (len(held) >= most_rows or chars >= most_chars):
                    close(False)
                    cut = True
                conv = row[0]
                held.append(row[1:])
                chars += len(row[3]) + 32
            if size > 1 << 22:
                yield _batch(out, _CHUNK)
                out, size = [], 0
        if held:
            close(False)  # it may go on in the next task
        if out:
            yield _batch(out, _CHUNK)

    return run


def _of(row: dict, seen: set[bytes] | None = None) -> Chunk:
    return Chunk(row["turns"], row["roles"], row["texts"], row["copies"], seen)


def _piece(row: dict, chunk: Chunk, cost: int, audit: str, rows: list[tuple[str, str]]) -> tuple:
    c = chunk
    return (row["conv_id"], row["place"], c.first_turn, c.last_turn, c.turns, c.blank, c.duplicate, c.truncated, c.illegal, c.first_initial, c.last_initial, cost, audit, [{"role": r, "text": t} for r, t in rows])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with the vector behind them (after), whether they are last, and the state before them (entry), to pieces."""
    for batch in batches:
        rows = batch.to_pylist()
        chunks = [_of(r, set(r["seen"] or ())) for r in rows]
        for group in batches_by_length([len(c.symbols) for c in chunks]):
            run = Run([(chunks[g].symbols, chunks[g].copies) for g in group], np.array([rows[g]["after"] for g in group], np.int64))
            entry = np.array([rows[g]["entry"] for g in group])
            letters, inserted, _ = run.traced(entry, np.array([rows[g]["last"] for g in group]))
            starts, out = run.starts(), []
            for c, g in enumerate(group):
                # behind the first chunk of a conversation only what its vector adds counts
                cost = int(starts[c, entry[c]]) if rows[g]["first"] else int(starts[c].min())
                out.append(_piece(rows[g], chunks[g], cost, *edited(chunks[g], int(entry[c]), letters[c], inserted[c])))
            yield _batch(out, _PIECE)


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order to a row for each conversation; texts only pass through the digest."""
    schema = pa.schema([("conv_id", pa.int64())] + [(n, pa.int64()) for n in COUNTS] + [("audit", pa.string()), ("repaired_sha256", pa.string())])
    now, held = None, []

    def fold(piece: dict) -> None:
        nonlocal now
        if now is None:
            now = dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal", "cost"), 0) | {"conv_id": piece["conv_id"], "first": None, "last": None, "initial": None, "edits": [], "sha": hashlib.sha256(), "empty": True}
        if piece["turns"]:
            now["first"] = piece["first_turn"] if now["first"] is None else now["first"]
            now["turns"] -= piece["first_turn"] == now["last"]
            now["last"] = piece["last_turn"]
        if now["initial"] is not None:
            now["illegal"] += now["initial"] + piece["first_initial"] not in ("su", "ua", "au")
        now["initial"] = piece["last_initial"]
        for n in ("turns", "blank", "duplicate", "truncated", "illegal", "cost"):
            now[n] += piece[n]
        now["edits"].append(piece["edits"])
        for r in piece["rows"]:
            now["sha"].update(("" if now["empty"] else "\n").encode() + f"{r['role']}:{r['text']}".encode())
            now["empty"] = False

    def close() -> None:
        nonlocal now
        gaps = 0 if now["first"] is None else min(now["last"] - now["first"] + 1 - now["turns"], (1 << 63) - 1)
        held.append((now["conv_id"], gaps, now["blank"], now["duplicate"], now["truncated"], now["illegal"], now["cost"], "".join(now["edits"]), now["sha"].hexdigest()))
        now = None

    for batch in batches:
        for piece in batch.to_pylist():
            if now is not None and now["conv_id"] != piece["conv_id"]:
                close()
            fold(piece)
        if held:
            yield _batch(held, schema)
            held = []
    if now is not None:
        close()
        yield _batch(held, schema)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


# ---- fix-up passes over the chunks of conversations that lie in several


_STATE = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("symbols", pa.binary()), ("copies", pa.binary()), ("after", pa.list_(pa.int64())), ("marks", pa.binary()), ("before", pa.list_(pa.int64())), ("ran", pa.int64())])
_STATE_SQL = "conv_id long, place long, symbols binary, copies binary, after array<long>, marks binary, before array<long>, ran long"


def _symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks to states that start from the speculative vector of a conversation's end."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            c = _of(row, set(row["seen"] or ()))
            out.append((row["conv_id"], row["place"], c.symbols.tobytes(), c.copies.tobytes(), END.tolist(), *run_back(c.symbols, c.copies, END)))
        if out:
            yield _batch(out, _STATE)


def run_back(symbols: np.ndarray, copies: np.ndarray, after: np.ndarray, marks: bytes = b"", before: list[int] | None = None) -> tuple[bytes, list[int], int]:
    """Marks (every MARK-th vector), the vector before the chunk, and the rows that were run. With marks and vector of an earlier run: only until they differ by a constant."""
    old = np.frombuffer(marks, np.int64).reshape(-1, 4) if marks else None
    now, new = np.array([after], np.int64), []
    for r in range(len(symbols)):
        if r % MARK == 0:
            k = r // MARK
            if old is not None:
                by = now[0] - old[k]
                if (by == by[0]).all():  # from here on all is as before, by that much higher
                    return np.concatenate([np.array(new, np.int64).reshape(-1, 4), old[k:] + by[0]]).tobytes(), (np.array(before) + by[0]).tolist(), r
            new.append(now[0].copy())
        at = len(symbols) - 1 - r
        now = step(now, symbols[at : at + 1], copies[at : at + 1])
    return np.array(new, np.int64).tobytes(), now[0].tolist(), len(symbols)


def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States with the vector that the next chunk has come to (next; null: unchanged)."""
    for batch in batches:
        out = []
        for s in batch.to_pylist():
            if s["next"] is None:
                out.append(tuple(s[n] for n in _STATE.names[:-1]) + (0,))
            else:
                symbols, copies = np.frombuffer(s["symbols"], np.uint8), np.frombuffer(s["copies"], np.int64)
                out.append((s["conv_id"], s["place"], s["symbols"], s["copies"], s["next"], *run_back(symbols, copies, np.array(s["next"]), s["marks"], s["before"])))
        if out:
            yield _batch(out, _STATE)


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each chunk's edits lead from each of the four states."""
    for batch in batches:
        rows = batch.to_pylist()
        chunks = [(np.frombuffer(r["symbols"], np.uint8), np.frombuffer(r["copies"], np.int64)) for r in rows]
        for group in batches_by_length([len(s) for s, _ in chunks]):
            run = Run([chunks[g] for g in group], np.array([rows[g]["after"] for g in group], np.int64))
            none = np.zeros(len(group), bool)
            states = np.stack([run.traced(np.full(len(group), x), none)[2] for x in range(4)], 1)
            yield pa.RecordBatch.from_arrays([pa.array([rows[g][n] for g in group], pa.int64()) for n in ("conv_id", "place")] + [pa.array(states.tolist(), pa.list_(pa.int64()))], names=["conv_id", "place", "exits"])


def _stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state before each chunk and whether it is a conversation's first, from sorted exits."""
    conv, state, any_yet = None, START, False
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            first = not any_yet or r["conv_id"] != conv
            state = START if first else state
            out.append((r["conv_id"], r["place"], state, first))
            conv, state, any_yet = r["conv_id"], r["exits"][state], True
        if out:
            yield _batch(out, pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("entry", pa.int64()), ("first", pa.bool_())]))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            own = list({digest(role, text) for role, text in zip(r["roles"], r["texts"])})
            yield pa.RecordBatch.from_arrays([pa.array([r["conv_id"]] * len(own), pa.int64()), pa.array([r["place"]] * len(own), pa.int64()), pa.array(own, pa.binary())], names=["conv_id", "place", "digest"])


def _seen_before(chunks: DataFrame) -> DataFrame:
    """Chunks with `seen`: digests of their rows that an earlier chunk of the conversation holds."""
    rows = materialize(chunks.mapInArrow(_digests, "conv_id long, place long, digest binary"))  # a row for each different row of a chunk
    first = rows.groupBy("conv_id", "digest").agg(F.min("place").alias("least"), F.count("*").alias("n")).where("n > 1").withColumnRenamed("conv_id", "c")
    first = first.withColumnRenamed("digest", "d")
    again = rows.join(first, (F.col("d") == rows.digest) & F.col("c").eqNullSafe(rows.conv_id) & (F.col("least") < rows.place))
    listed = again.groupBy("conv_id", "place").agg(F.collect_list("digest").alias("seen"))  # at most a chunk's rows
    return chunks.join(listed.withColumnsRenamed({"conv_id": "c", "place": "p"}), (F.col("p") == chunks.place) & F.col("c").eqNullSafe(chunks.conv_id), "left").drop("c", "p")


def _converged(chunks: DataFrame) -> DataFrame:
    """conv_id, place, symbols, copies, after and last: chunks with the exact vectors behind them, up to constants."""
    states = materialize(chunks.mapInArrow(_symbols, _STATE_SQL))
    while True:
        order = Window.partitionBy("conv_id").orderBy("place")  # small rows, one for each chunk
        ahead = states.select("conv_id", "place", "after", F.lead("before").over(order).alias("ahead"))
        given = F.coalesce(F.transform("ahead", lambda x: x - F.array_min("ahead")), F.array(*(F.lit(int(v)) for v in END)))
        used = F.transform("after", lambda x: x - F.array_min("after"))
        changed = materialize(ahead.where(given != used).select(F.col("conv_id").alias("c"), F.col("place").alias("p"), given.alias("next")))
        if changed.isEmpty():
            discard(changed)
            last = F.lead("place").over(order).isNull()
            return states.withColumn("last", last).select("conv_id", "place", "symbols", "copies", "after", "last")
        old = states
        states = materialize(old.join(changed, (F.col("p") == old.place) & F.col("c").eqNullSafe(old.conv_id), "left").mapInArrow(_again, _STATE_SQL))
        discard(old)
        discard(changed)


def pieces(rows: DataFrame, most_rows: int = ROWS, most_chars: int = CHARS) -> tuple[DataFrame, DataFrame]:
    """Two tables of pieces: conversations that lie in one chunk, and the chunks of the others. A piece has its place in the conversation, counts, edits and repaired (role, text) rows."""
    spark = rows.sparkSession
    small_batches(spark)
    order = ("conv_id", "turn", "role", "text")
    counted = rows.groupBy(*order).agg(F.sum("copies").alias("copies"))  # equal rows of a turn stand together
    chunks = materialize(counted.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_chunked(most_rows, most_chars), _CHUNK_SQL))
    edge = chunks.where("not whole").select("conv_id", "place")
    several = materialize(edge.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv_id").alias("c")))
    alone = chunks.join(several, F.col("c").eqNullSafe(chunks.conv_id), "left_anti")
    none = F.array().cast("array<binary>")
    whole = alone.select("*", none.alias("seen"), F.array(*(F.lit(int(v)) for v in END)).alias("after"), F.lit(True).alias("last"), F.lit(START).alias("entry"), F.lit(True).alias("first")).mapInArrow(_pieces, _PIECE_SQL)
    cut = materialize(_seen_before(chunks.join(several, F.col("c").eqNullSafe(chunks.conv_id), "left_semi")))
    states = materialize(_converged(cut))
    exits = states.mapInArrow(_exits, "conv_id long, place long, exits array<long>")
    entries = exits.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_stitched, "conv_id long, place long, entry long, first boolean")
    ends = states.select(F.col("conv_id").alias("c"), F.col("place").alias("p"), "after", "last")
    known = materialize(entries.join(ends, (F.col("p") == entries.place) & F.col("c").eqNullSafe(entries.conv_id)).select("c", "p", "after", "last", "entry", "first"))
    parts = cut.join(known, (F.col("p") == cut.place) & F.col("c").eqNullSafe(cut.conv_id)).drop("c", "p").mapInArrow(_pieces, _PIECE_SQL)
    return whole, parts


def repair(rows: DataFrame, most_rows: int = ROWS, most_chars: int = CHARS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of conversations (conv_id, turn, role, text, copies).

    Rows go by turn, nulls first; those of one turn by role, then text, so equal
    rows stand together. A null conv_id is a conversation of its own. Roles count
    by their first character; a row with an empty role can't be kept as it is.
    """
    whole, parts = pieces(rows, most_rows, most_chars)
    schema = "conv_id long, " + ", ".join(f"{n} long" for n in COUNTS) + ", audit string, repaired_sha256 string"
    joined = parts.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_folded, schema)
    return whole.mapInArrow(_folded, schema).unionByName(joined)


def damaged_and_repaired(table: DataFrame, most_rows: int = ROWS, most_chars: int = CHARS) -> DataFrame:
    """`repair` of the damaged conversations (conv_id, turn, role, text), with a row for every conv_id there was.

    Null roles and texts are one space; conversations of which no row is left
    have zeros, an empty audit and the digest of nothing; repeated rows count
    each; other columns are ignored; an empty table has no result.
    """
    found = repair(damage(table), most_rows, most_chars).withColumnRenamed("conv_id", "c")
    ids = table.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    both = ids.join(found, F.col("c").eqNullSafe(ids.conv_id), "left")
    return both.select("conv_id", *(F.coalesce(n, F.lit(0)).alias(n) for n in COUNTS), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
