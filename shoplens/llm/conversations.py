"""Repair of conversation structure (operator 12).

A repaired conversation's role initials read ``(s?(ua)+)?``.  Edits are Keep
(0), Rerole to user or assistant (1), Delete (2) and Insert of an empty turn
(5); a truncated row that is not deleted adds 5, and blank and duplicate rows
must go.  The cheapest edits are a shortest path over four states (nothing yet,
after a system, a user, an assistant row), and of equal paths the one whose
letters come first in ASCII is taken.

*Four Russians.*  What is left to pay after a row is a vector of four costs.
Less their smallest they are one of a few vectors, whatever follows, so a
row's step is a table from vector to vector, and so is a block of ``BLOCK``
rows: ``tables`` composes them for every block of symbols.  Blocks are looked
up from the last row to the first.  The trace goes forward and expands each
block backward once more, because which edits are cheapest, and hence which
come first in ASCII, depends on what the rest costs; expansions are kept by
(vector behind, block, state before).

*On Spark.*  Rows are ranged over partitions by conversation and order, so a
long conversation spans many; each partition cuts its rows into chunks and
gives a chunk's table from vector behind to vector before.  The vectors meet
the chunks in one stream per conversation, in order, of which only the
digest, the letters and the state are held.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

START, SYSTEM, USER, ASSISTANT = range(4)
#: Symbols of a row: to be deleted; whole by role initial s, u, a or another;
#: truncated likewise; and one that fills a chunk's last block.
GONE, WHOLE, CUT, FILL, SYMBOLS = 0, 1, 5, 9, 10
RESTORE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLOCK = 4
#: Rows and characters of a chunk (one row at least).
CHUNK_ROWS, CHUNK_CHARS = 512, 16_384
#: The state that an inserted or reroled row leads to, and its role.
_PUT = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: The state that a kept row with initial s, u or a leads to, where allowed.
_KEEP = ({0: SYSTEM, 1: USER}, {1: USER}, {2: ASSISTANT}, {1: USER})
_LEGAL = {"su", "ua", "au"}
_FIRST_CRC_STEPS = 20


# --- one row ---------------------------------------------------------------------

def _edits(state: int, symbol: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after) of the edits that take the row."""
    out = [("D", DELETE, state)]
    if symbol != GONE:
        extra = TRUNCATED if symbol >= CUT else 0
        after = _KEEP[state].get((symbol - WHOLE) % 4)
        if after is not None:
            out.append(("K", extra, after))
        out.append(("R", RESTORE + extra, _PUT[state]))
    return out


def _step(behind: tuple, symbol: int) -> tuple:
    """Costs before a row from the costs behind it."""
    if symbol == FILL:
        return behind
    take = [min(cost + behind[after] for _, cost, after in _edits(q, symbol)) for q in range(4)]
    one = [min(take[q], INSERT + take[_PUT[q]]) for q in range(4)]
    return tuple(min(one[q], INSERT + one[_PUT[q]]) for q in range(4))


def _less(costs: tuple) -> tuple:
    return tuple(c - min(costs) for c in costs)


@lru_cache(maxsize=1)
def tables() -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """(vectors, step by symbol, step by block): all normalised vectors that can
    stand behind a row, the first being the end's, and where a symbol or a
    block (its symbols as digits, the first the highest) takes each."""
    vectors = [_less((0, 2 * INSERT, INSERT, 0))]
    steps = []
    for v in vectors:  # grows while new vectors turn up
        row = []
        for symbol in range(SYMBOLS):
            w = _less(_step(v, symbol))
            if w not in vectors:
                vectors.append(w)
            row.append(vectors.index(w))
        steps.append(row)
    single = np.array(steps, np.uint16)
    block = single
    for _ in range(BLOCK - 1):  # one more symbol in front
        block = np.moveaxis(single[block], -1, 1).reshape(len(vectors), -1)
    return vectors, single, block


def blocks_of(symbols: bytes) -> np.ndarray:
    """Symbols as block numbers, the last block filled."""
    digits = np.full(-(-len(symbols) // BLOCK) * BLOCK, FILL, np.int64)
    digits[: len(symbols)] = np.frombuffer(symbols, np.uint8)
    return digits.reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))


def chunk_step(symbols: bytes) -> bytes:
    """Where the chunk takes every vector."""
    vectors, _, table = tables()
    at = np.arange(len(vectors))
    for block in blocks_of(symbols)[::-1].tolist():
        at = table[at, block]
    return at.astype("<u2").tobytes()


@lru_cache(maxsize=400_000)
def _expand(behind: int, block: int, state: int) -> tuple[tuple[str, ...], int, int]:
    """(letters of each row, cost, state after) of a block's cheapest edits,
    ASCII-least among equals."""
    vectors, single, _ = tables()
    symbols = [block // SYMBOLS**i % SYMBOLS for i in range(BLOCK - 1, -1, -1)]
    after = [behind]
    for symbol in reversed(symbols):
        after.append(int(single[after[-1], symbol]))
    out, total = [], 0
    for symbol, rest in zip(symbols, after[-2::-1], strict=True):
        if symbol == FILL:
            break
        left, letters = vectors[rest], ""
        while not letters or letters[-1] == "I":
            options = _edits(state, symbol)
            least = min(cost + left[q] for _, cost, q in options)
            put = _step(left, symbol)[_PUT[state]] + INSERT
            if put < least or (put == least and min(options, key=lambda e: (e[1] + left[e[2]], e[0]))[0] > "I"):
                letters, total, state = letters + "I", total + INSERT, _PUT[state]
                continue
            letter, cost, after_row = min(options, key=lambda e: (e[1] + left[e[2]], e[0]))
            letters, total, state = letters + letter, total + cost, after_row
        out.append(letters)
    return tuple(out), total, state


def trace(symbols: bytes, behind: int, state: int) -> tuple[list[str], int, int]:
    """(letters of each row, cost, state after) of a chunk, the vector behind
    it and the state before it given."""
    _, _, table = tables()
    blocks = blocks_of(symbols).tolist()
    vector = [behind]
    for block in reversed(blocks):
        vector.append(int(table[vector[-1], block]))
    letters, total = [], 0
    for block, rest in zip(blocks, vector[-2::-1], strict=True):
        of_rows, cost, state = _expand(rest, block, state)
        letters += of_rows
        total += cost
    return letters, total, state


# --- rows into chunks ----------------------------------------------------------------

_CHUNK = pa.schema(
    [
        ("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("kind", pa.int32()),
        ("symbols", pa.binary()), ("step", pa.binary()), ("behind", pa.int32()),
        ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
        ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
        ("first_initial", pa.string()), ("last_initial", pa.string()),
        ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()),
    ]
)
_CHUNK_SQL = (
    "conv_id bigint, part int, seq bigint, kind int, symbols binary, step binary, behind int, roles array<string>, "
    "texts array<string>, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_initial string, "
    "last_initial string, first_turn bigint, last_turn bigint, turns bigint"
)
_MARK, _VECTOR, _ROWS = range(3)  # kinds of rows that meet in a conversation's stream


class _Chunk:
    """Consecutive rows of one conversation."""

    def __init__(self, conv_id, limit: int):
        self.limit = limit
        self.conv_id, self.symbols, self.roles, self.texts, self.chars = conv_id, bytearray(), [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_initial = self.last_initial = self.first_turn = self.last_turn = None

    def add(self, turn, role: str, text: str, symbol: int, blank: bool, copies: int) -> int:
        """Take a row and as many of its copies as fit; returns those left."""
        taken = min(copies, max(1, self.limit - len(self.symbols)))
        initial = role[:1]
        if self.last_initial is None:
            self.first_initial = initial
        elif self.last_initial + initial not in _LEGAL:
            self.illegal += 1
        self.illegal += taken - 1  # two rows of one role
        self.last_initial = initial
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            if self.first_turn is None:
                self.first_turn = turn
        self.symbols.append(symbol)
        self.symbols += bytes(taken - 1)  # copies are duplicates, or blank like the first
        if blank:
            self.blank += taken
        else:
            self.duplicate += taken - (symbol != GONE)
            self.truncated += symbol >= CUT
        if symbol != GONE:
            self.roles.append(role)
            self.texts.append(text)
            self.chars += len(text)
        return copies - taken

    @property
    def full(self) -> bool:
        return len(self.symbols) >= self.limit or self.chars >= CHUNK_CHARS

    def row(self, part: int, seq: int) -> dict:
        symbols = bytes(self.symbols)
        return {
            "conv_id": self.conv_id, "part": part, "seq": seq, "kind": _ROWS, "symbols": symbols, "step": chunk_step(symbols),
            "behind": None, "roles": self.roles, "texts": self.texts, "blank": self.blank, "duplicate": self.duplicate,
            "truncated": self.truncated, "illegal": self.illegal, "first_initial": self.first_initial,
            "last_initial": self.last_initial, "first_turn": self.first_turn, "last_turn": self.last_turn, "turns": self.turns,
        }


def _batches(rows, schema: pa.Schema, size: int = 256):
    """Rows (dicts) as record batches of at most ``size`` rows."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _chunks(limit: int):
    """A sorted partition's rows as chunks of at most ``limit`` rows."""

    def rows(batches):
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        chunk, seq = None, 0
        for batch in batches:
            for conv_id, turn, role, text, copies, symbol, blank in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                while copies:
                    if chunk is not None and (chunk.full or chunk.conv_id != conv_id):
                        yield chunk.row(part, seq)
                        chunk, seq = None, seq + 1
                    chunk = chunk or _Chunk(conv_id, limit)
                    copies = chunk.add(turn, role, text, symbol, blank, copies)
                    symbol = GONE  # of the copies that are left
        if chunk is not None:
            yield chunk.row(part, seq)

    return lambda batches: _batches(rows(batches), _CHUNK)


_VECTORS = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("behind", pa.int32())])


def _vectors(batches):
    """The vector behind each chunk; chunks of a conversation come last first."""

    def rows():
        last, state = object(), 0
        for batch in batches:
            for conv_id, part, seq, step in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if conv_id != last:
                    last, state = conv_id, 0
                yield {"conv_id": conv_id, "part": part, "seq": seq, "behind": state}
                state = int(np.frombuffer(step, "<u2")[state])

    yield from _batches(rows(), _VECTORS, 4096)


# --- a conversation's stream ------------------------------------------------------------

_REPORT = pa.schema(
    [
        ("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
        ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
        ("repaired_sha256", pa.string()),
    ]
)
_REPORT_SQL = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)
_REPAIRED = pa.schema(
    [("conv_id", pa.int64()), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
)
_REPAIRED_SQL = "conv_id bigint, position bigint, edit string, role string, text string"
_LONG = (1 << 63) - 1


class _Conversation:
    """What is carried along a conversation's chunks."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.position, self.cost, self.audit = conv_id, START, 0, 0, []
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.initial = self.first_turn = self.last_turn = None
        self.turns = 0
        self.digest = hashlib.sha256()

    def _out(self, edit: str, role: str, text: str) -> dict:
        self.digest.update(("\n" if self.position else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.position += 1
        return {"conv_id": self.conv_id, "position": self.position - 1, "edit": edit, "role": role, "text": text}

    def take(self, chunk: dict, behind: int):
        """Repaired rows of the next chunk."""
        for name in self.counts:
            self.counts[name] += chunk[name]
        if self.initial is not None and self.initial + chunk["first_initial"] not in _LEGAL:
            self.counts["illegal"] += 1
        self.initial = chunk["last_initial"]
        if chunk["first_turn"] is not None:
            self.turns += chunk["turns"] - (chunk["first_turn"] == self.last_turn)
            self.first_turn = chunk["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = chunk["last_turn"]
        symbols, rows = chunk["symbols"], iter(zip(chunk["roles"], chunk["texts"], strict=True))
        letters, cost, end = trace(symbols, behind, self.state)
        self.cost += cost
        self.audit.append("".join(letters))
        state = self.state
        for symbol, edits in zip(symbols, letters, strict=True):
            role, text = (None, None) if symbol == GONE else next(rows)
            for edit in edits:
                if edit == "K":
                    state = _KEEP[state][(symbol - WHOLE) % 4]
                    yield self._out(edit, role, text)
                elif edit != "D":
                    state = _PUT[state]
                    yield self._out(edit, _ROLE[state], "" if edit == "I" else text)
        self.state = end

    def finish(self):
        """Rows put in at the end."""
        while self.state in (SYSTEM, USER):
            self.state = _PUT[self.state]
            self.cost += INSERT
            self.audit.append("I")
            yield self._out("I", _ROLE[self.state], "")

    def report(self) -> dict:
        span = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return {
            "conv_id": self.conv_id, "gaps": min(span, _LONG), **self.counts, "cost": self.cost,
            "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest(),
        }


def _streams(report: bool):
    def rows(batches):
        conversation, behind = None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if conversation is None or conversation.conv_id != row["conv_id"]:
                    if conversation is not None:
                        yield from close(conversation)
                    conversation = _Conversation(row["conv_id"])
                if row["kind"] == _VECTOR:
                    behind = row["behind"]
                elif row["kind"] == _ROWS:
                    for out in conversation.take(row, behind):
                        if not report:
                            yield out
        if conversation is not None:
            yield from close(conversation)

    def close(conversation):
        rest = list(conversation.finish())
        if report:
            yield conversation.report()
        else:
            yield from rest

    def run(batches):
        yield from _batches(rows(batches), _REPORT if report else _REPAIRED, 1024)

    return run


# --- the operator ---------------------------------------------------------------------------

_ANY, _ENDED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"


def _number(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def _spaced(name: str) -> Column:
    """A column as text, a null as one space."""
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows hurt by the crc32 of
    ``conv_id:turn`` modulo 20 (0 drops, 1 empties, 2 takes away ``[.!?]``, 3
    repeats, 4 makes a user's); null roles and texts become one space, as do
    null ids and turns in the crc's text."""
    fault = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")) % _FIRST_CRC_STEPS
    rows = conversations.select(
        "conv_id", "turn", _spaced("role").alias("role"), _spaced("text").alias("text"), fault.alias("fault")
    ).filter("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("fault") == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )


def _marked(rows: DataFrame) -> DataFrame:
    """Unlike rows with their copies and the symbol of the first copy.  Equal
    rows are counted before the shuffle, so a row repeated without end is one;
    the first turn of a text is looked up only where a conversation has it twice."""
    key = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    each = (
        rows.groupBy("conv_id", "turn", "role", "text")
        .agg(F.sum("copies").alias("copies"))
        .withColumn("blank", ~F.col("text").rlike(_ANY))
        .withColumn("key", F.when(~F.col("blank"), key))
    )
    again = (
        each.filter("key IS NOT NULL")
        .groupBy("conv_id", "key")
        .agg(F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("unturned"), F.count("*").alias("n"))
        .filter("n > 1")
        .select(F.col("conv_id").alias("c"), F.col("key").alias("k"), F.when(~F.col("unturned"), F.col("least")).alias("first"))
    )
    seen = F.col("k").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))
    symbol = (
        F.when(F.col("blank") | seen, GONE)
        .when(F.col("text").rlike(_ENDED), _number(F.col("role")) + WHOLE)
        .otherwise(_number(F.col("role")) + CUT)
    )
    return each.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")), "left").select(
        "conv_id", "turn", "role", "text", "copies", symbol.alias("symbol"), "blank"
    )


def _repaired(rows: DataFrame, ids: DataFrame, report: bool) -> DataFrame:
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    ranged = _marked(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    chunks = stage(ranged.mapInArrow(_chunks(CHUNK_ROWS), _CHUNK_SQL), "chunks")
    back = (
        chunks.select("conv_id", "part", "seq", "step")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("part").desc(), F.col("seq").desc())
    )
    vectors = back.mapInArrow(_vectors, "conv_id bigint, part int, seq bigint, behind int").withColumn("kind", F.lit(_VECTOR))
    marks = ids.select("conv_id").distinct().select(
        "conv_id", F.lit(-1).alias("part"), F.lit(-1).cast("bigint").alias("seq"), F.lit(_MARK).alias("kind")
    )
    streams = (
        chunks.drop("step")
        .unionByName(vectors.unionByName(marks, allowMissingColumns=True), allowMissingColumns=True)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "seq", "kind")
    )
    return streams.mapInArrow(_streams(report), _REPORT_SQL if report else _REPAIRED_SQL)


def _plain(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        "conv_id", "turn", _spaced("role").alias("role"), _spaced("text").alias("text"), F.lit(1).cast("bigint").alias("copies")
    )


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, edit, role, text): the repaired rows of every
    conversation in order, edit being K, R or I.

    Rows are taken by turn, null turns first, rows of one turn by role, then
    text (in UTF-8).  A null role or text is one space; rows without conv_id
    are one conversation.  Equal rows are duplicates of the first.  Roles count
    by their first letter as it is written; an empty role is none of the three.
    A conversation of which nothing is left has no rows here.  Other columns
    are ignored; an empty table gives an empty result."""
    return _repaired(_plain(conversations), conversations, report=False)


def repair_report(conversations: DataFrame, damaged: DataFrame | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) of every conversation of ``conversations``, from the rows
    ``damaged`` (see ``damage``; without them, its own rows).

    Rows, ties and nulls as for ``repair``.  A row's first fault counts: blank,
    duplicate, truncated.  gaps saturates at the largest long.  A conversation
    without rows has zeros, an empty audit and the digest of nothing.  The rows
    of a conversation pass one task in order, because a digest is taken in
    order, but the task holds one chunk and the audit's letters only."""
    return _repaired(_plain(conversations) if damaged is None else damaged, conversations, report=True)
