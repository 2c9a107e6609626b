"""Repair of the role structure of conversations by a run-length dynamic program.

A repaired conversation has an optional system row and then user and assistant rows in turn. Rows are
symbols (what their role begins with, and their fault); a min-plus matrix per symbol says what a row
costs between two states of that pattern. Equal consecutive symbols are a run, and a run is one power
of its matrix, put together from cached binary powers. Matrices of neighbouring runs multiply, so the
pieces of a conversation that lie in different range partitions are summed up each on its own.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator
from itertools import groupby, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import forget, pick, stored

# States of the pattern: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
FAR = 10**15
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Where a new user or assistant row leads from each state, and where a kept row of each initial does.
_NEW = (USER, USER, ASSISTANT, USER)
_KEPT = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None), "": (None,) * 4}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: A symbol: DROP, or the initial ("" for any other) and whether the row is truncated.
DROP = ("d", False)
SYMBOLS = [DROP, *((initial, cut) for initial in _KEPT for cut in (False, True))]

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]

_ONE: Matrix = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))


@functools.lru_cache(maxsize=1 << 14)
def _product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(min(x + y[j] for x, y in zip(row, b, strict=True)), FAR) for j in range(4)) for row in a)


def times(a: tuple[int, Matrix], b: tuple[int, Matrix]) -> tuple[int, Matrix]:
    """The min-plus product of two matrices, each kept as its least entry and the rest above it."""
    out = _product(a[1], b[1])
    least = min(map(min, out))
    return a[0] + b[0] + least, tuple(tuple(FAR if x >= FAR else x - least for x in row) for row in out)


@functools.lru_cache(maxsize=1 << 14)
def _applied(a: Matrix, v: Vector) -> Vector:
    return tuple(min(min(x + y for x, y in zip(row, v, strict=True)), FAR) for row in a)


def apply(a: tuple[int, Matrix], v: tuple[int, Vector]) -> tuple[int, Vector]:
    out = _applied(a[1], v[1])
    least = min(out)
    return a[0] + v[0] + least, tuple(FAR if x >= FAR else x - least for x in out)


def _inserts() -> Matrix:
    """The cheapest way by new rows alone from state to state."""
    one = tuple(tuple(0 if i == j else INSERT if j == _NEW[i] else FAR for j in range(4)) for i in range(4))
    return _product(_product(one, one), _product(one, one))


INSERTS = _inserts()


def _row(symbol: tuple[str, bool]) -> Matrix:
    """What one row costs from state to state, new rows before it included."""
    out = [[FAR] * 4 for _ in range(4)]
    for state in range(4):
        out[state][state] = DELETE
        if symbol != DROP:
            extra = TRUNCATED * symbol[1]
            kept = _KEPT[symbol[0]][state]
            out[state][_NEW[state]] = min(out[state][_NEW[state]], REROLE + extra)
            if kept is not None:
                out[state][kept] = min(out[state][kept], KEEP + extra)
    return _product(INSERTS, tuple(map(tuple, out)))


@functools.lru_cache(maxsize=1024)
def binary_power(symbol: int, bit: int) -> tuple[int, Matrix]:
    """The matrix of ``2 ** bit`` rows of one symbol."""
    if bit == 0:
        return times((0, _ONE), (0, _row(SYMBOLS[symbol])))
    half = binary_power(symbol, bit - 1)
    return times(half, half)


def run_matrix(symbol: int, length: int) -> tuple[int, Matrix]:
    out = (0, _ONE)
    for bit in range(length.bit_length()):
        if length >> bit & 1:
            out = times(out, binary_power(symbol, bit))
    return out


#: What is left to pay behind the last row: new rows until the pattern is whole.
END: tuple[int, Vector] = (0, _applied(INSERTS, (0, FAR, FAR, 0)))


@functools.lru_cache(maxsize=1 << 14)
def _choice(symbol: int, state: int, here: Vector, after: Vector, gap: int) -> str:
    """The least letter on a cheapest way from ``state``; ``gap`` is what ``after`` is higher than ``here`` at its least."""
    kind = SYMBOLS[symbol]
    left = here[state]
    if DELETE + after[state] + gap == left:
        return "D"
    if INSERT + here[_NEW[state]] == left:
        return "I"
    extra = TRUNCATED * kind[1]
    kept = None if kind == DROP else _KEPT[kind[0]][state]
    if kept is not None and KEEP + extra + after[kept] + gap == left:
        return "K"
    return "R"


def unroll(runs: list[tuple[int, int]], after: tuple[int, Vector], state: int) -> Iterator[str]:
    """The edits of the rows of some runs in order, each with the new rows before it, as letters.

    Every run's values at its end come from the powers of the runs behind it; within the run a value
    per row is enough. Of all cheapest ways the one with the least letters is taken: each letter leads
    to one state alone, so the least letter that keeps the cost is always right.
    """
    ends = [after]
    for symbol, length in reversed(runs[1:]):
        ends.append(apply(run_matrix(symbol, length), ends[-1]))
    for (symbol, length), end in zip(runs, reversed(ends), strict=True):
        if SYMBOLS[symbol] == DROP:  # new rows may as well come later, and D is the least letter
            yield from repeat("D", length)
            continue
        one, values = binary_power(symbol, 0), [end]
        for _ in range(length):
            values.append(apply(one, values[-1]))
        while len(values) > 1:
            here, then = values.pop(), values[-1]
            letters = ""
            while not letters or letters[-1] == "I":
                letters += _choice(symbol, state, here[1], then[1], then[0] - here[0])
                if letters[-1] == "K":
                    state = _KEPT[SYMBOLS[symbol][0]][state]
                elif letters[-1] != "D":
                    state = _NEW[state]
            yield letters


def rest(state: int) -> str:
    """New rows behind the last row."""
    return {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[state]


def _damaged(rows: DataFrame) -> DataFrame:
    """The damaged rows, equal ones as one with their number ``n``; a row that is dropped leaves a mark with 0."""

    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain("conv"), F.lit(":"), plain("turn"))) % 20
    text = F.when(kind <= 1, "").when(kind == 2, F.translate(plain("text"), ".!?", "")).otherwise(plain("text"))
    role = F.when(kind == 0, "").when(kind == 4, "user").otherwise(plain("role"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    rows = rows.select("conv", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), copies.alias("n"))
    return rows.groupBy("conv", "turn", "role", F.sha2("text", 256).alias("h"), "text").agg(F.sum("n").alias("n"))


_PIECE = "conv {kind}, piece long, place long, n long, first boolean, blank boolean, role string, text string, summary binary, runs binary"


def _symbol(initial: str, cut: bool) -> int:
    return SYMBOLS.index((initial if initial in _KEPT else "", cut))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch], size: int = 1000) -> Iterator[list[tuple]]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            yield list(zip(*(part.column(i).to_pylist() for i in range(part.num_columns)), strict=True))


class _Piece:
    """What is known of the rows of one conversation within one partition."""

    def __init__(self) -> None:
        self.runs: list[list[int]] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.initials: list[str] = []
        self.low = self.high = None

    def run(self, symbol: int, n: int) -> None:
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1][1] += n
        elif n:
            self.runs.append([symbol, n])

    def add(self, turn: int | None, role: str, n: int, first: bool, blank: bool, cut: bool) -> None:
        if not n:
            return
        initial = role[:1]
        if self.initials:
            self.illegal += self.initials[-1] + initial not in ("su", "ua", "au")
        self.illegal += (n - 1) * (2 * initial not in ("su", "ua", "au"))
        self.initials = [*self.initials[:1], initial]
        if turn is not None:
            self.turns += self.high != turn
            self.low, self.high = turn if self.low is None else self.low, turn
        if blank:
            self.blank += n
            self.run(0, n)
            return
        self.duplicate += n - first
        self.truncated += first and cut
        if first:
            self.run(_symbol(initial, cut), 1)
        self.run(0, n - first)

    def summary(self) -> bytes:
        least, matrix = (0, _ONE)
        for symbol, length in self.runs:
            least, matrix = times((least, matrix), run_matrix(symbol, length))
        facts = [self.blank, self.duplicate, self.truncated, self.illegal, self.turns, least, *(x for row in matrix for x in row)]
        marks = [self.low, self.high]
        return json.dumps([*facts, *marks, [*self.initials[:1], *self.initials[-1:]]]).encode()

    def coded_runs(self) -> bytes:
        return np.array(self.runs, "<i8").reshape(-1, 2).tobytes()


def _pieces(schema: pa.Schema):
    """Rows of a sorted partition with their place, and for each conversation in it a summary and its runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        place, conv, piece, marked = 0, None, None, None
        for rows in _rows(batches):
            out: list[tuple] = []
            for own, turn, role, h, n, text, blank, cut in rows:
                if piece is None or own != conv:
                    if piece is not None:
                        out += _closing(conv, part, piece)
                    conv, piece = own, _Piece()
                if n is None:  # a mark in front of the first row of a text
                    marked = (own, turn, role, h)
                    continue
                first = marked == (own, turn, role, h)
                marked = None
                piece.add(turn, role, n, first, blank, cut)
                if n:
                    out.append((own, part, place, n, first, blank, role, text, None, None))
                    place += 1
            yield _batch(out, schema)
        if piece is not None:
            yield _batch(_closing(conv, part, piece), schema)

    return run


def _closing(conv: object, part: int, piece: _Piece) -> list[tuple]:
    """Summaries of all pieces come before anything else of a conversation, the runs of a piece before its rows."""
    return [(conv, -1, part, None, None, None, None, None, piece.summary(), None), (conv, part, -1, None, None, None, None, None, None, piece.coded_runs())]


class _Conversation:
    """Takes the summaries of the pieces, then each piece's runs and rows, and gives one row."""

    def __init__(self, conv: object):
        self.conv, self.parts, self.summaries = conv, [], []
        self.state, self.letters = START, []
        self.hash, self.wrote, self.ends = hashlib.sha256(), False, {}
        self.edits: Iterator[str] = iter(())

    def summary(self, part: int, data: bytes) -> None:
        *numbers, low, high, ends = json.loads(data)
        matrix = tuple(tuple(numbers[6 + 4 * i : 10 + 4 * i]) for i in range(4))
        self.parts.append(part)
        self.summaries.append((numbers[:5], (numbers[5], matrix), (low, high), ends))

    def chain(self) -> None:
        """What is left to pay behind each piece, from the last to the first, and the totals."""
        self.left = END
        for part, (_, matrix, _, _) in zip(reversed(self.parts), reversed(self.summaries), strict=True):
            self.ends[part] = self.left
            self.left = apply(matrix, self.left)
        self.totals = [sum(s[0][i] for s in self.summaries) for i in range(5)]
        known = [s for s in self.summaries if s[3]]
        for before, own in zip(known, known[1:], strict=False):
            self.totals[3] += before[3][-1] + own[3][0] not in ("su", "ua", "au")
        dated = [s[2] for s in known if s[2][0] is not None]
        for before, own in zip(dated, dated[1:], strict=False):
            self.totals[4] -= before[1] == own[0]
        self.gaps = min(dated[-1][1] - dated[0][0] + 1 - self.totals[4], 2**63 - 1) if dated else 0

    def runs(self, part: int, data: bytes) -> None:
        if not self.ends:
            self.chain()
        runs = [(int(a), int(b)) for a, b in np.frombuffer(data, "<i8").reshape(-1, 2)]
        self.edits = unroll(runs, self.ends[part], self.state)

    def write(self, role: str, text: str) -> None:
        if self.wrote:
            self.hash.update(b"\n")
        self.hash.update(f"{role}:{text}".encode())
        self.wrote = True

    def new_rows(self, letters: str) -> None:
        for _ in letters:
            self.state = _NEW[self.state]
            self.write(_ROLE[self.state], "")

    def row(self, n: int, first: bool, blank: bool, role: str, text: str) -> None:
        initial = role[:1] if role[:1] in _KEPT else ""
        for _ in range(n):
            letters = next(self.edits)
            self.letters.append(letters)
            self.new_rows(letters[:-1])
            if letters[-1] == "K":
                self.state = _KEPT[initial][self.state]
                self.write(role, text)
            elif letters[-1] == "R":
                self.state = _NEW[self.state]
                self.write(_ROLE[self.state], text)

    def result(self) -> tuple:
        if not self.ends:
            self.chain()
        last = rest(self.state)
        self.new_rows(last)
        blank, duplicate, truncated, illegal, _ = self.totals
        cost = self.left[0] + self.left[1][START]
        return self.conv, self.gaps, blank, duplicate, truncated, illegal, cost, "".join(self.letters) + last, self.hash.hexdigest()


def _repaired(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Conversation | None = None
        for rows in _rows(batches):
            out = []
            for conv, own in groupby(rows, key=lambda r: r[0]):
                if held is None or held.conv != conv:
                    if held is not None:
                        out.append(held.result())
                    held = _Conversation(conv)
                for _, piece, place, n, first, blank, role, text, summary, runs in own:
                    if summary is not None:
                        held.summary(place, summary)
                    elif runs is not None:
                        held.runs(piece, runs)
                    else:
                        held.row(n, first, blank, role, text)
            yield _batch(out, schema)
        if held is not None:
            yield _batch([held.result()], schema)

    return run


def repair(conversations: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Faults, cheapest edits and repaired text of every conversation, after the rows were damaged.

    Equal rows are one with their number, so a row that repeats a million times is one row. The
    first place of each (role, text) of a conversation is found by partial minima. Rows are dealt by
    ranges of (conversation, turn, role, text hash), so a conversation of any length reaches over many
    tasks; each task finds the runs, counts and the min-plus matrix of its piece. Then the pieces of a
    conversation meet: a matrix each gives what is left to pay behind every piece, and the rows
    stream by, piece after piece, for the letters and the hash. That last step is one task a
    conversation, as a SHA-256 can only be fed in order; it holds one row, a piece's runs and the letters.

    A null counts as one space, in role and text and in what is hashed for the damage. Rows of one
    turn go by role, then by the SHA-256 of their text; rows without a turn come first. A null key is a
    conversation of its own. An empty table gives no rows. ``gaps`` ends at the largest long.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = pick(conversations, key, turn, role, text).toDF("conv", "turn", "role", "text")
    kind = dict(rows.dtypes)["conv"]
    spark = rows.sparkSession
    merged = stored(_damaged(rows))
    place = ["conv", "turn", "role", "h"]
    firsts = merged.filter("n > 0").groupBy("conv", "role", "h").agg(F.min("turn").alias("turn"), F.max(F.col("turn").isNull()).alias("undated"))
    firsts = firsts.select("conv", F.when(~F.col("undated"), F.col("turn")).alias("turn"), "role", "h", F.lit(None).cast("long").alias("n"), F.lit(None).cast("string").alias("text"))
    trimmed = F.rtrim(F.coalesce("text", F.lit("")), F.lit("\t\n\x0b\x0c\r "))
    last = F.substring(trimmed, -1, 1)
    both = merged.select(*place, "n", "text").unionByName(firsts)
    dealt = both.repartitionByRange(*place).sortWithinPartitions(*place, F.asc_nulls_first("n"))
    dealt = dealt.select(*place, "n", "text", (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"))
    form = _PIECE.format(kind=kind)
    schema = to_arrow_schema(spark.createDataFrame([], form).schema)
    pieces = stored(dealt.mapInArrow(_pieces(schema), form))
    forget(merged)
    out = f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    schema = to_arrow_schema(spark.createDataFrame([], out).schema)
    return pieces.repartition("conv").sortWithinPartitions("conv", "piece", "place").mapInArrow(_repaired(schema), out).withColumnRenamed("conv", key)
