"""Conversation structure repair: shortest paths in an edit lattice, found by auction.

A conversation is repaired when its roles read: an optional system row, then user and
assistant in turn, closed by the assistant. Rows may be kept, given another role, deleted, or
inserted, each at a cost in whole numbers. A node of the lattice is a place between rows and
the role before it (START, SYSTEM, USER, ASSISTANT); an arc is an edit.

**Auction.** Every node has a price, at first 0, never above the cost from there to the end.
A path starts at a node and looks for the cheapest arc plus price beyond: a node priced lower
is raised to it and the path steps back, else the path is extended, until it meets a node
whose price has converged; then so have all prices on the path. Paths start from the last
place towards the first, so that every one is short. Converged prices expose the tight arcs, those
whose cost is the difference of two prices; among them the trace takes the least letter.

**Long conversations.** Rows are sorted by range over the whole table, not dealt by
conversation, and packed into segments of at most `SEGMENT` rows, one byte each. A segment's
prices towards each of its four ends make a table of four by four; tables are chained
backwards (sixteen numbers a segment), which prices the ends; segments are then traced for
every role they may start with, in parallel; what they start with follows from the one before.
Only the hash of a repaired conversation and its audit, one value each by definition, need its
rows in order in one task, as a stream: no group is held, apart from the audit itself.

Rows are ordered by turn, nulls first, then by a digest of role and text; equal rows are alike.
Null roles and texts are one space; a null turn or conversation is one space in the checksum
that chooses the damage. Rows with a null conversation are a conversation. A conversation whose
rows are all dropped has zeros and empty results; empty tables give no rows. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from skyrisk.llm.shared import landed

SEGMENT = 2048  # rows of a segment
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
STOP = r"[.!?]"
# A row's byte: its role's initial, whether it must go, whether its text breaks off.
INITIALS = {"s": 0, "u": 1, "a": 2}
OTHER, GONE, CUT = 3, 4, 8
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
_PAIRS = {(0, 1), (1, 2), (2, 1)}
_FAR = 1 << 40  # the price of an end that cannot be met
# After the last row: what closing costs, and its letters.
FINAL = (0, 4, 2, 0)
CLOSING = ("", INSERT * 2, INSERT, "")

Arc = tuple[str, int, int, int]  # letter, cost, rows forward, state


def _arcs(state: int, row: int) -> list[Arc]:
    """Edits from a state before a row, by letter; a letter names one of them."""
    following = ASSISTANT if state == USER else USER
    out: list[Arc] = [(INSERT, 2, 0, following), (DELETE, 3, 1, state)]
    if not row & GONE:
        extra = 1 if row & CUT else 0
        out.append((REROLE, 2 + extra, 1, following))
        if row & 3 == following - 1:
            out.append((KEEP, extra, 1, following))
        elif row & 3 == INITIALS["s"] and state == START:
            out.append((KEEP, extra, 1, SYSTEM))
    return sorted(out)


_ARCS = [[_arcs(s, r) for s in STATES] for r in range(16)]


class Lattice:
    """Prices of a segment's nodes towards its end, where every state has a price of its own.
    Nothing is inserted at the end: that belongs to what follows."""

    def __init__(self, rows: bytes, end: tuple[int, ...]) -> None:
        self.arcs = [_ARCS[r] for r in rows]
        self.price = [[0] * 4 for _ in rows] + [list(end)]
        self.done = [[False] * 4 for _ in rows] + [[True] * 4]
        # No edit leads back to START or SYSTEM.
        top = max(s for s in STATES if end[s] < _FAR)
        closed = [s for s in STATES if s > top] if top < USER else []
        for place in range(len(rows) - 1, -1, -1):
            least = min(self.price[place + 1])  # what is left costs no less from here
            for state in STATES:
                self.price[place][state] = _FAR if state in closed else least
                self.done[place][state] = state in closed
            for state in STATES:
                self._auction(place, state)

    def _auction(self, place: int, state: int) -> None:
        path = [(place, state)]
        while not self.done[path[-1][0]][path[-1][1]]:
            p, s = path[-1]
            value, beyond = _FAR, None
            for _, cost, step, to in self.arcs[p][s]:
                v = cost + self.price[p + step][to]
                if v < value:
                    value, beyond = v, (p + step, to)
            if self.price[p][s] < value:  # contraction
                self.price[p][s] = value
                if len(path) > 1:
                    path.pop()
            elif beyond is None:  # no way to an end
                break
            else:  # extension
                path.append(beyond)
        for p, s in path:
            self.done[p][s] = True

    def trace(self, state: int) -> tuple[str, int] | None:
        """The least letters along tight arcs, and the state at the end."""
        if self.price[0][state] >= _FAR:
            return None
        place, letters = 0, []
        while place < len(self.arcs):
            price = self.price[place][state]
            for letter, cost, step, to in self.arcs[place][state]:
                if cost + self.price[place + step][to] == price:
                    letters.append(letter)
                    place, state = place + step, to
                    break
        return "".join(letters), state


def table(rows: bytes) -> list[int]:
    """Costs from every state before the rows (four by four) to every state after them."""
    costs = [Lattice(rows, tuple(0 if s == e else _FAR for s in STATES)).price[0] for e in STATES]
    return [costs[e][s] for s in STATES for e in STATES]


@lru_cache(maxsize=50_000)
def traced(rows: bytes, end: tuple[int, ...], states: int) -> tuple[int, list[str | None], list[int | None]]:
    """Cost from START, and for the first few states the letters and the state at the end."""
    lattice = Lattice(rows, end)
    found = [(lattice.trace(s) if s < states else None) or (None, None) for s in STATES]
    return lattice.price[0][START], [f[0] for f in found], [f[1] for f in found]


def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role, text, n, digest: the rows after the damage their checksum chooses, with
    the number of adjacent copies."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)]
    key = F.concat(part[0], F.lit(":"), part[1])
    out = rows.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"), (F.crc32(key.cast("binary")) % 20).cast("int").alias("how"),
    ).where("how <> 0")
    out = out.select(
        "conv", "turn",
        F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.regexp_replace("text", STOP, "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("how") == 3, 2).otherwise(1).cast("long").alias("n"),
    )
    return out.withColumn("digest", F.unhex(F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text").cast("binary"))))


def faults(rows: DataFrame) -> DataFrame:
    """One narrow row for equal rows: conv, turn, digest, n, code, blank, cut, and whether the
    first of them is the first of its role and text. By aggregates only: no group is held."""
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    narrow = rows.select("conv", "turn", "digest", "n", code.alias("code"), (last == "").alias("blank"), (~last.rlike(STOP)).alias("cut"))
    at = ["conv", "turn", "digest"]
    same = landed(narrow.groupBy(*at).agg(F.sum("n").alias("n"), F.min("code").alias("code"), F.min("blank").alias("blank"), F.min("cut").alias("cut")), "faults")
    earliest = same.groupBy("conv", "digest").agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("e"))
    mark = earliest.select("conv", F.col("e.turn").alias("turn"), "digest", F.lit(0).cast("long").alias("n"), *[F.lit(None).cast(t).alias(c) for c, t in (("code", "int"), ("blank", "boolean"), ("cut", "boolean"))], F.lit(True).alias("first"))
    both = same.withColumn("first", F.lit(False)).unionByName(mark)
    return both.groupBy(*at).agg(*[F.max(c).alias(c) for c in ("n", "code", "blank", "cut", "first")])


ORDER = ["conv", "set", "turn", "digest"]  # `set`: nulls go first
PIECE = "seq long, audits array<string>, ends array<int>, cost long, first int, last int, illegal long"


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _illegal(rows: bytes) -> int:
    return sum((a & 3, b & 3) not in _PAIRS for a, b in zip(rows, rows[1:], strict=False))


def _out(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _batched(rows: Iterator[tuple], schema: pa.Schema, most: int = 2000, letters: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    part, size = [], 0
    for r in rows:
        part.append(r)
        size += sum(len(x) for x in r if isinstance(x, str | bytes))
        if len(part) == most or size > letters:
            yield _out(part, schema)
            part, size = [], 0
    if part:
        yield _out(part, schema)


def segments(rows: DataFrame, most: int = SEGMENT) -> DataFrame:
    """Rows of `faults` packed in order, at most so many together. A conversation that lies in one segment, and cannot go
    on in another task, is traced at once; segments of others have rows and costs instead."""
    spark = rows.sparkSession
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"conv {types['conv']}, set boolean, turn {types['turn']}, digest binary, {PIECE}, rows binary, costs array<long>"
    fields = to_arrow_schema(spark.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[tuple[tuple, int, bytes, bool, bool]]:
            """(key, seq, rows, first of its conversation here, last of it here)"""
            key, held, seq, opening = None, bytearray(), 0, True
            for conv, is_set, turn, digest, n, code, blank, cut, first in _groups(batches):
                if key is not None and key[0] != conv:
                    yield key, seq, bytes(held), opening, True
                    key, held, opening, seq = None, bytearray(), True, seq + 1
                left = n
                while left:
                    if len(held) == most:
                        yield key, seq, bytes(held), opening, False
                        key, held, opening, seq = None, bytearray(), False, seq + 1
                    if key is None:
                        key = (conv, is_set, turn, digest)
                    if left == n:
                        held.append(code | (GONE if blank or not first else CUT if cut else 0))
                        left -= 1
                    else:
                        some = min(left, most - len(held))
                        held += bytes([code | GONE]) * some
                        left -= some
            if key is not None:
                yield key, seq, bytes(held), opening, True

        def solved() -> Iterator[tuple]:
            before, ahead, start = None, None, True
            for ahead in pieces():
                if before is not None:
                    yield settle(before, start, False)
                    start = start and before[0][0] == ahead[0][0]
                before = ahead
            if before is not None:
                yield settle(before, start, True)

        def settle(piece: tuple, start: bool, end: bool) -> tuple:
            key, seq, data, opening, closing = piece
            shape = data[0] & 3, data[-1] & 3, _illegal(data)
            if opening and closing and not start and not end:
                cost, audits, ends = traced(data, FINAL, 1)
                return *key, seq, audits, ends, cost, *shape, None, None
            return *key, seq, None, None, None, *shape, data, table(data)

        yield from _batched(solved(), fields)

    sorted_rows = rows.withColumn("set", F.col("turn").isNotNull()).select(*ORDER, "n", "code", "blank", "cut", "first")
    return sorted_rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).mapInArrow(run, schema)


def chained(pieces: DataFrame) -> DataFrame:
    """Segments of long or parted conversations, traced. Their ends are priced backwards in one
    stream a conversation, a few numbers a segment, then every segment is traced on its own."""
    spark, key = pieces.sparkSession, [*ORDER, "seq"]
    parted = pieces.where("rows IS NOT NULL")
    priced = parted.select(*key, "costs")
    priced_schema = f"{priced.drop('costs').schema.simpleString()[7:-1].replace(',', ', ').replace(':', ' ')}, end array<long>"
    priced_fields = to_arrow_schema(spark.createDataFrame([], priced_schema).schema)

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ends() -> Iterator[tuple]:
            conv, end, fresh = None, FINAL, True
            for *at, costs in _groups(batches):
                if fresh or at[0] != conv:
                    conv, end, fresh = at[0], FINAL, False
                yield *at, list(end)
                end = tuple(min(costs[4 * s + e] + end[e] for e in STATES) for s in STATES)

        yield from _batched(ends(), priced_fields)

    backwards = [F.col("conv"), *[F.desc(c) for c in key[1:]]]
    known = landed(priced.repartition("conv").sortWithinPartitions(*backwards).mapInArrow(price, priced_schema), "ends")
    met = parted.alias("p").join(known.alias("k"), F.expr(" AND ".join(f"p.{c} <=> k.{c}" for c in key))).select("p.*", "k.end")
    schema = met.drop("end", "rows", "costs").schema
    fields = to_arrow_schema(schema)

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for *at, seq, _, _, _, first, last, illegal, rows, _, end in _groups(batches):
                cost, audits, ends = traced(rows, tuple(end), 4)
                yield *at, seq, audits, ends, cost, first, last, illegal

        yield from _batched(out(), fields)

    return met.mapInArrow(trace, schema)


class _Repair:
    """One conversation as its rows pass by: its numbers, its audit, then its texts."""

    def __init__(self, conv: object, numbers: list[int]) -> None:
        self.conv, self.numbers = conv, numbers
        self.audit: list[str] = []
        self.state, self.cost, self.illegal, self.last = START, None, 0, None
        self.hash, self.written, self.letters = hashlib.sha256(), 0, None

    def piece(self, audits: list, ends: list, cost: int, first: int, last: int, illegal: int) -> None:
        if self.cost is None:
            self.cost = cost
        self.illegal += illegal + (self.last is not None and (self.last, first) not in _PAIRS)
        self.last = last
        self.audit.append(audits[self.state])
        self.state = ends[self.state]

    def _start(self) -> None:
        if self.letters is None:
            self.audit = "".join(self.audit) + CLOSING[self.state]
            self.letters, self.role = iter(self.audit), START

    def _write(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.written else "") + f"{role}:{text}").encode())
        self.written += 1

    def _edit(self, letter: str, role: str, text: str) -> None:
        if letter == DELETE:
            return
        following = ASSISTANT if self.role == USER else USER
        if letter == KEEP:
            self._write(role, text)
            self.role = SYSTEM if role[:1] == "s" else following
        else:
            self._write("user" if following == USER else "assistant", text)
            self.role = following

    def row(self, role: str, text: str) -> None:
        self._start()
        while (letter := next(self.letters)) == INSERT:
            self._edit(letter, "", "")
        self._edit(letter, role, text)

    def result(self) -> tuple:
        self._start()
        for letter in self.letters:
            self._edit(letter, "", "")
        return self.conv, *self.numbers, self.illegal, self.cost or 0, self.audit, self.hash.hexdigest()


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = SEGMENT) -> DataFrame:
    """conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for every
    conversation of `rows`, after the damage."""
    spark = rows.sparkSession
    texts = damaged(rows, conv, turn, role, text)
    found = landed(faults(texts), "rows")
    pieces = landed(segments(found, segment), "pieces")
    solved = pieces.where("rows IS NULL").drop("rows", "costs").unionByName(chained(pieces))
    own = F.col("first").cast("long")
    gaps = F.coalesce(F.max("turn").cast("long") - F.min("turn").cast("long") + 1 - F.count_distinct("turn"), F.lit(0).cast("long"))
    numbers = found.groupBy("conv").agg(
        gaps.alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), F.col("n") - own).otherwise(0)).alias("duplicate"),
        F.sum(F.when(~F.col("blank") & F.col("cut"), own).otherwise(0)).alias("truncated"),
    )
    names = ["gaps", "blank", "duplicate", "truncated"]
    zeros = rows.select(F.col(conv).alias("conv"), *[F.lit(0).cast("long").alias(c) for c in names])
    heads = numbers.union(zeros).groupBy("conv").agg(F.array(*[F.max(c) for c in names]).alias("numbers"))
    # Heads, then pieces, then texts of each conversation, in order.
    shape = F.struct("audits", "ends", "cost", "first", "last", "illegal")
    empty_piece, empty_row = F.lit(None).cast(solved.select(shape.alias("x")).schema["x"].dataType), F.lit(None).cast("struct<role:string,text:string>")
    key_types = [texts.schema["turn"].dataType, "binary", "long"]
    nothing = [F.lit(None).cast("boolean").alias("set"), *[F.lit(None).cast(t).alias(c) for c, t in zip(("turn", "digest", "seq"), key_types, strict=True)]]
    no_numbers, no_copies = F.lit(None).cast("array<long>"), F.lit(1).cast("long")
    stream = (
        heads.select("conv", F.lit(0).alias("part"), *nothing, "numbers", empty_piece.alias("piece"), empty_row.alias("row"), no_copies.alias("n"))
        .union(solved.select("conv", F.lit(1), "set", "turn", "digest", "seq", no_numbers, shape, empty_row, no_copies))
        .union(texts.select("conv", F.lit(2), F.col("turn").isNotNull(), "turn", "digest", F.lit(None).cast("long"), no_numbers, empty_piece, F.struct("role", "text"), "n"))
    )
    conv_type = rows.schema[conv].dataType.simpleString()
    schema = f"conv {conv_type}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    fields = to_arrow_schema(spark.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[tuple]:
            one = None
            for key, part, numbers, piece, row, n in _groups(batches):
                if part == 0:
                    if one is not None:
                        yield one.result()
                    one = _Repair(key, numbers)
                elif part == 1:
                    one.piece(**piece)
                else:
                    for _ in range(n):
                        one.row(row["role"], row["text"])
            if one is not None:
                yield one.result()

        yield from _batched(results(), fields)

    order = ["conv", "part", "set", "turn", "digest", "seq"]
    dealt = stream.repartition("conv").sortWithinPartitions(*order).select("conv", "part", "numbers", "piece", "row", "n")
    return dealt.mapInArrow(run, schema).withColumnRenamed("conv", conv)
