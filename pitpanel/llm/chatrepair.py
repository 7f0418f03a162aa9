"""Repair of conversation structure by weighted CYK parsing over intervals of turns.

A conversation is sound if the first letters of its roles, in order, read ``(s?(ua)+)?``: nothing, or user and assistant in
turns, after a system row if there is one. Edits make it so: Keep a row (cost 0), Rerole it to user or assistant (2),
Delete it (3; the only edit for blank and duplicate rows), Insert an empty user or assistant row (2). A truncated row that
stays costs 1 more. The *audit* is the string of the edits' first letters; of the cheapest ones the ASCII-least counts.

The grammar is in Chomsky normal form. Its nonterminals X[p,q] stand for whatever leads from state p of the pattern to
state q: X[p,q] -> X[p,r] X[r,q] joins two adjacent intervals, X[p,q] -> row takes one row by an edit, and the insertion
closure X[p,q] -> I.. is applied to each row's cell, so empty rows may come before and behind every row. A cell keeps for
each nonterminal the least (cost, audit). Since X[p,r] X[r,q] exists for every state r, all bracketings of an interval
derive the same, and one cut per interval is enough: intervals are joined bottom-up by their length, 1, 2, 4, 8, ...
Equal costs never leave one audit a prefix of the other (the longer would have paid for more rows), so the least
of each part is the least of the whole.

Rows are counted by (conversation, turn, role, digest of the text) before anything moves; a conversation of any length is
range-partitioned over many tasks, each task reduces its rows to the cells of one interval for each conversation and
4,096 rows, and those few cells meet. Only the repaired text of one conversation, when its digest is asked for, passes
through one task in order, as a stream: a SHA-256 has no other form.

Null conversations are one conversation of their own, null roles and texts are one space, null turns come first. Rows of
one turn are ordered by role, then by the SHA-256 of the text; equal rows follow each other. Rows whose role starts with
another letter, or is empty, can be reroled or deleted, not kept. Empty texts are blank. Other columns are not looked at. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.common import bounded_batches, crc_of
from pitpanel.session import shuffle_partitions, stable

#: White space of this operator.
SPACE = r"\x20\x09-\x0D"
#: Rows of an interval that one task reduces at once.
INTERVAL = 4096
#: Intervals up to this length are remembered by their symbols.
REMEMBERED = 8
#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
#: States: 0 nothing yet, 1 after the system row, 2 after user, 3 after assistant; what each letter leads to.
STEPS = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ACCEPTED = (0, 3)
ROLES = {"u": "user", "a": "assistant"}

Cell = dict[tuple[int, int], tuple[int, str]]


def _better(cell: Cell, at: tuple[int, int], item: tuple[int, str]) -> None:
    if at not in cell or item < cell[at]:
        cell[at] = item


def joined(left: Cell, right: Cell) -> Cell:
    """Cell of two adjacent intervals."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in range(4):
            other = right.get((r, q))
            if other is not None:
                total = cost + other[0]
                known = out.get((p, q))
                if known is None or total < known[0] or (total == known[0] and audit + other[1] < known[1]):
                    out[p, q] = (total, audit + other[1])
    return out


def _closure() -> Cell:
    """Cell of no row at all: insertions only."""
    out: Cell = {(p, p): (0, "") for p in STEPS}
    for _ in STEPS:
        for (p, q), (cost, audit) in list(out.items()):
            for letter, to in STEPS[q].items():
                if letter in ROLES:
                    _better(out, (p, to), (cost + INSERT, audit + "I"))
    return out


NOTHING = _closure()


@lru_cache(64)
def _row(symbol: str) -> Cell:
    """Cell of one row: its first letter, capital if the row is truncated; ``-`` if it has to go."""
    cell: Cell = {(p, p): (DELETE, "D") for p in STEPS}
    if symbol != "-":
        more = CUT if symbol.isupper() else 0
        for p, steps in STEPS.items():
            for letter, q in steps.items():
                if letter == symbol.lower():
                    _better(cell, (p, q), (more, "K"))
                if letter in ROLES:
                    _better(cell, (p, q), (REROLE + more, "R"))
    return joined(joined(NOTHING, cell), NOTHING)


@lru_cache(1 << 16)
def _short(symbols: str) -> Cell:
    if len(symbols) == 1:
        return _row(symbols)
    half = len(symbols) // 2
    return joined(_short(symbols[:half]), _short(symbols[half:]))


class Chart:
    """Intervals from left to right; neighbours of one length are joined as soon as both are there."""

    def __init__(self) -> None:
        self.open: list[tuple[int, Cell]] = []

    def add(self, cell: Cell, level: int = 0) -> None:
        while self.open and self.open[-1][0] <= level:
            below, left = self.open.pop()
            cell, level = joined(left, cell), max(level, below) + 1
        self.open.append((level, cell))

    def whole(self) -> Cell:
        cell = NOTHING
        for _, left in reversed(self.open):
            cell = joined(left, cell)
        return cell


def interval(symbols: str) -> Cell:
    """Cell of consecutive rows."""
    chart = Chart()
    for start in range(0, len(symbols), REMEMBERED):
        chart.add(_short(symbols[start : start + REMEMBERED]))
    return chart.whole()


def cheapest(cell: Cell) -> tuple[int, str]:
    return min(cell[0, q] for q in ACCEPTED if (0, q) in cell)


def parse(symbols: str) -> tuple[int, str]:
    """(cost, audit) of a conversation, a symbol for each row."""
    return cheapest(interval(symbols))


# ---------------------------------------------------------------- tables


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults by the CRC-32 of ``conv_id:turn``: rows dropped, emptied, cut, repeated, reroled.

    Nulls are one space, in the key as well."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind, text = crc_of(key) % 20, F.coalesce("text", space)
    return rows.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1))).alias("__copy"),
    ).drop("__copy")


def _key(conversation: str) -> Column:
    """A text that is never null, so that the null conversation is one like others."""
    return F.coalesce(F.concat(F.lit("="), F.col(conversation).cast("string")), F.lit(""))


def _rows(rows: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(" "))
    return rows.select(
        _key(conversation).alias("c"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.sha2(body, 256).alias("digest"), body.alias("text"))


_COUNTS = ("blank", "duplicate", "truncated")
_PIECE = "c string, part int, piece long, blank long, duplicate long, truncated long, illegal long, first string, last string, pairs array<int>, costs array<long>, audits array<string>"
_LEGAL = {"su", "ua", "au"}


class _Piece:
    """Consecutive rows of one conversation, so far."""

    def __init__(self, c: str) -> None:
        self.c, self.symbols, self.first, self.last = c, [], None, None
        self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, letter: str, blank: bool, later: bool, cut: bool) -> None:
        if self.last is None:
            self.first = letter
        elif self.last + letter not in _LEGAL:
            self.illegal += 1
        self.last = letter
        if blank:
            self.blank += 1
        elif later:
            self.duplicate += 1
        elif cut:
            self.truncated += 1
        self.symbols.append("-" if blank or later else letter.upper() if cut else letter)

    def row(self, part: int, number: int) -> tuple:
        cell = interval("".join(self.symbols))
        pairs = sorted(cell)
        return (self.c, part, number, self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last,
                [4 * p + q for p, q in pairs], [cell[x][0] for x in pairs], [cell[x][1] for x in pairs])


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in _PIECE.split(", ")]
    part, number, piece = TaskContext.get().partitionId(), 0, None
    for pdf in batches:
        out = []
        for c, letter, n, blank, later, cut in zip(pdf["c"], pdf["letter"], pdf["n"], pdf["blank"], pdf["later"], pdf["cut"]):
            for k in range(n):
                if piece is not None and (piece.c != c or len(piece.symbols) >= INTERVAL):
                    out.append(piece.row(part, number))
                    number, piece = number + 1, None
                piece = piece or _Piece(c)
                piece.add(letter, blank, later or k > 0, cut)
            if len(out) >= 1024:
                yield pd.DataFrame(out, columns=names)
                out = []
        yield pd.DataFrame(out, columns=names)
    if piece is not None:
        yield pd.DataFrame([piece.row(part, number)], columns=names)


_PARSED = "c string, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in _PARSED.split(", ")]
    now, counts, last, chart = None, [], None, Chart()
    for pdf in batches:
        out = []
        for x in pdf.itertuples(index=False):
            if x.c != now:
                if now is not None:
                    out.append((now, *counts, *cheapest(chart.whole())))
                now, counts, last, chart = x.c, [0, 0, 0, 0], None, Chart()
            counts = [a + b for a, b in zip(counts, (x.blank, x.duplicate, x.truncated, x.illegal))]
            counts[3] += last is not None and last + x.first not in _LEGAL
            last = x.last
            chart.add({divmod(int(at), 4): (int(cost), audit) for at, cost, audit in zip(x.pairs, x.costs, x.audits)})
        yield pd.DataFrame(out, columns=names)
    if now is not None:
        yield pd.DataFrame([(now, *counts, *cheapest(chart.whole()))], columns=names)


def parsed(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation: ``c`` (its key as text), gaps, blank, duplicate, truncated, illegal, cost, audit."""
    bounded_batches(rows.sparkSession)
    body = F.col("text")
    blank = ~body.rlike(f"[^{SPACE}]")
    cut = ~blank & ~body.rlike(rf"[.!?][{SPACE}]*\z")
    counted = _rows(rows, conversation, turn, role, text).select("c", "turn", "role", "digest", blank.alias("blank"), cut.alias("cut"))
    counted = stable(counted.groupBy("c", "turn", "role", "digest", "blank", "cut").agg(F.count("*").alias("n")))
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = counted.groupBy("c", "role", "digest").agg(F.min(place).alias("first"), F.count("*").alias("turns")).where("turns > 1")
    again = stable(again.drop("turns"))
    letter = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("x")
    marked = counted.join(again, ["c", "role", "digest"], "left").select(
        "c", "turn", "role", "digest", letter.alias("letter"), "n", "blank", F.coalesce(place > F.col("first"), F.lit(False)).alias("later"), "cut")
    order = ["c", "turn", "role", "digest"]
    dealt = marked.repartitionByRange(shuffle_partitions(rows), *order).sortWithinPartitions(*order)
    pieces = dealt.select("c", "letter", "n", "blank", "later", "cut").mapInPandas(_pieces, _PIECE)
    whole = pieces.repartition(shuffle_partitions(rows), "c").sortWithinPartitions("c", "part", "piece").mapInPandas(_merged, _PARSED)
    turns = counted.groupBy("c", "turn").agg(F.lit(1).alias("one")).groupBy("c").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    return turns.join(whole, "c").select("c", "gaps", *_COUNTS, "illegal", "cost", "audit")


def _edited(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, str | None, str, str | None]]:
    """(conversation, role or None if the row goes, text, edit) in order; rows that head a conversation carry its audit.

    After the last row of a conversation follows (conversation, None, "", None)."""
    now, audit, at, state = None, "", 0, 0

    def insertions(until_end: bool):
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            letter = "a" if state == 2 else "u"
            state, at = STEPS[state][letter], at + 1
            yield now, ROLES[letter], "", "I"
        if until_end:
            yield now, None, "", None

    for pdf in batches:
        for c, head, role, text in zip(pdf["c"], pdf["audit"], pdf["role"], pdf["text"]):
            if c != now:
                if now is not None:
                    yield from insertions(True)
                now, audit, at, state = c, head, 0, 0
                continue
            yield from insertions(False)
            edit, at = audit[at], at + 1
            if edit == "D":
                yield now, None, text, "D"
                continue
            letter = role[:1] if edit == "K" else "a" if state == 2 else "u"
            state = STEPS[state][letter]
            yield now, role if edit == "K" else ROLES[letter], text, edit
    if now is not None:
        yield from insertions(True)


def _emit_rows(batches):
    out, size, number, last = [], 0, 0, None
    for c, role, text, edit in _edited(batches):
        number = number if c == last else 0
        last = c
        if role is not None:
            out.append((c, number, role, text, edit))
            number, size = number + 1, size + len(text) + 64
        if size > 1 << 22:
            yield pd.DataFrame(out, columns=["c", "place", "role", "text", "edit"])
            out, size = [], 0
    yield pd.DataFrame(out, columns=["c", "place", "role", "text", "edit"])


def _emit_digests(batches):
    out, digest, any_row = [], hashlib.sha256(), False
    for c, role, text, edit in _edited(batches):
        if edit is None:
            out.append((c, digest.hexdigest()))
            digest, any_row = hashlib.sha256(), False
        elif role is not None:
            digest.update((("\n" if any_row else "") + f"{role}:{text}").encode())
            any_row = True
        if len(out) >= 4096:
            yield pd.DataFrame(out, columns=["c", "sha256"])
            out = []
    yield pd.DataFrame(out, columns=["c", "sha256"])


def _streamed(rows: DataFrame, found: DataFrame, names: tuple) -> DataFrame:
    """Rows of each conversation in order, after a row with its audit."""
    nothing = F.lit(None).cast("string")
    heads = found.select("c", F.lit(None).cast("long").alias("turn"), nothing.alias("role"), nothing.alias("digest"), nothing.alias("text"), "audit", F.lit(0).alias("kind"))
    both = heads.unionByName(_rows(rows, *names).select("*", nothing.alias("audit"), F.lit(1).alias("kind")))
    both = both.repartition(shuffle_partitions(rows), "c").sortWithinPartitions("c", "kind", "turn", "role", "digest")
    return both.select("c", "audit", "role", "text")


def repaired(rows: DataFrame, found: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired conversations: c, place (from 0), role, text, edit (K, R or I), given what ``parsed`` found."""
    return _streamed(rows, found, (conversation, turn, role, text)).mapInPandas(_emit_rows, "c string, place long, role string, text string, edit string")


def digests(rows: DataFrame, found: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(c, sha256) of the repaired ``role:text`` lines of each conversation, joined by newlines."""
    return _streamed(rows, found, (conversation, turn, role, text)).mapInPandas(_emit_digests, "c string, sha256 string")


def report(original: DataFrame, rows: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """One row for each conversation of ``original``: faults, cost, audit and digest of its repaired ``rows``."""
    bounded_batches(rows.sparkSession)
    found = stable(parsed(rows, conversation))
    named = original.select(F.col(conversation)).distinct().withColumn("c", _key(conversation))
    both = named.join(found, "c", "left").join(digests(rows, found, conversation), "c", "left")
    zero = [F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in ("gaps", *_COUNTS, "illegal", "cost")]
    return both.select(conversation, *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
