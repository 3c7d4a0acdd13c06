"""Conversation structure repair by least edits, with Four-Russians block tables.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``. Rows are kept (0, and only where the
grammar takes their role), given the role user or assistant (2), or deleted (3; a must for blank and duplicate rows);
rows of user or assistant without text may be inserted anywhere (2); a truncated row that stays costs 1 more. Of the
cheapest ways the one whose letters D, I, K, R, in order, come first in ASCII is taken.

The grammar has four states: nothing yet, after s, after u, after a. What the rows from a place to the end cost at
least is a vector over the states. Less its minimum, only a few such vectors exist, so they are numbered, and the
tables say for every vector and every block of three rows which vector stands before the block, and what is added:

1. rows get their order from a range partitioning, so a long conversation lies in several parts, each within a task;
2. each part goes through the tables, last block first, for every vector that may stand behind it;
3. a row per part is left of a conversation; from its end these give each part the vector behind it;
4. the rows stream by conversation: blocks of a part are looked up from its end, then each is expanded backward
   from the vector behind it into the vectors of its rows, and traced forward, by the letter that comes first among
   the cheapest. Only one part is held at a time, whatever the length of the conversation.

A duplicate repeats role and text of an earlier row. Rows that are the same in conversation, turn, role and text are
one row with a count, so a text said a million times is not in one task; a row's first place is joined back to it.

Rows go by turn (NULL first), then role, then text. A NULL role or text is one blank; rows of a NULL ``conv_id`` are one
conversation; an empty table gives no row; an empty conversation is well formed. Texts may be of any length. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import cache
from itertools import groupby, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sievework.session import stage

from .common import in_batches, rows_of

ROLES = ["system", "user", "assistant"]
#: fixed values: what an edit costs
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
COST = {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}
#: symbols: 2 * initial (s, u, a, other) + truncated, and one for rows that must go
GONE, SYMBOLS = 8, 9
BLOCK = 3
NONE, S, U, A = range(4)
#: the state behind a row of initial s, u, a, other; -1: not allowed there
AFTER = {NONE: (S, U, -1, -1), S: (-1, U, -1, -1), U: (-1, -1, A, -1), A: (-1, U, -1, -1)}
#: the state behind a row that may be given a role or be inserted
FREE = (U, U, A, U)
END = (0, 4, 2, 0)

Vector = tuple[int, int, int, int]


def before(symbol: int, behind: Vector) -> Vector:
    """The least cost from each state, with this row to come and ``behind`` what the states cost after it."""
    initial, late = symbol >> 1, symbol & 1
    out = []
    for state in range(4):
        ways = [DELETE + behind[state]]
        if symbol != GONE:
            ways.append(REROLE + late + behind[FREE[state]])
            if AFTER[state][initial] >= 0:
                ways.append(late + behind[AFTER[state][initial]])
        out.append(min(ways))
    while (better := [min(c, INSERT + out[FREE[s]]) for s, c in enumerate(out)]) != out:
        out = better
    return tuple(out)


class Tables:
    """The vectors that can occur, and where a block leads from each."""

    def __init__(self) -> None:
        least = lambda v: (tuple(x - min(v) for x in v), min(v))
        self.vectors, steps = [least(END)[0]], {}
        for v in self.vectors:  # grows while it is read
            for symbol in range(SYMBOLS):
                to, cost = least(before(symbol, v))
                if to not in self.vectors:
                    self.vectors.append(to)
                steps[v, symbol] = self.vectors.index(to), cost
        n = len(self.vectors)
        self.row = np.array([[steps[v, s] for s in range(SYMBOLS)] for v in self.vectors])  # vector, symbol: to, cost
        self.to = np.zeros((SYMBOLS**BLOCK, n), np.int64)
        self.cost = np.zeros((SYMBOLS**BLOCK, n), np.int64)
        for k, block in enumerate(product(range(SYMBOLS), repeat=BLOCK)):
            at, cost = np.arange(n), np.zeros(n, np.int64)
            for symbol in reversed(block):
                cost += self.row[at, symbol, 1]
                at = self.row[at, symbol, 0]
            self.to[k], self.cost[k] = at, cost

    def blocks(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that fill no block, at the front, and the numbers of the blocks behind them."""
        cut = len(symbols) % BLOCK
        return symbols[:cut], symbols[cut:].reshape(-1, BLOCK) @ np.array([SYMBOLS**k for k in reversed(range(BLOCK))])

    def through(self, symbols: np.ndarray) -> tuple[list[int], list[int]]:
        """For every vector behind the symbols: the vector before them, and the cost added."""
        front, blocks = self.blocks(symbols)
        at, cost = np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64)
        for k in blocks[::-1].tolist():
            cost += self.cost[k, at]
            at = self.to[k, at]
        for symbol in front[::-1].tolist():
            cost += self.row[at, symbol, 1]
            at = self.row[at, symbol, 0]
        return at.tolist(), cost.tolist()

    def edits(self, symbols: np.ndarray, behind: int, state: int, closes: bool) -> tuple[list[list[tuple[str, int]]], int]:
        """For each row its letters, inserts before it included, with the state behind each; and the last state.
        ``closes``: nothing follows, so one more list holds the inserts at the end."""
        front, blocks = self.blocks(symbols)
        edges = [behind]
        for k in blocks[::-1].tolist():
            edges.append(int(self.to[k, edges[-1]]))
        edges.reverse()  # the vector before each block, and behind the last
        pieces = [symbols[:len(front)], *symbols[len(front):].reshape(-1, BLOCK)]
        out: list[list[tuple[str, int]]] = []
        for piece, edge in zip(pieces, edges, strict=True):
            inner = [edge]
            for symbol in piece[::-1].tolist():  # expanded backward: the vector behind each row of the block
                inner.append(int(self.row[inner[-1], symbol, 0]))
            for symbol, after in zip(piece.tolist(), inner[-2::-1], strict=True):
                letters, state = self.trace(symbol, self.vectors[after], state)
                out.append(letters)
        if closes:
            tail = []
            while END[state]:
                state = FREE[state]
                tail.append(("I", state))
            out.append(tail)
        return out, state

    @staticmethod
    def trace(symbol: int, after: Vector, state: int) -> tuple[list[tuple[str, int]], int]:
        here, letters, initial, late = before(symbol, after), [], symbol >> 1, symbol & 1
        while True:
            if here[state] == DELETE + after[state]:
                return [*letters, ("D", state)], state
            if here[state] == INSERT + here[FREE[state]]:
                state = FREE[state]
                letters.append(("I", state))
                continue
            kept = AFTER[state][initial] if symbol != GONE else -1
            if kept >= 0 and here[state] == late + after[kept]:
                return [*letters, ("K", kept)], kept
            return [*letters, ("R", FREE[state])], FREE[state]


@cache
def tables() -> Tables:
    return Tables()


def said(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def counted(rows: DataFrame, times: Column | None = None) -> DataFrame:
    """A row for each different (conv_id, turn, role, text), with its symbol, fault and how often it is there: n.

    ``times``: how often a given row counts, 0 to drop it; a conversation stays known even without rows.
    """
    text = F.col("text")
    rows = rows.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), (F.lit(1) if times is None else times).cast("long").alias("n"))
    rows = rows.withColumn("digest", F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256))
    rows = rows.groupBy("conv_id", "turn", "role", "digest").agg(F.sum("n").alias("n"), F.first("text").alias("text"))
    initial = F.substring("role", 1, 1)
    blank = ~text.rlike(r"[^\x20\x09-\x0D]")
    late = ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")
    code = F.when(initial == "s", 0).when(initial == "u", 2).when(initial == "a", 4).otherwise(6) + late.cast("int")
    return rows.withColumns({"initial": initial, "blank": blank, "symbol": F.when(blank, GONE).otherwise(code)})


def in_order(rows: DataFrame) -> DataFrame:
    """``counted`` rows with the part of the conversation they lie in, their place in it, and whether they are
    the first of their role and text. Only rows that are there (n > 0) make another a duplicate."""
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = rows.filter("n > 0").groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(F.min(place).alias("place"))
    rows = rows.join(first, rows["conv_id"].eqNullSafe(first["c"]) & (rows["digest"] == first["d"]), "left")
    rows = rows.withColumn("is_first", F.col("place").eqNullSafe(place)).drop("c", "d", "place")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    return (
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id())
    )


def symbols_of(rows) -> np.ndarray:
    """The symbols of (symbol, n, is_first): one for each row that is there. Its further copies are duplicates, and a row
    that must go leaves every vector as it is: deleting it comes first among the letters, whatever the state."""
    return np.array([symbol if first else GONE for symbol, n, first in rows if n], np.int64)


def parts_with_ends(rows: DataFrame) -> DataFrame:
    """(conv_id, part, behind, closes): the number of the vector behind each part, and whether it is the last.

    Nothing is behind the only part of a conversation. Only the few conversations that the range partitioning cut,
    at most one a boundary, go through the tables for it.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()

    def through(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        at, _ = tables().through(symbols_of(zip(*(table[c].to_pylist() for c in ("symbol", "n", "is_first")), strict=True)))
        return pa.table({"conv_id": table["conv_id"][:1], "part": table["part"][:1], "leads": pa.array([at], pa.list_(pa.int32()))})

    def ends(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        behind = [0]  # the vector of END is the first
        for leads in reversed(table["leads"].to_pylist()):
            behind.append(leads[behind[-1]])
        behind = behind[-2::-1]
        return table.select(["conv_id", "part"]).append_column("behind", pa.array(behind, pa.int32())).append_column(
            "closes", pa.array([k == len(behind) - 1 for k in range(len(behind))]))

    parts = rows.groupBy("conv_id").agg(F.min("part").alias("part"), F.max("part").alias("last"))
    whole = parts.filter("part = last").select("conv_id", "part", F.lit(0).alias("behind"), F.lit(True).alias("closes"))
    split = parts.filter("part < last").select(F.col("conv_id").alias("c"))
    rows = rows.select("conv_id", "part", "place", "symbol", "n", "is_first")
    led = rows.join(split, rows["conv_id"].eqNullSafe(split["c"]), "left_semi").groupBy("conv_id", "part").applyInArrow(
        through, f"conv_id {kind}, part int, leads array<int>")
    return whole.unionByName(led.groupBy("conv_id").applyInArrow(ends, f"conv_id {kind}, part int, behind int, closes boolean"))


def edits(rows: DataFrame, times: Column | None = None) -> DataFrame:
    """A row per edit, in order within its conversation, and conversations whole within a partition:

    conv_id, turn, letter, role and text after the edit (as before for D), was (the initial before; NULL for I), fault
    (NULL, blank, duplicate, truncated), cost. A conversation without rows has one row with no letter.
    """
    ordered = stage(in_order(counted(rows, times)), "turns")
    kind, turn = (ordered.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    heads = parts_with_ends(ordered)
    both = ordered.withColumn("head", F.lit(False)).unionByName(heads.withColumn("head", F.lit(True)), allowMissingColumns=True)
    both = both.repartition("conv_id").sortWithinPartitions("conv_id", "part", F.col("head").desc(), "place")
    names = ["conv_id", "turn", "role", "text", "initial", "symbol", "blank", "n", "is_first", "part", "head", "behind", "closes"]

    def rows(batches):
        state = NONE
        for (conv, _), group in groupby(rows_of(batches, len(names)), key=lambda r: (r[0], r[9])):
            head, *held = group
            behind, closes = head[11:13]
            ways, state = tables().edits(symbols_of((r[5], r[7], r[8]) for r in held), behind, state, closes)
            way, empty = iter(ways), not any(r[7] for r in held)
            for _, turn, role, text, initial, symbol, blank, n, first, *_ in held:
                for k in range(n):
                    fault = "blank" if blank else "duplicate" if k or not first else "truncated" if symbol & 1 else None
                    for letter, now in next(way) if k == 0 else [("D", None)]:
                        if letter == "I":
                            yield conv, None, "I", ROLES[now - 1], "", None, None, INSERT
                        else:
                            cost = COST[letter] + (TRUNCATED if fault == "truncated" and letter != "D" else 0)
                            yield conv, turn, letter, ROLES[now - 1] if letter == "R" else role, text, initial, fault, cost
            if closes:
                for _, now in next(way):
                    yield conv, None, "I", ROLES[now - 1], "", None, None, INSERT
                state = NONE
            if empty:
                yield conv, None, None, None, None, None, None, 0

    schema = pa.schema([
        ("conv_id", to_arrow_type(ordered.schema["conv_id"].dataType)), ("turn", to_arrow_type(ordered.schema["turn"].dataType)),
        *((n, pa.string()) for n in ("letter", "role", "text", "was", "fault")), ("cost", pa.int64()),
    ])
    return both.select(*names).mapInArrow(
        lambda batches: in_batches(rows(batches), schema),
        f"conv_id {kind}, turn {turn}, letter string, role string, text string, was string, fault string, cost long",
    )


def report(edited: DataFrame) -> DataFrame:
    """What ``edits`` gave, folded in its order: a row per conversation, its repaired rows as a digest."""
    kind = edited.schema["conv_id"].dataType

    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def rows(batches):
        for conv, group in groupby(rows_of(batches, 8), key=lambda r: r[0]):
            faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
            illegal = cost = distinct = 0
            low = high = before_it = None
            letters, digest, between = [], hashlib.sha256(), ""
            for _, turn, letter, role, text, was, fault, price in group:
                if letter is None:
                    continue
                cost += price
                letters.append(letter)
                if letter != "D":
                    digest.update(f"{between}{role}:{text}".encode("utf-8", "replace"))
                    between = "\n"
                if letter == "I":
                    continue
                if fault:
                    faults[fault] += 1
                illegal += before_it is not None and before_it + was not in ("su", "ua", "au")
                before_it = was
                if turn is not None:
                    distinct += turn != high
                    low, high = turn if low is None else low, turn
            gaps = 0 if low is None else high - low + 1 - distinct
            yield conv, gaps, *faults.values(), illegal, cost, "".join(letters), digest.hexdigest()

    schema = pa.schema([("conv_id", to_arrow_type(kind)), *((n, pa.int64()) for n in counts), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    return edited.mapInArrow(
        lambda batches: in_batches(rows(batches), schema),
        f"conv_id {kind.simpleString()}, {', '.join(f'{n} long' for n in counts)}, audit string, repaired_sha256 string",
    )
