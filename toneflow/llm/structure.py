"""Repair of conversation structure by weighted CYK parsing of intervals.

The roles of a sound conversation, by their first letters, are ``(s?(ua)+)?``.
Its states are B (nothing yet), S (after a system turn), U (after a user turn)
and A (after an assistant turn); B and A may end.  Nonterminal (p, q) of the
repair grammar derives every way to edit a span of turns so that it leads from
state p to state q.  The grammar is in Chomsky normal form: binary rules
(p, q) -> (p, r) (r, q), and terminal rules for the edits of one turn, closed
under insertions before and after it.  A cell of the chart holds, for every
nonterminal, the least (cost, audit) of a span; cells are filled bottom-up by
span length over all places to cut a span in two.

Edits: K keeps a turn, R gives it the role of a user or an assistant, D deletes
it, I inserts a turn without text.  The audit is their letters in order; among
equally cheap repairs the least audit wins.  Equal cost and one audit a prefix
of the other cannot be, since every further I costs, so the least cell of a
span may be taken before spans are joined.

A chart covers ``ARITY`` units; its top cell is one unit of the next chart, so
work grows with the conversation and not with its cube.  That loses nothing:
(p, q) derives all repairs of a span, and a repair of a whole leads through some
state at every cut.  Turns are dealt in segments of ``SEGMENT``, whose cells are
joined in further rounds, so no task sees all turns of a long conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from toneflow.llm.ordering import positions
from toneflow.llm.tables import OWN, stored

ARITY, SEGMENT = 8, 512
#: Blank characters; characters that end a sentence.
BLANK, ENDS = " \t\n\x0b\x0c\r", ".!?"
#: Costs of the edits, and of keeping a truncated turn.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Moves of the states by role letter; pairs of letters that may stand side by side.
MOVES = {"B": {"s": "S", "u": "U"}, "S": {"u": "U"}, "U": {"a": "A"}, "A": {"u": "U"}}
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}
STATES = "BSUA"

Cell = dict[str, tuple[int, str]]


def join_cells(left: Cell, right: Cell) -> Cell:
    """Cell of two adjacent spans that are cut here: binary rules of the grammar."""
    out: Cell = {}
    for a, (cost, audit) in left.items():
        for q in STATES:
            if (other := right.get(a[1] + q)) is not None:
                found = (cost + other[0], audit + other[1])
                if (key := a[0] + q) not in out or found < out[key]:
                    out[key] = found
    return out


def least(a: Cell, b: Cell) -> Cell:
    return {key: min(a[key], b[key]) if key in a and key in b else a.get(key) or b[key] for key in {*a, *b}}


def insertions() -> Cell:
    """The least insertions that lead from state to state, none included."""
    one: Cell = {p + q: (INSERT, "I") for p in MOVES for letter, q in MOVES[p].items() if letter in ROLES}
    out: Cell = {p + p: (0, "") for p in STATES}
    while (further := least(out, join_cells(out, one))) != out:
        out = further
    return out


GAP = insertions()


def unit(kind: str) -> Cell:
    """Cell of one turn: its edits between insertions.  Kinds are given by :func:`kinds`."""
    edits: Cell = {p + p: (DELETE, "D") for p in STATES}
    if kind != "d":
        extra = TRUNCATED if kind.isupper() else 0
        for p, moves in MOVES.items():
            for letter, q in moves.items():
                if letter in ROLES:
                    edits[p + q] = min(edits.get(p + q, (99, "")), (REROLE + extra, "R"))
                if letter == kind.lower():
                    edits[p + q] = min(edits.get(p + q, (99, "")), (extra, "K"))
    return join_cells(join_cells(GAP, edits), GAP)


def chart(units: list, known: dict) -> Cell:
    """Top cell of a chart over a few units, a string of kinds or cells with their indices as keys in ``known``.

    Spans that were parsed before are looked up: a cell depends on the span alone.
    """
    for length in range(1, len(units) + 1):
        for i in range(len(units) - length + 1):
            span = units[i:i + length]
            if span not in known:
                cell: Cell = {}
                for cut in range(1, length):
                    cell = least(cell, join_cells(known[span[:cut]], known[span[cut:]]))
                known[span] = cell or unit(span)
    return known[units]


def parse_cells(cells: list[Cell]) -> Cell:
    """Cell of a row of adjacent cells, by charts over ``ARITY`` of them at a time."""
    while len(cells) > 1:
        cells = [chart(tuple(range(len(part))), {(k,): c for k, c in enumerate(part)})
                 for part in (cells[i:i + ARITY] for i in range(0, len(cells), ARITY))]
    return cells[0]


def parse_kinds(text: str, known: dict[str, Cell]) -> Cell:
    """Cell of a row of turns, one letter each."""
    if len(known) > 20_000:
        known.clear()
    return parse_cells([chart(text[i:i + ARITY], known) for i in range(0, len(text), ARITY)])


def cheapest(cell: Cell) -> tuple[int, str]:
    """Least (cost, audit) of a whole conversation."""
    return min(cell[key] for key in ("BB", "BA") if key in cell)


def replay(audit: str, roles: Iterator[str]) -> Iterator[tuple[str, str | None]]:
    """(edit, role afterwards) for every letter of an audit, given the roles of the turns it edits."""
    state = "B"
    for letter in audit:
        role = None if letter == "I" else next(roles)
        if letter == "D":
            yield letter, None
            continue
        if letter != "K":
            role = ROLES["a" if state == "U" else "u"]
        state = MOVES[state][role[:1]]
        yield letter, role


# -- turns -------------------------------------------------------------------------------------------

#: A cell in a table: pairs of states, costs and audits side by side.
CELL = "struct<pairs:array<string>,costs:array<bigint>,audits:array<string>,illegal:bigint,ends:string>"


def _pack(cell: Cell, illegal: int, ends: str) -> dict:
    return {"pairs": list(cell), "costs": [c for c, _ in cell.values()], "audits": [a for _, a in cell.values()],
            "illegal": illegal, "ends": ends}


def _breaks(letters: list[str]) -> int:
    """Adjacent letters that may not stand side by side."""
    return sum(a + b not in LEGAL for a, b in zip(letters, letters[1:], strict=False))


def _segment_cells(kinds: pd.Series, letters: pd.Series) -> pd.DataFrame:
    known: dict[str, Cell] = {}
    return pd.DataFrame([_pack(parse_kinds(k, known), _breaks(list(x)), x[0] + x[-1])
                         for k, x in zip(kinds, letters, strict=True)], columns=["pairs", "costs", "audits", "illegal", "ends"])


def _joined_cells(groups: pd.Series) -> pd.DataFrame:
    out = []
    for group in groups:
        cells = [dict(zip(g["pairs"], zip(map(int, g["costs"]), g["audits"], strict=True), strict=True)) for g in group]
        illegal = sum(int(g["illegal"]) for g in group) + sum(
            a["ends"][1] + b["ends"][0] not in LEGAL for a, b in zip(group, group[1:], strict=False))
        out.append(_pack(parse_cells(cells), illegal, group[0]["ends"][0] + group[-1]["ends"][1]))
    return pd.DataFrame(out, columns=["pairs", "costs", "audits", "illegal", "ends"])


def faults(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv, turn, role, sha, pos, fault): one light row per turn, in order, with the first of its faults.

    Turns of a conversation are ordered by number (nulls first), then role,
    then SHA-256 of role and text.  Faults are ``blank`` (nothing but ASCII
    blanks), ``duplicate`` (role and text occur earlier), ``truncated`` (the
    last character that is no blank ends no sentence), or null.  A null role or
    text is empty.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    cut = F.rtrim(text, F.lit(BLANK))
    light = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.substring(role, 1, 1).alias("letter"), role.alias("role"),
        sha(role, text).alias("sha"), (cut == "").alias("blank"),
        (~F.substring(cut, -1, 1).isin(*ENDS)).alias("truncated"))
    rows = stored(positions(light, "conv", F.col("turn").asc_nulls_first(), F.col("role"), F.col("sha")), "positions")
    first = rows.groupBy(F.col("conv").alias("of"), F.col("sha").alias("same")).agg(
        F.min("pos").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    rows = rows.join(stored(first, "repeats"), F.col("conv").eqNullSafe(F.col("of")) & (F.col("sha") == F.col("same")), "left")
    again = F.coalesce(F.col("pos") > F.col("first"), F.lit(False))
    fault = F.when(F.col("blank"), "blank").when(again, "duplicate").when(F.col("truncated"), "truncated")
    return rows.select("conv", "turn", "letter", "sha", "pos", fault.alias("fault"))


def sha(role: Column, text: Column) -> Column:
    """Digest of a turn's role and text."""
    return F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)


def kinds() -> Column:
    """One letter a turn: ``d`` must go; s, u, a, x by role, in upper case if truncated."""
    letter = F.when(F.col("letter").isin("s", "u", "a"), F.col("letter")).otherwise("x")
    return F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault").isNull(), letter).otherwise(F.upper(letter))


def parse(found: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv, cost, audit, illegal) of every conversation of :func:`faults`."""
    at = F.floor(F.col("pos") / segment)
    letter = F.when(F.col("letter") == "", F.lit(" ")).otherwise(F.col("letter"))
    turn = F.sort_array(F.collect_list(F.struct("pos", kinds().alias("kind"), letter.alias("letter"))))
    rows = found.groupBy("conv", at.alias("at")).agg(turn.alias("turns"))
    # One letter a turn in both strings; a letter is one character, whatever it is.
    cells = rows.select("conv", "at", F.pandas_udf(_segment_cells, CELL)(
        F.concat_ws("", "turns.kind"), F.concat_ws("", "turns.letter")).alias("cell"))
    cells = stored(cells, "cells")
    while (cells.agg(F.max("at")).first()[0] or 0) > 0:
        group = F.sort_array(F.collect_list(F.struct("at", "cell")))
        rows = cells.groupBy("conv", F.floor(F.col("at") / segment).alias("at")).agg(group["cell"].alias("cells"))
        cells = stored(rows.select("conv", "at", F.pandas_udf(_joined_cells, CELL)("cells").alias("cell")), "cells")
    best = F.pandas_udf(_best, "struct<cost:bigint,audit:string>")("cell")
    return cells.select("conv", best.alias("best"), F.col("cell.illegal").alias("illegal")).select(
        "conv", "best.cost", "best.audit", "illegal")


def _best(cells: pd.DataFrame) -> pd.DataFrame:
    rows = (zip(c.pairs, zip(c.costs, c.audits, strict=True), strict=True) for c in cells.itertuples())
    return pd.DataFrame([cheapest({p: (int(x), a) for p, (x, a) in r}) for r in rows], columns=["cost", "audit"])


# -- results -----------------------------------------------------------------------------------------


def summary(found: DataFrame, parsed: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation with turns."""
    number = F.col("turn").cast("decimal(38,0)")
    turns = found.groupBy("conv", "turn").agg(
        *[F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")])
    gaps = F.max(number) - F.min(number) + 1 - F.count("turn")
    counts = turns.groupBy("conv").agg(
        F.coalesce(gaps, F.lit(0)).try_cast("long").alias("gaps"), *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")])
    other = parsed.withColumnRenamed("conv", "of")
    return counts.join(other, F.col("conv").eqNullSafe(F.col("of"))).drop("of")


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, place, turn, role, text, edit) of every repaired turn, and (conv, None, ...) at the end of a conversation.

    Rows come sorted; the first of a conversation is its audit.  What is held is the audit and one batch.
    """
    now, steps, place, todo = None, None, 0, None
    for batch in batches:
        for conv, head, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "head", "turn", "role", "text")), strict=True):
            if head:
                if steps is not None:
                    yield from _inserted(now, steps, place)
                now, place, todo = conv, 0, []
                steps = replay(text, iter(todo.pop, None))
                continue
            todo.append(role)
            for edit, new in steps:
                if edit == "I":
                    yield now, place, None, new, "", edit
                elif edit != "D":
                    yield now, place, turn, new, text, edit
                place += edit != "D"
                if edit != "I":
                    break
    if steps is not None:
        yield from _inserted(now, steps, place)


def _inserted(conv, steps: Iterator, place: int) -> Iterator[tuple]:
    for edit, role in steps:
        yield conv, place, None, role, "", edit
        place += 1
    yield conv, None, None, None, None, None


def _sorted_turns(turns: DataFrame, parsed: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Every conversation's audit, then its turns in order, in one task; the digest or the numbers of its turns need them in a row."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    rows = turns.select(F.col(conv_col).alias("conv"), F.lit(False).alias("head"), F.col(turn_col).alias("turn"),
                        role.alias("role"), text.alias("text"), sha(role, text).alias("sha"))
    empty = F.lit(None)
    heads = parsed.select("conv", F.lit(True).alias("head"), empty.cast(turns.schema[turn_col].dataType).alias("turn"),
                          empty.cast("string").alias("role"), F.col("audit").alias("text"), empty.cast("string").alias("sha"))
    return rows.union(heads).repartition("conv").sortWithinPartitions(
        F.col("conv").asc_nulls_first(), F.col("head").desc(), F.col("turn").asc_nulls_first(), "role", "sha")


def repaired(turns: DataFrame, parsed: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv, place, turn, role, text, edit): the turns of every conversation after its repair, numbered from 0.

    Inserted turns have no number of their own and an empty text.
    """
    kind = {f.name: f.dataType for f in turns.schema}
    schema = StructType([StructField("conv", kind[conv_col])]).add("place", "long").add("turn", kind[turn_col])
    schema = schema.add("role", "string").add("text", "string").add("edit", "string")

    def rows(batches):
        out: list[list] = [[] for _ in schema.names]
        size = 0
        for row in _stream(batches):
            if row[1] is not None:
                for column, value in zip(out, row, strict=True):
                    column.append(value)
                size += 64 + len(row[4])
            if size > 1 << 24:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in zip(*out, strict=True)], schema=arrow)
                out, size = [[] for _ in schema.names], 0
        if out[0]:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in zip(*out, strict=True)], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return _sorted_turns(turns, parsed, conv_col, turn_col, role_col, text_col).mapInArrow(rows, schema)


def digests(turns: DataFrame, parsed: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv, sha256) over ``role:text`` lines of every repaired conversation, fed line by line."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([StructField("conv", turns.schema[conv_col].dataType)]).add("sha256", "string")
    arrow = to_arrow_schema(schema)

    def rows(batches):
        out, digest = [], hashlib.sha256()
        for conv, place, _, role, text, _ in _stream(batches):
            if place is None:
                out.append({"conv": conv, "sha256": digest.hexdigest()})
                digest = hashlib.sha256()
            else:
                digest.update(("\n" * (place > 0) + f"{role}:{text}").encode("utf-8", "replace"))
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return _sorted_turns(turns, parsed, conv_col, turn_col, role_col, text_col).mapInArrow(rows, schema)
