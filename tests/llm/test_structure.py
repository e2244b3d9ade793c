from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from toneflow.llm import queries, structure

from .conftest import CLASHING

SOUND = re.compile(r"(s?(ua)+)?")


def enumerate_repairs(kinds: str) -> tuple[int, str]:
    """All edits of all turns, with up to two insertions in every gap."""
    options = []
    for k in kinds:
        keep = [] if k == "d" else [("K", k.lower(), 5 * k.isupper())] + [("R", r, 1 + 5 * k.isupper()) for r in "ua"]
        options.append([("D", "", 2), *keep])
    gaps = [[("I" * n, "".join(x), 5 * n) for n in range(3) for x in product("ua", repeat=n)]]
    best = None
    for choice in product(*[o for k in options for o in (gaps[0], k)], gaps[0]):
        if SOUND.fullmatch("".join(c[1] for c in choice)):
            found = sum(c[2] for c in choice), "".join(c[0] for c in choice)
            best = found if best is None or found < best else best
    return best


def walk(kinds: str) -> tuple[int, str]:
    """The same turn by turn over the states of the pattern."""
    moves = {("B", "s"): "S", ("B", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}

    def settle(best):
        changed = True
        while changed:
            changed = False
            for p, (c, a) in list(best.items()):
                for (q, letter), r in moves.items():
                    if q == p and letter in "ua" and (c + 5, a + "I") < best.get(r, (1 << 60, "")):
                        best[r], changed = (c + 5, a + "I"), True
        return best

    best = settle({"B": (0, "")})
    for k in kinds:
        new: dict = {}
        for p, (c, a) in best.items():
            tries = [(p, c + 2, a + "D")]
            if k != "d":
                extra = 5 * k.isupper()
                tries += [(moves[p, r], c + 1 + extra, a + "R") for r in "ua" if (p, r) in moves]
                tries += [(moves[p, k.lower()], c + extra, a + "K")] if (p, k.lower()) in moves else []
            for q, cost, audit in tries:
                new[q] = min(new.get(q, (1 << 60, "")), (cost, audit))
        best = settle(new)
    return min(best[s] for s in "BA" if s in best)


@pytest.mark.parametrize("n", range(4))
def test_all_short_conversations(n):
    for kinds in product("suaxSUAXd", repeat=n):
        assert walk("".join(kinds)) == enumerate_repairs("".join(kinds)) if n < 3 or hash(kinds) % 29 == 0 else True
        if n:
            assert structure.cheapest(structure.parse_kinds("".join(kinds), {})) == walk("".join(kinds)), kinds


def test_long_conversations_by_charts_of_charts():
    rng = random.Random(5)
    for n in (7, 8, 9, 64, 65, 300):
        kinds = "".join(rng.choice("suuuaaaxUAd") for _ in range(n))
        assert structure.cheapest(structure.parse_kinds(kinds, {})) == walk(kinds)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute(original, rows):
    """Results of every conversation of ``original`` whose turns are ``rows``."""
    out = {}
    for conv in {r[0] for r in original}:
        turns = [r for r in rows if r[0] == conv]
        sha = [hashlib.sha256(f"{len(r[2].encode())}:{r[2]}{r[3]}".encode()).hexdigest() for r in turns]
        turns = [t for _, t in sorted(zip(sha, turns, strict=True), key=lambda x: (x[1][1] is not None, x[1][1] or 0, x[1][2], x[0]))]
        seen, kinds, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in turns:
            cut = text.rstrip(" \t\n\x0b\x0c\r")
            fault = ("blank" if not cut else "duplicate" if (role, text) in seen else "truncated" if cut[-1] not in ".!?" else None)
            seen.add((role, text))
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            kinds += "d" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
            if fault:
                counts[fault] += 1
        cost, audit = walk(kinds)
        lines, left, state = [], iter(turns), "B"
        for edit in audit:
            turn = None if edit == "I" else next(left)
            if edit == "D":
                continue
            role = turn[2] if edit == "K" else "assistant" if state == "u" else "user"
            state = role[0]
            lines.append(f"{role}:{turn[3] if turn else ''}")
        numbers = [t[1] for t in turns if t[1] is not None]
        letters = [t[2][:1] for t in turns]
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, counts["blank"], counts["duplicate"],
                     counts["truncated"], sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:], strict=False)),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def results(df):
    return {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"])
            for r in df.collect()}


def run(spark, tmp_path, rows, clash=False):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.select("*", *[F.lit(c).alias(c) for c in CLASHING]) if clash else df
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    return results(queries.op13_structure(spark, str(tmp_path)))


ROWS = [(None, 0, "user", "Hi."), (None, None, "assistant", "Yes"), (1, 0, None, None), (1, 1, "user", "a."), (1, 1, "user", "a."), (1, 1, "", "b!"),
        (1, None, "assistant", "c?"), (2, 5, "user", ""), (2, 9, "user", " \t\n"), (3, 0, "system", "S."), (3, 1, "user", "x" * 100_000 + "."),
        (3, 2, "assistant", "é. \n"), (4, 0, "😀", "z."), (5, -7, "assistant", "q"), (5, 7, "user", "q\xa0."), (6, 1, "user", "line\nbreak.")]


@pytest.mark.parametrize("clash", [False, True])
def test_odd_rows(spark, tmp_path, clash):
    assert run(spark, tmp_path, ROWS, clash) == brute(ROWS, damage(ROWS))


def test_empty_table(spark, tmp_path):
    assert run(spark, tmp_path, []) == {}


def test_turns_without_end(spark, tmp_path):
    rows = [(1, -(1 << 63), "user", "a."), (1, (1 << 63) - 1, "assistant", "b.")]
    assert run(spark, tmp_path, rows).keys() == {1}


def test_one_conversation_with_most_turns_in_segments(spark, tmp_path, monkeypatch):
    """A small segment makes several rounds of joining cells, and the stream crosses batches."""
    rng = random.Random(9)
    rows = [(0, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["Same.", f"Other {t}.", "cut", ""])) for t in range(700)]
    rows += [(c, t, ("user", "assistant")[t % 2], f"{c} {t}.") for c in range(1, 60) for t in range(c % 7)]
    monkeypatch.setattr(structure.parse, "__defaults__", (5,))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        assert run(spark, tmp_path, rows) == brute(rows, damage(rows))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_repaired_turns(spark):
    rows = [(1, 3, "system", "s."), (1, 4, "assistant", "no user."), (1, 5, "user", "u."), (2, 0, "user", "only."), (3, 0, "user", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    parsed = structure.parse(structure.faults(turns))
    df = structure.repaired(turns, parsed)
    assert df.schema["turn"].dataType.simpleString() == "int"
    # A single user turn and a blank one go; swapped roles are cheaper than anything else.
    assert sorted(map(tuple, df.select("conv", "place", "turn", "role", "text", "edit").collect())) == [
        (1, 0, 3, "system", "s.", "K"), (1, 1, 4, "user", "no user.", "R"), (1, 2, 5, "assistant", "u.", "R")]
    # A system turn between two pairs goes.
    rows = [(1, t, r, f"{t}.") for t, r in enumerate(["user", "assistant", "system", "user", "assistant"])]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    parsed = structure.parse(structure.faults(turns))
    assert [tuple(r) for r in parsed.select("cost", "audit").collect()] == [(2, "KKDKK")]
    assert [r["turn"] for r in structure.repaired(turns, parsed).orderBy("place").collect()] == [0, 1, 3, 4]
