"""Repaired conversations against a search that keeps every cheapest audit."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from gleanwork.llm import repair

_NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}


def _with_inserts(best):
    todo = [(s, k) for s in best for k in best[s]]
    while todo:
        state, key = todo.pop()
        if key[1].endswith("II"):
            continue
        to, role = (3, "assistant") if state == 2 else (2, "user")
        longer = key[0] + 5, key[1] + "I"
        if longer not in best.setdefault(to, {}):
            best[to][longer] = (*best[state][key], (role, ""))
            todo.append((to, longer))
    for state, found in best.items():
        least = min(k[0] for k in found)
        best[state] = {k: v for k, v in found.items() if k[0] == least}
    return best


def cheapest(rows):
    """``((cost, audit), lines)`` of ``(role, text, fault)`` rows."""
    best = _with_inserts({0: {(0, ""): ()}})
    for role, text, fault in rows:
        made = defaultdict(dict)
        late = 5 if fault == "truncated" else 0
        for state, found in best.items():
            filled = (3, "assistant") if state == 2 else (2, "user")
            kept = _NEXT.get(role[:1], {}).get(state)
            for (cost, audit), lines in found.items():
                made[state].setdefault((cost + 2, audit + "D"), lines)
                if fault in ("blank", "duplicate"):
                    continue
                if kept is not None:
                    made[kept].setdefault((cost + late, audit + "K"), (*lines, (role, text)))
                made[filled[0]].setdefault(
                    (cost + 1 + late, audit + "R"), (*lines, (filled[1], text))
                )
        best = _with_inserts(dict(made))
    return min((k, v) for s in (0, 3) for k, v in best.get(s, {}).items())


def plain(rows, damage=True):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        kind = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20 if damage else 9
        role, text = shown[2], shown[3]
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = turn, "user" if kind == 4 else role, text
        turns[conv] += [] if kind == 0 else [row] * (2 if kind == 3 else 1)
    out = []
    for conv, held in turns.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, count, faults = set(), Counter(), []
        for _, role, text in held:
            end = text.strip(" \t\n\x0b\x0c\r")[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else ""
            if not fault and end not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            count[fault] += 1
            faults.append((role, text, fault))
        known = [t for t, *_ in held if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        pairs = zip(faults, faults[1:])
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs)
        (cost, audit), lines = cheapest(faults)
        told = "\n".join(f"{r}:{t}" for r, t in lines)
        out.append(
            (str(conv), gaps, count["blank"], count["duplicate"], count["truncated"], illegal,
             cost, audit, hashlib.sha256(told.encode()).hexdigest())
        )
    return sorted(out)


def found(df, **more):
    return sorted((str(r[0]), *r[1:]) for r in repair.repair(df, **more).collect())


def conversations(seed, n):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", None, "", "sage", "ü"]
    texts = ["a.", "b.", "c", "", " \n", "d!", None, "e?", "f", "g.", "h.", "i\x85", "j.\x0b"]
    return [
        (
            draw.choice([None, 1, 2, 3]),
            draw.choice([None, *range(9)]),
            draw.choice(roles),
            draw.choice(texts),
        )
        for _ in range(n)
    ]


SCHEMA = "conv_id int, turn long, role string, text string"


@pytest.mark.parametrize("turns", [1, 3, 4096])
def test_blocks_of_any_size_give_the_cheapest_repair(spark, monkeypatch, turns):
    monkeypatch.setattr(repair, "BLOCK_TURNS", turns)
    rows = conversations(turns, 70)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(df) == plain(rows)
    assert found(df, damage=False) == plain(rows, False)


def test_passes_go_on_where_vectors_do_not_converge(spark, monkeypatch):
    """Turns that must go carry a vector unchanged through every block."""
    monkeypatch.setattr(repair, "BLOCK_TURNS", 2)
    texts = ["a.", *["" for _ in range(11)], "b.", "c.", "d."]
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df, damage=False) == plain(rows, False)


def test_vectors_that_differ_by_a_constant_are_one():
    costs = repair.Costs()
    for letters in ("ua" * 40, "uasxUA-+" * 20, "x" * 30):
        vector = repair.LAST
        for letter in letters:
            vector, _ = costs.back(vector, letter)
    assert len({v for v, _ in costs.known}) < 30


def test_lost_conversations_other_columns_and_empty_tables(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame(
        [(lost, 0, "user", "a.", 1, 2)],
        "conv_id int, turn int, role string, text string, block int, `a.b` int",
    )
    row = repair.repair(df).first()
    assert row["audit"] == "" and row["cost"] == row["gaps"] == 0
    assert row["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert repair.repair(df.limit(0)).count() == 0


def test_other_id_types_repeated_rows_and_long_texts(spark):
    long = "word " * 300_000 + "end."
    rows = [("x:1", 0, "user", long), ("x:1", 0, "user", long), ("x:1", 1, "assistant", "b.")]
    df = spark.createDataFrame(rows, SCHEMA.replace("int", "string", 1))
    row = repair.repair(df, damage=False).first()
    assert (row["conv_id"], row["audit"], row["duplicate"]) == ("x:1", "KDK", 1)
