"""Conversation repair by a Viterbi search whose blocks run side by side.

A conversation is a row of turns; keeping, changing the role of, deleting and
inserting turns are edits with a cost, and the kept roles have to read
``(s?(ua)+)?`` by their initials. The costs to finish from the four states of
that grammar form a vector per turn. Turns are cut into blocks, and all blocks
are walked backwards at once from a speculative vector. A fix-up pass gives
every block the true vector of the block behind it and walks again only until
its vector differs by a constant from the one it had, as all earlier vectors
then do too. Passes end when no block changes. The same relay hands the state
from block to block for the forward trace, which takes the smallest edit of
those that keep the cheapest cost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanwork.functions.joins import attach
from gleanwork.functions.numbering import numbered
from gleanwork.session import settle

#: Turns of a block.
BLOCK_TURNS = 4096

# Costs of the edits.
_RENAME, _DELETE, _INSERT, _TRUNCATED = 1, 2, 5, 5

# States of the grammar: nothing yet, after s, after u, after a.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STEP = {
    "s": (_SYSTEM, None, None, None),
    "u": (_USER, _USER, None, _USER),
    "a": (None, None, _ASSISTANT, None),
}
#: What an inserted or renamed turn is, and leads to, from each state.
_FILL = ("u", "u", "a", "u")
_FILLED = (_USER, _USER, _ASSISTANT, _USER)
_NAMES = {"u": "user", "a": "assistant"}

Vector = tuple[int, int, int, int]


def inserted(vector: Vector) -> Vector:
    """Costs to finish if turns may be inserted first."""
    best = list(vector)
    for _ in range(3):
        best = [min(best[s], _INSERT + best[_FILLED[s]]) for s in range(4)]
    return tuple(best)


def lowered(vector: Vector) -> tuple[Vector, int]:
    """The vector with its least cost taken off, and that cost."""
    least = min(vector)
    return tuple(v - least for v in vector), least


#: Costs after the last turn: only nothing and ``(s?(ua)+)`` may end. The high
#: number stands for no way; inserts always lead to an end.
LAST = lowered(inserted((0, 1_000, 1_000, 0)))[0]


class Costs:
    """Steps of the search, remembered: vectors that differ by a constant are
    one, so only a few exist and a turn costs a look-up.

    A turn is a letter: the initial s, u, a or - for any other, in upper case
    if it is truncated; ``x`` has to be deleted.
    """

    def __init__(self) -> None:
        self.known: dict[tuple[Vector, str], tuple[Vector, int]] = {}
        self.chosen: dict[tuple[Vector, str, int], tuple[str, int, int]] = {}

    @staticmethod
    def edits(letter: str, state: int) -> Iterator[tuple[str, int, int]]:
        """Edit, cost and next state of a turn; inserts are no turn."""
        yield "D", _DELETE, state
        if letter == "x":
            return
        late = _TRUNCATED if letter.isupper() or letter == "+" else 0
        kept = _STEP.get(letter.lower(), (None,) * 4)[state]
        if kept is not None:
            yield "K", late, kept
        yield "R", _RENAME + late, _FILLED[state]

    def back(self, vector: Vector, letter: str) -> tuple[Vector, int]:
        """Costs to finish before a turn from those behind it."""
        key = vector, letter
        found = self.known.get(key)
        if found is None:
            taken = tuple(
                min(cost + vector[to] for _, cost, to in self.edits(letter, s)) for s in range(4)
            )
            found = self.known[key] = lowered(inserted(taken))
        return found

    def trace(self, behind: Vector, letter: str, state: int) -> tuple[str, int, int]:
        """The edits up to and with a turn, their cost and the next state: of
        the cheapest ones the least text. A letter leads to one state, so the
        least letter at each step gives the least text."""
        key = behind, letter, state
        found = self.chosen.get(key)
        if found is None:
            before, least = self.back(behind, letter)
            text, cost, at = "", 0, state
            while True:
                left = before[state] + least - cost
                ways = [e for e in self.edits(letter, at) if e[1] + behind[e[2]] == left]
                more = _INSERT + before[_FILLED[at]] + least == left
                deleted = [w for w in ways if w[0] == "D"]
                if deleted or not more:
                    edit, price, to = deleted[0] if deleted else min(ways)
                    found = text + edit, cost + price, to
                    break
                text, cost, at = text + "I", cost + _INSERT, _FILLED[at]
            self.chosen[key] = found
        return found


def ending(state: int) -> str:
    """Inserts after the last turn."""
    return {_START: "", _ASSISTANT: "", _USER: "I", _SYSTEM: "II"}[state]


def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``<conv, turn, role, text, copy, gone>``: turns as they arrive, by
    ``crc32(conv:turn) % 20``: 0 loses the turn (it stays with ``gone``), 1 its
    text, 2 the sentence ends, 3 doubles it, 4 makes it the user's. Null counts
    as one blank, but for the order of turns."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank(conv), F.lit(":"), blank(turn)).cast("binary")) % 20
    words = blank(text)
    changed = (
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.regexp_replace(words, "[.!?]", ""))
        .otherwise(words)
    )
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(blank(role)).alias("role"),
        changed.alias("text"),
        F.explode(copies).alias("copy"),
        (kind == 0).alias("gone"),
    )


def _last_character(text: Column) -> Column:
    """The last character that is no ASCII blank, '' if there is none."""
    return F.right(F.rtrim(F.translate(text, "\t\n\x0b\x0c\r", "     ")), F.lit(1))


def with_faults(turns: DataFrame) -> DataFrame:
    """Add ``n`` (place in the conversation), ``block``, ``fault`` and
    ``letter``. Order is the turn (null first), then role and text; lost turns
    come last and have no letter."""
    order = [
        F.col("gone"),
        F.col("turn").asc_nulls_first(),
        F.col("role"),
        F.col("text"),
        F.col("copy"),
        F.col("line"),
    ]
    lined = turns.withColumn("line", F.monotonically_increasing_id())
    placed = settle(numbered(lined, order, "n", ["conv_key"]).drop("line", "copy"))
    same = ["conv_key", "role", "said"]
    placed = placed.withColumn("said", F.sha2("text", 256))
    first = placed.filter(~F.col("gone")).groupBy(*same).agg(
        F.min("n").alias("first"), F.count(F.lit(1)).alias("rows")
    )
    known = attach(placed.filter(~F.col("gone")), settle(first), same, "rows")
    end = _last_character(F.col("text"))
    fault = (
        F.when(end == "", "blank")
        .when(F.col("n") > F.col("first"), "duplicate")
        .when(~end.isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    initial = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("-")
    cut = F.when(initial == "-", "+").otherwise(F.upper(initial))
    letter = (
        F.when(F.col("fault").isin("blank", "duplicate"), "x")
        .when(F.col("fault") == "truncated", cut)
        .otherwise(initial)
    )
    found = (
        known.withColumn("fault", fault)
        .withColumn("initial", F.left("role", F.lit(1)))
        .withColumn("letter", letter)
        .drop("first", "rows", "said", "initial")
    )
    lost = placed.filter("gone").withColumns({"fault": F.lit(""), "letter": F.lit("")})
    return found.unionByName(lost.drop("said")).withColumn(
        "block", F.floor((F.col("n") - 1) / BLOCK_TURNS).cast("long")
    )


def _relay(blocks: DataFrame, walk, back: bool, guess: str) -> DataFrame:
    """Hand a value from block to block of each conversation.

    ``walk(letters, given, made, held)`` returns what a block makes of the
    value ``given`` by the block before it (or behind it, with ``back``); a
    block that had ``held`` and made ``made`` may stop early. ``guess`` is the
    speculative value of all blocks, the true one of the outermost. Adds
    ``given``, the true value of each block. Passes repeat until no block gets
    another value; a pass touches only the blocks that did.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = Costs()
        for batch in batches:
            columns = {c: batch[c].to_pylist() for c in batch.schema.names}
            made = [
                walk(costs, *values)
                for values in zip(*(columns[c] for c in ("input", "next", "made", "given")))
            ]
            columns |= {"given": columns["next"], "made": made}
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[c], t) for c, t in zip(names, types)], names
            )

    names = ["conv_key", "block", "rest", "input", "given", "made"]
    types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 3]
    schema = "conv_key string, block long, rest long, input string, given string, made string"
    start = blocks.select(
        "conv_key",
        "block",
        "rest",
        "input",
        F.lit(None).cast("string").alias("given"),
        F.lit(None).cast("string").alias("made"),
        F.lit(guess).alias("next"),
    )
    held = settle(start.mapInArrow(run, schema))
    while True:
        step = 1 if back else -1
        others = held.filter(f"block >= {int(back)}").select(
            "conv_key", (F.col("block") - step).alias("block"), F.col("made").alias("next")
        )
        # The outermost block keeps the guess; an inner one always has a giver.
        wrong = held.join(others, ["conv_key", "block"]).filter("next <> given")
        fixed = settle(wrong.select(*names, "next").mapInArrow(run, schema))
        if fixed.isEmpty():
            return held
        kept = held.join(fixed.select("conv_key", "block"), ["conv_key", "block"], "left_anti")
        held = settle(kept.unionByName(fixed))


def _text(vector: Vector) -> str:
    return ",".join(map(str, vector))


def _vector(text: str) -> Vector:
    return tuple(map(int, text.split(",")))


def walk_back(costs: Costs, letters: str, given: str, made: str | None, held: str | None) -> str:
    """The vector before a block. Where a walk from the old vector stands on
    the same one (constants aside), the rest of the way is known."""
    vector = _vector(given)
    if made is None:
        for letter in reversed(letters):
            vector, _ = costs.back(vector, letter)
        return _text(vector)
    old = _vector(held)
    for letter in reversed(letters):
        if vector == old:
            return made
        vector, _ = costs.back(vector, letter)
        old, _ = costs.back(old, letter)
    return _text(vector)


def traced(costs: Costs, letters: str, behind: Vector, state: int) -> tuple[list[str], int, int]:
    """Edits per turn, their cost and the last state of a block."""
    vectors = [behind]
    for letter in reversed(letters):
        vectors.append(costs.back(vectors[-1], letter)[0])
    edits, total = [], 0
    for letter, vector in zip(letters, reversed(vectors[:-1])):
        text, cost, state = costs.trace(vector, letter, state)
        edits.append(text)
        total += cost
    return edits, total, state


def walk_on(costs: Costs, held: str, given: str, made: str | None, before: str | None) -> str:
    """The state after a block; ``held`` has its vector and letters."""
    vector, letters = held.split(";")
    return str(traced(costs, letters, _vector(vector), int(given))[2])


def repaired(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    damage: bool = True,
) -> DataFrame:
    """``<conv, rows>`` with the turns of the cheapest repair; see ``repair``."""
    named = rows.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text"),
    )
    if damage:
        turns = damaged(named, "conv", "turn", "role", "text")
    else:
        blank = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
        turns = named.select(
            "conv", "turn", blank("role"), blank("text"),
            F.lit(0).alias("copy"), F.lit(False).alias("gone"),
        )
    # Conversations of any id type meet by its text; no id is one of its own.
    key = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("null"))
    found = settle(with_faults(turns.withColumn("conv_key", key)))
    alive = found.filter(~F.col("gone"))
    letters = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("n", "letter"))), lambda x: x["letter"]),
        "",
    )
    last = Window.partitionBy("conv_key")
    blocks = settle(
        alive.groupBy("conv_key", "block")
        .agg(letters.alias("input"))
        .withColumn("rest", F.max("block").over(last) - F.col("block"))
    )
    vectors = _relay(blocks, walk_back, True, _text(LAST))
    both = vectors.select(
        "conv_key", "block", "rest", F.concat_ws(";", "given", "input").alias("input")
    )
    states = _relay(both, walk_on, False, str(_START))

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = Costs()
        for batch in batches:
            edits = []
            for held, state, rest in zip(*(batch[c].to_pylist() for c in ("input", "given", "rest"))):
                vector, letters = held.split(";")
                made, _, end = traced(costs, letters, _vector(vector), int(state))
                if not rest and made:
                    made[-1] += ending(end)
                edits.append(made)
            yield pa.RecordBatch.from_arrays(
                [batch["conv_key"], batch["block"], batch["given"], pa.array(edits, pa.list_(pa.string()))],
                ["conv_key", "block", "state", "edits"],
            )

    told = states.mapInArrow(
        tell, "conv_key string, block long, state string, edits array<string>"
    )
    own = F.get("edits", (F.col("n") - 1 - F.col("block") * BLOCK_TURNS).cast("int"))
    joined = found.join(told, ["conv_key", "block"], "left")
    return joined.withColumn("edit", F.when(F.col("gone"), "").otherwise(own)).drop("edits", "state")


_REPORT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
_PAIRS = {"su", "ua", "au"}


class _Report:
    """Figures of one conversation, turn by turn in order; holds no texts."""

    def __init__(self, conv) -> None:
        self.conv = conv
        self.least = self.most = self.turn = None
        self.turns = self.illegal = self.cost = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.before: str | None = None
        self.state, self.audit = _START, []
        self.digest, self.lines = hashlib.sha256(), 0

    def line(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def add(self, turn, role: str, text: str, fault: str, edit: str) -> None:
        if turn is not None:
            if turn != self.turn:
                self.turns += 1
            self.turn, self.most = turn, turn
            self.least = turn if self.least is None else self.least
        if fault:
            self.faults[fault] += 1
        initial = role[:1]
        if self.before is not None and self.before + initial not in _PAIRS:
            self.illegal += 1
        self.before = initial
        self.audit.append(edit)
        late = _TRUNCATED if fault == "truncated" else 0
        for step in edit:
            if step == "I":
                self.line(_NAMES[_FILL[self.state]], "")
                self.cost += _INSERT
                self.state = _FILLED[self.state]
            elif step == "R":
                self.line(_NAMES[_FILL[self.state]], text)
                self.cost += _RENAME + late
                self.state = _FILLED[self.state]
            elif step == "K":
                self.line(role, text)
                self.cost += late
                self.state = _STEP[initial][self.state]
            else:
                self.cost += _DELETE

    def row(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (
            self.conv, gaps, *self.faults.values(), self.illegal, self.cost,
            "".join(self.audit), self.digest.hexdigest(),
        )


def repair(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    damage: bool = True,
) -> DataFrame:
    """``<conv, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256>`` per conversation of the input.

    ``damage`` first spoils the turns as ``damaged`` says. Null texts and roles
    are one blank, null turns come first and count in no gap, rows of a null id
    are one conversation. Ties of a turn are ordered by role and text, and
    repeated rows are duplicates. A conversation without turns has zeros, an
    empty audit and the hash of nothing; an empty table gives no rows. Other
    columns are ignored under any name. Blocks bound what a task holds at a
    time; the final digest reads a conversation in order, as a stream.
    """
    kind = rows.schema[conv_col].dataType
    found = repaired(rows, conv_col, turn_col, role_col, text_col, damage)
    ordered = found.repartition("conv_key").sortWithinPartitions("conv_key", "gone", "n")

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, done = None, None, []
        wanted = ("conv_key", "conv", "turn", "role", "text", "fault", "edit", "gone")

        def out() -> pa.RecordBatch:
            columns = list(zip(*done))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f) for c, f in zip(columns, types)], names
            )

        types = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
        names = ["conv", *(c.split()[0] for c in _REPORT.split(", "))]
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in wanted)):
                if held is None or row[0] != key:
                    if held is not None:
                        done.append(held.row())
                    key, held = row[0], _Report(row[1])
                if not row[7]:
                    held.add(*row[2:7])
            if len(done) >= 1000:
                yield out()
                done = []
        if held is not None:
            done.append(held.row())
        if done:
            yield out()

    from pyspark.sql.pandas.types import to_arrow_type

    conv_type = to_arrow_type(kind)
    made = ordered.select(
        "conv_key", "conv", "turn", "role", "text", "fault", "edit", "gone"
    ).mapInArrow(report, f"conv {kind.simpleString()}, {_REPORT}")
    return made.withColumnRenamed("conv", conv_col)
