"""Repair of conversations: the cheapest edits that leave turns in the order system?, then user and assistant in turn.

Each row becomes one letter for its fault and its role's initial, so a conversation is one short string, put together
from blocks of rows. Over it runs a dynamic program with one cost for each of the four states of the wanted order.
Costs to the end are kept only at about as many checkpoints as the square root of the length; on the way forward the costs
inside a block are worked out again from its end, and of all edits on a cheapest way the first in ASCII order is
taken at each step. Edits then meet their rows again in a join, spread evenly, so texts of one conversation are
never held together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.order import record_id
from .scratch import stored

# Costs of edits and of what stays cut off.
DELETE, INSERT, REROLE, CUT_OFF = 4, 3, 3, 3
BLOCK_ROWS = 4096  # rows whose letters are put together first

# Letters: 4 * fault + role. Faults: none, blank, duplicate, truncated. Roles: system, user, assistant, other.
LETTERS = "abcdefghijklmnop"
# States: nothing yet, after system, after user, after assistant. From each there is one turn that may be added.
ADDED = (1, 1, 2, 1)
STEP = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
ROLES = ("system", "user", "assistant")


class Repaired(NamedTuple):
    """conversations: a row each with its faults, cost and audit; turns: the repaired ones, numbered by `place`."""

    conversations: DataFrame
    turns: DataFrame


class Repairer:
    """The dynamic program. Cost vectors recur, so steps between them are remembered."""

    def __init__(self) -> None:
        self.vectors: list[tuple[int, ...]] = []
        self.numbers: dict[tuple[int, ...], int] = {}
        self.steps: dict[tuple[int, int], tuple[int, int]] = {}
        self.ways: dict[tuple[int, int, int], tuple[str, int]] = {}
        self.end, _ = self._number([0, 99, 99, 0])

    def _number(self, costs: list[int]) -> tuple[int, int]:
        """A number for the vector less its smallest cost, inserts allowed, and that cost."""
        for _ in range(3):
            costs = [min(c, INSERT + costs[STEP[s, ADDED[s]]]) for s, c in enumerate(costs)]
        low = min(costs)
        vector = tuple(c - low for c in costs)
        if vector not in self.numbers:
            self.numbers[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.numbers[vector], low

    def _choices(self, letter: int, state: int) -> list[tuple[str, int, int]]:
        """What can be done with a row: edit, cost and next state."""
        fault, role = divmod(letter, 4)
        out = [("D", DELETE, state)]
        if fault in (0, 3):
            cut = CUT_OFF if fault == 3 else 0
            if (state, role) in STEP:
                out.append(("K", cut, STEP[state, role]))
            out.append(("R", REROLE + cut, STEP[state, ADDED[state]]))
        return out

    def back(self, after: int, letter: int) -> tuple[int, int]:
        """The vector before a row, from that behind it, and what it has more."""
        if (after, letter) not in self.steps:
            v = self.vectors[after]
            self.steps[after, letter] = self._number([min(c + v[t] for _, c, t in self._choices(letter, s)) for s in range(4)])
        return self.steps[after, letter]

    def forth(self, after: int, letter: int, state: int) -> tuple[str, int]:
        """The first cheapest edits in ASCII order up to and with a row, and the state behind it."""
        if (after, letter, state) not in self.ways:
            before, more = self.back(after, letter)
            at, edits = state, ""
            while True:
                left = self.vectors[before][at] + more
                best = {e: t for e, c, t in self._choices(letter, at) if c + self.vectors[after][t] == left}
                added = STEP[at, ADDED[at]]
                if "D" not in best and INSERT + self.vectors[before][added] + more == left:
                    edits, at = edits + "I", added
                    continue
                edit = min(best)
                self.ways[after, letter, state] = edits + edit, best[edit]
                break
        return self.ways[after, letter, state]

    def repair(self, letters: list[int]) -> tuple[int, list[str]]:
        """The cost, and the edits up to and with each row; the last entry are those behind all rows."""
        n = len(letters)
        size = isqrt(n) + 1
        kept, at, cost = {}, self.end, 0
        for i in range(n - 1, -1, -1):
            if (i + 1) % size == 0 or i == n - 1:
                kept[i // size] = at
            at, more = self.back(at, letters[i])
            cost += more
        cost += self.vectors[at][0]
        state, edits = 0, []
        for block in range(len(kept)):
            low, high = block * size, min(n, (block + 1) * size)
            after = [kept[block]]
            for i in range(high - 1, low, -1):
                after.append(self.back(after[-1], letters[i])[0])
            for i in range(low, high):
                done, state = self.forth(after[high - 1 - i], letters[i], state)
                edits.append(done)
        edits.append("" if not n else {1: "II", 2: "I"}.get(state, ""))
        return cost, edits


def _illegal(roles: list[int]) -> int:
    return sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(roles, roles[1:], strict=False))


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    work = Repairer()
    for batch in batches:
        done = []
        for codes in batch.column("codes").to_pylist():
            letters = [ord(c) - 97 for c in codes]
            cost, edits = work.repair(letters)
            faults = [x >> 2 for x in letters]
            done.append((*(faults.count(k) for k in (1, 2, 3)), _illegal([x & 3 for x in letters]), cost, edits))
        names = ("blank", "duplicate", "truncated", "illegal", "cost")
        columns = [pa.array([d[i] for d in done], pa.int64()) for i in range(5)]
        columns.append(pa.array(["".join(d[5]) for d in done], pa.string()))
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names, "audit"])


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each conversation's audit: the turns left, with the row they come from (null: inserted) and a new role."""
    kind = [("__conv", pa.string()), ("place", pa.int64()), ("__at", pa.int64()), ("__role", pa.string())]
    out: list[tuple] = []

    def packed() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, (_, k) in enumerate(kind)], names=[n for n, _ in kind])
        out.clear()
        return batch

    for batch in batches:
        for conv, first, codes, audit in zip(*(batch.column(c).to_pylist() for c in ("__conv", "__first", "codes", "audit")), strict=True):
            state, row, place = 0, 0, 0
            for edit in audit:
                role = ord(codes[row]) - 97 & 3 if edit == "K" else ADDED[state]
                if edit != "D":
                    out.append((conv, place, None if edit == "I" else first + row, None if edit == "K" else ROLES[role]))
                    state, place = STEP[state, role], place + 1
                row += edit != "I"
                if len(out) == 10_000:
                    yield packed()
    if out:
        yield packed()


def repair(conversations: DataFrame) -> Repaired:
    """Faults, audit and repaired turns of conversations given as rows of conv_id, turn, role, text.

    Rows are taken by turn (nulls first), rows of one turn by role and text. A null role or text is one space; rows without
    conv_id are one conversation. Equal rows count each; other columns are left out; an empty table gives empty tables.
    `gaps` are the numbers missing between the smallest and the largest turn; `illegal` counts neighbours whose initials
    are not su, ua or au. A row's first fault counts: blank, duplicate (of an earlier row's role and text), truncated (the
    last solid character is none of `.!?`). A turn whose role has another initial can't be kept. One conversation may
    hold most rows: rows are sorted by ranges, letters are joined by blocks, and one letter a row is all that meets in
    a task. The last two take the space of the audit itself.
    """
    key = F.concat(F.when(F.col("conv_id").isNull(), "n").otherwise("v"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    rows = conversations.select("conv_id", key.alias("__conv"), "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    rows = record_id(rows, "__at", ["__conv", "turn", "role", "text"], start=0)
    rows = rows.withColumn("__same", F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256))
    firsts = rows.groupBy("__conv", "__same").agg(F.min("__at").alias("__one"), F.count(F.lit(1)).alias("__n")).filter("__n > 1").drop("__n")
    blank, whole = ~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(blank, 1).when(F.col("__at") > F.col("__one"), 2).when(~whole, 3).otherwise(0)
    role = F.instr(F.lit("sua"), F.substring("role", 1, 1))
    role = F.when((role == 0) | (F.col("role") == ""), 3).otherwise(role - 1)
    letter = F.substring(F.lit(LETTERS), 4 * fault + role + 1, F.lit(1))
    coded = rows.join(firsts, ["__conv", "__same"], "left").select("conv_id", "__conv", "turn", "__at", letter.alias("letter"))

    def joined(parts: str, order: str):
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, parts))), lambda x: x[parts]), "")

    blocks = coded.groupBy("conv_id", "__conv", F.expr(f"__at div {BLOCK_ROWS}").alias("block")).agg(joined("letter", "__at").alias("letters"), F.min("__at").alias("__first"))
    whole_ones = blocks.groupBy("conv_id", "__conv").agg(joined("letters", "block").alias("codes"), F.min("__first").alias("__first"))
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    spread = coded.groupBy("__conv").agg(gaps.alias("gaps"))
    plain = whole_ones.join(spread, "__conv").select("conv_id", "__conv", "__first", "gaps", "codes")
    types = ", ".join(f"{c} bigint" for c in ("blank", "duplicate", "truncated", "illegal", "cost"))
    named = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)
    planned = stored(plain.mapInArrow(_plans, f"{named}, {types}, audit string"), "repairs")

    edits = stored(planned.select("__conv", "__first", "codes", "audit").mapInArrow(_turns, "__conv string, place bigint, __at bigint, __role string"), "edits")
    kept = edits.filter("__at is not null").join(rows.select("__at", "role", "text"), "__at").select("__conv", "place", F.coalesce("__role", "role").alias("role"), "text")
    added = edits.filter("__at is null").select("__conv", "place", F.col("__role").alias("role"), F.lit("").alias("text"))
    return Repaired(planned.select("conv_id", "__conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"), kept.unionByName(added))


def text_hashes(turns: DataFrame) -> DataFrame:
    """`__conv` and the sha256 of its turns as `role:text` lines. A conversation's lines stream through one task in
    order, as the hash asks for; none is held."""
    lines = turns.select("__conv", "place", F.concat("role", F.lit(":"), "text").alias("line"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(done: list[tuple[str, str]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)], names=["__conv", "repaired_sha256"])

        conv, work = None, None
        for batch in batches:
            done = []
            for c, line in zip(batch.column("__conv").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if c != conv:
                    if work is not None:
                        done.append((conv, work.hexdigest()))
                    conv, work = c, hashlib.sha256(line.encode())
                else:
                    work.update(b"\n" + line.encode())
            if done:
                yield packed(done)
        if work is not None:
            yield packed([(conv, work.hexdigest())])

    return lines.repartition("__conv").sortWithinPartitions("__conv", "place").select("__conv", "line").mapInArrow(hashed, "__conv string, repaired_sha256 string")


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with known faults, by the crc32 of `conv_id:turn` modulo 20: 0 drops a row, 1 empties its text, 2 takes its
    `.!?` out, 3 repeats it, 4 makes it the user's. Nulls are one space (but a null conv_id or turn stays one)."""
    named = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id",)], F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")], (F.crc32(named) % 20).alias("__what"))
    what = F.col("__what")
    text = F.when(what == 1, "").when(what == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    twice = F.explode(F.when(what == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.filter("__what != 0").select("conv_id", "turn", F.when(what == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), twice.alias("__copy")).drop("__copy")


def digest(original: DataFrame, repaired: Repaired) -> DataFrame:
    """A row for every conv_id of `original`; those without rows in `repaired` have zeros and empty texts."""
    named = F.concat(F.when(F.col("conv_id").isNull(), "n").otherwise("v"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    all_ids = original.select("conv_id").distinct().withColumn("__conv", named)
    found = repaired.conversations.drop("conv_id").join(text_hashes(repaired.turns), "__conv", "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return all_ids.join(found, "__conv", "left").select(
        "conv_id", *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
